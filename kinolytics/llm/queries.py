"""Registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolytics.llm.decontam import contamination
from kinolytics.llm.embed_dedup import embedding_groups
from kinolytics.llm.infill import infilled, restored
from kinolytics.llm.lm_score import lm_scores
from kinolytics.llm.packing import pack
from kinolytics.llm.quality import fit_quality, in_training, quality_score
from kinolytics.llm.simhash import simhash_groups
from kinolytics.llm.substring_dedup import repeated
from kinolytics.llm.token_counts import token_counts
from kinolytics.llm.toxicity import fit_toxicity, toxicity
from kinolytics.llm.url_filter import url_verdicts
from kinolytics.llm.vector_codes import codebooks_digest, vector_codes
from kinolytics.llm.warc import archived


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules of op2's contract.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text, by the stored counts at its prefixes; null texts count as empty."""
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"), "fit_chars")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every url; null urls have empty parts and are allowed."""
    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors within their labels, cosine 0.98 or more; unusable vectors link with nothing."""
    return embedding_groups(table(spark, sf_dir, "embeddings"), least=0.98)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every text by shingles of three words, up to three differing bits; texts without words have fingerprint zero."""
    return simhash_groups(table(spark, sf_dir, "documents"), width=3, most_bits=3)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every whole text; the model learns from rows that are not held out, null texts are the end token."""
    return lm_scores(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and benchmark items of every text, by windows of ten words; texts without words have none."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and looked up again by its URL; null html is an empty payload."""
    return archived(table(spark, sf_dir, "pages")).select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learnt from labels outside the held-out fold; empty texts are scored too."""
    docs = table(spark, sf_dir, "documents")
    voters = fit_quality(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(~in_training("doc_id"), F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality_score(voters, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text by the chain, learnt from labels outside the held-out fold; empty texts are scored too."""
    docs = table(spark, sf_dir, "documents")
    chain = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity(docs, chain).select("doc_id", F.coalesce(~in_training("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all texts' ids, packed into sequences of 1024; null texts are the end id alone."""
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), capacity=1024, end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text in the order of infilling, and the digest of the text that is rebuilt from it; null texts are empty and plain."""
    made = infilled(table(spark, sf_dir, "documents"), seed=42, percent=50, spm_percent=80)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text without those of 13-word windows that a document of a smaller id has; null texts have no words."""
    left = repeated(table(spark, sf_dir, "documents"), width=13)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all usable vectors by 16 codebooks of 64 entries after two rounds, with errors; vectors that are null or hold null or non-finite components go."""
    coded, books = vector_codes(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    return coded.withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))


QUERIES = {
    f.__name__: f
    for f in (op1_token_counts, op2_url_filter, op3_embedding_dedup, op4_lm_scoring, op5_simhash, op6_decontamination, op7_warc, op8_quality, op9_toxicity, op10_packing, op11_infill, op12_substring_dedup, op13_vector_codes)
}

SQL = {
    "op2_url_filter": r"""
        WITH parts AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest
            FROM pages),
        split AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts),
        judged AS (
            SELECT *, '.' || host AS h,
                   CASE WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                        WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
                        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                        WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
            FROM split)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
        FROM judged""",
    "op6_decontamination": r"""
        WITH low AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        doc AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
        item AS (
            SELECT CAST(item_id AS VARCHAR) AS item,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        places AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM item WHERE len(w) > 0),
        gram AS (SELECT DISTINCT item, n, array_to_string(w[k : k + n - 1], ' ') AS g FROM places),
        size AS (SELECT DISTINCT n FROM gram),
        win AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc, size WHERE len(w) >= n),
        found AS (SELECT doc_id, item, k, win.n AS n FROM win JOIN gram ON gram.n = win.n AND gram.g = array_to_string(w[k : k + win.n - 1], ' ')),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
        m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> head THEN head END AS refers_to
        FROM m""",
    "op11_infill": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                   sha256('42:' || CAST(doc_id AS VARCHAR)) AS h
            FROM documents),
        r AS (
            SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
                   CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4
            FROM d),
        c AS (
            SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 50 THEN 'plain' WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form,
                   array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s
            FROM r)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
        FROM c""",
    "op12_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, k, array_to_string(w[k : k + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13) x),
        gone AS (SELECT doc_id, k FROM win JOIN (SELECT g, min(doc_id) AS least FROM win GROUP BY g) f USING (g) WHERE least < doc_id),
        covered AS (SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS p FROM gone),
        word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op13_vector_codes": r"""
        WITH v AS (
            SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS c, row_number() OVER (ORDER BY vec_id) - 1 AS rn
            FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
        x AS MATERIALIZED (SELECT vec_id, rn, (i - 1) // (len(c) // 16) AS part, (i - 1) % (len(c) // 16) AS pos, c[i] AS x FROM (SELECT *, unnest(range(1, len(c) + 1)) AS i FROM v) y),
        b0 AS MATERIALIZED (SELECT part, rn AS entry, pos, x FROM x WHERE rn < 64),
        a0 AS MATERIALIZED (
            SELECT vec_id, part, min(e * 64 + entry) % 64 AS entry, min(e * 64 + entry) // 64 AS e
            FROM (SELECT x.vec_id, x.part, b.entry, sum((x.x - b.x) * (x.x - b.x))::BIGINT AS e FROM x JOIN b0 b USING (part, pos) GROUP BY ALL) z GROUP BY ALL),
        m1 AS (SELECT part, entry, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM x JOIN a0 USING (vec_id, part) GROUP BY ALL),
        b1 AS MATERIALIZED (SELECT part, entry, pos, coalesce(m.x, b.x) AS x FROM b0 b LEFT JOIN m1 m USING (part, entry, pos)),
        a1 AS MATERIALIZED (
            SELECT vec_id, part, min(e * 64 + entry) % 64 AS entry, min(e * 64 + entry) // 64 AS e
            FROM (SELECT x.vec_id, x.part, b.entry, sum((x.x - b.x) * (x.x - b.x))::BIGINT AS e FROM x JOIN b1 b USING (part, pos) GROUP BY ALL) z GROUP BY ALL),
        m2 AS (SELECT part, entry, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM x JOIN a1 USING (vec_id, part) GROUP BY ALL),
        b2 AS MATERIALIZED (SELECT part, entry, pos, coalesce(m.x, b.x) AS x FROM b1 b LEFT JOIN m2 m USING (part, entry, pos)),
        a2 AS MATERIALIZED (
            SELECT vec_id, part, min(e * 64 + entry) % 64 AS entry, min(e * 64 + entry) // 64 AS e
            FROM (SELECT x.vec_id, x.part, b.entry, sum((x.x - b.x) * (x.x - b.x))::BIGINT AS e FROM x JOIN b2 b USING (part, pos) GROUP BY ALL) z GROUP BY ALL),
        coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INT)), '' ORDER BY part) AS code, sum(e)::BIGINT AS error FROM a2 GROUP BY vec_id),
        digest AS (SELECT sha256(coalesce(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos), '')) AS h FROM b2)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM coded JOIN v USING (vec_id), digest""",
}
