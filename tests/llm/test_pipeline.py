"""The pipeline's stages on whole small tables: what each keeps is what plain code keeps."""

from __future__ import annotations

import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers

from kinolytics.llm import quality, queries, toxicity


def plain_quality(spark, docs, labels):
    voters = quality.fit_quality(docs, labels)
    return {r["doc_id"] for r in docs.collect() if voters.scores(quality.terms((r["text"] or "").encode())[None, :])[0] >= 0.3}


def plain_toxicity(spark, docs, labels):
    chain = toxicity.fit_toxicity(docs, labels)
    return {r["doc_id"] for r in docs.collect() if chain.probabilities([toxicity.slots((r["text"] or "").encode())])[0, -1] < chain.threshold}


def plain_near_duplicates(spark, docs, labels):
    sets = {}
    for r in docs.collect():
        w = (r["text"] or "").encode().lower().split()
        sets[r["doc_id"]] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {k: k for k in sets}
    ids = sorted(sets)
    for n, b in enumerate(ids):
        for a in ids[:n]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {k for k, v in label.items() if k == v}


def plain_decontamination(spark, docs, labels, sf_dir="/root/testdata/sf0.001"):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    grams = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = words(r["text"])
        grams |= {tuple(w[k : k + min(10, len(w))]) for k in range(len(w) - min(10, len(w)) + 1)} if w else set()
    lengths = {len(g) for g in grams}
    hit = set()
    for r in docs.collect():
        w = words(r["text"])
        if any(tuple(w[k : k + n]) in grams for n in lengths for k in range(len(w) - n + 1)):
            hit.add(r["doc_id"])
    return {r["doc_id"] for r in docs.select("doc_id").collect()} - hit


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plain = {"quality": plain_quality, "toxicity": plain_toxicity, "near_duplicates": plain_near_duplicates, "decontamination": plain_decontamination}
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, sf_dir)
        assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), docs.schema)
        kept = {r["doc_id"] for r in out.collect()}
        assert kept == plain[name](spark, seen, labels), name
        assert len(kept) > seen.count() / 3
        seen = out
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 0], dtype="<u4") for r in seen.collect()}
    places, covered = {}, {k: 0 for k in ids}
    for r in corpus_pipeline.STAGES[-1][1](spark, seen, sf_dir).collect():
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        covered[r["doc_id"]] += r["length"]
    assert covered == {k: len(v) for k, v in ids.items()}
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024


def test_stages_take_odd_tables(spark, sf_dir):
    """Nulls in every column, repeated rows, clashing columns, and no rows at all."""
    kind = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "a b c", None, None, None), (1, "x " * 30, "en", "s", 60), (1, "x " * 30, "en", "s", 60), (2, "", None, None, 0)], kind)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == kind.names and out.count() <= docs.count(), name
        assert len({r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()}) == len({r["doc_id"] for r in docs.collect()})


def test_queries_have_contract_columns(spark, sf_dir):
    want = {
        "op2_url_filter": ["page_id", "host", "path", "rule", "verdict"],
        "op3_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
        "op5_simhash": ["doc_id", "fingerprint", "component_id"],
        "op7_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    }
    want |= {
        "op1_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
        "op4_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        "op6_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op8_quality": ["doc_id", "held_out", "score", "predicted"],
        "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op10_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    }
    assert set(want) == set(queries.QUERIES)
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, sf_dir).columns == columns
