"""Each operator on odd rows (nulls, empty and long texts, ties, repeats, empty tables, clashing columns) and against brute force."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

from kinolytics.llm import decontam, embed_dedup, lm_score, near_text, packing, quality, simhash, token_counts, toxicity, url_filter, warc

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, n_tokens string, host string, score string, `group` string"
LONG = "la maison bleue est grande. " * 3000
TEXTS = [None, "", " ", "The cat sat.", "The cat sat.", "it's <|endoftext|> 'Tis  a\n\ttest!!", "İstanbul éa 日本語", LONG, LONG + "fin", "x" * 300]


def docs(spark, texts=TEXTS, start=0):
    return spark.createDataFrame([(start + k, t, "a", "b", "c", "d") for k, t in enumerate(texts)], DOCS)


def words(t):
    return (t or "").encode().lower().split()


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def components(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in range(n):
                if a != b and linked(a, b) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_token_counts(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    got = by_id(token_counts.token_counts(docs(spark), WORD, limit=5))
    for k, text in enumerate(TEXTS):
        text = text or ""
        assert got[k]["n_tokens"] == len(t.encode(text, add_special_tokens=False).ids)
        assert got[k]["n_bytes"] == len(text.encode()) and len(got[k]["prefix_tokens"]) == len(text)
        for j in range(1, min(len(text), 60) + 1):
            assert got[k]["prefix_tokens"][j - 1] == len(t.encode(text[:j], add_special_tokens=False).ids)
        fit = [j for j in range(len(text) + 1) if j == 0 or got[k]["prefix_tokens"][j - 1] <= 5]
        assert got[k]["fit_chars"] == max(fit)
    assert token_counts.token_counts(docs(spark, []), WORD).count() == 0
    asked = by_id(token_counts.token_counts(docs(spark), WORD).select("doc_id", "prefix_tokens", token_counts.fits("prefix_tokens", 5).alias("fit"), token_counts.tokens_before("prefix_tokens", 7).alias("seven"), token_counts.tokens_before("prefix_tokens", 0).alias("none")))
    for k in range(len(TEXTS)):
        counts = asked[k]["prefix_tokens"]
        assert asked[k]["fit"] == got[k]["fit_chars"] and asked[k]["none"] == 0 and asked[k]["seven"] == (counts[min(7, len(counts)) - 1] if counts else 0)


def test_prefix_counts_of_characters_that_change_when_normalised():
    from tokenizers import Tokenizer

    t, counter = Tokenizer.from_file(WORD), token_counts.PrefixCounter(WORD)
    parts = ["it's", "'", "'re", "r", "e\u0301", "\u0323", "か\u3099", "\u3000", "\xa0", "İ", "Σ", "한", "\u1112\u1161\u11ab", "<|endoftext|>", "<|end", "ﬁ", "\u212b", "\u0958", "２", "\U0001f602", "\x1c", "the", "\n", "\u212a"]
    draw = np.random.default_rng(3)
    texts = ["".join(draw.choice(parts, draw.integers(1, 12))) for _ in range(400)] + ["".join(draw.choice(["か", "\u3099", "は"], 200)), "".join(draw.choice(["!", "\u0301", "?"], 200))]
    for x in texts:
        assert counter.prefixes(x.encode()).tolist() == [len(t.encode(x[:j], add_special_tokens=False).ids) for j in range(1, len(x) + 1)], ascii(x)


def test_prefix_counts_of_long_stretches_take_linear_time():
    from time import process_time

    from tokenizers import Tokenizer

    t, counter = Tokenizer.from_file(WORD), token_counts.PrefixCounter(WORD)
    for x in ["日本語は" * 5000 + "\u3000日本", "e\u0301" * 10000, "a" + "\u0301" * 20000, "x" * 100_000 + "İ", " " * 1_000_000 + "a"]:
        began = process_time()
        assert counter.prefixes(x.encode())[-1] == len(t.encode(x, add_special_tokens=False).ids)
        assert process_time() - began < 5  # quadratic: minutes


def test_another_vocabulary_is_refused():
    with pytest.raises(ValueError, match="normaliser"):
        token_counts.PrefixCounter(BYTE)


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/es/"), ("allow", "net/es/"), ("block", "é.com/ü"), ("allow", "com/ü")]
URLS = [None, "", "no scheme", "http://Example.COM/en/a?x#y", "https://www.example.com/en/", "https://a.www.example.com/en", "ftp://x.net/es/q", "http://badexample.com/en/", "http://example.com", "http://h.net#/es/", "x://é.com/ü?", "http://example.com/en/a?x#y", "http://example.com/en/a?x#y", "http://é.com/üü", "http://a.com/" + "p" * 100_000, "http://" + "a." * 300 + "net/es/"]


def test_url_filter_and_join_agree(spark):
    urls = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(URLS)], "page_id bigint, url string, rule string")
    got = by_id(url_filter.url_verdicts(urls, RULES), "page_id")
    rules = spark.createDataFrame(RULES, "verdict string, rule string")
    joined = by_id(url_filter.joined_verdicts(urls, rules), "page_id")
    held = url_filter.checked_rules(RULES)
    for k, u in enumerate(URLS):
        host, path = url_filter.split_url(u)
        fits = [r for r in {r for _, r in RULES} if (h := r.split("/", 1)) and (host == h[0] or host.endswith("." + h[0])) and path.startswith("/" + h[1])]
        best = max(fits, key=len, default=None)
        want = (host, path, best, "block" if best and held[best.encode()] else "allow")
        assert tuple(got[k])[1:] == want, u
        assert tuple(joined[k])[1:] == want, u
    for wrong in (("allow", "nohost"), ("maybe", "a/")):
        table = spark.createDataFrame([wrong], "verdict string, rule string")
        for form in (url_filter.url_verdicts, url_filter.joined_verdicts):
            with pytest.raises(ValueError, match="not a rule"):
                form(urls, table)
    assert url_filter.url_verdicts(urls.limit(0), RULES).count() == 0 and url_filter.joined_verdicts(urls.limit(0), rules).count() == 0
    assert url_filter.url_verdicts(urls.limit(0), RULES).count() == 0


def test_digest_array_collisions(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "key_digests", lambda keys: np.array([len(k) for k in keys], dtype=np.uint64))
    url_filter.DigestArray.write(str(tmp_path / "a"), {b"ab/": True, b"cd/": False, b"xyz/": True})
    a = url_filter.DigestArray(str(tmp_path / "a"))
    at = a.find([b"cd/", b"ab/", b"ef/", b"xyz/", b"zzzzzz/"])
    assert at[2] == at[4] == -1 and len({at[0], at[1], at[3]}) == 3


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    rows = [(k, (base[k % 40] + 0.05 * rng.normal(size=16) * (k >= 40)).astype("f4").tolist(), k % 40 % 3, "x") for k in range(400)]
    rows += [(400, rows[3][1], rows[3][2], "x"), (401, None, 1, "x"), (402, [0.0] * 16, 1, "x"), (403, [float("nan")] * 16, 1, "x"), (404, rows[3][1], None, "x"), (405, [1.0], 1, "x"), (406, [], 1, "x"), (407, [None] * 16, 1, "x")]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>, label int, n_links string")
    got = by_id(embed_dedup.embedding_groups(df), "vec_id")
    u = {r[0]: np.array(r[1], dtype=float) for r in rows if r[0] <= 400}
    u = {k: v / np.linalg.norm(v) for k, v in u.items()}
    links = {k: {j for j in u if j != k and rows[j][2] == rows[k][2] and u[k] @ u[j] >= 0.98} for k in u}
    found, real = sum(got[k]["n_links"] for k in u), sum(map(len, links.values()))
    assert 0.9 * real <= found <= real
    assert all(got[k]["n_links"] <= len(links[k]) for k in u)
    assert got[400]["component_id"] == got[3]["component_id"] and got[3]["n_links"] >= 1
    for k in range(401, 408):
        assert tuple(got[k]) == (k, 0, k, True)
    assert embed_dedup.embedding_groups(df.limit(0)).count() == 0


def test_embedding_recall_by_dimension(spark):
    """Pairs just above the least cosine, in vectors of 8 to 64 dimensions and in few longer or shorter ones, in one table."""
    rng = np.random.default_rng(12)
    rows, pairs = [], Counter()
    for size, n in ((8, 150), (16, 150), (32, 150), (64, 400), (1100, 30)):
        for _ in range(n):
            a = rng.normal(size=size)
            a /= np.linalg.norm(a)
            b = rng.normal(size=size)
            b -= (a @ b) * a
            cosine = 0.98 + 0.004 * rng.random()
            b = cosine * a + math.sqrt(1 - cosine**2) * b / np.linalg.norm(b)
            rows += [(len(rows), a.tolist(), size), (len(rows) + 1, (3 * b).tolist(), size)]
            pairs[size] += 1
    df = spark.createDataFrame([(k, v, 1) for k, v, _ in rows], "vec_id bigint, embedding array<double>, label int")
    got = by_id(embed_dedup.embedding_groups(df), "vec_id")
    for size, n in pairs.items():
        ids = [k for k, _, s in rows if s == size]
        unit = np.array([v for _, v, s in rows if s == size])
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        real = (unit @ unit.T >= 0.98).sum() - len(ids)
        found = sum(got[k]["n_links"] for k in ids)
        assert 0.9 * real <= found <= real, size


def test_embedding_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    one = rng.normal(size=8)
    rows = [(k, (one + 0.02 * rng.normal(size=8)).tolist(), 0) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    whole = sorted(map(tuple, embed_dedup.embedding_groups(df).collect()))
    monkeypatch.setattr(embed_dedup, "BLOCK", 7)
    assert sorted(map(tuple, embed_dedup.embedding_groups(df).collect())) == whole


def test_lm_counts_and_normalisation(spark):
    texts = [*TEXTS[:7], "a b c d e f g " * 40, "b c d " * 30]
    got = by_id(lm_score.lm_scores(docs(spark, texts)))
    c = Counter()
    for k, t in enumerate(texts):
        if zlib.crc32(str(k).encode()) % 7 != 2:
            c.update([*words(t), b"\n"])
    n, v = sum(c.values()), len(c)
    for k, t in enumerate(texts):
        own = [*words(t), b"\n"]
        assert got[k]["train_tokens"] == n and got[k]["n_tokens"] == len(own) and got[k]["n_known"] == sum(c[w] > 0 for w in own)
        assert got[k]["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own))
        assert got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 7 == 2) and math.isfinite(got[k]["score"])
    assert got[7]["score"] > got[7]["base_score"]
    assert lm_score.lm_scores(docs(spark, [])).count() == 0
    m = lm_score.Model.start(np.arange(1.0, 6.0)).trained(np.full(5000, (1 * 6 + 2) * 6 + 3), np.full(5, 0.2), 1)
    s = np.arange(5)
    assert np.exp(m.log_probabilities(np.full(5, 1), np.full(5, 2), s)).sum() == pytest.approx(1, abs=1e-5)


def test_lm_scores_equal_plain_sums_and_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", 3)
    monkeypatch.setattr(lm_score, "LEAST_DRAWS", 9000)
    monkeypatch.setattr(lm_score, "TRAINER_BYTES", 2000)
    rng = np.random.default_rng(4)
    texts = [None, "", *(" ".join(f"w{k}" for k in rng.zipf(1.5, int(rng.integers(1, 60))) % 50) for _ in range(60))]
    df = docs(spark, texts)
    got = by_id(lm_score.lm_scores(df))
    other = by_id(lm_score.lm_scores(df.repartition(7)))
    assert all(tuple(got[k]) == pytest.approx(tuple(other[k]), rel=1e-9) for k in got)
    scorer, _, counts = lm_score.fit_lm(lm_score.dealt_rows(df, "doc_id", "text"))
    c = {bytes(r["word"]): r["c"] for r in counts.collect()}
    m = scorer.model
    for k, t in enumerate(texts):
        total, before = 0.0, [len(m.b), len(m.b)]  # the two places before the first word
        for w in [*words(t), b"\n"]:
            s = scorer.symbol_of(w)
            scores = m.q @ (m.r[before[-2]] @ m.c[0] + m.r[before[-1]] @ m.c[1]) + m.b
            total += (scores[s] - np.log(np.exp(scores.astype(float)).sum())) / math.log(10)
            if s >= len(scorer.symbols):
                at = s - len(scorer.symbols)
                total += math.log10((c.get(w, 0) + 1) / (scorer.class_n[at] + scorer.class_v[at] + 1))
            before.append(s)
        assert got[k]["score"] == pytest.approx(total, rel=1e-4, abs=1e-4)


def test_lm_draws_every_token_equally_often():
    rng = np.random.default_rng(3)
    documents = [rng.integers(0, 6, n) for n in (1, 2, 40, 0, 7)]
    stream = np.concatenate([lm_score.packed(d, 6) for d in documents])
    plain = sorted((p[k] * 7 + p[k + 1]) * 7 + p[k + 2] for d in documents for p in [[6, 6, *d.tolist()]] for k in range(len(d)))
    triples = lm_score.triples_of(stream, 6)
    assert triples.tolist() == plain
    drawn = np.concatenate([lm_score.draws(triples, 4, k) for k in range(lm_score.ROUNDS)])
    passes = -(-lm_score.LEAST_DRAWS // len(plain))
    assert np.sort(drawn).tolist() == np.repeat(plain, passes).tolist()
    many = np.arange(lm_score.LEAST_DRAWS + 1)
    assert np.array_equal(np.sort(np.concatenate([lm_score.draws(many, 0, k) for k in range(lm_score.ROUNDS)])), many)


@pytest.mark.parametrize("trainer_bytes", [32 << 20, 500_000])
def test_lm_beats_the_base_on_held_out_documents(spark, monkeypatch, trainer_bytes):
    monkeypatch.setattr(lm_score, "TRAINER_BYTES", trainer_bytes)
    got = lm_score.lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").toPandas()
    gain = (got.score.sum() - got.base_score.sum()) / got.n_tokens.sum()
    better = (got.score > got.base_score).mean()
    assert gain > 0.18 and better > 0.97, (gain, better)
    print("gain", gain, "better", better)


def test_golay_code_meets_all_within_three_bits():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    y = x.copy()
    for k in range(len(y)):
        for b in rng.choice(64, k % 4, replace=False):
            y[k] ^= np.uint64(1) << np.uint64(b)

    def sides(p):
        out = [[set(), set()] for _ in p]
        for r, key, probe in zip(*simhash.keys_of(p), strict=True):
            out[r][int(probe)].add(key)
        return out

    assert all(a[0] & b[1] and a[1] & b[0] for a, b in zip(sides(x), sides(y), strict=True))


@pytest.mark.parametrize("block", [2048, 3])
def test_simhash_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = list(TEXTS)
    for _ in range(8):
        base = list(rng.choice(vocabulary, 400))
        for _ in range(6):
            copy = list(base)
            copy[int(rng.integers(400))] = "changed"
            texts.append(" ".join(copy))

    def brute(t):
        w = words(t)
        s = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    p = [brute(t) for t in texts]
    label = components(len(p), lambda a, b: (p[a] ^ p[b]).bit_count() <= 3)
    got = by_id(simhash.simhash_groups(docs(spark, texts)))
    assert [got[k]["fingerprint"] for k in range(len(p))] == [f"{x:016x}" for x in p]
    assert [got[k]["component_id"] for k in range(len(p))] == label
    assert simhash.simhash_groups(docs(spark, [])).count() == 0


@pytest.mark.parametrize("block", [2048, 5])
def test_near_copies_of_many_changed_words(spark, monkeypatch, block):
    """Copies of similarity 0.83 and more go, texts that share nothing or a half stay."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(8)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts, want = [None, "", "one", "one"], {0, 2}
    for _ in range(25):
        base = list(rng.choice(vocabulary, int(rng.integers(150, 500))))
        want.add(len(texts))
        texts.append(" ".join(base))
        for _ in range(2):
            copy = list(base)
            for k in rng.choice(len(copy), len(copy) // 60, replace=False):
                copy[int(k)] = "changed"
            texts.append(" ".join(copy))
        want.add(len(texts))
        texts.append(" ".join(base[: len(base) // 2] + list(rng.choice(vocabulary, len(base) // 2))))
    kept = {r["doc_id"] for r in near_text.keep_first(docs(spark, texts)).collect()}
    assert kept == want
    assert near_text.similar_groups(docs(spark, [])).count() == 0


@pytest.mark.parametrize(("few", "block"), [(8, 4096), (0, 3)])
def test_near_copies_against_brute_force(spark, monkeypatch, few, block):
    """Pairs between 0.65 and 0.9, short texts and repeated lines: linked by the exact similarity of distinct shingles, no more and no fewer, in blocks of any size."""
    monkeypatch.setattr(near_text, "FEW", few)
    monkeypatch.setattr(near_text, "BLOCK", block)
    rng = np.random.default_rng(11)
    vocabulary = [f"w{k}" for k in range(5000)]
    texts = [None, "", "a b c d e f g h", "a b c d e f g i", "a b c d e f g h i", "one two"]
    line = "the same line again and again "
    texts += [line * 50 + " ".join(rng.choice(vocabulary, 30)) for _ in range(3)] + [line * n + "end" for n in (2, 3, 90)]
    for _ in range(40):
        base = list(rng.choice(vocabulary, int(rng.integers(12, 300))))
        texts.append(" ".join(base))
        for share in (0.65, 0.7, 0.75, 0.79, 0.8, 0.81, 0.85, 0.9):
            # without its last words a text keeps this share of its shingles
            texts.append(" ".join(base[: round(share * (len(base) - 4)) + 4]))
            copy = list(base)
            for k in rng.choice(len(copy), max(1, round(len(copy) * (1 - share) / 9)), replace=False):
                copy[int(k)] = f"x{rng.integers(10**9)}"
            texts.append(" ".join(copy))
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := words(t)) else set() for t in texts]
    label = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            # in whole numbers: 0.8 is 4 / 5
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((label[a], label[b]))
                label = [x if z == y else z for z in label]
    got = by_id(near_text.similar_groups(docs(spark, texts)))
    assert [got[k]["component_id"] for k in range(len(texts))] == label
    assert {r["doc_id"] for r in near_text.keep_first(docs(spark, texts)).collect()} == set(label)


def test_decontamination(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    items = spark.createDataFrame([(7, item), (12, item + " and more words here"), (3, "short item"), (4, None), (5, "!!"), (None, "x y")], "item_id int, text string")
    texts = [None, "", "nothing", f"Before. {item.upper()}, after", "two three four five six seven eight nine ten eleven twelve", "a Short-ITEM b short item", item + " " + item, "one two three", "éa " + "one two three four five six seven eight nine ten, é"]
    rows = by_id(decontam.contamination(docs(spark, texts), items))
    hit = {k: (r["n_words"], r["n_hit"], r["items"]) for k, r in rows.items()}
    assert hit == {0: (0, 0, []), 1: (0, 0, []), 2: (1, 0, []), 3: (14, 12, ["12", "7"]), 4: (11, 11, ["12", "7"]), 5: (6, 4, ["3"]), 6: (24, 24, ["12", "7"]), 7: (3, 0, []), 8: (12, 10, ["12", "7"])}
    assert [tuple(s) for s in rows[5]["spans"]] == [(1, 3), (4, 6)]
    twice = docs(spark, texts).union(docs(spark, texts))
    left = [r["doc_id"] for r in decontam.decontaminate(twice, items).collect()]
    assert sorted(left) == sorted([0, 1, 2, 7] * 2)
    cut = by_id(decontam.decontaminate(docs(spark, texts), items, remove="spans"))
    assert cut[3]["text"] == "Before. after" and cut[5]["text"] == "a b " and cut[2]["text"] == "nothing" and cut[0]["text"] is None
    assert decontam.contamination(docs(spark, []), items).count() == 0 and decontam.contamination(docs(spark, texts), items.limit(0)).filter("n_hit > 0").count() == 0


def test_warc_round_trip(spark):
    html = [None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "é" * 50, "é" * 50, "<p>a</p>" * 10_000]
    urls = [None, "http://www.a.com/1", "http://b.a.com/2?x", "http://www.a.com/1", "no scheme", "http://é.org/\r\nx", "http://a.com", "http://a.com", "https://A.com/Z#f"]
    pages = spark.createDataFrame([(9 - k, u, h, "clash") for k, (u, h) in enumerate(zip(urls, html, strict=True))], "page_id bigint, url string, html string, file string")
    got = by_id(warc.archived(pages), "page")
    data = {9 - k: (h or "").encode() for k, h in enumerate(html)}
    for k, d in data.items():
        first = min(j for j, x in data.items() if x == d)
        again = len(d) >= 100 and k != first
        assert (got[k]["payload_bytes"], got[k]["payload_digest"]) == (len(d), hashlib.sha256(d).hexdigest())
        assert (got[k]["record_type"], got[k]["refers_to"]) == (("revisit", first) if again else ("response", None))
        assert got[k]["payload"] == (None if again else bytearray(d))
    assert warc.archived(pages.limit(0)).count() == 0


def test_warc_index_search(spark, monkeypatch):
    from kinolytics.llm.common import shared_dir

    monkeypatch.setattr(warc, "BLOCK_ENTRIES", 3)
    pages = spark.createDataFrame([(k, f"http://h{k % 5}.a.com/p{k % 11}", f"body {k}") for k in range(60)], "page_id bigint, url string, html string")
    folder = shared_dir(spark)
    warc.build_index(warc.write_archives(pages, folder), folder)
    for k in range(5):
        want = sorted(f"body {j}" for j in range(60) if j % 5 == k and j % 11 == k)
        assert sorted(p.decode() for _, p in warc.captures(folder, f"com,a,h{k})/p{k}")) == want
    assert warc.captures(folder, "com,zzz)/") == []
    keys = spark.createDataFrame([("com,a,h1)/p1",), ("com,a,h1)/p1",), ("com,a,h2)/p7",), ("none)/",), (None,)], "key string")
    found = {bytes(r["payload"]).decode() for r in warc.looked_up(keys, folder).collect()}
    assert found == {f"body {j}" for j in range(60) if (j % 5, j % 11) in ((1, 1), (2, 7))}
    # only the blocks that may hold a key are read
    blocks = warc.directory_rows(folder, "", "z")
    assert len(blocks) >= 20 and all(len(ks) == 1 for *_, ks in warc.blocks_of(["com,a,h1)/p1"], blocks)) and len(warc.blocks_of(["com,a,h1)/p1"], blocks)) <= 2
    member = warc.record(7, "http://a.com/", "response", "d", 3, b"abc", None)
    import gzip

    text = gzip.decompress(member)
    assert b"application/http" in text and b"\r\n\r\nHTTP/1.1 200 OK\r\n" in text and warc.parsed(member)[1] == b"abc"
    fields, empty = warc.parsed(warc.record(8, "http://b.com/", "revisit", "d", 3, b"", 7))
    assert empty == b"" and fields["WARC-Refers-To"] == warc.parsed(member)[0]["WARC-Record-ID"]
    twice = pages.union(pages)
    again = warc.archived(twice).groupBy("page").count().collect()
    assert len(again) == 60 and {r["count"] for r in again} == {2}


def test_quality_votes_against_plain_loops():
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma!", "d3lta", "| x", "%%%"], int(rng.integers(1, 30)))).encode() for _ in range(90)] + [b"", b"alpha"] * 3
    x = np.array([quality.terms(t) for t in texts])
    y = np.array([float(b"%" in t) for t in texts])
    v = quality.Voters(x, y)

    def latent(row):
        out = np.log1p(row) * np.log1p(len(x) / np.maximum((x > 0).sum(axis=0), 1))
        for part in (slice(0, quality.FORM), slice(quality.FORM, None)):
            out[part] /= max(np.linalg.norm(out[part]), 1e-12)
        out[quality.FORM :] *= quality.GRAM_WEIGHT
        out = (out / max(np.linalg.norm(out), 1e-12)) @ v.axes
        return out / max(np.linalg.norm(out), 1e-12)

    held = [latent(r) for r in x]
    for k, score in enumerate(v.scores(x)):
        cosines = np.array([held[k] @ h for h in held])
        near = np.sort(cosines)[::-1][: quality.NEIGHBOURS]
        # rows at the same cosine as the last neighbour may change places: the score lies between the extremes
        sure, edge = cosines > near[-1] + 1e-5, np.abs(cosines - near[-1]) <= 1e-5
        left = quality.NEIGHBOURS - sure.sum()
        weight = np.maximum(cosines, 0) ** quality.SHARPNESS + 1e-9
        low, high = ((weight[sure] @ y[sure] + weight[edge].max() * votes) / (weight[sure].sum() + weight[edge].max() * left) for votes in (max(0, left - (1 - y[edge]).sum()), min(left, y[edge].sum())))
        assert low - 1e-3 <= score <= high + 1e-3
    weighted = v.weighted(x)
    best = np.linalg.svd(weighted)[1][: v.axes.shape[1]]
    assert np.linalg.norm(weighted @ v.axes) >= 0.999 * np.linalg.norm(best)
    assert quality.Voters(x[:0], y[:0]).scores(x[:3]).tolist() == [0.5] * 3


def test_toxicity_chain_against_plain_loops():
    rng = np.random.default_rng(10)
    bad = [[f"bad{g}{k}" for k in range(4)] for g in range(3)]
    texts, y = [], []
    for k in range(400):
        words_ = list(rng.choice([f"w{j}" for j in range(80)], 12))
        y.append(float(k % 4 == 0))
        texts.append(" ".join(words_ + (list(rng.choice(bad[k % 3], 2)) if y[-1] else [])).encode())
    rows = [toxicity.slots(t) for t in texts]
    y = np.array(y)
    group = toxicity.toxic_groups(rows, y > 0)
    assert set(group[y == 0]) == {-1} and 1 <= len(set(group[y > 0])) <= 4
    n = group.max() + 1
    chain = toxicity.fit_chain(rows, np.stack([*(group == k for k in range(n)), y], axis=1).astype(float), [*(f"c{k}" for k in range(n)), "toxic"])
    got = chain.probabilities([*rows, np.zeros(0, dtype=np.int32)])
    for k, r in enumerate([*rows[:50], []]):
        p = []
        for c, w in enumerate(chain.weights):
            z = w[-1] + sum(w[chain.chosen[s]] for s in r if chain.chosen[s] >= 0) + sum(p[j] * w[len(w) - 1 - c + j] for j in range(c))
            p.append(1 / (1 + math.exp(-z)))
        assert got[k if len(r) else -1] == pytest.approx(p, abs=1e-6)
    assert ((got[:-1, -1] >= chain.threshold) == (y > 0)).mean() > 0.97


def test_models_see_each_id_once(spark):
    """Repeated ids, texts and labels, clashing columns and empty tables: what reaches the driver stays bounded."""
    d = spark.createDataFrame([(k % 3, f"text number {k}", "q") for k in range(30)], "doc_id bigint, text string, quality string")
    labels = spark.createDataFrame([(k % 3, k % 2, k % 2, "t") for k in range(30)] + [(None, 1, 1, "t"), (1, None, None, "t")], "doc_id bigint, quality int, toxic int, text string")
    want = sum(2 for k in range(3) if zlib.crc32(str(k).encode()) % 5)
    assert len(quality.fit_quality(d, labels).labels) == want
    for a, b in ((d, labels), (d.limit(0), labels), (d, labels.limit(0))):
        voters, chain = quality.fit_quality(a, b), toxicity.fit_toxicity(a, b)
        twice = docs(spark).union(docs(spark))
        assert quality.keep_good(twice.limit(0), voters).count() == 0 and toxicity.keep_clean(twice.limit(0), chain).count() == 0
        scores = twice.select("doc_id", quality.quality_score(voters, twice["text"]).alias("s")).collect()
        assert len(scores) == 2 * len(TEXTS) and len({(r["doc_id"], r["s"]) for r in scores}) == len(TEXTS)


def test_quality_and_toxicity_on_held_out_rows(spark):
    base = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    voters, chain = quality.fit_quality(d, labels), toxicity.fit_toxicity(d, labels)
    rows = d.join(labels, "doc_id").filter(~quality.in_training("doc_id"))
    q = rows.select("quality", (quality.quality_score(voters, rows["text"]) >= 0.3).cast("int").alias("p")).collect()
    assert np.mean([r["p"] == r["quality"] for r in q]) > 0.95
    assert chain.categories[-1] == "toxic" and len(chain.categories) > 1
    t = toxicity.toxicity(rows, chain).join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in t]) > 0.9
    odd = toxicity.toxicity(docs(spark), chain).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in odd)
    own = docs(spark)
    scores = own.select(quality.quality_score(voters, own["text"]).alias("s")).collect()
    assert len(scores) == len(TEXTS) and all(0 <= r["s"] <= 1 for r in scores)
    nothing = toxicity.fit_toxicity(d, labels.limit(0))
    assert toxicity.toxicity(docs(spark), nothing).filter("predicted = 1").count() == 0
    assert quality.keep_good(docs(spark), quality.fit_quality(d, labels.limit(0))).count() == len(TEXTS)


def test_packing(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE)
    rows = packing.pack(docs(spark), BYTE, public_tokenizers.path("byte_bpe_50k.tiktoken"), capacity=64).collect()
    ids = {k: [*t.encode(x or "", add_special_tokens=False).ids, 0] for k, x in enumerate(TEXTS)}
    back: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == len(back.setdefault(r["doc_id"], [])) and 0 < r["length"] <= 64 and r["doc_tokens"] == len(ids[r["doc_id"]])
        back[r["doc_id"]] += np.frombuffer(r["ids"], dtype="<u4").tolist()
    assert back == ids
    seq: dict[int, list] = {}
    for r in rows:
        seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seq.values():
        end = 0
        for a, n in sorted(parts):
            assert a == end
            end += n
        assert end <= 64
    whole = packing.sequences(packing.pack(docs(spark), BYTE, capacity=64)).collect()
    assert sum(len(r["ids"]) // 4 for r in whole) == sum(map(len, ids.values())) and all(len(r["ids"]) // 4 == r["n_tokens"] for r in whole)
    assert packing.pack(docs(spark, []), BYTE).count() == 0


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 65, 500)
    seq, off = packing.first_fit_decreasing(lengths, 64)
    rest, n_full = lengths[lengths < 64], int((lengths == 64).sum())
    room: list[int] = []
    want = []
    for x in sorted(rest.tolist(), reverse=True):
        at = next((k for k, r in enumerate(room) if r >= x), None)
        if at is None:
            room.append(64)
            at = len(room) - 1
        want.append((at + n_full, 64 - room[at]))
        room[at] -= x
    order = [k for k in np.argsort(-lengths, kind="stable") if lengths[k] < 64]
    assert [(int(seq[k]), int(off[k])) for k in order] == want


@pytest.mark.parametrize("text", [" " * 1_000_000 + "a", " " * 2_000_000, "\n " * 500_000 + "b", "7" * 1_000_000, "a" * 1_000_000, (" " * 9_999 + "a") * 5], ids=range(6))
def test_long_runs_are_encoded(text):
    coder = packing.coder_of(BYTE, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert coder.ids(text) == np.array(coder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_byte_ids_equal_the_tokenizer():
    coder = packing.ByteIds(BYTE, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = np.random.default_rng(4)
    pool = ["a b", "\n", "  ", " ", "\n\n", "x", "<|endoftext|>", "é", "日本", "\t", "12", "'s", "don't", "!!", ",", ". ", " ,x", "«", "\v", "²", "ª"]
    texts = [*(x or "" for x in TEXTS), *("".join(rng.choice(pool, k % 8)) for k in range(1500))]
    for s in texts:
        want = coder.tokenizer.encode(s, add_special_tokens=False).ids
        assert np.frombuffer(coder.ids(s), "<u4").tolist() == want
        if "<|" not in s:
            assert coder.plain.encode_ordinary(s) == want


def test_null_and_repeated_ids_and_rows(spark):
    """Every row is a row of its own: null ids, ids with several texts, and rows that occur twice."""
    entries = [(None, "a b c d e"), (None, "a b c d e"), (None, None), (1, "one two three four"), (1, "another text here"), (1, "one two three four"), (2, "")]
    df = spark.createDataFrame([(k, t, "x", "y", "z", "w") for k, t in entries], DOCS)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    ids = Counter(k for k, _ in entries)

    def per_id(out):
        rows = out.collect()
        assert Counter(r["doc_id"] for r in rows) == ids
        return sorted(rows, key=key)

    counts = per_id(token_counts.token_counts(df, WORD))
    assert sorted(r["n_tokens"] for r in counts) == sorted({"a b c d e": 5, "one two three four": 4, "another text here": 3}.get(t, 0) for _, t in entries)
    scores = per_id(lm_score.lm_scores(df))
    assert len({r["score"] for r in scores if r["n_tokens"] == 6}) == 1 and all(math.isfinite(r["score"]) for r in scores)
    prints = per_id(simhash.simhash_groups(df))
    assert all((r["component_id"] is None) == (r["doc_id"] is None) for r in prints)
    near = per_id(near_text.similar_groups(df))
    assert {r["component_id"] for r in near} == {None, 1, 2}
    assert sorted(map(key, near_text.keep_first(df).collect())) == sorted(key({"doc_id": k}) for k, _ in entries)
    marks = per_id(decontam.contamination(df, spark.createDataFrame([(1, "one two three")], "item_id int, text string")))
    assert sum(r["n_hit"] > 0 for r in marks) == 2
    packed = packing.pack(df, BYTE, capacity=8).collect()
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == ids
    vectors = spark.createDataFrame([(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (3, [1.0, 0.001], 1), (4, [0.0, 1.0], 1)], "vec_id bigint, embedding array<double>, label int")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.embedding_groups(vectors).collect()), key=str)
    assert got == [(3, 2, 3, True), (4, 0, 4, True), (5, 2, 3, False), (5, 2, 3, False), (None, 0, None, False)]
