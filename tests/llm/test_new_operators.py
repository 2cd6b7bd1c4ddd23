"""Infilling, substring dedup and vector codes on odd rows and against brute force."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pytest

from kinolytics.llm import infill, quality, queries, substring_dedup, url_filter, vector_codes

DOCS = "doc_id bigint, text string, id string, block string, n string, form string, label string, kept string"
UNIT = re.compile("[ \t\n\v\f\r]*[^ \t\n\v\f\r]+|[ \t\n\v\f\r]+")
LONG = "la maison bleue est grande. " * 4000
TEXTS = [None, "", " ", "\n\t ", "one", " one", "one ", "İs  é日本 語\x0b\x1cx\u0085 y ", "a <P> mark", "<S>", "x" * 5000, "é" * 5000 + " é", LONG, LONG + "fin", "<" * 40 + " >" * 9, "the cat sat", "the cat sat"] + [f"w{k} " * k for k in range(40)]


def docs(spark, rows):
    return spark.createDataFrame([(k, t, "a", "b", "c", "d", "e", "f") for k, t in rows], DOCS)


def test_units_of_blocks_against_the_pattern(monkeypatch):
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 7, 1024):
        monkeypatch.setattr(infill, "BLOCK", size)
        for _ in range(60):
            text = "".join(rng.choice(["a", "é", "日", " ", "\n", "\x0b", "\U0001f602", "\x1f", " "], rng.integers(0, 40)))
            units, pieces = infill.Units(text.encode()), UNIT.findall(text)
            assert units.count == len(pieces) and "".join(pieces) == text
            for k in range(len(pieces) + 1):
                head = "".join(pieces[:k])
                assert units.end(k) == (len(head.encode()), len(head)), (ascii(text), k, size)


def plain_infill(doc_id, text, seed=42, percent=50):
    text = text or ""
    pieces = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return len(pieces), "plain", None, None, text
    a, b = sorted((h1 % (len(pieces) + 1), h2 % (len(pieces) + 1)))
    p, m, s = ("".join(x) for x in (pieces[:a], pieces[a:b], pieces[b:]))
    if h4 % 100 < 80:
        return len(pieces), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(pieces), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("percent", [50, 100])
def test_infill(spark, percent):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "no id at all"), (3, "the same id"), (-7, "a b c d e f")]
    made = infill.infilled(docs(spark, rows), percent=percent)
    got = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", infill.restored(made["output"], made["form"]).alias("back")).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(((k, *plain_infill(k, t, percent=percent)) for k, t in rows), key=repr)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else 99, r["back"]) for r in got) == sorted((k if k is not None else 99, t or "") for k, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert infill.infilled(docs(spark, [])).count() == 0


@pytest.mark.parametrize("period", range(2, 32))
def test_difference_cover(period):
    cover = substring_dedup.difference_cover(period)
    for a in range(period):
        assert any(shift in cover and (shift + a) % period in cover for shift in range(period))
    assert len(cover) <= 2 * math.isqrt(period) + 2


def plain_dedup(rows, width):
    held: dict[tuple, list] = {}
    order = lambda i: (i is None, i or 0)
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - width + 1):
            held.setdefault(tuple(w[k : k + width]), []).append(order(i))
    least = {g: min(x) for g, x in held.items()}
    out = []
    for i, w in split:
        gone = {p for k in range(len(w) - width + 1) if least[tuple(w[k : k + width])] < order(i) for p in range(k, k + width)}
        out.append((i, len(w), len(gone), " ".join(x.decode() for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def dedup_rows(draw, n):
    """Texts of few words with copies, near copies and shared passages at all places."""
    vocabulary = [f"v{k}" for k in range(300)]
    passages = [list(draw.choice(vocabulary, draw.integers(5, 60))) for _ in range(12)]
    rows = []
    for k in range(n):
        w = list(draw.choice(vocabulary, draw.integers(0, 60)))
        for _ in range(draw.integers(0, 3)):
            at = int(draw.integers(0, len(w) + 1))
            w[at:at] = passages[draw.integers(0, len(passages))]
        rows.append((int(draw.integers(0, 10 * n)), draw.choice([" ", "\n", "\t  "]).join(w)))
    rows += [(k + 5, t) for k, t in rows[: n // 4]] + [(k, t) for k, t in rows[: n // 8]]
    return rows + [(None, rows[0][1]), (None, rows[1][1] + " x"), (1, None), (2, ""), (3, " \n "), (4, "x " * 40), (9, "x " * 41), (9, LONG), (11, "q " + LONG)]


@pytest.mark.parametrize(("width", "block", "bucket"), [(13, 8 << 20, 1 << 21), (13, 400, 50), (3, 4000, 10), (4, 300, 1 << 21), (20, 2000, 100)])
def test_substring_dedup_against_brute_force(spark, monkeypatch, width, block, bucket):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(substring_dedup, "BUCKET", bucket)
    rows = dedup_rows(np.random.default_rng(width + block), 60)
    if block < 1000:
        rows = rows[:-2]
    got = substring_dedup.repeated(docs(spark, rows).repartition(3), width).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=repr) == plain_dedup(rows, width)
    assert all(sum(s["stop"] - s["start"] for s in r["removed"]) == r["n_removed"] for r in got)


def test_substring_dedup_of_string_ids_and_no_rows(spark):
    same = " ".join(f"w{k}" for k in range(20))
    d = spark.createDataFrame([("b", same), ("a", "z " + same), ("é", same), (None, same)], "doc_id string, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.repeated(d).collect()} == {"a": 0, "b": 20, "é": 20, None: 20}
    assert substring_dedup.repeated(d.limit(0)).count() == 0
    assert substring_dedup.sort_key(-1) < substring_dedup.sort_key(0) < substring_dedup.sort_key(2**40) < substring_dedup.sort_key(None)


def plain_codes(rows, parts, entries, rounds):
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(order[0][2])]
    order = [r for r in order if len(r[2]) == len(order[0][2])]
    width = len(order[0][2]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(r[2])[p] for r in order[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p])) for p, x in enumerate(cut(v))] for _, _, v in kept]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                if own := [cut(kept[k][2])[p] for k in range(len(kept)) if found[k][p][1] == e]:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    sums: dict = {}
    for r, f in zip(kept, found, strict=True):
        sums[r[1]] = sums.get(r[1], 0) + sum(e for e, _ in f)
    return [(r[0], "".join(f"{k:02x}" for _, k in f), sum(e for e, _ in f), sums[r[1]]) for r, f in zip(kept, found, strict=True)], books


@pytest.mark.parametrize(("parts", "entries", "n"), [(4, 8, 120), (16, 64, 200), (2, 3, 2), (1, 1, 9), (4, 256, 300)])
def test_vector_codes_against_brute_force(spark, parts, entries, n):
    rng = np.random.default_rng(n)
    rows = [(int(k), [float(np.float32(x)) for x in rng.normal(0, 1, 16)], None if k % 5 == 0 else int(k % 3)) for k in rng.permutation(n)]
    rows += rows[: n // 4] + [(None, rows[0][1], 7), (-1, None, 1), (-2, [], 1), (-3, [math.nan] * 16, 1), (-4, [None] + [1.0] * 15, 1), (-5, [math.inf] + [0.5] * 15, 1), (n + 1, [0.5] * 15, 1), (n + 2, [0.0] * 16, 1), (n + 3, [1000.0] + [-3.25] * 15, 1)]
    kind = "vec_id bigint, embedding array<float>, label int, id string, code string, error string, `group` string"
    d = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], kind).repartition(3)
    coded, books = vector_codes.vector_codes(d, parts, entries)
    want, plain = plain_codes(rows, parts, entries, 2)
    assert books.tolist() == plain
    assert sorted((tuple(r) for r in coded.collect()), key=repr) == sorted(want, key=repr)
    assert coded.columns == ["vec_id", "code", "error", "label_error"]
    assert vector_codes.codebooks_digest(books) == hashlib.sha256(",".join(str(x) for p in plain for e in p for x in e).encode()).hexdigest()
    assert vector_codes.decoded(want[0][1], books).tolist() == [x / 256 for p in range(parts) for x in plain[p][int(want[0][1][2 * p : 2 * p + 2], 16)]]


def test_vector_codes_of_odd_tables(spark):
    kind = "vec_id bigint, embedding array<double>, label string"
    for rows in ([], [(1, None, "a"), (2, [math.nan] * 16, None)]):
        coded, books = vector_codes.vector_codes(spark.createDataFrame(rows, kind))
        assert coded.count() == 0 and books.size == 0 and vector_codes.codebooks_digest(books) == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1.0] * 15, "a")], kind))
    with pytest.raises(Exception, match="too large"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1e12] * 16, "a")], kind))
    wide = [np.array([-3, 2, 9]), np.array([0])]
    codes = np.array([[0, 2, 1], [0, 0, 0]])
    back = vector_codes.unpacked(*vector_codes.packed(wide, codes))
    assert [x.tolist() for x in back[0]] == [x.tolist() for x in wide] and back[1].tolist() == codes.tolist()
    many = np.arange(70000).reshape(-1, 1)
    values, codes = vector_codes.dictionaries(many)
    assert vector_codes.unpacked(*vector_codes.packed(values, codes))[1].tolist() == codes.tolist()


def test_labels_of_most_rows_and_of_few(spark):
    rows = [(k, [k / 7, 1.0], "hot" if k % 2 else None if k % 7 == 0 else f"l{k}") for k in range(4000)]
    coded, _ = vector_codes.vector_codes(spark.createDataFrame(rows, "vec_id int, embedding array<double>, label string"), 2, 16)
    got = {r["vec_id"]: r for r in coded.collect()}
    sums: dict = {}
    for k, _, label in rows:
        sums[label] = sums.get(label, 0) + got[k]["error"]
    assert len(got) == 4000 and all(got[k]["label_error"] == sums[label] for k, _, label in rows)


@pytest.mark.parametrize("name", ["op11_infill", "op12_substring_dedup", "op13_vector_codes"])
def test_queries_on_the_smallest_tables(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_dir)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.SQL[name]}) q").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_anchor_hashes_are_cut_to_their_width():
    assert substring_dedup.ANCHOR_BYTES <= 8
    assert substring_dedup.scheme(13) == (7, (0, 1, 3), 7)


def test_hosts_of_any_length_cost_a_rules_labels(spark):
    rules = [("block", "a.b.c.d.example.com/x"), ("allow", "example.com/"), ("block", "/nohost")]
    long = "a." * 400_000 + "example.com"
    urls = [(1, f"http://{long}/y"), (2, "http://q.a.b.c.d.example.com/xy"), (3, f"http://{long}x/y"), (4, "http://" + "z" * 500_000 + "/"), (5, "http:///nohost"), (6, "http://x./nohost/z"), (7, "http://com/"), (8, None)]
    d = spark.createDataFrame(urls, "page_id int, url string")
    want = {1: "example.com/", 2: "a.b.c.d.example.com/x", 3: None, 4: None, 5: "/nohost", 6: "/nohost", 7: None, 8: None}
    assert {r["page_id"]: r["rule"] for r in url_filter.url_verdicts(d, rules).collect()} == want
    table = spark.createDataFrame(rules, "verdict string, rule string")
    assert {r["page_id"]: r["rule"] for r in url_filter.joined_verdicts(d, table).collect()} == want
    assert len(url_filter.candidates("a.b.c.d", "/", [1], 2, 9)) == 2 and url_filter.candidates("a", "/", [1], 0, 0) == []


def test_quality_of_a_row_does_not_depend_on_its_batch():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma!", "d3lta", "| x"], int(rng.integers(1, 12)))).encode() for _ in range(300)]
    x = np.array([quality.terms(t) for t in texts + texts[:150] + texts[:150]], dtype=np.float32)  # voters that tie
    v = quality.Voters(x, rng.integers(0, 2, len(x)).astype(float))
    whole = v.scores(x)
    assert whole.tolist() == np.concatenate([v.scores(x[k : k + 1]) for k in range(len(x))]).tolist() == np.concatenate([v.scores(x[a : a + 37]) for a in range(0, len(x), 37)]).tolist()
    assert v.scores(x[::-1])[::-1].tolist() == whole.tolist()
