"""Benchmark decontamination with a broadcast set of n-grams, in DataFrame functions only.

Test items give their windows of ten words; a shorter item is one window.  Any window inside a
document covers a stretch of at most half its length that begins at a multiple of that
length; so each text is tokenised once, only those stretches are hashed, and they are looked up
in the broadcast set.  Documents with a hit are scanned window by window, and a window
counts only if its words are the item's words.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import stored

WIDTH = 10
#: Rows and bytes of n-grams, or of documents with hits, that may be broadcast; more are joined by shuffle.
MOST_ROWS, MOST_BYTES = 2_000_000, 64 << 20
#: Lengths of the stretches that stand for windows: of each window the longest that is at most half of it, rounded up.
STRETCHES = (1, 2, 5)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same borders in a text that is not in lower case.
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def sized(df: DataFrame, *texts: str) -> DataFrame:
    """Broadcast what was counted and is small enough, in rows and in bytes of its text columns; else leave the choice to Spark."""
    size = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(16))
    n = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if n["rows"] <= MOST_ROWS and n["bytes"] <= MOST_BYTES else df


def stretch_of(n: int) -> int:
    return max(s for s in STRETCHES if 2 * s <= n + 1)


def stretch_hash(words_: Column, start: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), F.array_join(F.slice(words_, start, F.lit(length)), " "))


def item_windows(items: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(item, n, gram): each item's windows of ``width`` words; a shorter item with words is one window."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter("item is not null and size(w) > 0")
    w = w.withColumn("n", F.least(F.size("w"), F.lit(width)))
    at = F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)
    return w.select("item", "n", F.explode(F.transform(at, lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("gram")).distinct()


def marked(docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: id, digest (of the text), n_words, n_hit, items (sorted ids as strings), spans (start and stop word of each hit stretch, merged).

    Null and empty texts have no words; documents without hits have empty arrays; an empty table gives no rows.
    Repeated rows stay.  Rows are told apart by id and text, so a repeated or
    null id does no harm.  Items with a null id, and items without words, are skipped; equal items all count.  Other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    grams = stored(item_windows(items, width, item_col, item_text))
    lengths = sorted(r["n"] for r in grams.select("n").distinct().collect())  # at most ``width`` numbers
    used = sorted({stretch_of(n) for n in lengths})

    def steps(s: int) -> Column:
        at = F.sequence(F.lit(1), F.size("w") - s + 1, F.lit(s))
        return F.when(F.size("w") >= s, F.transform(at, lambda i: stretch_hash(F.col("w"), i, s))).otherwise(F.array().cast("array<bigint>"))

    w = rows.select("id", "digest", words(F.col("text")).alias("w"))
    hashes = F.flatten(F.array(*[steps(s) for s in used])) if used else F.array().cast("array<bigint>")
    base = stored(w.select("id", "digest", F.size("w").cast("long").alias("n_words"), hashes.alias("h")))
    counted = base.select("id", "digest", "n_words")
    no_items = F.array().cast("array<string>").alias("items")
    no_spans = F.array().cast("array<struct<start:int,stop:int>>").alias("spans")
    if not lengths:
        return counted.select("id", "digest", "n_words", F.lit(0).cast("long").alias("n_hit"), no_items, no_spans)

    parts = F.split("gram", " ")
    known = None
    for n in lengths:
        s = stretch_of(n)
        own = grams.filter(F.col("n") == n).select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(n - s + 1)), lambda i: stretch_hash(parts, i, s))).alias("h"))  # noqa: B023
        known = own if known is None else known.union(own)
    suspects = base.select("id", "digest", F.explode("h").alias("h")).join(sized(stored(known.distinct())), "h", "left_semi").select("id", "digest")
    suspects = stored(suspects.distinct())

    near = sized(suspects.select(F.col("id").alias("i"), F.col("digest").alias("d")))
    close = rows.join(near, F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")), "left_semi").select("id", "digest", words(F.col("text")).alias("w"))

    def windows(n: int) -> Column:
        at = F.sequence(F.lit(1), F.size("w") - n + 1)
        found = F.transform(at, lambda i: F.struct((i - 1).cast("int").alias("start"), F.lit(n).alias("n"), F.array_join(F.slice("w", i, F.lit(n)), " ").alias("gram")))
        return F.when(F.size("w") >= n, found).otherwise(F.array().cast("array<struct<start:int,n:int,gram:string>>"))

    mine = close.select("id", "digest", F.explode(F.flatten(F.array(*[windows(n) for n in lengths]))).alias("x"))
    mine = mine.select("id", "digest", F.col("x.start").alias("start"), (F.col("x.start") + F.col("x.n")).alias("stop"), F.col("x.n").alias("n"), F.col("x.gram").alias("gram"))
    hits = mine.join(sized(grams, "gram", "item"), ["n", "gram"]).select("id", "digest", "start", "stop", "item")
    hits = stored(hits.distinct())
    stretches = F.sort_array(F.collect_set(F.struct("start", "stop")))

    def joined(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        apart = (F.size(acc) == 0) | (last["stop"] < x["start"])
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))))
        return F.when(apart, F.concat(acc, F.array(x))).otherwise(grown)

    found = hits.groupBy("id", "digest").agg(F.sort_array(F.collect_set("item")).alias("items"), stretches.alias("all"))
    empty = F.array().cast("array<struct<start:int,stop:int>>")
    found = found.select(F.col("id").alias("i"), F.col("digest").alias("d"), "items", F.aggregate("all", empty, joined).alias("spans"))
    out = counted.join(sized(stored(found)), F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")), "left")
    spans = F.coalesce("spans", no_spans)
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return out.select("id", "digest", "n_words", n_hit.alias("n_hit"), F.coalesce("items", no_items).alias("items"), spans.alias("spans"))


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``marked`` under the id's own name, without the digest."""
    out = marked(docs, items, width, id_col, text_col, item_col, item_text)
    return out.select(F.col("id").alias(id_col), "n_words", "n_hit", "items", "spans")


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans (and what follows each of them up to the next word)."""
    text = F.coalesce(text, F.lit(""))
    parts = F.regexp_extract_all(text, F.lit(f"{BETWEEN}|{ANY_CASE}"), F.lit(0))
    begins = F.regexp_like(text, F.lit(f"^{ANY_CASE}")).cast("int")

    def kept_part(x: Column, k: Column) -> Column:
        word = F.floor((k + begins + 1) / 2) - 1  # of this part, or before it
        return ~F.exists(spans, lambda s: (word >= s["start"]) & (word < s["stop"]))

    kept = F.filter(parts, kept_part)
    return F.array_join(kept, "")


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "documents", width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The input rows, with their own columns, without hit documents (``remove="documents"``) or without hit words (``"spans"``)."""
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    found = marked(docs, items, width, id_col, text_col, item_col, item_text)
    hit = sized(stored(found.filter("n_hit > 0").select("id", "digest", "spans").dropDuplicates(["id", "digest"])))  # spans of hits only
    same = docs[id_col].eqNullSafe(hit["id"]) & (F.xxhash64(docs[text_col]) == hit["digest"])
    if remove == "documents":
        return docs.join(hit, same, "left_anti")
    joined = docs.join(hit, same, "left")
    return joined.select(*[F.when(hit["spans"].isNull(), docs[c]).otherwise(without_spans(docs[c], hit["spans"])).alias(c) if c == text_col else docs[c] for c in docs.columns])
