"""Removing passages that an earlier document has already, by difference-cover anchors.

Word sequences of ``width`` words (windows) that also start in a document of a smaller id are removed.  Hashing every
window would send one row for each word through a shuffle.  Instead anchors, stretches of about half a window, are hashed
only at positions that lie in a difference cover modulo a period: whatever the two places of a long match, some
shift below the period takes both to cover positions, so the match has an anchor that both documents hash.
Anchors in one block of documents only are dropped; the others are extended to all windows around them,
and those windows are compared whole.

Documents are packed into blocks.  A block asks for each of its distinct hashes once, packed by bucket; a bucket's task
sorts what it is asked and answers with one bit each.  So a passage in a million documents costs one entry for each
block, nothing is paired, and no answer needs the text to travel again.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import small_batches, stored

#: Bytes of words in a block of documents (a longer document is a block of its own), and hashes of a bucket on average.
BLOCK_BYTES = 8 << 20
BUCKET = 1 << 21
#: Bytes of a hash beyond its bucket: anchors only choose what is looked at, windows decide.
ANCHOR_BYTES, WINDOW_BYTES = 5, 12


@lru_cache(maxsize=8)
def difference_cover(period: int) -> tuple[int, ...]:
    """The smallest set whose differences are all numbers modulo ``period``; the first in order."""
    need = set(range(period))
    for size in range(1, period + 1):
        if size * (size - 1) + 1 < period:
            continue
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if {(a - b) % period for a in cover for b in cover} == need:
                return cover
    return (0,)


def scheme(width: int) -> tuple[int, tuple[int, ...], int]:
    """(period, cover, words of an anchor) for windows of ``width`` words: any anchor that starts at one of a window's first ``period`` words lies inside."""
    period = min((width + 1) // 2, 31)
    return period, difference_cover(period), width - period + 1


class Texts:
    """A block's documents as words joined by single spaces, with the places of all words."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        stops = np.flatnonzero((raw == 32) | (raw == 10))
        starts = np.concatenate([[0], stops[:-1] + 1])
        line = np.cumsum(raw[stops] == 10) - (raw[stops] == 10)
        real = stops > starts  # a document without words leaves an empty one
        self.starts, self.stops, self.doc = starts[real], stops[real], line[real]
        self.n_words = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.first = np.cumsum(self.n_words) - self.n_words
        self.at = np.arange(len(self.doc)) - self.first[self.doc]

    def whole(self, length: int) -> np.ndarray:
        """Whether ``length`` words of the same document begin at each word."""
        return self.at + length <= self.n_words[self.doc]

    def slices(self, at: np.ndarray, length: int) -> Iterator[bytes]:
        data = self.data
        return (data[a:b] for a, b in zip(self.starts[at].tolist(), self.stops[at + length - 1].tolist(), strict=True))


def anchors(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(the words where anchors begin, their hashes as 64-bit numbers)."""
    period, cover, length = scheme(width)
    inside = texts.n_words[texts.doc] >= width
    at = np.flatnonzero(inside & texts.whole(length) & np.isin(texts.at % period, cover))
    digest = xxhash.xxh3_64_intdigest
    return at, np.fromiter((digest(x) for x in texts.slices(at, length)), np.uint64, len(at))


def windows(texts: Texts, width: int, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the words where a window with a shared anchor begins, the windows' hashes: 96 bits to compare, 32 to deal them by)."""
    period, _, _ = scheme(width)
    count = np.concatenate([[0], np.cumsum(shared)])
    whole = np.flatnonzero(texts.whole(width))
    at = whole[count[whole + period] > count[whole]]
    digest = xxhash.xxh3_128_digest
    return at, np.frombuffer(b"".join(digest(x) for x in texts.slices(at, width)), dtype=[("key", f"V{WINDOW_BYTES}"), ("deal", "<u4")])


def bucketed(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, the places of its hashes, in order)."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(bucket[part[0]]), part


def anchor_keys(hashes: np.ndarray, doc: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, which of them each anchor has, whether two documents of this block have it)."""
    keys, place = np.unique(hashes, return_inverse=True)
    low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), -1)
    np.minimum.at(low, place, doc)
    np.maximum.at(high, place, doc)
    return keys, place, low < high


def bits_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes as two numbers for sorting."""
    raw = np.frombuffer(keys.tobytes(), np.uint8).reshape(-1, WINDOW_BYTES)
    return raw[:, :8].copy().view("<u8").ravel(), raw[:, 8:].copy().view("<u4").ravel()


def distinct_windows(hashes: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a row of each distinct window, which of them each row has, the smallest rank that has it)."""
    high, low = bits_of(hashes["key"])
    order = np.lexsort((hashes["deal"], low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1]) | (hashes["deal"][order][1:] != hashes["deal"][order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    least = np.full(int(new.sum()), np.iinfo(np.int64).max)
    np.minimum.at(least, place, rank)
    return order[new], place, least


def sort_key(value) -> bytes:
    """Bytes that sort as ids do; null ids come last."""
    if value is None:
        return b"\x01"
    return b"\x00" + (struct.pack(">Q", value + (1 << 63)) if isinstance(value, int) else str(value).encode())


def repeated(docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(the id, n_words, n_removed, removed: array of (start, stop) in words, kept: the other words joined by one space) for each row.

    Words are runs without ASCII white space, as they stand.  A word goes if a window of ``width`` words of its document
    that covers it also starts in a document of a smaller id; windows are judged on the input.  Rows of equal id are equally early: neither removes from the other,
    but both lose what smaller ids have.  A null id is later than all others and equal to other null ids.  Null texts have no words; documents of
    fewer than ``width`` words lose none; an empty table gives no rows; other columns are not read, whatever their names.  Ids are integers or strings.

    Exact but for chance: windows are compared by 96 bits of a hash and by their bucket.  Memory: a block of documents (or the longest text, which is
    a block, whole) or a bucket of hashes.
    """
    if width < 3:
        raise ValueError("a window has at least three words")
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents as rows of about ``BLOCK_BYTES`` of words, compressed."""
        number, squeeze = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        ids: list[pa.Array] = []
        texts: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            held = pa.concat_arrays(ids)
            words = sum(x.count(b" ") + bool(x) for x in texts)
            columns = [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held), pa.array([squeeze.compress(b"\n".join(texts))], pa.binary()), pa.array([words])]
            return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "texts", "words"])

        for batch in batches:
            start = 0
            for k, text in enumerate(batch.column(1)):
                texts.append(b" ".join((text.as_py() or "").encode().split()))
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    ids.append(batch.column(0).slice(start, k + 1 - start))
                    yield block()
                    ids, texts, size, start, number = [], [], 0, k + 1, number + 1
            ids.append(batch.column(0).slice(start))
        if texts:
            yield block()

    blocks = stored(rows.mapInArrow(pack, f"block long, ids array<{kind}>, texts binary, words long"), spark)
    total = blocks.agg(F.sum("words")).first()[0] or 0
    period, cover, _ = scheme(width)
    anchor_buckets = max(1, -(-total * len(cover) // (period * BUCKET)))
    window_buckets = max(1, -(-total // BUCKET))

    def opened(row: dict) -> Texts:
        return Texts(zstandard.ZstdDecompressor().decompress(row["texts"]).split(b"\n"))

    def anchor_rows(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at, hashes = anchors(texts, width)
        keys, place, often = anchor_keys(hashes, texts.doc[at], anchor_buckets)
        return at, place, keys & np.uint64((1 << 8 * ANCHOR_BYTES) - 1), (keys >> np.uint64(8 * ANCHOR_BYTES)).astype(np.int64) % anchor_buckets, often

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, keys, bucket, _ = anchor_rows(opened(row))
                raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ANCHOR_BYTES]
                asked = [(b, raw[part].tobytes()) for b, part in bucketed(bucket)]
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * len(asked), pa.int64()), pa.array([b for b, _ in asked], pa.int64()), pa.array([x for _, x in asked], pa.binary())], names=["block", "bucket", "keys"])

    def answer_anchors(table: pa.Table) -> pa.Table:
        """Whether another block asks for the same hash, a bit for each hash asked."""
        asked = table.column("keys").to_pylist()
        wide = np.zeros((sum(map(len, asked)) // ANCHOR_BYTES, 8), np.uint8)
        wide[:, :ANCHOR_BYTES] = np.frombuffer(b"".join(asked), np.uint8).reshape(-1, ANCHOR_BYTES)
        _, place, count = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
        return replies(table, count[place] > 1, [len(x) // ANCHOR_BYTES for x in asked], "anchor")

    def replies(table: pa.Table, bit: np.ndarray, sizes: list[int], about: str) -> pa.Table:
        edges = np.cumsum([0, *sizes])
        packed = [np.packbits(bit[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.Table.from_arrays([table.column("block"), table.column("bucket"), pa.array([about] * len(packed)), pa.array(packed, pa.binary())], names=["block", "bucket", "about", "bits"])

    def heard(right: pa.Table, about: str, bucket: np.ndarray) -> np.ndarray:
        """The answers of all buckets, put back in the order of the hashes."""
        out = np.zeros(len(bucket), bool)
        said = {b: x for b, a, x in zip(right.column("bucket").to_pylist(), right.column("about").to_pylist(), right.column("bits").to_pylist(), strict=True) if a == about}
        for b, part in bucketed(bucket):
            out[part] = np.unpackbits(np.frombuffer(said[b], np.uint8), count=len(part)).astype(bool)
        return out

    def window_rows(row: dict, right: pa.Table) -> tuple:
        texts = opened(row)
        at, place, _, bucket, often = anchor_rows(texts)
        shared = np.zeros(len(texts.doc) + period, bool)
        shared[at] = (heard(right, "anchor", bucket) | often)[place]
        start, hashes = windows(texts, width, shared)
        names = sorted({sort_key(x) for x in row["ids"]})
        known = {x: k for k, x in enumerate(names)}
        own = np.array([known[sort_key(x)] for x in row["ids"]], np.int64)[texts.doc[start]]
        keep, place, least = distinct_windows(hashes, own)
        return texts, start, own, hashes[keep], place, least, names

    def ask_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            _, _, _, keys, _, least, names = window_rows(row, right)
            for b, part in bucketed(keys["deal"].astype(np.int64) % window_buckets):
                used, who = np.unique(least[part], return_inverse=True)
                out.append((row["block"], b, keys["key"][part].tobytes(), [names[k] for k in used], who.astype("<u4").tobytes()))
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.Table.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.list_(pa.binary())), pa.array(columns[4], pa.binary())], names=["block", "bucket", "keys", "names", "who"])

    def answer_windows(table: pa.Table) -> pa.Table:
        """Whether a document of a smaller id than the block's smallest has the window."""
        asked, names = table.column("keys").to_pylist(), table.column("names").to_pylist()
        known = {x: k for k, x in enumerate(sorted({x for one in names for x in one}))}
        rank = np.concatenate([np.array([known[x] for x in one], np.int64)[np.frombuffer(who, "<u4")] for one, who in zip(names, table.column("who").to_pylist(), strict=True)])
        hashes = np.zeros(len(rank), dtype=[("key", f"V{WINDOW_BYTES}"), ("deal", "<u4")])
        hashes["key"] = np.frombuffer(b"".join(asked), f"V{WINDOW_BYTES}")
        _, place, least = distinct_windows(hashes, rank)
        return replies(table, least[place] < rank, [len(x) // WINDOW_BYTES for x in asked], "window")

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            texts, start, own, keys, place, least, _ = window_rows(row, right)
            earlier = heard(right, "window", keys["deal"].astype(np.int64) % window_buckets)
            gone = start[earlier[place] | (own > least[place])]
            step = np.zeros(len(texts.doc) + width + 1, np.int64)
            np.add.at(step, gone, 1)
            np.add.at(step, gone + width, -1)
            covered = np.cumsum(step)[: len(texts.doc)] > 0
            for k, doc_id in enumerate(row["ids"]):
                a, n = int(texts.first[k]), int(texts.n_words[k])
                mark = covered[a : a + n]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))).tolist()
                spans = list(zip(edge[::2], edge[1::2], strict=True))
                stretches = zip([0, *edge[1::2]], [*edge[::2], n], strict=True)
                kept = b" ".join(texts.data[texts.starts[a + x] : texts.stops[a + y - 1]] for x, y in stretches if y > x)
                out.append((doc_id, n, int(mark.sum()), [{"start": x, "stop": y} for x, y in spans], kept))
        columns = list(zip(*out, strict=True)) or [()] * 5
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        ids = left.column("ids").combine_chunks().flatten()
        return pa.Table.from_arrays([ids, pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], span), pa.array(columns[4], pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "removed", "kept"])

    reply = "block long, bucket long, about string, bits binary"
    asked = blocks.mapInArrow(ask_anchors, "block long, bucket long, keys binary")
    common = stored(asked.groupBy("bucket").applyInArrow(answer_anchors, reply), spark)
    asked = blocks.groupBy("block").cogroup(common.groupBy("block")).applyInArrow(ask_windows, "block long, bucket long, keys binary, names array<binary>, who binary")
    earlier = stored(asked.groupBy("bucket").applyInArrow(answer_windows, reply), spark)
    told = common.unionByName(earlier)
    made = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(remove, f"id {kind}, n_words long, n_removed long, removed array<struct<start: long, stop: long>>, kept string")
    return made.withColumnRenamed("id", id_col)
