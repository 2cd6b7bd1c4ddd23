"""SimHash near-duplicates found through the binary Golay code.

A fingerprint of 64 bits is cut into three segments of 22, 21 and 21 bits, each
padded to the 23 bits of the perfect Golay code, where every word has exactly
one codeword within three bits.  Three differing bits or fewer leave at least two
segments with one differing bit or none (pigeonhole).  For two words ``x`` and
``y`` at most one bit apart, ``y``'s codeword is among those that ``x`` and its
one-bit neighbours decode to (one or up to six indices).  So for each pair of
segments, a fingerprint is stored under (nearby indices of one segment, own
index of the other) and probed under (own index of one, nearby indices of the
other): fingerprints up to three bits apart always meet under one key.
All meetings are verified on the full fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinolytics.llm.common import local_heads, small_batches, smallest_ids, stored, utf8

SEED = 42
#: First bit and length of each segment of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of one key that one task compares at once; keys with more are dealt to several tasks.
BLOCK = 2048
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the Golay code (23, 12)


def remainders(words: np.ndarray) -> np.ndarray:
    """Of words of 23 bits divided by the generator, over GF(2)."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest ^= (rest >> bit & 1) * (GENERATOR << (bit - 11))
    return rest


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(remainder of each upper half of 12 bits, error pattern of each remainder): the code is perfect, so each remainder has one pattern of up to three bits."""
    flips = [0] + [1 << a for a in range(23)]
    flips += [1 << a | 1 << b for a in range(23) for b in range(a)]
    flips += [1 << a | 1 << b | 1 << c for a in range(23) for b in range(a) for c in range(b)]
    patterns = np.array(flips, dtype=np.int64)
    error = np.zeros(1 << 11, dtype=np.int64)
    error[remainders(patterns)] = patterns
    return remainders(np.arange(1 << 12, dtype=np.int64) << 11), error


UPPER, ERROR = golay_tables()


def decode(words: np.ndarray) -> np.ndarray:
    """The index (upper 12 bits) of the codeword within three bits of each word."""
    return (words ^ ERROR[UPPER[words >> 11] ^ (words & 0x7FF)]) >> 11


def segment(prints: np.ndarray, s: int) -> np.ndarray:
    start, n = SEGMENTS[s]
    return (prints >> np.uint64(start) & np.uint64((1 << n) - 1)).astype(np.int64)


def nearby(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) for each distinct codeword index that a word or a neighbour at one of its ``n`` bits decodes to."""
    flips = np.array([0, *(1 << k for k in range(n))], dtype=np.int64)
    index = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    new = np.ones(index.shape, dtype=bool)
    new[:, 1:] = index[:, 1:] != index[:, :-1]
    row, _ = np.nonzero(new)
    return row, index[new].astype(np.int64)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, probes): the keys that each fingerprint is stored and probed under."""
    own = [decode(segment(prints, s)).astype(np.int64) for s in range(3)]
    near = [nearby(segment(prints, s), SEGMENTS[s][1]) for s in range(3)]
    rows, keys, side = [], [], []
    for k, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        row, index = near[a]
        rows.append(row), keys.append(k << 24 | index << 12 | own[b][row]), side.append(np.zeros(len(row), bool))
        row, index = near[b]
        rows.append(row), keys.append(k << 24 | own[a][row] << 12 | index), side.append(np.ones(len(row), bool))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(side)


def fingerprint(data: bytes, width: int) -> int:
    """SimHash of the text's shingles, repeats included; 0 without words.  A-Z are lower-cased, ASCII white space separates words."""
    words = data.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: max(0, len(words) - width)].tolist()]
    stops = (ends[width - 1 :] - 1).tolist() or [len(line)]
    digest = xxhash.xxh64_intdigest
    over = np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), 1 << 14):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts[k : k + (1 << 14)], stops[k : k + (1 << 14)], strict=True)], dtype="<u8")
        over += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * over > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, f0) of each row's whole text, as a long; null counts as empty."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(x, width) for x in utf8(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64))], names=["id", "f0"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(work, f"id {kind}, f0 long")


def whole_keys(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 1 << 16) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows of a partition that is sorted by ``keys``, many keys at a time but each whole, with a number for each row's key."""
    kept: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        kept.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table, number = _numbered(kept, keys)
        cut = int(np.searchsorted(number, number[-1]))  # where the last key begins, which may go on
        if cut:
            yield table.slice(0, cut), number[:cut]
        kept = table.slice(cut).to_batches()
        rows = 0  # the rest is a bounded number of rows
    if kept:
        table, number = _numbered(kept, keys)
        if table.num_rows:
            yield table, number


def _numbered(batches: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    new = np.zeros(table.num_rows, dtype=np.int64)
    for k in keys:
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return table, np.cumsum(new)


def linked_prints(prints: DataFrame, most_bits: int) -> DataFrame:
    """Edges (src, dst) between distinct fingerprints (id, f0) that connect what links of at most ``most_bits`` differing bits connect.

    The keys of segment pairs find every link of up to three bits.  A task gets whole keys, of hot
    keys one pair of blocks; it compares all rows of many keys at once and returns for each
    fingerprint one edge to the head of its local component, not all pairs.
    """
    if not 0 <= most_bits <= 3:
        raise ValueError("the code finds up to three differing bits")
    kind = prints.schema["id"].dataType.simpleString()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 10_000):
                part = b.slice(k, 10_000)
                row, key, probes = keys_of(part.column("f0").to_numpy().view(np.uint64))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(probes), part.column("id").take(at), part.column("f0").take(at)], names=["key", "probes", "id", "f0"])

    keyed = prints.select("id", "f0").mapInArrow(spread, f"key long, probes boolean, id {kind}, f0 long")
    hot = stored(keyed.groupBy("key").count().filter(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    # each stored row goes to every block of probes of its key, and each probing row to every block of stored ones
    own = F.pmod(F.xxhash64("id", "probes"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = keyed.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).select("*", own.alias("own"), other.alias("other"))
    dealt = dealt.select("key", F.when(F.col("probes"), F.col("other")).otherwise(F.col("own")).alias("a"), F.when(F.col("probes"), F.col("own")).otherwise(F.col("other")).alias("b"), "probes", "id", "f0")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, number in whole_keys(batches, ["key", "a", "b"]):
            probes = rows.column("probes").to_numpy()
            f = rows.column("f0").to_numpy().view(np.uint64)
            ids, node = np.unique(rows.column("id").to_numpy(), return_inverse=True)
            label = np.arange(len(ids))
            at, apart = np.arange(len(number) - 1), 1
            while len(at):  # each row with the one that stands ``apart`` places after it under the same key
                at = at[: np.searchsorted(at, len(number) - apart)]
                at = at[number[at] == number[at + apart]]
                meet = at[(probes[at] != probes[at + apart]) & (label[node[at]] != label[node[at + apart]])]
                meet = meet[np.bitwise_count(f[meet] ^ f[meet + apart]) <= most_bits]
                if len(meet):
                    label = local_heads([(label[node[meet]], label[node[meet + apart]])], len(ids))[label]
                apart += 1
            away = np.flatnonzero(label != np.arange(len(ids)))
            if len(away):
                yield pa.RecordBatch.from_arrays([pa.array(ids[away]), pa.array(ids[label[away]])], names=["src", "dst"])

    found = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b").mapInArrow(link, f"src {kind}, dst {kind}").distinct()
    # a fingerprint has a head for each batch where one of its keys was (a few dozen at most): it keeps the smallest, and its heads are linked with that one
    least = F.min("dst").over(Window.partitionBy("src"))
    starred = found.select("src", "dst", least.alias("head"))
    ends = F.when(F.col("dst") == F.col("head"), F.col("src")).otherwise(F.col("dst"))
    return starred.select(ends.alias("src"), F.col("head").alias("dst")).distinct()


def simhash_groups(docs: DataFrame, width: int = 3, most_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, fingerprint (16 lower-case hex digits), component_id.

    Texts link when their fingerprints differ in at most ``most_bits`` bits;
    component_id is the smallest id reachable by links.  Texts without words
    (also null) have the fingerprint 0 and link like any other.  Rows with a
    null id get component_id null and take no part; repeated rows stay; an empty table gives no rows.  Ids
    are integers; other columns are not read, whatever their names.  Equal fingerprints
    are one class before anything is compared, so that copies cost one row.
    """
    prints = stored(fingerprints(docs, width, id_col, text_col))
    classes = stored(prints.filter("id is not null").groupBy("f0").agg(F.min("id").alias("id")))
    named = smallest_ids(classes, linked_prints(classes.select(F.col("f0").alias("id"), "f0"), most_bits), "f0")
    out = prints.join(named.withColumnRenamed("head", "component"), "f0", "left")
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"))
