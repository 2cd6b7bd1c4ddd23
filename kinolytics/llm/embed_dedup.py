"""Near-duplicate vectors by iterative quantisation (ITQ).

Rotations of the principal axes are learnt on a bounded sample so that signs
are balanced bits that lose little.  Codes are stored in several tables, one
for each stretch of bits; vectors that agree on a whole stretch meet.  A stretch
has about as many bits as the logarithm of the largest label's vectors, so that entries
stay short as the input grows, and there are as many tables as the recall then needs.
What meets and is near enough by its Hamming distance is judged on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import local_heads, runs, smallest_ids, stored

#: Rows that the rotations are fitted on, at most: those of the smallest hashes of the id.
SAMPLE = 20_000
ROUNDS = 25
#: Bits of a stretch, at least and at most; and the share of links at the least cosine that may meet in no table.
SHORT, LONG = 8, 24
MISSED = 0.01
#: Coordinates that codes tell apart; those of longer vectors are added up in turn (for codes only).
WIDTH = 1024
#: Rows of one table entry that one task compares at once; larger entries are dealt to several tasks.
BLOCK = 1024


class Itq:
    """Centre, principal axes and learnt rotations to ``bits`` signs: as many rotations as it takes, of up to 64 axes each."""

    def __init__(self, sample: np.ndarray, bits: int, seed: int = 0):
        self.mean = sample.mean(axis=0)
        x = sample - self.mean
        values, axes = np.linalg.eigh(x.T @ x / max(1, len(x)))
        axes = axes[:, np.argsort(-values, kind="stable")[:64]]
        v, n = x @ axes, axes.shape[1]
        turns = []
        for k in range(-(-bits // n)):
            r, _ = np.linalg.qr(np.random.default_rng(seed + k).normal(size=(n, n)))
            for _ in range(ROUNDS):  # signs for the rotation, then the rotation for the signs
                b = np.where(v @ r >= 0, 1.0, -1.0)
                u, _, w = np.linalg.svd(b.T @ v)
                r = (u @ w).T
            turns.append(axes @ r)
        self.turn = np.hstack(turns)[:, :bits]

    def signs(self, unit: np.ndarray) -> np.ndarray:
        return (unit - self.mean) @ self.turn >= 0


def unit_rows(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    n = len(column[0]) if len(column) else 0
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), n)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow when squared
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def folded(column: pa.Array, width: int) -> np.ndarray:
    """Unit rows of vectors of any lengths in ``width`` coordinates: shorter ones end in zeros, further coordinates are added to the first."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        unit = unit_rows(column.take(pa.array(at)))
        for k in range(0, int(n), width):
            out[at, : min(width, int(n) - k)] += unit[:, k : k + width]
    return out


def tables_for(most: int, least: float) -> tuple[int, int]:
    """(bits of a stretch, tables) for labels of up to ``most`` vectors and links from that cosine: a bit differs with the angle's share of half a turn."""
    bits = int(np.clip(np.ceil(np.log2(max(most, 2))), SHORT, LONG))
    agree = (1 - np.arccos(np.clip(least, -1, 1)) / np.pi) ** bits
    return bits, int(np.clip(np.ceil(np.log(MISSED) / np.log(max(1 - agree, 1e-9))), 4, 64))


def embedding_groups(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: the id, n_links, component_id, kept.

    Vectors with equal labels and lengths link at a cosine of ``least`` or more, computed in
    double precision.  Null labels, and vectors that are null, empty, all zero or
    hold null or non-finite components, link with nothing.
    component_id is the smallest id reachable by links, kept says
    that this is the row itself.  Equal vectors of a label are one class: they
    count as links of each other but are compared once.  Ids are integers; rows of a
    repeated id are vectors of their own; null ids get n_links 0 and
    a null component.  An empty table gives no rows; other columns are not read.
    Recall against brute force is tested for 8, 16, 32 and 64 dimensions (0.9 or more at the least cosine).
    """
    v = F.col("v")
    narrow = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>" if narrow else "array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    fine = (
        v.isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    good = rows.filter(F.coalesce(fine, F.lit(False)))
    classes = stored(good.groupBy("label", "v").agg(F.min("id").alias("own"), F.count("*").alias("weight")).withColumn("id", F.xxhash64("label", "v")))
    out_of_play = rows.select(F.col("id").alias(id_col))
    size = classes.agg(F.max(F.size("v")).alias("length")).first()["length"]
    if size is None:
        return out_of_play.select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"), F.col(id_col).isNotNull().alias("kept"))
    width = min(size, WIDTH)
    most = classes.groupBy("label", F.size("v")).count().agg(F.max("count").alias("n")).first()["n"]
    bits, tables = tables_for(most, least)
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    itq = Itq(folded(sample.column("v").combine_chunks(), width), bits * tables)
    # a pair at the least cosine differs in this many of all bits, six standard deviations above the mean at most
    share = np.arccos(np.clip(least, -1, 1)) / np.pi
    most_apart = int(bits * tables * share + 6 * np.sqrt(bits * tables * share) + 1)

    # table entries: (label, length, table, value); large ones are cut into blocks that meet pairwise
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sign = itq.signs(folded(b.column(2), width))
            values = (sign.reshape(b.num_rows, tables, bits) @ (1 << np.arange(bits))).astype(np.int32)
            offsets = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))], names=["label", "id", "v", "weight", "code"])

    coded = classes.select("label", "id", "v", "weight").mapInArrow(encode, f"label string, id bigint, v array<{'float' if narrow else 'double'}>, weight long, code array<int>")
    coded = stored(coded)
    entry = [F.xxhash64("label", F.size("v"), "t", "value").alias("key")]
    sizes = coded.select("label", "v", F.posexplode("code").alias("t", "value")).select(*entry)
    # entries of one row are left out before a vector moves
    sizes = stored(sizes.groupBy("key").count().filter("count > 1").select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")))
    dealt = coded.select("label", "id", "weight", "code", "v", F.posexplode("code").alias("t", "value")).withColumn("key", *entry).join(sizes, "key")
    block = F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")).cast("int")
    dealt = dealt.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "t", "label", "id", "weight", "code", "v")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["key", "a", "b"]):
            if rows.num_rows < 2:
                continue
            vectors, codes = rows.column("v").combine_chunks(), rows.column("code").combine_chunks()
            lengths = np.diff(vectors.offsets.to_numpy())
            if (lengths != lengths[0]).any() or len(set(rows.column("t").to_pylist())) > 1:
                raise ValueError("two entries share a digest of 64 bits")
            block, t = rows.column("block").to_numpy(), int(rows.column("t")[0].as_py())
            label = rows.column("label").to_numpy(zero_copy_only=False)
            ids, weight = rows.column("id").to_numpy(), rows.column("weight").to_numpy()
            code = codes.flatten().to_numpy().reshape(len(ids), tables)
            meet = np.triu(label[:, None] == label[None, :], 1)
            if rows.column("a")[0].as_py() != rows.column("b")[0].as_py():
                meet &= block[:, None] != block[None, :]
            i, j = np.nonzero(meet)
            links = np.zeros(len(ids), dtype=np.int64)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            unit = unit_rows(vectors)
            for k in range(0, len(i), 1 << 15):
                x, y = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
                near = np.bitwise_count(code[x] ^ code[y]).sum(axis=1, dtype=np.int64) <= most_apart
                x, y = x[near], y[near]
                near = np.einsum("ij,ij->i", unit[x], unit[y]) >= least
                x, y = x[near], y[near]
                if len(x):
                    first = (code[x, :t] != code[y, :t]).all(axis=1)  # a pair counts in the first table where it meets
                    np.add.at(links, x[first], weight[y[first]])
                    np.add.at(links, y[first], weight[x[first]])
                    found.append((x, y))
            head = local_heads(found, len(ids))
            say = np.flatnonzero((links > 0) | (head != np.arange(len(ids))))
            if len(say):
                yield pa.RecordBatch.from_arrays([pa.array(ids[say]), pa.array(links[say]), pa.array(ids[head[say]])], names=["id", "links", "head"])

    found = stored(dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b").mapInArrow(judge, "id bigint, links long, head bigint"))
    edges = found.select(F.col("id").alias("src"), F.col("head").alias("dst")).filter("src != dst").distinct()
    groups = smallest_ids(classes.select(F.col("id").alias("key"), F.col("own").alias("id")), edges, "key").select(F.col("key").alias("id"), F.col("head").alias("component"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    state = classes.join(links, "id", "left").join(groups, "id").select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component")
    state = stored(state)
    # classes that are alone need no lookup; the rest is found by (label, vector)
    shared = state.filter("n_links > 0")
    digest = F.xxhash64("label", "v").alias("digest")
    seen = rows.join(shared.select(digest, F.col("label").alias("l"), F.col("v").alias("w"), "n_links", "component"), (F.xxhash64(rows["label"], rows["v"]) == F.col("digest")) & (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")) & F.col("id").isNotNull(), "left")
    component = F.coalesce("component", "id")
    return seen.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
