"""Compressing vectors to one codebook index for each part, with exact integers.

Components become integers and vectors equal parts; every part position has a codebook
that rounds of assignment and averaging improve.  Distances come from tables: for each dimension
of a block of vectors, the distinct integers form a dictionary, the squared differences of each of them to all
entries are tabulated once, and a part's distances are gathers from those tables by the vectors' dictionary codes, added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import small_batches, stored

#: Vectors whose gathered rows are held at a time.
ROWS = 2048
#: A label with more than one in so many rows counts as frequent; there are fewer than this many of them.
FREQUENT = 1000


def usable(vector: Column) -> Column:
    """True for vectors that are not null or empty and hold neither nulls nor NaN nor infinities."""
    sound = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & sound, F.lit(False))


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component; raises where sums of squared differences would not fit 64 bits."""
    out = np.floor(scale * vectors)
    if out.size and np.abs(out).max() > isqrt((1 << 63) // vectors.shape[1]) // 2 - 1:
        raise ValueError("components too large: squared distances would not fit 64 bits")
    return out.astype(np.int64)


def dictionaries(numbers: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(the sorted distinct integers of each dimension, every vector's code in each: dimensions x vectors)."""
    values, codes = [], []
    for column in numbers.T:
        distinct, code = np.unique(column, return_inverse=True)
        values.append(distinct), codes.append(code)
    return values, np.array(codes)


def nearest_entries(values: list[np.ndarray], codes: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each vector's parts, both vectors x parts; ties go to the lower entry.  ``books``: parts x entries x width."""
    parts, entries, width = books.shape
    count = codes.shape[1]
    entry, error = np.empty((count, parts), np.int64), np.empty((count, parts), np.int64)
    for p in range(parts):
        tables = [(values[d][:, None] - books[p, :, d - p * width][None, :]) ** 2 for d in range(p * width, (p + 1) * width)]
        if sum(int(t.max(initial=0)) for t in tables) < 1 << 31:  # the same numbers in half the bytes
            tables = [t.astype(np.int32) for t in tables]
        for a in range(0, count, ROWS):
            total = tables[0][codes[p * width, a : a + ROWS]]
            for d in range(1, width):
                total += tables[d][codes[p * width + d, a : a + ROWS]]
            best = total.argmin(axis=1)
            entry[a : a + ROWS, p] = best
            error[a : a + ROWS, p] = total[np.arange(len(best)), best]
    return entry, error


def packed(values: list[np.ndarray], codes: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """A block's dictionaries as bytes: sizes, values, codes of one, two or four bytes."""
    sizes = np.array([len(v) for v in values], dtype="<i8")
    kind = "<u1" if sizes.max() <= 1 << 8 else "<u2" if sizes.max() <= 1 << 16 else "<u4"
    return sizes.tobytes(), np.concatenate(values).astype("<i8").tobytes(), codes.astype(kind).tobytes()


def unpacked(sizes: bytes, values: bytes, codes: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    size = np.frombuffer(sizes, "<i8")
    rows = codes and max(1, 1 if size.max() <= 1 << 8 else 2 if size.max() <= 1 << 16 else 4)
    return np.split(np.frombuffer(values, "<i8").astype(np.int64), np.cumsum(size)[:-1]), np.frombuffer(codes, f"<u{rows}").reshape(len(size), -1).astype(np.int64)


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decoded(code: str, books: np.ndarray, scale: int = 256) -> np.ndarray:
    """The vector that a code stands for: its entries, one after the other, as components."""
    return np.concatenate([books[p, e] for p, e in enumerate(bytes.fromhex(code))]) / scale


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label") -> tuple[DataFrame, np.ndarray]:
    """(one row for each vector: the id, code, error and, with ``label_col``, label_error; the codebooks, parts x entries x width).

    code holds two hex digits for each part, error the squared distances summed over parts, label_error the
    errors summed over rows of an equal label (null labels together).  Codebooks begin as the ``entries`` vectors of smallest id (null ids last; ties
    by content; fewer vectors, fewer entries), entries without parts stay as they are.  Every row of the input is a vector of its own, repeated rows too.
    Dropped are vectors that are null or empty or hold null or non-finite components, and those whose length is not that
    of the first (by id): they fit no codebook.  An empty table gives no rows and empty codebooks.  Components beyond about 2**31 / sqrt(dimensions) after
    scaling are an error, since distances would not fit a long.  Other columns are not read, whatever their names.

    Blocks of vectors are stored once as dictionaries and codes; each round is one pass over them, and only sums for each
    entry reach the driver.  Memory: one batch of vectors and one dimension's table, whatever the size of labels.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    spark = vectors.sparkSession
    small_batches(spark)
    id_kind = vectors.schema[id_col].dataType.simpleString()
    label_kind = vectors.schema[label_col].dataType.simpleString() if label_col else "int"
    rows = vectors.select(F.col(id_col).alias("id"), (F.col(label_col) if label_col else F.lit(0)).alias("label"), F.col(vector_col).cast("array<double>").alias("v")).filter(usable(F.col("v")))
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    one = rows.orderBy(*order).select(F.size("v").alias("n")).first()
    length = one["n"] if one else parts
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    rows = rows.filter(F.size("v") == length)
    first = np.array([r["v"] for r in rows.orderBy(*order).limit(entries).select("v").collect()], dtype=np.float64).reshape(-1, length)
    books = integers(first, scale).reshape(len(first), parts, length // parts).transpose(1, 0, 2).copy()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                numbers = integers(batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, length), scale)
                lists = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(k)) for k in (0, 1)]
                data = [pa.array([x], pa.binary()) for x in packed(*dictionaries(numbers))]
                yield pa.RecordBatch.from_arrays([*lists, *data], names=["ids", "labels", "sizes", "values", "codes"])

    blocks = stored(rows.mapInArrow(encode, f"ids array<{id_kind}>, labels array<{label_kind}>, sizes binary, values binary, codes binary"), spark)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield batch.column(0)[k].values, batch.column(1)[k].values, *unpacked(*[batch.column(j)[k].as_py() for j in (2, 3, 4)])

    def sums(books: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
            for _, _, values, codes in opened(batches):
                entry, _ = nearest_entries(values, codes, books)
                for p in range(parts):
                    count[p] += np.bincount(entry[:, p], minlength=books.shape[1])
                    for d in range(books.shape[2]):
                        at = p * books.shape[2] + d
                        np.add.at(total[p, :, d], entry[:, p], values[at][codes[at]])
            p, e = np.nonzero(count)
            if len(p):
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

        return blocks.mapInArrow(run, "part int, entry int, n long, total array<long>")

    for _ in range(rounds if len(first) else 0):
        width = books.shape[2]
        means = sums(books).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[d]).alias(f"t{d}") for d in range(width)])
        for r in means.collect():  # parts x entries rows at most
            books[r["part"], r["entry"]] = [r[f"t{d}"] // r["n"] for d in range(width)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, values, codes in opened(batches):
            entry, error = nearest_entries(values, codes, books)
            text = entry.astype(np.uint8).tobytes().hex()
            code = [text[a : a + 2 * parts] for a in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code, pa.string()), pa.array(error.sum(axis=1))], names=["id", "label", "code", "error"])

    coded = blocks.mapInArrow(assign, f"id {id_kind}, label {label_kind}, code string, error long")
    if label_col is None:
        return coded.select(F.col("id").alias(id_col), "code", "error"), books
    return with_label_error(stored(coded, spark)).select(F.col("id").alias(id_col), "code", "error", "label_error"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """label_error beside each row.  Labels with over a thousandth of the rows (so fewer than a thousand of them) are broadcast; the rest are joined by label."""
    sums = stored(coded.groupBy(F.col("label").alias("group")).agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    total = sums.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * FREQUENT > total
    near = coded.join(F.broadcast(sums.filter(often).drop("n")), F.col("label").eqNullSafe(F.col("group")), "left")
    far = coded.join(F.broadcast(sums.filter(often).select("group")), F.col("label").eqNullSafe(F.col("group")), "left_anti")
    far = far.join(sums.filter(~often).drop("n"), F.col("label").eqNullSafe(F.col("group")))
    return near.filter("label_error is not null").drop("group").unionByName(far.drop("group"))
