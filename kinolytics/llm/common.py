"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the separators of words in the contracts.
ASCII_SPACE = " \t\n\v\f\r"


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which all executors see.

    Only where that setting is absent (tests, one machine) a local temporary
    folder becomes the checkpoint folder of the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Let batches to and from Python hold about 4 MB instead of 64: texts are long, and every worker and its JVM keep several copies."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def stored(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends here,
    and the loss of an executor costs no earlier step."""
    spark = spark or df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each slice have about ``limit`` bytes (a single long text may have more)."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = np.array([len(x) for x in utf8(batch.column(at))], dtype=np.int64)
        part = np.cumsum(sizes) // limit
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(sizes) else np.array([0])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(a, b - a)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of a partition that is sorted by ``keys``, one key after the other, across batches."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        change[0] = last is not None and tuple(c[0] for c in columns) != last
        last = tuple(c[-1] for c in columns)
        start = 0
        for cut in np.flatnonzero(change):
            kept.append(batch.slice(start, cut - start))
            if rows := [b for b in kept if b.num_rows]:
                yield pa.Table.from_batches(rows)
            kept, start = [], cut
        kept.append(batch.slice(start))
    if rows := [b for b in kept if b.num_rows]:
        yield pa.Table.from_batches(rows)


def local_heads(links: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """The smallest of ``n`` nodes in each node's component, for arrays of links a[k] - b[k]."""
    label = np.arange(n)
    for a, b in links:
        a, b = label[a], label[b]
        while len(a):
            low = label.copy()
            np.minimum.at(low, a, label[b])
            np.minimum.at(low, b, label[a])
            np.minimum.at(low, label, low.copy())  # a component's head learns what its members have learnt
            low = np.minimum(low, low[low])
            if (low == label).all():
                break
            label = low
        label = label[label]
    return label


def connected_components(spark: SparkSession, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that edges (src, dst) lead to, over all ``nodes`` (id).

    Each round lets every node take the smallest label among its neighbours',
    tells a label's node what its members have found, and goes on to the label of the label's
    node (pointer jumping), so that rounds grow with the logarithm of a component's
    length.  A round is one plan of minimum aggregations and joins, whose
    result is written to the shared folder; nothing is gathered by component.  Nodes without an edge are their own
    component and take no part in the rounds.
    """
    linked = edges.filter("src != dst")
    both = stored(linked.select("src", "dst").union(linked.select("dst", "src")).distinct(), spark)
    label = stored(both.groupBy(F.col("src").alias("id")).agg(F.least(F.min("dst"), F.col("id")).alias("label")), spark)
    while True:
        seen = both.join(label.select(F.col("id").alias("dst"), "label"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("label").alias("near"))
        step = label.join(seen, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # what members of a label's node have found is told to that node
        told = step.filter("label < old").groupBy(F.col("old").alias("id")).agg(F.min("label").alias("told"))
        step = step.join(told, "id", "left").select("id", "old", F.least("label", F.coalesce("told", "label")).alias("label"))
        # a label whose node had a smaller label before this round is replaced by it
        far = label.filter("label < id").select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = stored(step.join(far, "label", "left").select("id", "old", F.least("label", F.coalesce("far", "label")).alias("label")), spark)
        changed = new.filter("label != old").limit(1).count()
        label = new.select("id", "label")
        if not changed:
            break
    return nodes.join(label, "id", "left").select("id", F.coalesce("label", "id").alias("component"))


def smallest_of(classes: DataFrame, component: DataFrame, key: str) -> DataFrame:
    """(key, head) for classes (key, id) of distinct keys: the smallest id of all classes of the same component, for (key, component) of those that are linked.  Ids may repeat."""
    smallest = component.join(classes.select(key, "id"), key)
    smallest = smallest.join(smallest.groupBy("component").agg(F.min("id").alias("head")), "component").select(key, "head")
    return stored(classes.select(key, "id").join(smallest, key, "left").select(key, F.coalesce("head", "id").alias("head")))


def smallest_ids(classes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, head) for classes (key, id) of distinct keys: the smallest id of all classes that edges (src, dst) between keys lead to.  Ids may repeat."""
    edges = stored(edges)
    members = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    component = stored(connected_components(classes.sparkSession, members, edges).select(F.col("id").alias(key), "component"))
    return smallest_of(classes, component, key)
