"""Change messages of several tables in one stream: current rows and validity intervals, kept up to date batch by batch.

Both tables depend on the set of changes alone, told apart by key and log position; so batches that come again, late or in
another order leave them as one build over the whole log does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinolytics.operators import cdc
from kinolytics.sources.io import KeyedTable
from kinolytics.sources.shared import stored

c = F.col
#: Messages of one file of a replayed log, and rows of one bucket of a table kept up to date, about.
FILE_ROWS, BUCKET_ROWS = 250_000, 250_000


def buckets_for(rows: int, least: int = 16) -> int:
    """Buckets of a table that will hold so many rows: their size, not their number, stays."""
    return max(least, -(-rows // BUCKET_ROWS))


def written_in_batches(messages: DataFrame, path: str, batches: int, rows: int, by: list[str]) -> int:
    """Write about ``rows`` messages for a stream of so many batches, in the order of ``by``; returns the files of one batch, which grow in number and not in size."""
    files = max(1, -(-rows // (batches * FILE_ROWS)))
    messages.repartitionByRange(batches * files, *by).select("topic", "value").write.parquet(path)
    return files


class ChangedTable:
    """The tables that one topic keeps up to date: ``current`` by key, ``history`` by key and log position.

    ``row`` is the row's schema with ``key`` and ``updated_at``.  Deleted keys stay in ``current`` as marks, so that an older change that
    comes later does not bring them back; ``rows`` leaves them out.
    """

    def __init__(self, current: KeyedTable, history: KeyedTable, row: T.StructType, key: str):
        self.current, self.history, self.row, self.key = current, history, row, key

    def apply(self, messages: DataFrame) -> None:
        """One batch of envelopes (value).  Messages without an operation, key or log position (tombstones, broken ones) change nothing."""
        changes = cdc.unwrap(messages.select("value"), self.row)
        changes = changes.filter(c("__op").isNotNull() & c(self.key).isNotNull() & c("__lsn").isNotNull()).drop("__op", "__source_ts")
        # of one change that was sent twice, or changed on the way, the same copy whatever the order
        changes = stored(cdc.latest_by(changes, [self.key, "__lsn"], ["updated_at", *[x for x in self.row.names if x not in (self.key, "updated_at")], "__deleted"]))
        self.current.upsert(cdc.latest_by(changes, [self.key], ["__lsn"]), [self.key], "__lsn")
        self._close(changes)

    def _close(self, changes: DataFrame) -> None:
        """A change ends the interval before it and is ended by the one after it.  Of a key's held rows only those from the last before its first new one are read on, one when changes come in order."""
        key, names = self.key, [*self.row.names, "__lsn", "__deleted"]
        new = changes.select(*names, F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("_new"))
        held = self.history.read_touched(changes, [key])
        if held is not None:
            low = changes.groupBy(key).agg(F.min("__lsn").alias("_low"))
            near = held.join(low, key)
            floor = near.filter(c("__lsn") < c("_low")).groupBy(key).agg(F.max("__lsn").alias("_floor"))
            near = near.join(floor, key, "left").filter(c("_floor").isNull() | (c("__lsn") >= c("_floor")))
            near = near.join(changes.select(key, "__lsn"), [key, "__lsn"], "left_anti")
            new = new.unionByName(near.select(*names, "valid_to", F.lit(False).alias("_new")))
        after = new.withColumn("_end", F.lead("updated_at").over(Window.partitionBy(key).orderBy("__lsn")))
        moved = after.filter(c("_new") | ~c("_end").eqNullSafe(c("valid_to")))
        self.history.upsert(stored(moved.select(*names, c("_end").alias("valid_to"))), [key, "__lsn"], by=[key])

    def rows(self) -> DataFrame | None:
        """Current rows with ``__lsn``; null before the first change."""
        held = self.current.read()
        return None if held is None else held.filter(F.coalesce("__deleted", F.lit("false")) == "false").drop("__deleted")

    def intervals(self) -> DataFrame | None:
        """Validity intervals as ``cdc.history`` gives them: valid_from, valid_to (null: open), ``__lsn``; null before the first change."""
        held = self.history.read()
        return None if held is None else held.filter(F.coalesce("__deleted", F.lit("false")) == "false").drop("__deleted").withColumnRenamed("updated_at", "valid_from")


def change_sink(messages: DataFrame, tables: dict[str, ChangedTable], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Messages (topic, value) of all topics, routed to the tables of their names (``cdc.<name>``); other topics are passed over.

    A batch that fails on the way is run again from the checkpoint, which changes nothing that it had done.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("_table", cdc.routed_table(c("topic"))).persist()  # read once for each table
        try:
            for name, table in tables.items():
                table.apply(batch.filter(c("_table") == f"cdc.{name}"))
        finally:
            batch.unpersist()

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="15 seconds")).start()
