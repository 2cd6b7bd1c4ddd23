"""Change data: unwrapping, routing, current state, and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unwrap(messages: DataFrame, row: T.StructType, value: str = "value") -> DataFrame:
    """Rows from change envelopes (JSON): the row after the change, or before it for a deletion, with
    ``__op``, ``__lsn``, ``__source_ts`` and ``__deleted``.  Tombstones (null messages) stay as rows of nulls."""
    envelope = T.StructType([T.StructField("op", T.StringType()), T.StructField("before", row), T.StructField("after", row), T.StructField("source", T.StructType([T.StructField("lsn", T.LongType()), T.StructField("ts_ms", T.LongType())]))])
    m = messages.withColumn("_m", F.from_json(value, envelope))
    state = F.coalesce("_m.after", "_m.before")
    others = [x for x in messages.columns if x != value]
    return m.select(
        *others, *[state[f.name].alias(f.name) for f in row], F.col("_m.op").alias("__op"), F.col("_m.source.lsn").alias("__lsn"),
        F.timestamp_millis("_m.source.ts_ms").alias("__source_ts"), F.when(F.col("_m.op").isNotNull(), F.when(F.col("_m.op") == "d", "true").otherwise("false")).alias("__deleted"),
    )


def routed_table(topic: Column) -> Column:
    """``streaming.streaming.<table>`` belongs to ``cdc.<table>``; other topics keep their name."""
    return F.regexp_replace(topic, r"^streaming\.streaming\.(.*)$", "cdc.$1")


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of the highest ``order`` for each key.  An aggregate of structs, so partial results go before the shuffle."""
    rest = [x for x in df.columns if x not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*[F.col(x) if x in keys else F.col("_r")[x].alias(x) for x in df.columns])


def current_state(log: DataFrame, keys: list[str]) -> DataFrame:
    """State after the last change by log position; deleted keys go only after the ranking."""
    return latest_by(log, keys, ["__lsn"]).filter(F.coalesce("__deleted", F.lit("false")) == "false")


def history(log: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Validity intervals from every change of the log, in the order of log positions: valid_from, valid_to (null: open).
    A deletion closes the interval before it and opens none; ``__lsn`` stays, as the last order between intervals of equal dates.  Intervals of no or negative length (dates against the log's order) are kept as they are."""
    w = Window.partitionBy(key).orderBy("__lsn")
    rows = log.select(key, *columns, F.col("updated_at").alias("valid_from"), F.lead("updated_at").over(w).alias("valid_to"), "__lsn", "__deleted")
    return rows.filter(F.coalesce("__deleted", F.lit("false")) == "false").drop("__deleted")


def snapshot(held: DataFrame, current: DataFrame, key: str, columns: list[str], run_at: Column) -> DataFrame:
    """One run of a type-2 snapshot by ``updated_at``: held has key, columns, updated_at, valid_from, valid_to.

    Open rows whose key changed are closed at the new ``updated_at`` and followed by a new row; keys that are gone are closed
    at ``run_at``; equal ones stay; new keys begin at their ``updated_at``.
    """
    closed = held.filter(F.col("valid_to").isNotNull())
    old = held.filter(F.col("valid_to").isNull()).alias("o")
    new = current.select(key, *columns, "updated_at").alias("n")
    both = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    known, there = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    changed = known & there & (F.col("n.updated_at") > F.col("o.updated_at"))
    names = [key, *columns, "updated_at"]
    end = F.when(changed, F.col("n.updated_at")).when(~there, run_at)
    kept = both.filter(known).select(*[F.col(f"o.{x}").alias(x) for x in names], F.col("o.valid_from").alias("valid_from"), end.cast("timestamp").alias("valid_to"))
    begun = both.filter(changed | ~known).select(*[F.col(f"n.{x}").alias(x) for x in names], F.col("n.updated_at").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    return closed.select(*names, "valid_from", "valid_to").unionByName(kept).unionByName(begun)


def as_of(history_: DataFrame, on: Column, start: str = "valid_from", end: str = "valid_to") -> Column:
    """Condition of a validity join: from <= on < to, or open."""
    return (on >= F.to_date(history_[start])) & (history_[end].isNull() | (on < F.to_date(history_[end])))


def deduplicated(events: DataFrame) -> DataFrame:
    """One row for each event_id: the earliest receipt, ties by all other columns so that reruns agree."""
    rest = [x for x in events.columns if x not in ("event_id", "ingest_ts")]
    first = events.groupBy("event_id").agg(F.min_by(F.struct("ingest_ts", *rest), F.struct("ingest_ts", *[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in rest])).alias("_r"))
    return first.select(*[F.col(x) if x == "event_id" else F.col("_r")[x].alias(x) for x in events.columns])
