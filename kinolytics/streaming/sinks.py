"""Streaming sinks: keyed online features, windows and alerts; metrics of a running query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from kinolytics.sources.io import KeyedTable, as_messages, online_rows

c = F.col


def online_sink(features: DataFrame, table: KeyedTable, checkpoint: str, key: Column, updated: str = "updated_ts", ttl_hours: float = 24, audit: str | None = None, once: bool = False) -> StreamingQuery:
    """Batched upsert by key; the row of the highest ``updated_ts`` stays, so a batch that is run again, or late, changes nothing.

    A batch that fails is dropped and counted (``errors`` on the query's sink), because a missing key falls back to
    offline features while a stalled stream does not.  ``audit``: a table that keeps what was served, for parity checks.
    """
    counts = {"written": 0, "errors": 0}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read twice, computed once
        rows = online_rows(batch, key, updated, ttl_hours).persist()
        n = rows.count()
        try:
            table.upsert(rows, ["key"], "updated_ts")
            counts["written"] += n
            if audit:
                audited(batch, updated).write.mode("append").parquet(audit)
        except Exception:  # noqa: BLE001  degraded personalisation, not an outage
            counts["errors"] += n
        finally:
            rows.unpersist()
            batch.unpersist()

    writer = features.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    query = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()
    query.kinolytics_counts = counts  # type: ignore[attr-defined]
    return query


def audited(features: DataFrame, updated: str = "updated_ts") -> DataFrame:
    """What was served: the last features of each session, by day."""
    rest = ["profile_id", "seconds_watched", "rebuffer_seconds", "completion_ratio"]
    last = features.groupBy("session_id").agg(F.max_by(F.struct(*rest), F.struct(c(updated), c("event_count"))).alias("r"), F.to_date(F.max(updated)).alias("snapshot_date"))
    return last.select("session_id", "r.*", "snapshot_date")


def parquet_sink(rows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    writer = rows.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="15 seconds")).start(path)


def kafka_sink(rows: DataFrame, key: str, brokers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Windows to ``qoe.windows``, alerts to ``qoe.alerts``."""
    return as_messages(rows, key).writeStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).option("checkpointLocation", checkpoint).start()


class Metrics(StreamingQueryListener):
    """Rows in, rows dropped as late, and observed metrics of each query by name."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.late: dict[str, int] = {}
        self.observed: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802, ANN001
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802, ANN001
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802, ANN001
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802, ANN001
        p = event.progress
        name = p.name or str(p.id)
        self.rows[name] = self.rows.get(name, 0) + p.numInputRows
        self.late[name] = self.late.get(name, 0) + sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        for k, v in p.observedMetrics.items():
            self.observed.setdefault(name, {})[k] = v.asDict()


def freshness(online: DataFrame) -> DataFrame:
    """Seconds from event to visible feature: percentiles over a keyed table."""
    age = (F.unix_millis("written_at") - F.unix_millis("updated_ts")) / 1000.0
    q = F.percentile_approx(age, F.array(F.lit(0.5), F.lit(0.99)), 10_000)
    return online.agg(q.alias("q"), F.count("*").alias("rows")).select(c("q")[0].alias("p50_s"), c("q")[1].alias("p99_s"), "rows")
