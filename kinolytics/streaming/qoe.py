"""Playback quality windows and regression alerts, for streams and for tables."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

c = F.col

# Fixed values of the detector.
ALPHA = 0.05
WARM_UP = 20
Z_WARNING, Z_CRITICAL = 3.0, 5.0
MIN_RATIO = 0.05
MIN_SESSIONS = 25
COOLDOWN_SECONDS = 600
ALERT_SCHEMA = "alert_type string, severity string, cdn_pop string, region_code string, detected_at timestamp, rebuffer_ratio double, baseline_ratio double, z_score double, sessions_affected bigint, p95_startup_ms int, error_rate double, runbook string"


def qoe_windows(events: DataFrame, size: str = "60 seconds", slide: str = "15 seconds", unique: bool = False) -> DataFrame:
    """One row for each location and sliding window.  Two levels: first by session, so distinct sessions need no set of all
    events in state, then by location.  On streams: watermark first; ``unique`` drops repeated events within it.
    region_code is the smallest of the window's; p95 is the element at index int(0.95 n) of the sorted non-zero startups."""
    e = events.filter(c("cdn_pop").isNotNull())
    if unique:
        e = e.dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else e.dropDuplicates(["event_id"])
    kind = lambda n: F.count_if(c("event_type") == n)
    by_session = e.groupBy(F.window("event_ts", size, slide).alias("w"), "cdn_pop", "session_id").agg(
        F.min("region_code").alias("region"), kind("REBUFFER").alias("rebuffers"), F.sum(F.when(c("event_type") == "REBUFFER", F.coalesce("rebuffer_ms", F.lit(0))).otherwise(0)).alias("ms"),
        kind("HEARTBEAT").alias("beats"), kind("ERROR").alias("errors"), F.collect_list(F.when(c("startup_ms") != 0, c("startup_ms"))).alias("startups"),
    )
    sorted_startups = F.sort_array(F.flatten(F.collect_list("startups")))
    out = by_session.groupBy("w", "cdn_pop").agg(
        F.min("region").alias("region_code"), F.count("*").alias("sessions"), F.sum("rebuffers").alias("rebuffer_events"), (F.sum("ms") / 1000.0).alias("rebuffer_seconds"),
        (F.sum("beats") * 10.0).alias("playback_seconds"), F.sum("errors").alias("error_events"), sorted_startups.alias("s"),
    )
    p95 = F.when(F.size("s") > 0, F.get("s", F.floor(F.size("s") * 0.95).cast("int"))).otherwise(0)
    ratio = F.coalesce(c("rebuffer_seconds") / F.nullif(c("playback_seconds"), F.lit(0.0)), F.lit(0.0))
    return out.select(c("cdn_pop").alias("pop"), "region_code", c("w.end").alias("window_end"), "sessions", "rebuffer_events", "rebuffer_seconds", "playback_seconds", "error_events", p95.cast("int").alias("p95_startup_ms"), ratio.alias("rebuffer_ratio"))


def detect(windows: DataFrame, min_sessions: int = MIN_SESSIONS, z_warning: float = Z_WARNING, min_ratio: float = MIN_RATIO) -> DataFrame:
    """The detector over a table: a fold over each location's windows in order.

    The baseline is updated with every window, in cooldown too; z uses the mean and variance before the update.
    Windows stream through a task in order, batch by batch; only a location's four numbers are held, however long its history is.
    """
    names = ["pop", "window_end", "rebuffer_ratio", "sessions", "error_events", "p95_startup_ms", "region_code"]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pop, b = None, Baseline()
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                if r.pop != pop:
                    pop, b = r.pop, Baseline()
                if got := b.see(int(r.window_end.value // 1000), r.rebuffer_ratio, r.sessions, min_sessions, z_warning, min_ratio):
                    out.append((*r, *got))
            yield pd.DataFrame(out, columns=[*names, "mean", "z"])

    kinds = "pop string, window_end timestamp, rebuffer_ratio double, sessions bigint, error_events bigint, p95_startup_ms int, region_code string"
    rows = windows.select(*[c(n) for n in names]).repartition("pop").sortWithinPartitions("pop", "window_end")
    found = rows.mapInPandas(fold, f"{kinds}, mean double, z double")
    return found.select(
        F.lit("qoe_regression").alias("alert_type"), F.when(c("z") >= Z_CRITICAL, "critical").otherwise("warning").alias("severity"), c("pop").alias("cdn_pop"), "region_code",
        c("window_end").alias("detected_at"), F.bround("rebuffer_ratio", 4).alias("rebuffer_ratio"), F.bround("mean", 4).alias("baseline_ratio"), F.bround("z", 2).alias("z_score"),
        c("sessions").alias("sessions_affected"), "p95_startup_ms", F.bround(c("error_events") / F.greatest(c("sessions"), F.lit(1)), 4).alias("error_rate"), F.lit("docs/runbook.md#qoe-regression").alias("runbook"),
    )


class Baseline:
    """Exponentially weighted mean and variance of one location."""

    def __init__(self, mean: float | None = None, var: float = 0.0, n: int = 0, quiet: int = 0):
        self.mean, self.var, self.n, self.quiet = mean, var, n, quiet

    def see(self, end: int, ratio: float, sessions: int, min_sessions: int, z_warning: float, min_ratio: float) -> tuple[float, float] | None:
        """(mean before, z) if this window raises an alert.  ``end`` in microseconds."""
        if self.mean is None:
            self.mean, self.n = ratio, 1
            return None
        mean, delta, n = self.mean, ratio - self.mean, self.n
        z = delta / max(self.var, 1e-9) ** 0.5
        self.mean, self.var, self.n = mean + ALPHA * delta, (1 - ALPHA) * (self.var + ALPHA * delta * delta), n + 1
        if n < WARM_UP or end < self.quiet or not (z >= z_warning and ratio >= min_ratio and sessions >= min_sessions):
            return None
        self.quiet = end + COOLDOWN_SECONDS * 1_000_000
        return mean, z


class Detector(StatefulProcessor):
    """The detector over a stream of windows, keyed by location: four numbers of state."""

    def __init__(self, min_sessions: int = MIN_SESSIONS, z_warning: float = Z_WARNING, min_ratio: float = MIN_RATIO):
        self.bars = (min_sessions, z_warning, min_ratio)

    def init(self, handle: Any) -> None:
        self.state = handle.getValueState("baseline_v1", "mean double, var double, n int, quiet bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        b = Baseline(*self.state.get()) if self.state.exists() else Baseline()
        out = []
        for r in pd.concat(list(rows)).sort_values("window_end").itertuples():  # a batch's rows come in any order
            got = b.see(int(r.window_end.value // 1000), float(r.rebuffer_ratio), int(r.sessions), *self.bars)
            if got:
                mean, z = got
                out.append(("qoe_regression", "critical" if z >= Z_CRITICAL else "warning", key[0], r.region_code, r.window_end, round(r.rebuffer_ratio, 4), round(mean, 4), round(z, 2), int(r.sessions), int(r.p95_startup_ms), round(r.error_events / max(r.sessions, 1), 4), "docs/runbook.md#qoe-regression"))
        self.state.update((b.mean, b.var, b.n, b.quiet))
        if out:
            yield pd.DataFrame(out, columns=[x.strip().split(" ")[0] for x in ALERT_SCHEMA.split(",")])

    def close(self) -> None:
        pass


def detect_stream(windows: DataFrame, **bars: float) -> DataFrame:
    """Alerts of a stream of windows; needs the RocksDB state store."""
    return windows.groupBy("pop").transformWithStateInPandas(Detector(**bars), ALERT_SCHEMA, "append", "none")  # type: ignore[arg-type]
