"""The nightly build as one job: stages in order, checks as gates, audit rows, backfill by day.

    python -m kinolytics.job --source <tables> --target <warehouse> --as-of 2024-01-31 [--start 2024-01-01] [--only watch_sessions]

Each stage reads what earlier ones wrote, is checked before it is written, replaces the days from ``--start`` on (all days
without it), and leaves a row in ``run_results``.  A broken rule of severity error stops the stages that need it; a warning does not.
"""

from __future__ import annotations

import argparse
import datetime as dt
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolytics import schemas as S
from kinolytics.operators import cdc, checks
from kinolytics.plans import features as FT
from kinolytics.plans import marts as M
from kinolytics.plans import staging as ST
from kinolytics.sources import io as IO
from kinolytics.sources.shared import stored
from kinolytics.sources.views import view

c = F.col
RESULTS = "run_id string, stage string, status string, rows_affected bigint, execution_seconds double, error_message string, as_of date, finished_at timestamp"


@dataclass
class Run:
    """One run: where it reads and writes, and the days that it builds."""

    spark: SparkSession
    source: str
    target: str
    as_of: str
    start: str | None = None
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def raw(self, name: str) -> DataFrame:
        return view(self.spark, self.source, name)

    def built(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.target}/{name}")


@dataclass
class Stage:
    name: str
    needs: list[str]
    build: Callable[[Run], DataFrame]
    day: str
    rules: dict[str, Column]
    warn: set[str] = field(default_factory=set)


def from_start(run: Run, df: DataFrame, day: str, before: int = 0) -> DataFrame:
    """The days that the run builds, and ``before`` days before them."""
    return df.filter(c(day) >= F.date_sub(F.lit(run.start).cast("date"), before)) if run.start else df


def days_of(run: Run) -> tuple[str, str]:
    """The first day that the run builds (of all sessions, without a start), and the day after as_of."""
    first = run.start or str(run.built("watch_sessions").agg(F.min("session_date")).first()[0] or run.as_of)
    return first, str(dt.date.fromisoformat(run.as_of) + dt.timedelta(days=1))


def staged_events(run: Run) -> DataFrame:
    return ST.playback_events(from_start(run, run.raw("v_playback_events_raw"), "event_ts"), run.as_of).withColumn("event_date", F.to_date("event_ts"))


def watch_sessions(run: Run) -> DataFrame:
    """A session that began before the start keeps its day: all events of the sessions that the new days touch are read."""
    events = run.built("staged_events").drop("_built_at")
    if run.start:
        touched = from_start(run, events, "event_date").select("session_id").distinct()
        events = events.join(touched, "session_id", "left_semi")
    return M.watch_sessions(events, run.raw("v_titles"))


def content_performance(run: Run) -> DataFrame:
    return M.content_performance(from_start(run, run.built("watch_sessions"), "session_date"), run.raw("v_titles"), run.raw("v_title_costs"), run.as_of, approximate=True)


def qoe_daily(run: Run) -> DataFrame:
    """Its baselines count rows, however long ago, so all sessions are read."""
    return M.qoe_daily(run.built("watch_sessions"), run.raw("v_regions"), approximate=True)


def title_popularity(run: Run) -> DataFrame:
    return M.title_popularity(from_start(run, run.built("watch_sessions"), "session_date", 60), *days_of(run))


def profile_features(run: Run) -> DataFrame:
    history = cdc.history(run.raw("v_subscriptions_log"), "subscription_id", ["subscriber_id", "tier", "status", "started_at"])
    sessions = from_start(run, run.built("watch_sessions"), "session_date", max(S.FEATURE_WINDOWS))
    return FT.profile_features(sessions, run.raw("v_profiles"), run.raw("v_title_genres"), run.raw("v_genres"), history, *days_of(run))


def published_features(run: Run) -> DataFrame:
    """The rows of as_of for the online store."""
    at = F.lit(run.as_of).cast("timestamp")
    return IO.publish_daily(run.built("profile_features").drop("_built_at"), run.as_of, 30, at).withColumn("feature_date", F.lit(run.as_of).cast("date"))


def stages() -> list[Stage]:
    """In the order in which they run."""
    return [
        Stage("staged_events", [], staged_events, "event_date", {"event_id_not_null": checks.not_null("event_id"), "event_type_accepted": checks.accepted("event_type", S.EVENT_TYPES)}),
        Stage("watch_sessions", ["staged_events"], watch_sessions, "session_date", {"session_id_not_null": checks.not_null("session_id"), "completion_in_range": checks.in_range("completion_ratio", 0, 1), "spans_are_short": c("session_span_seconds") <= 86_400}, {"spans_are_short"}),
        Stage("content_performance", ["watch_sessions"], content_performance, "metric_date", {"rate_in_range": checks.in_range("completion_rate", 0, 1)}),
        Stage("qoe_daily", ["watch_sessions"], qoe_daily, "metric_date", {"sessions_positive": c("sessions") > 0}),
        Stage("title_popularity", ["watch_sessions"], title_popularity, "metric_date", {"score_in_range": checks.in_range("popularity_score", 0, 1)}),
        Stage("profile_features", ["watch_sessions"], profile_features, "feature_date", {"profile_not_null": checks.not_null("profile_id"), "no_leak": c("days_since_last_session") >= 1, "tier_accepted": checks.accepted("tier", S.TIERS), "segment_accepted": checks.accepted("engagement_segment", S.SEGMENTS)}),
        Stage("published_features", ["profile_features"], published_features, "feature_date", {"key_not_null": checks.not_null("key")}),
    ]


def write_days(run: Run, stage: Stage, df: DataFrame) -> None:
    """Replace the days of ``df``, one folder each; the whole table without a start."""
    writer = df.withColumn("_built_at", F.current_timestamp()).repartition(stage.day).write.mode("overwrite").partitionBy(stage.day)
    (writer.option("partitionOverwriteMode", "dynamic") if run.start else writer).parquet(f"{run.target}/{stage.name}")


def run_stage(run: Run, stage: Stage, broken: set[str]) -> tuple:
    """(status, rows, seconds, message): skipped if a stage that it needs has failed; error if a rule is broken, and then nothing is written."""
    began = time.monotonic()
    if missing := [n for n in stage.needs if n in broken]:
        return "skipped", 0, 0.0, f"needs {', '.join(missing)}"
    try:
        df = stored(from_start(run, stage.build(run), stage.day))  # worked out once, for the checks and for the table
        found = checks.verdicts(checks.broken_counts(df, stage.rules), stage.warn).collect()
        failed = [f"{r['rule']}: {r['broken']} of {r['rows']}" for r in found if r["status"] == "error"]
        if failed:
            checks.store_failures(df, {n: r for n, r in stage.rules.items() if n not in stage.warn}, f"{run.target}/failures_{stage.name}", run.run_id, [df.columns[0]])
            return "error", 0, time.monotonic() - began, "; ".join(failed)
        write_days(run, stage, df)
        status = "warn" if any(r["status"] == "warn" for r in found) else "success"
        return status, found[0]["rows"], time.monotonic() - began, None
    except (PySparkException, Py4JJavaError, ValueError) as e:  # of the data or the cluster: the audit row tells; later stages that need this one are skipped
        return "error", 0, time.monotonic() - began, str(e)


def build(run: Run, only: list[str] | None = None, plan: list[Stage] | None = None) -> DataFrame:
    """Run the stages (or ``only`` some of them) in order; returns this run's audit rows, which are also appended to ``run_results``."""
    broken: set[str] = set()
    rows = []
    for stage in plan or stages():
        if only and stage.name not in only:
            continue
        status, n, seconds, message = run_stage(run, stage, broken)
        if status in ("error", "skipped"):
            broken.add(stage.name)
        rows.append((run.run_id, stage.name, status, n, seconds, message))
    audit = run.spark.createDataFrame(rows, RESULTS.split(", as_of")[0]).withColumns({"as_of": F.lit(run.as_of).cast("date"), "finished_at": F.current_timestamp()})
    checks.run_results(audit).write.mode("append").parquet(f"{run.target}/run_results")
    return run.spark.read.schema(RESULTS).parquet(f"{run.target}/run_results").filter(c("run_id") == run.run_id)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--source", required=True), p.add_argument("--target", required=True), p.add_argument("--as-of", required=True)
    p.add_argument("--start"), p.add_argument("--only", action="append")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("build").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    results = build(Run(spark, a.source, a.target, a.as_of, a.start), a.only).orderBy("finished_at", "stage").collect()
    for r in results:
        print(r["stage"], r["status"], r["rows_affected"], r["execution_seconds"], r["error_message"] or "")
    return int(any(r["status"] in ("error", "skipped") for r in results))


if __name__ == "__main__":
    raise SystemExit(main())
