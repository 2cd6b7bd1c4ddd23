"""Typed, deduplicated staging relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolytics import schemas as S
from kinolytics.functions import expressions as X
from kinolytics.operators.cdc import current_state, deduplicated

c = F.col


def playback_events(raw: DataFrame, as_of: str, start_date: str = "1970-01-01") -> DataFrame:
    """Deduplicated events inside [start_date, as_of + 1 hour], typed, with the clock's skew."""
    typed = raw.select(
        c("event_id").cast("string"), c("session_id").cast("string"), c("profile_id").cast("bigint"), c("title_id").cast("bigint"), "region_code", "event_type",
        c("event_ts").cast("timestamp"), c("ingest_ts").cast("timestamp"), c("position_seconds").cast("int"), "device_type", "app_version", "cdn_pop",
        c("bitrate_kbps").cast("int"), "rebuffer_ms", c("startup_ms").cast("int"), "error_code", "ab_bucket",
    )
    inside = (c("event_ts") >= F.lit(start_date).cast("timestamp")) & (c("event_ts") <= F.lit(as_of).cast("timestamp") + F.expr("interval 1 hour"))
    out = deduplicated(typed).filter(inside)  # a retry repeats event_ts, so the guard may go below the ranking
    return out.withColumns({"event_date": F.to_date("event_ts"), "clock_skew_seconds": X.clock_skew_seconds(), "rebuffer_ms": X.clamped("rebuffer_ms", 0, S.REBUFFER_CAP_MS), "ab_bucket": F.coalesce("ab_bucket", F.lit("control"))})


def since(df: DataFrame, column: str, built: DataFrame, days: int = S.LOOKBACK_DAYS) -> DataFrame:
    """Rows from ``days`` before the newest built one on.  The mark is one row, read first, so that the filter is a literal and prunes partitions."""
    mark = built.agg(F.coalesce(F.max(column).cast("timestamp"), F.lit("1970-01-01").cast("timestamp")).alias("m")).first()["m"]
    kind = df.schema[column].dataType.simpleString()
    return df.filter(c(column) >= F.date_sub(F.lit(mark).cast("date"), days).cast(kind) if kind == "date" else c(column) >= F.lit(mark) - F.make_dt_interval(F.lit(days)))


def subscriptions(log: DataFrame) -> DataFrame:
    state = current_state(log, ["subscription_id"])
    return state.select("subscription_id", "subscriber_id", "tier", "status", c("monthly_price").cast("decimal(8,2)").alias("monthly_price"), "started_at", "ended_at", "updated_at", (c("status") == "active").alias("is_active"), X.tier_rank(c("tier")).alias("tier_rank"))


def titles(state: DataFrame, as_of: str) -> DataFrame:
    return state.withColumns({"runtime_bucket": X.runtime_bucket(c("runtime_seconds")), "days_since_release": F.datediff(F.lit(as_of).cast("date"), "release_date")})


def title_availability(state: DataFrame, as_of: str) -> DataFrame:
    return state.withColumn("is_available_now", X.available_at(c("available_from"), c("available_to"), F.lit(as_of).cast("timestamp")))


def title_costs(costs: DataFrame) -> DataFrame:
    """Licence days (at least one) and the licence cost spread over them."""
    days = F.greatest(F.datediff("licence_end", "licence_start"), F.lit(1))
    return costs.withColumns({"licence_days": days, "daily_amortised_cost_usd": F.round(c("licence_cost_usd") / days, 4)})


def title_genres(state: DataFrame) -> DataFrame:
    """With the title's lowest genre id marked as primary."""
    first = state.groupBy("title_id").agg(F.min("genre_id").alias("_first"))
    return state.join(first, "title_id").select("title_id", "genre_id", (c("genre_id") == c("_first")).alias("is_primary_genre"))


def date_dimension(spine: DataFrame, as_of: str, day: str = "date_day") -> DataFrame:
    d = c(day)
    dow = F.dayofweek(d) - 1  # 0: Sunday
    today = F.lit(as_of).cast("date")
    return spine.select(
        d.alias("date_day"), F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.day(d).alias("day_of_month"), dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), dow.isin(0, 6).alias("is_weekend"), F.to_date(F.date_trunc("week", d)).alias("week_start"),
        F.to_date(F.date_trunc("month", d)).alias("month_start"), (d == today).alias("is_today"), (d < today).alias("is_complete_day"),
    )
