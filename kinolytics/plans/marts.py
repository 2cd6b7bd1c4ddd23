"""Session facts and the three marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinolytics import schemas as S
from kinolytics.functions import expressions as X
from kinolytics.operators.timetravel import popularity_at, popularity_windows

c = F.col


def is_type(name: str) -> F.Column:
    return c("event_type") == name


def session_grain(events: DataFrame) -> DataFrame:
    """One row for each session; partial aggregation goes before the shuffle on session_id."""
    first = ("profile_id", "title_id", "region_code", "device_type", "app_version", "ab_bucket")
    return events.groupBy("session_id").agg(
        *[F.min(x).alias(x) for x in first],
        F.min("event_ts").alias("session_start_ts"), F.max("event_ts").alias("session_end_ts"), F.to_date(F.min("event_ts")).alias("session_date"),
        F.timestamp_diff("SECOND", F.min("event_ts"), F.max("event_ts")).alias("session_span_seconds"),
        (F.count_if(is_type("HEARTBEAT")) * S.HEARTBEAT_SECONDS).alias("seconds_watched"), F.max("position_seconds").alias("max_position_seconds"),
        F.count_if(is_type("SEEK")).alias("seek_count"), F.count_if(is_type("PAUSE")).alias("pause_count"), F.count_if(is_type("REBUFFER")).alias("rebuffer_count"),
        (F.coalesce(F.sum("rebuffer_ms"), F.lit(0)) / 1000.0).alias("rebuffer_seconds"), F.max(F.when(is_type("START"), c("startup_ms"))).alias("startup_ms"),
        F.avg("bitrate_kbps").alias("avg_bitrate_kbps"), F.min("bitrate_kbps").alias("min_bitrate_kbps"),
        (F.count_if(is_type("ERROR")) > 0).alias("had_error"), F.max("error_code").alias("error_code"),
        (F.count_if(is_type("COMPLETE")) > 0).alias("reached_complete"), (F.count_if(is_type("ABANDON")) > 0).alias("explicitly_abandoned"),
        F.min("cdn_pop").alias("cdn_pop"), F.size(F.collect_set("cdn_pop")).cast("bigint").alias("cdn_pop_switches"), F.count("*").alias("event_count"),
    )


def watch_sessions(events: DataFrame, titles: DataFrame) -> DataFrame:
    """Sessions with their title's context, completion, validity and label."""
    t = titles.select("title_id", "title_name", "content_type", "runtime_seconds", "is_original", "maturity_rating")
    s = session_grain(events).join(t, "title_id", "left")
    s = s.withColumns({"completion_ratio": X.completion_ratio(c("seconds_watched"), c("runtime_seconds")), "rebuffer_seconds_per_hour": X.rebuffer_per_hour(c("rebuffer_seconds"), c("seconds_watched"))})
    return s.withColumns({"is_completed": c("completion_ratio") >= S.COMPLETION_THRESHOLD, "is_valid_session": c("seconds_watched") >= S.MIN_VALID_SESSION_SECONDS, "engagement_label": X.engagement_label(c("completion_ratio"), c("explicitly_abandoned"))})


def content_daily(sessions: DataFrame, approximate: bool = False) -> DataFrame:
    """Title-day metrics over valid sessions.  Percentiles are exact, or approximate where asked (one sketch pass, bounded memory)."""
    quantile = (lambda col, q: F.percentile_approx(col, q, 10_000)) if approximate else (lambda col, q: F.percentile(col, q))
    return sessions.filter("is_valid_session").groupBy("title_id", c("session_date").alias("metric_date")).agg(
        F.count("*").alias("sessions"), F.count_distinct("profile_id").alias("unique_viewers"), F.sum("seconds_watched").alias("total_seconds_watched"),
        (F.sum("seconds_watched") / 3600.0).alias("total_hours_watched"), F.avg("completion_ratio").alias("avg_completion_ratio"), X.share(c("is_completed")).alias("completion_rate"),
        quantile("completion_ratio", 0.5).alias("median_completion_ratio"), X.share(c("seconds_watched") < 120).alias("early_abandon_rate"),
        F.avg("rebuffer_seconds_per_hour").alias("avg_rebuffer_per_hour"), X.share(c("had_error")).alias("error_rate"), quantile("startup_ms", 0.95).alias("p95_startup_ms"),
    )


def content_performance(sessions: DataFrame, titles: DataFrame, costs: DataFrame, as_of: str, approximate: bool = False) -> DataFrame:
    t = titles.select("title_id", "title_name", "content_type", "is_original", "runtime_seconds", "release_date", "licence_expires")
    d = content_daily(sessions, approximate).join(t, "title_id").join(costs.select("title_id", "licence_cost_usd"), "title_id", "left")
    hours, cost = c("total_hours_watched"), c("licence_cost_usd").cast("double")
    return d.withColumns({
        "days_since_release": F.datediff("metric_date", "release_date"),
        "sessions_per_viewer": c("sessions").cast("double") / F.nullif(c("unique_viewers"), F.lit(0)),
        "efficiency_index": F.when(cost > 0, F.round(hours / (cost / 1000.0), 2)),
        "licence_status": X.licence_status(c("licence_expires"), hours, F.lit(as_of).cast("date")),
    })


def qoe_daily(sessions: DataFrame, regions: DataFrame, approximate: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Day, location and region (and ``by``): ratio of sums as the headline, startup percentiles, last week's value and a 27-row baseline.

    Frames count rows, within (cdn_pop, region, by).
    """
    keys = ["cdn_pop", "region_code", *by]
    if approximate:
        startup = F.percentile_approx("startup_ms", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), 10_000)
    else:
        startup = F.percentile("startup_ms", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    d = sessions.filter("is_valid_session and cdn_pop is not null").groupBy(c("session_date").alias("metric_date"), *keys).agg(
        F.count("*").alias("sessions"), F.count_distinct("profile_id").alias("unique_viewers"), (F.sum("seconds_watched") / 3600.0).alias("playback_hours"),
        (F.sum("rebuffer_seconds") / F.nullif(F.sum("seconds_watched") / 3600.0, F.lit(0.0))).alias("rebuffer_seconds_per_hour"),
        X.share(c("rebuffer_count") > 0).alias("sessions_with_rebuffer_pct"), startup.alias("_startup"), F.avg("avg_bitrate_kbps").alias("avg_bitrate_kbps"),
        X.share(c("had_error")).alias("error_rate"), X.share(c("explicitly_abandoned")).alias("abandon_rate"), F.avg("cdn_pop_switches").alias("avg_pop_switches"),
    )
    d = d.withColumns({f"p{p}_startup_ms": c("_startup")[k] for k, p in enumerate((50, 95, 99))}).drop("_startup")
    w = Window.partitionBy(*keys).orderBy("metric_date")
    per_hour = c("rebuffer_seconds_per_hour")
    d = d.join(regions.select("region_code", "cdn_provider"), "region_code", "left")
    return d.withColumns({
        "rebuffer_per_hour_same_day_last_week": F.lag(per_hour, 7).over(w),
        "rebuffer_per_hour_28d_baseline": F.avg(per_hour).over(w.rowsBetween(-27, -1)),
        "quality_band": X.quality_band(per_hour),
    })


def qoe_same_weekday_by_date(daily: DataFrame) -> DataFrame:
    """The date-exact comparison: the value of exactly seven days before (null on a gap), and the mean of the 28 days before."""
    number = F.unix_date("metric_date")
    w = Window.partitionBy("cdn_pop", "region_code").orderBy(number)
    per_hour = c("rebuffer_seconds_per_hour")
    return daily.select("metric_date", "cdn_pop", "region_code", F.max(per_hour).over(w.rangeBetween(-7, -7)).alias("seven_days_before"), F.avg(per_hour).over(w.rangeBetween(-28, -1)).alias("mean_28_days"))


def incident(daily: DataFrame) -> DataFrame:
    """Quality by provider, worst first: one location or the whole provider?"""
    hours = F.sum("playback_hours")
    return daily.groupBy("metric_date", "cdn_provider").agg(F.count_distinct("cdn_pop").alias("pops"), F.sum("sessions").alias("sessions"), (F.sum(c("rebuffer_seconds_per_hour") * c("playback_hours")) / F.nullif(hours, F.lit(0.0))).alias("rebuffer_seconds_per_hour"))


def incident_slices(sessions: DataFrame, by: list[str]) -> DataFrame:
    """Quality of valid sessions by any columns (app version, hour, device), as headline ratios: which slice is worse than the others?"""
    ratio = F.sum("rebuffer_seconds") / F.nullif(F.sum("seconds_watched") / 3600.0, F.lit(0.0))
    return sessions.filter("is_valid_session").groupBy(*by).agg(F.count("*").alias("sessions"), ratio.alias("rebuffer_seconds_per_hour"), X.share(c("had_error")).alias("error_rate"))


def incident_same_hour(sessions: DataFrame, days: int = 7) -> DataFrame:
    """Each location's hour of a day against the same hour of the ``days`` days before: is this bad, or is it always so at that hour?  Days without sessions then do not count."""
    ratio = F.sum("rebuffer_seconds").cast("double") / F.nullif(F.sum("seconds_watched") / 3600.0, F.lit(0.0))
    hourly = sessions.filter("is_valid_session and cdn_pop is not null").groupBy(c("session_date").alias("metric_date"), "cdn_pop", F.hour("session_start_ts").alias("hour")).agg(F.count("*").alias("sessions"), ratio.alias("rebuffer_seconds_per_hour"))
    before = Window.partitionBy("cdn_pop", "hour").orderBy(F.unix_date("metric_date")).rangeBetween(-days, -1)
    usual = F.avg("rebuffer_seconds_per_hour").over(before)
    return hourly.select("*", F.count("metric_date").over(before).alias("days_before"), usual.alias("same_hour_before"), F.try_divide(c("rebuffer_seconds_per_hour"), F.nullif(usual, F.lit(0.0))).alias("times"))


def title_activity(sessions: DataFrame) -> DataFrame:
    return sessions.filter("is_valid_session").groupBy("title_id", "session_date").agg(F.count("*").alias("sessions"), F.count_distinct("profile_id").alias("unique_viewers"), F.sum("seconds_watched").alias("seconds_watched"), X.share(c("is_completed")).alias("completion_rate"))


def title_popularity(sessions: DataFrame, start: str, end: str) -> DataFrame:
    """Scores 0..1 within each day of [start, end), from days strictly before; ties in rank by title_id."""
    w = popularity_windows(title_activity(sessions), start, end)
    weight = c("weighted_sessions")
    day = Window.partitionBy("metric_date", "block").orderBy(F.desc(X.rounded(weight, 9)), "title_id")  # a day lies in one block, and tells its rows apart
    best = F.max(weight).over(day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))  # in the rank's own order: sorted once
    zero = lambda x: F.coalesce(x, F.lit(0)).alias(x)
    return w.select(
        "metric_date", "title_id", zero("sessions_7d"), zero("viewers_7d"), zero("seconds_watched_7d"), F.coalesce("completion_rate_30d", F.lit(0.0)).alias("completion_rate_30d"),
        F.round(weight, 4).alias("weighted_sessions"), F.round(weight / F.nullif(best, F.lit(0.0)), 6).alias("popularity_score"),
        F.row_number().over(day).alias("popularity_rank"),
    )


def title_popularity_at(sessions: DataFrame, points: DataFrame, start: str, end: str) -> DataFrame:
    """The score of ``title_popularity`` for given (title_id, metric_date) alone."""
    return popularity_at(title_activity(sessions), points, start, end)
