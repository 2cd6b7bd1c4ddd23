"""Column expressions of the domain: all are Catalyst built-ins, none is a Python function on rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinolytics import schemas as S

c = F.col


def clock_skew_seconds(event: str = "event_ts", ingest: str = "ingest_ts") -> Column:
    """Positive: the device's clock runs ahead."""
    return F.timestamp_diff("SECOND", c(ingest), c(event))


def clamped(col: str, low: int, high: int) -> Column:
    """The value as int inside the range, else null."""
    return F.when(c(col).between(low, high), c(col).cast("int"))


def tier_rank(tier: Column) -> Column:
    return F.when(tier == "basic", 1).when(tier == "standard", 2).when(tier == "premium", 3)


def runtime_bucket(seconds: Column) -> Column:
    return F.when(seconds < 900, "short").when(seconds < 2700, "episode").when(seconds < 5400, "feature").otherwise("long_feature")


def available_at(start: Column, end: Column, as_of: Column) -> Column:
    """Half-open interval; an open end never closes."""
    return (as_of >= start) & (end.isNull() | (as_of < end))


def completion_ratio(watched: Column, runtime: Column) -> Column:
    """Capped at 1; null where the runtime is unknown or zero (``least`` alone would skip the null)."""
    ratio = watched.cast("double") / F.nullif(runtime, F.lit(0))
    return F.when(ratio.isNotNull(), F.least(F.lit(1.0), ratio))


def rebuffer_per_hour(rebuffer: Column, watched: Column) -> Column:
    return F.when(watched > 0, rebuffer / (watched / 3600.0)).otherwise(F.lit(0.0))


def engagement_label(ratio: Column, abandoned: Column) -> Column:
    return F.when(ratio >= S.COMPLETION_THRESHOLD, 1).when((ratio >= 0.25) & ~abandoned, 1).otherwise(0)


def quality_band(per_hour: Column) -> Column:
    return F.when(per_hour > 60, "poor").when(per_hour > 20, "degraded").when(per_hour > 5, "acceptable").otherwise("good")


def licence_status(expires: Column, hours: Column, as_of: Column) -> Column:
    soon = expires <= F.date_add(as_of, 90)
    return F.when(expires.isNull(), "owned").when(soon & (hours > 0), "renew_review").when(soon, "let_lapse").otherwise("active")


def engagement_segment(sessions_7d: Column, active_days_7d: Column) -> Column:
    return F.when(sessions_7d == 0, "dormant").when(active_days_7d >= 5, "daily").when(active_days_7d >= 2, "regular").otherwise("occasional")


def share(condition: Column) -> Column:
    """Mean of a condition; null counts as no."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def bounded_append(values: Column, value: Column, most: int = 200) -> Column:
    """The list with the value appended, cut to its last ``most`` entries."""
    grown = F.array_append(values, value)
    return F.slice(grown, F.greatest(F.size(grown) - most + 1, F.lit(1)), F.lit(most))


def rounded(x: Column, places: int) -> Column:
    """``F.round`` of a double, half up: the same value by whole numbers; only what lies so near a tie that a product's error may decide, is very large or is no number goes through a decimal.

    For columns: what ``x`` is worked out from would be worked out several times.
    """
    scale = float(10**places)
    y = F.abs(x) * scale
    rest = y - F.floor(y)
    units = F.floor(y) + F.when(rest > 0.5, 1).otherwise(0)
    return F.when((y < 1e11) & (F.abs(rest - 0.5) > 0.001), F.when(x < 0, -units).otherwise(units).cast("double") / scale).otherwise(F.round(x, places))
