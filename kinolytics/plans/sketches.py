"""Daily marts with mergeable sketches: viewers and percentiles of longer windows and larger groups without the sessions.

An opt-in beside the exact marts.  A daily row keeps a HyperLogLog sketch of its viewers and a KLL sketch of its startup times; both merge, but nothing can be taken out of them, so a sliding window
cannot be a difference of running sketches.  Days are cut into blocks as long as the window instead: a window is the end of one block and the beginning of the
next, and both are running merges inside a block.  So each daily sketch is merged twice for a window, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col
#: log2 of the buckets of a viewer sketch (standard error 1.04 / sqrt(buckets): 1.6 %), and the size of a KLL sketch (rank error about 1.3 % at 200).
VIEWER_BITS, STARTUP_SIZE = 12, 200


def daily_sketches(sessions: DataFrame, by: tuple[str, ...] = ("cdn_pop", "region_code")) -> DataFrame:
    """(metric_date, by, sessions, viewers, startup): one row for each day and group of valid sessions; groups of fewer values than a sketch's size are exact."""
    return sessions.filter("is_valid_session").groupBy(c("session_date").alias("metric_date"), *by).agg(
        F.count("*").alias("sessions"), F.hll_sketch_agg("profile_id", VIEWER_BITS).alias("viewers"), F.kll_sketch_agg_bigint(c("startup_ms").cast("bigint"), F.lit(STARTUP_SIZE)).alias("startup")
    )


def merged(sketches: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*by).agg(F.sum("sessions").alias("sessions"), F.hll_union_agg("viewers").alias("viewers"), F.kll_merge_agg_bigint("startup").alias("startup"))


def windows_of(sketches: DataFrame, by: tuple[str, ...], days: int) -> DataFrame:
    """(metric_date, by, sessions, viewers, startup) of the ``days`` days up to and including each day from a group's first to its last; days without rows are there too."""
    span = sketches.groupBy(*by).agg(F.min("metric_date").alias("a"), F.max("metric_date").alias("b"))
    grid = span.select(*by, F.explode(F.sequence("a", "b")).alias("metric_date"))
    rows = grid.join(sketches, [*by, "metric_date"], "left").withColumn("day", F.unix_date("metric_date")).withColumn("block", F.floor(c("day") / F.lit(days)))
    block = Window.partitionBy(*by, "block")
    ahead, back = block.orderBy("day").rowsBetween(Window.unboundedPreceding, 0), block.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)
    both = rows.select(
        *by, "metric_date", "day",
        *[f(x).over(w).alias(f"{n}_{x}") for n, w in (("head", ahead), ("tail", back)) for f, x in ((F.sum, "sessions"), (F.hll_union_agg, "viewers"), (F.kll_merge_agg_bigint, "startup"))],
    )
    # a window begins in the block before, with what is left of that, or its days here are all that the block has up to now
    tails = both.select(*by, c("day").alias("start"), *[f"tail_{x}" for x in ("sessions", "viewers", "startup")])
    first = span.select(*by, F.unix_date("a").alias("first"))
    heads = both.drop("tail_sessions", "tail_viewers", "tail_startup").join(first, [*by]).withColumn("start", F.greatest(c("day") - days + 1, c("first")))
    joined = heads.join(tails, [*by, "start"], "left")
    tail = lambda x: F.when(F.floor(c("start") / F.lit(days)) < F.floor(c("day") / F.lit(days)), c(f"tail_{x}"))
    either = lambda f, x: F.coalesce(f(c(f"head_{x}"), tail(x)), c(f"head_{x}"), tail(x)).alias(x)
    sums = (F.coalesce("head_sessions", F.lit(0)) + F.coalesce(tail("sessions"), F.lit(0))).alias("sessions")
    return joined.select("metric_date", *by, sums, either(F.hll_union, "viewers"), either(F.kll_sketch_merge_bigint, "startup"))


def estimates(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """The sketches read: unique_viewers, and p50_startup_ms and so on (null without a value)."""
    n = F.kll_sketch_get_n_bigint("startup")
    read = [F.when(n > 0, F.kll_sketch_get_quantile_bigint("startup", F.lit(q))).alias(f"p{round(100 * q)}_startup_ms") for q in quantiles]
    return sketches.select(*[x for x in sketches.columns if x not in ("viewers", "startup")], F.coalesce(F.hll_sketch_estimate("viewers"), F.lit(0)).alias("unique_viewers"), *read)


def _together(parts: list[DataFrame], by: tuple[str, ...]) -> DataFrame:
    """Rows of the same groups (null keys too) side by side."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows.groupBy(*by).agg(*[F.max(x).alias(x) for x in rows.columns if x not in by])


def exact_quantiles(values: DataFrame, by: tuple[str, ...], percents: tuple[int, ...] = (50, 95)) -> DataFrame:
    """(by, p50_startup_ms and so on): the smallest value up to which a group has at least so many hundredths of its rows.  ``values`` is (by, value, n), each value once; a group is a sorted stream."""
    group = Window.partitionBy(*by)
    upto = F.sum("n").over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    placed = values.select(*by, "value", upto.alias("upto"), F.sum("n").over(group).alias("all"))
    return placed.groupBy(*by).agg(*[F.min(F.when(c("upto") * 100 >= c("all") * p, c("value"))).alias(f"p{p}_startup_ms") for p in percents])


def _values(valid: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return valid.filter("startup_ms is not null").groupBy(*by, c("startup_ms").cast("bigint").alias("value")).agg(F.count("*").alias("n"))


def exact_groups(sessions: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by, sessions, unique_viewers, p50_startup_ms, p95_startup_ms) of valid sessions, whatever the size of a group."""
    valid = sessions.filter("is_valid_session")
    counts = valid.groupBy(*by).agg(F.count("*").alias("sessions"), F.count_distinct("profile_id").alias("unique_viewers"))
    return _together([counts, exact_quantiles(_values(valid, by), by)], by)


def exact_windows(sessions: DataFrame, by: tuple[str, ...], days: int) -> DataFrame:
    """(metric_date, by, sessions, unique_viewers, p50_startup_ms, p95_startup_ms) of the windows of ``windows_of``, exactly.

    A viewer is a mark where the days that his sessions cover begin and one where they cease, so sets are never merged; of startup times each day's
    count of a value goes to the ``days`` windows that hold it.  ``sessions`` is read several times: store it first.
    """
    s = sessions.filter("is_valid_session").withColumn("day", F.unix_date("session_date"))
    span = s.groupBy(*by).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    ends = span.select(*[c(x).alias(f"_{x}") for x in by], c("b").alias("_b"))

    def windows(rows: DataFrame) -> DataFrame:
        """Each row for every window that its day is in, up to the group's last."""
        same: Column = F.lit(True)
        for x in by:
            same = same & c(x).eqNullSafe(c(f"_{x}"))
        held = rows.join(ends, same).withColumn("x", F.explode(F.sequence("day", F.least(c("day") + days - 1, c("_b")))))
        return held.drop("day", "_b", *[f"_{x}" for x in by])

    grid = span.select(*by, F.explode(F.sequence("a", "b")).alias("x"), F.lit(True).alias("there"), F.lit(0).cast("bigint").alias("sessions"))
    counts = windows(s.groupBy(*by, "day").agg(F.count("*").alias("n"))).groupBy(*by, "x").agg(F.sum("n").alias("sessions"))
    own = Window.partitionBy(*by, "profile_id").orderBy("day")
    seen = s.filter("profile_id is not null").select(*by, "profile_id", "day").distinct().select(*by, "day", F.lag("day").over(own).alias("before"), F.lead("day").over(own).alias("after"))
    mark = lambda at, step: F.struct(at.alias("x"), F.lit(step).cast("bigint").alias("step"))
    enters, leaves = F.when(c("before").isNull() | (c("day") > c("before") + days), mark(c("day"), 1)), F.when(c("after").isNull() | (c("after") > c("day") + days), mark(c("day") + days, -1))
    marks = seen.select(*by, F.explode(F.array_compact(F.array(enters, leaves))).alias("m")).select(*by, "m.x", "m.step")
    daily = marks.unionByName(grid.select(*by, "x", "there"), allowMissingColumns=True).groupBy(*by, "x").agg(F.coalesce(F.sum("step"), F.lit(0)).alias("step"), F.max("there").alias("there"))
    sofar = Window.partitionBy(*by).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    viewers = daily.select(*by, "x", F.sum("step").over(sofar).alias("unique_viewers"), "there").filter("there").drop("there")
    values = windows(_values(s, (*by, "day"))).groupBy(*by, "x", "value").agg(F.sum("n").alias("n"))
    out = _together([grid.drop("there"), counts, viewers, exact_quantiles(values, (*by, "x"))], (*by, "x"))
    return out.select(F.date_from_unix_date("x").alias("metric_date"), *by, "sessions", "unique_viewers", "p50_startup_ms", "p95_startup_ms")
