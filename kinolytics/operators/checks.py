"""Data-quality checks: each gives the rows that break a rule, or a count of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


def broken_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, broken, rows) for any number of row rules in one pass.  A rule whose value is null is not broken."""
    counts = df.agg(*[F.count_if(~F.coalesce(r, F.lit(True))).alias(n) for n, r in rules.items()], F.count("*").alias("_rows"))
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), c(n).alias("broken")) for n in rules])).alias("x"), c("_rows").alias("rows")).select("x.rule", "x.broken", "rows")


def failures(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows that break a rule, with the names of the rules: what is stored for a look at it."""
    names = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(True)), F.lit(n)) for n, r in rules.items()]))
    return df.withColumn("broken_rules", names).filter(F.size("broken_rules") > 0)


def verdicts(counts: DataFrame, warn: set[str] = frozenset()) -> DataFrame:
    """``broken_counts`` with a status: pass, warn for rules that only warn, else error."""
    return counts.withColumn("status", F.when(c("broken") == 0, "pass").when(c("rule").isin(*warn) if warn else F.lit(False), "warn").otherwise("error"))


def store_failures(df: DataFrame, rules: dict[str, Column], path: str, run_id: str, keep: list[str]) -> None:
    """Append the broken rows' key columns and rules to a table of failures, by run."""
    failures(df, rules).select(*keep, "broken_rules", F.lit(run_id).alias("run_id")).write.mode("append").partitionBy("run_id").parquet(path)


def not_future(day: str, as_of: str) -> Column:
    return c(day) <= F.lit(as_of).cast("date")


def not_null(column: str) -> Column:
    return c(column).isNotNull()


def accepted(column: str, values: list[str]) -> Column:
    return c(column).isin(values)


def in_range(column: str, low: float, high: float) -> Column:
    return c(column).between(low, high)


def orphans(df: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose reference has no parent; null references pass."""
    return df.filter(c(column).isNotNull()).join(parents.select(c(key).alias(column)).distinct(), column, "left_anti")


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def freshness(df: DataFrame, loaded_at: str, as_of: Column, warn_hours: float, error_hours: float) -> DataFrame:
    """(newest, age_hours, status); an empty source is an error."""
    age = (F.unix_micros(as_of) - F.unix_micros("newest")) / 3.6e9
    out = df.agg(F.max(c(loaded_at).cast("timestamp")).alias("newest")).withColumn("age_hours", age)
    status = F.when(c("age_hours").isNull() | (c("age_hours") > error_hours), "error").when(c("age_hours") > warn_hours, "warn").otherwise("pass")
    return out.withColumn("status", status)


def parity(online: DataFrame, offline: DataFrame, tolerance: float = 0.02, least: int = 500, widespread: float = 0.01) -> DataFrame:
    """Sessions whose streamed features drift from the batch ones, if enough sessions can be judged and the drift is widespread.

    Division is in double precision; where the batch value is 0, any other streamed value drifts.
    """
    def drift(x: str) -> Column:
        on, off = c(f"online_{x}").cast("double"), c(f"offline_{x}").cast("double")
        return F.when(off == 0, F.when(on == 0, 0.0).otherwise(F.lit(float("inf")))).otherwise(F.abs(on - off) / off)

    names = ("seconds_watched", "rebuffer_seconds", "completion_ratio")
    a = online.select("session_id", "profile_id", *[c(x).alias(f"online_{x}") for x in names])
    b = offline.select("session_id", *[c(x).alias(f"offline_{x}") for x in names])
    both = a.join(b, "session_id").withColumns({"seconds_watched_drift": drift("seconds_watched"), "rebuffer_drift": drift("rebuffer_seconds"), "completion_drift": F.abs(c("online_completion_ratio") - c("offline_completion_ratio"))})
    seconds, rebuffer, completion = (F.coalesce(c(x) > tolerance, F.lit(False)) for x in ("seconds_watched_drift", "rebuffer_drift", "completion_drift"))
    both = both.withColumn("drifting_feature", F.when(seconds, "seconds_watched").when(rebuffer, "rebuffer_seconds").when(completion, "completion_ratio"))
    totals = both.agg(F.count("*").alias("_n"), F.count("drifting_feature").alias("_v"))
    return both.crossJoin(F.broadcast(totals)).filter((c("_n") >= least) & c("drifting_feature").isNotNull() & (c("_v") > c("_n") * widespread)).drop("_n", "_v")


def run_results(results: DataFrame) -> DataFrame:
    """Audit rows of a run: messages only for errors, cut to 1000 characters; seconds to three places."""
    return results.withColumns({"error_message": F.when(c("status") == "error", F.substring("error_message", 1, 1000)), "execution_seconds": F.round("execution_seconds", 3), "rows_affected": F.coalesce("rows_affected", F.lit(0))})
