"""Daily profile features, the training set, and interaction weights."""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinolytics import schemas as S
from kinolytics.functions import expressions as X
from kinolytics.operators.timetravel import genre_affinity, genre_shares_at, last_of_day, listed, parts_for, point_windows, resumed, running_windows, totals_on, window_marks, window_values
from kinolytics.sources.shared import stored

c = F.col
#: A day after all days.
NEVER = (1 << 31) - 1


def subscription_segments(history: DataFrame) -> DataFrame:
    """(subscriber_id, valid_from, valid_to, tier, tier_rank, is_active, started_on, known): days of one answer to which subscription holds.

    Intervals of a subscriber may overlap; of those that hold on a day the active one wins, then the latest started, the latest begun, and the last
    written.  A sweep over a subscriber's intervals in the order of their begin keeps the open ones in a heap: a segment ends where the winner
    ends or another begins, equal neighbours are merged, and a stretch on which none holds is a segment that is not ``known``.
    Rows stream through a sorted partition; a task holds the open intervals of one subscriber.
    """
    kind = history.schema["subscriber_id"].dataType.simpleString()
    micros = lambda x: F.coalesce(F.unix_micros(x), F.lit(-(1 << 62)))
    rows = history.select(
        "subscriber_id", F.unix_date(F.to_date("valid_from")).alias("first"), F.coalesce(F.unix_date(F.to_date("valid_to")), F.lit(NEVER)).alias("until"),
        F.coalesce(c("status") == "active", F.lit(False)).alias("active"), micros("started_at").alias("started"), micros("valid_from").alias("begun"), "__lsn", "tier", F.unix_date(F.to_date("started_at")).alias("started_on"),
    ).filter("first < until")
    rows = rows.repartition("subscriber_id").sortWithinPartitions("subscriber_id", "first")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[tuple] = []  # smallest first: the winner's fields with their order turned round
        out: list[list] = []
        who, day, number = None, 0, 0

        def put(first: int, until: int, value: tuple) -> None:
            if first >= until:
                return
            if out and out[-1][0] == who and out[-1][2] == first and tuple(out[-1][3:]) == value:
                out[-1][2] = until
            else:
                out.append([who, first, until, *value])

        def advance(to: int) -> None:
            """Segments from ``day`` up to the day ``to``."""
            nonlocal day
            while day < to:
                while open_ and open_[0][4] <= day:
                    heapq.heappop(open_)
                end = min(to, open_[0][4]) if open_ else to
                put(day, end, open_[0][6] if open_ else (None, None, None, False))
                day = end

        def table(held: list[list]) -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) or [()] * 7
            types = [schema.types[0], pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["subscriber_id", "first", "until", "tier", "is_active", "started_on", "known"])

        schema = None
        for batch in batches:
            schema = batch.schema
            for one, first, until, active, started, begun, lsn, tier, started_on in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if one != who:
                    advance(NEVER) if who is not None else None
                    open_.clear()
                    who, day = one, first
                advance(first)
                number += 1
                heapq.heappush(open_, (not active, -started, -begun, -(lsn or 0), until, number, (tier, active, started_on, True)))
            if len(out) > 10_000:
                yield table(out[:-1])
                del out[:-1]
        if schema is not None:
            advance(NEVER) if who is not None else None
            yield table(out)

    found = rows.filter("subscriber_id is not null").mapInArrow(sweep, f"subscriber_id {kind}, first int, until int, tier string, is_active boolean, started_on int, known boolean")
    return found.select("subscriber_id", F.date_from_unix_date("first").alias("valid_from"), F.when(c("until") < NEVER, F.date_from_unix_date("until")).alias("valid_to"), "tier", X.tier_rank(c("tier")).alias("tier_rank"), "is_active", F.date_from_unix_date("started_on").alias("started_on"), "known")


def affinity_maps(sessions: DataFrame, title_genres: DataFrame, genres: DataFrame) -> DataFrame:
    """(profile_id, at, genre_affinity): each profile's map of shares from day ``at`` until its next row."""
    shares = genre_affinity(sessions, title_genres, genres)
    ends = shares.select("profile_id", c("valid_to").alias("valid_from")).distinct()  # a day after which no genre is left has an empty map
    entries = F.sort_array(F.collect_list(F.when(c("genre_name").isNotNull(), F.struct("genre_name", "share"))))
    return shares.unionByName(ends, allowMissingColumns=True).groupBy("profile_id", F.unix_date("valid_from").alias("at")).agg(F.map_from_entries(entries).alias("genre_affinity"))


def feature_rows(sessions: DataFrame, profiles: DataFrame, title_genres: DataFrame, genres: DataFrame, history: DataFrame, asked: DataFrame, affinity: bool = True, marks: DataFrame | None = None) -> DataFrame:
    """What is known of each profile on every day on which something changes, and on the days of ``asked`` (profile_id, at; its rows are flagged ``asked``).

    Marks of the windows, days of new affinities, segments of the subscription and what is asked for are rows of one order for each profile: no day is joined with a span of days.
    Maps are looked up last, by the day from which they hold.  ``marks`` are the windows' marks where they are known already.
    """
    segments = profiles.select("profile_id", "subscriber_id").join(subscription_segments(history), "subscriber_id")
    context = segments.select("profile_id", F.unix_date("valid_from").alias("at"), F.struct("tier", "tier_rank", "is_active", "started_on").alias("context"))
    others = context.unionByName(asked.select("profile_id", "at", F.lit(True).alias("asked")), allowMissingColumns=True)
    if affinity:
        maps = stored(affinity_maps(sessions, title_genres, genres))
        others = others.unionByName(maps.select("profile_id", "at", c("at").alias("shares_at")), allowMissingColumns=True)
    latest, who = ("context", "shares_at") if affinity else ("context",), profiles.select("profile_id")
    if marks is None:  # narrow rows are dealt once; what is made of them stays where it is
        n = parts_for(sessions)
        who, dealt = who.repartition(n, "profile_id"), lambda d: d.repartition(n, "profile_id")
        known = point_windows(dealt(sessions).join(who, "profile_id", "left_semi"), dealt(others).join(who, "profile_id", "left_semi"), latest, ("asked",), parts=n)
    else:
        known = running_windows(marks.unionByName(others, allowMissingColumns=True).join(who, "profile_id", "left_semi"), latest, ("asked",))
    if affinity:
        known = known.join(maps.withColumnRenamed("at", "shares_at"), ["profile_id", "shares_at"], "left")
    return known.withColumns({"valid_from": F.date_from_unix_date("at"), "valid_to": F.date_from_unix_date("until")}).join(profiles.select("profile_id", "subscriber_id"), "profile_id")


def _columns(known: DataFrame, day: Column | None) -> list[Column]:
    """The features of rows of ``feature_rows``; with ``day``, ages on that day, without it the days from which they count."""
    *windows, last, first = window_values()
    since = c("context.started_on")
    if day is None:
        ages = [last, first, since.alias("started_on")]
    else:
        ages = [F.coalesce(F.datediff(day, last), F.lit(999)).alias("days_since_last_session"), F.coalesce(F.datediff(day, first), F.lit(0)).alias("profile_age_days"), F.coalesce(F.datediff(day, since), F.lit(0)).alias("tenure_days")]
    maps = [F.coalesce("genre_affinity", F.create_map().cast("map<string,double>")).alias("genre_affinity")] if "genre_affinity" in known.columns else []
    return [
        *windows, *ages, *maps, c("context.tier").alias("tier"), c("context.tier_rank").alias("tier_rank"), c("context.is_active").alias("subscription_active"),
        X.engagement_segment(c("t_n_7"), c("t_active_7")).alias("engagement_segment"),
    ]


def feature_intervals(sessions: DataFrame, profiles: DataFrame, title_genres: DataFrame, genres: DataFrame, history: DataFrame, affinity: bool = True) -> DataFrame:
    """(profile_id, subscriber_id, valid_from, valid_to, features): all of each profile's history, a row from each change to the next; the last row has no end."""
    nothing = profiles.limit(0).select("profile_id", F.lit(0).alias("at"))
    known = last_of_day(feature_rows(sessions, profiles, title_genres, genres, history, nothing, affinity))
    return known.select("profile_id", "subscriber_id", "valid_from", "valid_to", *_columns(known, None))


def features_at(sessions: DataFrame, profiles: DataFrame, title_genres: DataFrame, genres: DataFrame, history: DataFrame, points: DataFrame, affinity: bool = True) -> DataFrame:
    """The features at given points (profile_id, feature_date), each known strictly before its day."""
    known = feature_rows(sessions, profiles, title_genres, genres, history, points.select("profile_id", F.unix_date("feature_date").alias("at")).distinct(), affinity).filter("asked")
    return known.select(c("valid_from").alias("feature_date"), "profile_id", "subscriber_id", *_columns(known, c("valid_from")))


def feature_spans(sessions: DataFrame, profiles: DataFrame, title_genres: DataFrame, genres: DataFrame, history: DataFrame, start: str, end: str, affinity: bool = True, marks: DataFrame | None = None) -> DataFrame:
    """Rows of ``feature_rows`` that together cover each profile's days of [start, end).  Reads the sessions from 90 days before ``start`` on (``marks``: see ``feature_rows``)."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    near = sessions.filter((c("session_date") < last) & (c("session_date") >= F.date_sub(first, max(S.FEATURE_WINDOWS))))
    return last_of_day(feature_rows(near, profiles, title_genres, genres, history, profiles.select("profile_id", F.unix_date(first).alias("at")), affinity, marks))


def profile_features(sessions: DataFrame, profiles: DataFrame, title_genres: DataFrame, genres: DataFrame, history: DataFrame, start: str, end: str, affinity: bool = True, marks: DataFrame | None = None) -> DataFrame:
    """One row for each profile and day of [start, end); everything is known strictly before the day."""
    days = listed(feature_spans(sessions, profiles, title_genres, genres, history, start, end, affinity, marks), start, end)
    return days.select("feature_date", "profile_id", "subscriber_id", *_columns(days, c("feature_date")))


#: Features that count days: from which day, and what they are without one.
AGES = {"days_since_last_session": ("last_session_date", 999), "profile_age_days": ("first_session_date", 0), "tenure_days": ("started_on", 0)}


def span_values(known: DataFrame) -> DataFrame:
    """Rows of ``feature_spans`` with their features, ages as the days from which they count."""
    return known.select("profile_id", "valid_from", "valid_to", *_columns(known, None))


def sums_by_day(spans: DataFrame, start: str, end: str, names: list[str]) -> DataFrame:
    """(feature_date, rows, <name>...): the sums over all rows of each day of [start, end) that ``listed`` gives for these spans, none of which is listed.

    A span's values are added on its first day and taken away after its last, a day's sums are running sums of that, one row for each day.  An age is the
    day's number times the spans that have a day to count from, less those days.  Whole numbers and decimals of six places, so sums are exact.
    """
    begin, until = F.greatest("valid_from", F.lit(start).cast("date")), F.least(F.coalesce("valid_to", F.lit(end).cast("date")), F.lit(end).cast("date"))
    kinds = {f.name: f.dataType.typeName() for f in spans.schema}
    values, slopes = {"rows": F.lit(1).cast("bigint")}, {}
    for n in names:
        if n in AGES:
            since, without = AGES[n]
            values[n] = F.coalesce(-F.unix_date(c(since)), F.lit(without)).cast("bigint")
            slopes[n] = c(since).isNotNull().cast("bigint")
        else:
            values[n] = F.coalesce(c(n).cast("decimal(18,6)" if kinds[n] in ("double", "float", "decimal") else "bigint"), F.lit(0))
    edges = F.array(F.struct(begin.alias("at"), F.lit(True).alias("enters")), F.struct(until.alias("at"), F.lit(False).alias("enters")))
    held = {**{f"v_{n}": x for n, x in values.items()}, **{f"s_{n}": x for n, x in slopes.items()}}
    marks = spans.filter(begin < until).select(F.explode(edges).alias("m"), *[x.alias(n) for n, x in held.items()])
    marks = marks.groupBy(c("m.at").alias("valid_from")).agg(*[F.sum(F.when(c("m.enters"), c(n)).otherwise(F.negative(n))).alias(n) for n in held])
    day = Window.orderBy("valid_from")
    sofar = day.rowsBetween(Window.unboundedPreceding, 0)
    days = listed(marks.select("valid_from", F.lead("valid_from").over(day).alias("valid_to"), *[F.sum(n).over(sofar).alias(n) for n in held]), start, end)
    return days.select("feature_date", *[(c(f"v_{n}") + c(f"s_{n}") * F.unix_date("feature_date") if n in slopes else c(f"v_{n}")).alias(n) for n in values]).filter("rows > 0")


class FeatureTable:
    """The daily feature table as folders of days, built once and then extended by the days that are missing.

    Beside the features lies the windows' state of the last day that was built.  An extension adds to it what enters and takes away what leaves; it reads the sessions of the
    longest window before the first new day and of the new days, whatever lies before.  State is written before the features' newest day is (the high-water mark), and a repeated
    run writes the same days again, so a run that was lost is simply started anew.
    """

    def __init__(self, path: str):
        self.features, self.states = f"{path}/features", f"{path}/states"

    def begin(self, sessions: DataFrame, day: str) -> None:
        """The state of ``day`` from all sessions before it: features begin the day after.  Of sessions that have left the longest window nothing is in the state, what they add and take away is equal; so they make no marks."""
        first = F.lit(day).cast("date")
        inside = sessions.filter((c("session_date") < first) & (c("session_date") >= F.date_sub(first, max(S.FEATURE_WINDOWS))))
        totals_on(window_marks(inside), day).write.mode("overwrite").parquet(f"{self.states}/{day}")

    def extend(self, day: str, until: str, sessions: DataFrame, profiles: DataFrame, title_genres: DataFrame, genres: DataFrame, history: DataFrame) -> None:
        """Features of the days after ``day``, whose state is there, up to and including ``until``."""
        spark = sessions.sparkSession
        first = F.lit(day).cast("date")
        near = sessions.filter((c("session_date") >= F.date_sub(first, max(S.FEATURE_WINDOWS))) & (c("session_date") < F.lit(until).cast("date")))
        marks = resumed(spark.read.parquet(f"{self.states}/{day}"), near, day)
        totals_on(marks, until).write.mode("overwrite").parquet(f"{self.states}/{until}")
        new = profile_features(near, profiles, title_genres, genres, history, _after(day), _after(until), marks=marks)
        new.repartition("feature_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feature_date").parquet(self.features)

    def newest(self, spark: SparkSession) -> str:
        """The last day that has features."""
        return str(spark.read.parquet(self.features).agg(F.max("feature_date")).first()[0])

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.features).withColumn("feature_date", c("feature_date").cast("date"))


def _after(day: str) -> str:
    return str(dt.date.fromisoformat(day) + dt.timedelta(days=1))


def labelled_sessions(sessions: DataFrame, titles: DataFrame, popularity: DataFrame, start: str, end: str) -> DataFrame:
    """Labels with their title's properties and its popularity of the day before: the narrow side of ``training_set``."""
    s = sessions.filter("is_valid_session").filter(c("session_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    s = s.select("profile_id", "session_id", "title_id", "engagement_label", "session_date", c("session_date").alias("feature_date"))
    pop = popularity.select("title_id", F.date_add("metric_date", 1).alias("session_date"), "popularity_score")
    return s.join(titles.select("title_id", "content_type", "runtime_bucket", "is_original", "days_since_release"), "title_id", "left").join(pop, ["title_id", "session_date"], "left")


def with_features(labelled: DataFrame, features: DataFrame) -> DataFrame:
    """Labels with the features of their own day (which know only the days before).  The wide rows of the features are met last, once."""
    own = [x for x in features.columns if x not in ("profile_id", "feature_date")]
    last = [x for x in labelled.columns if x not in ("profile_id", "feature_date", "title_id", "session_date", "session_id", "engagement_label")]
    return features.join(labelled, ["profile_id", "feature_date"]).select("title_id", "session_date", "profile_id", "feature_date", *own, "session_id", "engagement_label", *last)


def training_set(features: DataFrame, sessions: DataFrame, titles: DataFrame, popularity: DataFrame, start: str, end: str) -> DataFrame:
    """Labels with the features of their own day (which know only the days before) and the popularity of the day before."""
    return with_features(labelled_sessions(sessions, titles, popularity, start, end), features)


def with_genre_share(labelled: DataFrame, sessions: DataFrame, title_genres: DataFrame, genres: DataFrame) -> DataFrame:
    """Rows that know their title's ``primary_genre``, with the profile's affinity for it on the row's day as ``genre_affinity``, where the map of all genres would stand (before ``tier``, if there is one); 0 without."""
    at = F.unix_date("session_date")
    shares = genre_shares_at(sessions, title_genres, genres, labelled.select("profile_id", "session_date", "primary_genre").select("profile_id", at.alias("at"), c("primary_genre").alias("genre_name")))
    shares = shares.select("profile_id", F.date_from_unix_date("at").alias("session_date"), c("genre_name").alias("primary_genre"), "share")
    place = labelled.columns.index("tier") if "tier" in labelled.columns else len(labelled.columns)
    joined = labelled.join(shares, ["profile_id", "session_date", "primary_genre"], "left")
    return joined.select(*labelled.columns[:place], F.coalesce("share", F.lit(0.0)).alias("genre_affinity"), *labelled.columns[place:])


def refuse_small(df: DataFrame, least: int = 10_000) -> DataFrame:
    if (n := df.limit(least).count()) < least:
        raise ValueError(f"only {n} training rows; {least} are needed")
    return df


def temporal_split(df: DataFrame, holdout_days: int = 14, day: str = "session_date") -> tuple[DataFrame, DataFrame]:
    """Rows up to ``holdout_days`` before the newest, and those after; never a random split."""
    newest = df.agg(F.max(day)).first()[0]
    cutoff = F.date_sub(F.lit(newest).cast("date"), holdout_days)
    return df.filter(c(day) <= cutoff), df.filter(c(day) > cutoff)


def interactions(sessions: DataFrame, as_of_day: str, days: int = 180) -> DataFrame:
    """Completion-weighted pairs of profile and title; a rewatch adds weight, faint pairs (0.1 or less) go."""
    recent = sessions.filter("is_valid_session").filter((c("session_date") >= F.date_sub(F.lit(as_of_day).cast("date"), days)) & (c("session_date") < F.lit(as_of_day).cast("date")))
    weight = F.sum(F.when(c("completion_ratio").isNotNull(), F.least("completion_ratio", F.lit(1.0))))
    return recent.groupBy("profile_id", "title_id").agg(weight.alias("weight"), F.count("*").alias("session_count")).filter("weight > 0.1")
