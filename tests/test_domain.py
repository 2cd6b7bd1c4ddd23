"""Hand-made cases of the domain operators; each names the trap it covers."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinolytics import schemas as S
from kinolytics.functions import expressions as X
from kinolytics.operators import cdc, checks, timetravel
from kinolytics.plans import embeddings as E
from kinolytics.plans import features as FT
from kinolytics.plans import marts as M
from kinolytics.plans import recommend as R
from kinolytics.plans import staging as ST
from kinolytics.sources import io as IO
from kinolytics.streaming import qoe
from kinolytics.streaming import sessions as SS

c = F.col
T = dt.datetime
DAY = dt.date


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def raw_events(spark, entries):
    """entries: (event_id, session_id, event_type, event_ts, ingest_ts, extra)"""
    base = {f.name: None for f in S.schema(S.PLAYBACK_EVENTS)}
    out = []
    for e in entries:
        r = base | {"event_id": e[0], "session_id": e[1], "profile_id": 1, "title_id": 1, "region_code": "EU", "event_type": e[2], "event_ts": e[3], "ingest_ts": e[4], "position_seconds": 0, "device_type": "tv", "app_version": "1"} | (e[5] if len(e) > 5 else {})
        out.append(tuple(r[n] for n in base))
    return spark.createDataFrame(out, S.PLAYBACK_EVENTS)


def test_duplicates_clamp_and_guards(spark):
    t = T(2024, 1, 1, 12)
    e = raw_events(spark, [
        ("a", "s", "REBUFFER", t, t, {"rebuffer_ms": 60000}), ("a", "s", "REBUFFER", t, t, {"rebuffer_ms": 60000}), ("b", "s", "REBUFFER", t, t, {"rebuffer_ms": 60001}),
        ("c", "s", "REBUFFER", t, t, {"rebuffer_ms": -1}), ("d", "s", "REBUFFER", t, t, {"rebuffer_ms": 0}), ("e", "s", "START", T(2024, 1, 31, 0, 59), t), ("f", "s", "START", T(2024, 1, 31, 1, 1), t),
        ("g", "s", "START", t, t + dt.timedelta(seconds=5)), ("g", "s", "START", t, t + dt.timedelta(seconds=65)),
    ])
    got = ST.playback_events(e, "2024-01-31")
    assert rows(got, "event_id", "rebuffer_ms", "ab_bucket") == [("a", 60000, "control"), ("b", None, "control"), ("c", None, "control"), ("d", 0, "control"), ("e", None, "control"), ("g", None, "control")]
    assert got.filter("event_id = 'g'").first()["clock_skew_seconds"] == -5


def test_unknown_title_is_not_completed(spark):
    t = T(2024, 1, 1)
    e = raw_events(spark, [(str(k), f"s{k % 3}", "HEARTBEAT", t, t, {"title_id": k % 3}) for k in range(30)])
    titles = spark.createDataFrame([(0, "a", "film", 0, True, "G"), (1, "b", "film", 100, True, "G")], "title_id bigint, title_name string, content_type string, runtime_seconds int, is_original boolean, maturity_rating string")
    got = M.watch_sessions(ST.playback_events(e, "2024-01-31"), titles)
    assert rows(got, "session_id", "completion_ratio", "is_completed", "engagement_label") == [("s0", None, None, 0), ("s1", 1.0, True, 1), ("s2", None, None, 0)]


LOG = "id bigint, tier string, updated_at timestamp, __lsn bigint, __deleted string"


def test_delete_then_insert_and_equal_times(spark):
    t = T(2024, 1, 1)
    log = spark.createDataFrame([(1, "a", t, 1, None), (1, "a", t, 2, "true"), (1, "b", t, 3, "false"), (2, "a", t, 5, None), (2, "b", t, 6, None), (3, "a", t, 1, None), (3, "a", t, 9, "true")], LOG)
    assert rows(cdc.current_state(log, ["id"]), "id", "tier") == [(1, "b"), (2, "b")]


def test_snapshot_equals_log_history_when_every_change_is_seen(spark):
    days = [T(2024, 1, d) for d in range(1, 8)]
    changes = [(1, "a", days[0], 1, None), (2, "a", days[1], 2, None), (1, "b", days[2], 3, None), (2, "a", days[3], 4, "true"), (1, "c", days[4], 5, None), (3, "x", days[5], 6, None)]
    log = spark.createDataFrame(changes, LOG)
    held = log.limit(0).select("id", "tier", "updated_at", c("updated_at").alias("valid_from"), c("updated_at").alias("valid_to"))
    for k, d in enumerate(days[:6], 1):
        held = spark.createDataFrame(cdc.snapshot(held, cdc.current_state(log.filter(c("__lsn") <= k), ["id"]), "id", ["tier"], F.lit(d)).collect(), held.schema)
    assert rows(held, "id", "tier", "valid_from", "valid_to") == rows(cdc.history(log, "id", ["tier"]), "id", "tier", "valid_from", "valid_to")
    # two changes between two runs: the snapshot sees one, the log both
    skipped = cdc.snapshot(held.limit(0), cdc.current_state(log.filter("id = 1"), ["id"]), "id", ["tier"], F.lit(days[6]))
    assert skipped.count() == 1 and cdc.history(log.filter("id = 1"), "id", ["tier"]).count() == 3


def test_envelope_and_routing(spark):
    m = spark.createDataFrame([("t", '{"op":"c","after":{"id":1,"x":"a"},"source":{"lsn":5,"ts_ms":1000}}'), ("t", '{"op":"d","before":{"id":1,"x":"a"},"after":null,"source":{"lsn":6,"ts_ms":2000}}'), ("t", None)], "topic string, value string")
    got = cdc.unwrap(m, S.schema("id bigint, x string"))
    assert rows(got, "id", "x", "__op", "__lsn", "__deleted") == [(1, "a", "c", 5, "false"), (1, "a", "d", 6, "true"), (None, None, None, None, None)]
    topics = spark.createDataFrame([("streaming.streaming.titles",), ("other",)], "topic string").select(cdc.routed_table(c("topic")).alias("t"))
    assert rows(topics, "t") == [("cdc.titles",), ("other",)]


SESSION = "profile_id bigint, session_id string, title_id bigint, session_date date, seconds_watched bigint, completion_ratio double, is_completed boolean, is_valid_session boolean, rebuffer_seconds_per_hour double"


def sessions_on(spark, ages, day):
    return spark.createDataFrame([(1, f"s{k}", k % 3, day - dt.timedelta(days=a), 100, 0.5, False, True, 1.0) for k, a in enumerate(ages)], SESSION)


def test_window_edges(spark):
    day = DAY(2024, 6, 1)
    s, p = sessions_on(spark, [0, 1, 7, 8, 90, 91], day), spark.createDataFrame([(1,), (2,)], "profile_id bigint")
    for f in (timetravel.profile_windows, plain_windows):
        got = f(s, p, "2024-06-01", "2024-06-02")
        assert rows(got, "profile_id", "sessions_7d", "sessions_30d", "sessions_90d", "last_session_date") == [(1, 2, 3, 4, DAY(2024, 5, 31)), (2, 0, 0, 0, None)]


def plain_windows(sessions, profiles, start, end):
    return timetravel.profile_windows_at(sessions, profiles.crossJoin(timetravel.date_spine(sessions, start, end)))


def near(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in (r[n] for n in sorted(df.columns))) for r in df.collect())


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 4), st.integers(0, 120)), max_size=25))
def test_fast_windows_equal_plain_ones(spark, entries):
    day = DAY(2024, 6, 1)
    s = spark.createDataFrame([(p, f"s{k}", t, day - dt.timedelta(days=a), 60 * t, t / 4, t > 3, True, float(a)) for k, (p, t, a) in enumerate(entries)], SESSION)
    p = spark.createDataFrame([(1,), (2,), (3,)], "profile_id bigint")
    assert near(plain_windows(s, p, "2024-05-20", "2024-06-01")) == near(timetravel.profile_windows(s, p, "2024-05-20", "2024-06-01"))
    # intervals of the whole history, listed by day, are the same rows wherever there are sessions in the longest window
    every = timetravel.listed(timetravel.profile_intervals(s), "2024-01-01", "2024-12-01").filter("sessions_90d > 0")
    assert near(every) == near(plain_windows(s, p, "2024-01-01", "2024-12-01").filter("sessions_90d > 0"))


def test_a_session_changes_no_feature_up_to_its_day(spark):
    p = spark.createDataFrame([(1,)], "profile_id bigint")
    old, new = (timetravel.profile_windows(sessions_on(spark, a, DAY(2024, 6, 5)), p, "2024-06-01", "2024-06-10") for a in ([20, 30], [20, 30, 0]))
    same = lambda df: rows(df.filter("feature_date <= date'2024-06-05'"), *sorted(df.columns))
    assert same(old) == same(new) and rows(old, "sessions_7d") != rows(new, "sessions_7d")


def test_two_subscriptions_give_one_context(spark):
    t = T(2024, 1, 1)
    h = spark.createDataFrame([(1, 7, "basic", "active", t, t, None), (2, 7, "premium", "cancelled", T(2024, 2, 1), T(2024, 2, 1), None), (3, 7, "standard", "active", T(2024, 1, 15), T(2024, 1, 15), T(2024, 3, 2))], "subscription_id bigint, subscriber_id bigint, tier string, status string, started_at timestamp, valid_from timestamp, valid_to timestamp")
    got = FT.subscription_segments(h.withColumn("__lsn", c("subscription_id")))
    march = timetravel.listed(got, "2024-03-01", "2024-03-03").withColumn("tenure_days", F.datediff("feature_date", "started_on"))
    assert rows(march, "feature_date", "tier", "is_active", "tenure_days") == [(DAY(2024, 3, 1), "standard", True, 46), (DAY(2024, 3, 2), "basic", True, 61)]
    assert rows(got, "valid_from", "valid_to", "tier") == [(DAY(2024, 1, 1), DAY(2024, 1, 15), "basic"), (DAY(2024, 1, 15), DAY(2024, 3, 2), "standard"), (DAY(2024, 3, 2), None, "basic")]


HISTORY = "subscriber_id bigint, tier string, status string, started_at timestamp, valid_from timestamp, valid_to timestamp, __lsn bigint"


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["basic", "premium"]), st.booleans(), st.integers(0, 3), st.integers(0, 30), st.one_of(st.none(), st.integers(-2, 12))), max_size=20))
def test_segments_equal_a_choice_on_every_day(spark, entries):
    day = lambda k: T(2024, 1, 1) + dt.timedelta(days=k)
    held = [(who, tier, "active" if on else "paused", day(s), day(a), None if n is None else day(a + n), k) for k, (who, tier, on, s, a, n) in enumerate(entries)]
    want = set()
    for who in (1, 2, 3):
        for d in range(60):
            live = [h for h in held if h[0] == who and h[4] <= day(d) and (h[5] is None or day(d) < h[5])]
            if live:
                best = max(live, key=lambda h: (h[2] == "active", h[3], h[4], h[6]))
                want.add((who, day(d).date(), best[1], best[2] == "active", best[3].date()))
    segments = FT.subscription_segments(spark.createDataFrame(held, HISTORY))
    got = timetravel.listed(segments.filter("known"), "2024-01-01", "2024-03-01")
    assert set(rows(got, "subscriber_id", "feature_date", "tier", "is_active", "started_on")) == want and got.count() == len(want)
    s = sorted((r for r in segments.collect()), key=lambda r: (r["subscriber_id"], r["valid_from"]))
    for a, b in zip(s, s[1:], strict=False):  # contiguous, and neighbours differ
        assert a["subscriber_id"] != b["subscriber_id"] or (a["valid_to"] == b["valid_from"] and tuple(a)[3:] != tuple(b)[3:])


@settings(max_examples=2, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(0, 3), st.integers(0, 200)), max_size=15))
def test_features_of_days_points_and_intervals_agree(spark, entries):
    """Each form against the plain one: windows by the join, affinity by loops."""
    start = DAY(2024, 1, 1)
    s = spark.createDataFrame([(p, f"s{k}", t, start + dt.timedelta(days=a), 60 + 10 * t, t / 4, t > 2, True, 1.0) for k, (p, t, a) in enumerate(entries)], SESSION)
    p = spark.createDataFrame([(1, 1), (2, 2)], "profile_id bigint, subscriber_id bigint")
    tg, g = spark.createDataFrame([(0, 1), (1, 1), (1, 2), (2, 2)], "title_id bigint, genre_id int"), spark.createDataFrame([(1, "a"), (2, "b")], "genre_id int, genre_name string")
    h = spark.createDataFrame([(1, "basic", "active", T(2024, 1, 5), T(2024, 2, 1), T(2024, 3, 1), 1)], HISTORY)
    days = FT.profile_features(s, p, tg, g, h, "2024-04-01", "2024-04-20")
    points = p.crossJoin(timetravel.date_spine(s, "2024-04-01", "2024-04-20")).select("profile_id", "feature_date")
    assert near(days) == near(FT.features_at(s, p, tg, g, h, points)) and days.count() == 38
    names = [x for x in plain_windows(s, p, "2024-04-01", "2024-04-20").columns if x in days.columns]
    assert near(days.select(*names)) == near(plain_windows(s, p.select("profile_id"), "2024-04-01", "2024-04-20").select(*names))
    genres = {0: "a", 1: "ab", 2: "b", 3: ""}
    for r in days.collect():
        seen: dict = {}
        for who, t, a in entries:
            if who == r["profile_id"] and 0 < (r["feature_date"] - start).days - a <= 90:
                for x in genres[t]:
                    seen[x] = seen.get(x, 0) + 60 + 10 * t
        assert r["genre_affinity"] == {x: pytest.approx(n / sum(seen.values()), abs=6e-5) for x, n in seen.items()}
    spans = FT.feature_intervals(s, p, tg, g, h)
    listed = timetravel.listed(spans, "2024-04-01", "2024-04-20").filter("sessions_90d > 0").select("profile_id", "feature_date", "sessions_7d", "genre_affinity", "tier", "last_session_date")
    other = days.filter("sessions_90d > 0").select("profile_id", "feature_date", "sessions_7d", "genre_affinity", "tier", F.date_sub("feature_date", c("days_since_last_session")).alias("last_session_date"))
    assert near(listed) == near(other)


def test_a_table_built_in_steps_equals_one_built_at_once(spark, tmp_path):
    import random

    draw = random.Random(5)
    start = DAY(2024, 1, 1)
    entries = [(draw.randint(1, 6), draw.randint(0, 4), draw.choice([draw.randint(0, 240), draw.randint(150, 200)])) for _ in range(160)] + [(7, 1, 3), (8, 1, 120)]
    s = spark.createDataFrame([(p, f"s{k}", t, start + dt.timedelta(days=a), 60 + 10 * t, t / 3, t > 2, True, t / 7) for k, (p, t, a) in enumerate(entries)], SESSION)
    s.repartition("session_date").write.partitionBy("session_date").parquet(f"{tmp_path}/s")
    by_day = spark.read.parquet(f"{tmp_path}/s")
    p = spark.createDataFrame([(k, k) for k in range(1, 10)], "profile_id bigint, subscriber_id bigint")
    tg, g = spark.createDataFrame([(t, 1 + t % 2) for t in range(5)], "title_id bigint, genre_id int"), spark.createDataFrame([(1, "a"), (2, "b")], "genre_id int, genre_name string")
    h = spark.createDataFrame([(k, "basic", "active", T(2024, 1, 5), T(2024, 2, 1), T(2024, 7, 20), k) for k in range(1, 9)], HISTORY)
    table = FT.FeatureTable(f"file://{tmp_path}/t")
    day = "2024-06-30"
    table.begin(by_day, day)
    for until in ("2024-07-01", "2024-07-18", "2024-07-19", "2024-07-31"):
        table.extend(day, until, by_day, p, tg, g, h)
        assert table.newest(spark) == until
        day = until
    # a run that is repeated changes nothing, and one day's needs no session older than the 90 days before it
    table.extend("2024-07-18", "2024-07-19", by_day.filter("session_date between date'2024-04-19' and date'2024-07-18'"), p, tg, g, h)
    whole = FT.profile_features(by_day, p, tg, g, h, "2024-07-01", "2024-08-01")
    assert near(table.read(spark).select(*sorted(whole.columns))) == near(whole) and whole.count() == 31 * 9


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 300), st.integers(1, 9)), min_size=1, max_size=25, unique_by=lambda x: x[:2]))
def test_popularity_by_marks_equals_sums_over_days(spark, entries):
    start = DAY(2024, 1, 1)
    a = spark.createDataFrame([(t, start + dt.timedelta(days=d), n, n + 1, 10 * n, n / 10) for t, d, n in entries], "title_id bigint, session_date date, sessions bigint, unique_viewers bigint, seconds_watched bigint, completion_rate double")
    want = {}
    for x in range(20, 200):
        for t in (1, 2, 3):
            seen = [(x - d, n) for u, d, n in entries if u == t and 0 < x - d <= 60]
            if seen:
                month = [n / 10 for age, n in seen if age <= 30]
                want[(t, start + dt.timedelta(days=x))] = (sum(n * 0.5 ** (age / 14) for age, n in seen), sum(n for age, n in seen if age <= 7), sum(month) / len(month) if month else None)
    low, high = str(start + dt.timedelta(days=20)), str(start + dt.timedelta(days=200))
    got = {(r["title_id"], r["metric_date"]): (r["weighted_sessions"], r["sessions_7d"], r["completion_rate_30d"]) for r in timetravel.popularity_windows(a, low, high).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    points = spark.createDataFrame([(t, start + dt.timedelta(days=x)) for t in (1, 2, 3) for x in range(20, 200, 7)], "title_id bigint, metric_date date")
    score = {(r["title_id"], r["metric_date"]): r["popularity_score"] for r in timetravel.popularity_at(a, points, low, high).collect()}
    best: dict = {}
    for (_, day), v in want.items():
        best[day] = max(best.get(day, 0), v[0])
    assert score == {k: pytest.approx(v[0] / best[k[1]], abs=1e-6) for k, v in want.items() if (k[1] - start).days % 7 == 6}


def test_missing_day_shifts_rows_but_not_dates(spark):
    days = [d for d in range(1, 12) if d != 5]
    q = spark.createDataFrame([(DAY(2024, 1, d), "p", "EU", float(d)) for d in days], "metric_date date, cdn_pop string, region_code string, rebuffer_seconds_per_hour double")
    got = {r["metric_date"].day: r["seven_days_before"] for r in M.qoe_same_weekday_by_date(q).collect()}
    assert got[11] == 4.0 and got[8] == 1.0 and got[2] is None and 12 not in got


def test_alert_needs_all_bars_and_cools_down(spark):
    def windows(sessions):
        base = T(2024, 1, 1)
        out = [("p", "EU", base + dt.timedelta(seconds=15 * k), sessions, 0, 0.0, 100.0, 0, 0, 0.01) for k in range(20)]
        out += [("p", "EU", base + dt.timedelta(seconds=15 * (20 + k)), sessions, 0, 0.0, 100.0, 2, 5, 0.5) for k in range(4)]
        out += [("p", "EU", base + dt.timedelta(seconds=15 * (24 + k)), sessions, 0, 0.0, 100.0, 0, 0, 0.01) for k in range(200)]
        out += [("p", "EU", base + dt.timedelta(seconds=15 * 224), sessions, 0, 0.0, 100.0, 0, 0, 0.9)]
        return spark.createDataFrame(out, S.TABLES["qoe_windows"])

    assert qoe.detect(windows(24)).count() == 0
    got = qoe.detect(windows(25)).orderBy("detected_at").collect()
    assert [(r["severity"], (r["detected_at"] - T(2024, 1, 1)).seconds // 15) for r in got] == [("critical", 20), ("critical", 224)]
    b, fired = qoe.Baseline(), []
    for r in windows(25).orderBy("window_end").collect():
        if b.see(int(r["window_end"].timestamp() * 1e6), r["rebuffer_ratio"], r["sessions"], 25, 3.0, 0.05):
            fired.append(r["window_end"])
    assert fired == [r["detected_at"] for r in got]


def test_catalogue_rules(spark):
    ranked = spark.createDataFrame([(1, t, 1.0 - t / 100, "g1" if t < 8 else "g2", "r") for t in range(12)] + [(2, 1, 0.5, None, "r")], "profile_id bigint, title_id bigint, score double, primary_genre string, reason string")
    watched = spark.createDataFrame([(1, 0)], "profile_id bigint, title_id bigint")
    assert rows(R.presented(ranked, watched, 5), "profile_id", "rank", "title_id", "primary_genre") == [(1, 1, 1, "g1"), (1, 2, 2, "g1"), (1, 3, 3, "g1"), (1, 4, 8, "g2"), (1, 5, 9, "g2"), (2, 1, 1, "unknown")]
    rank = spark.createDataFrame([(1, DAY(2024, 1, 1), 1, 1, 0.9)] + [(2, DAY(2024, 1, 1), k, 0, 0.1) for k in range(3)] + [(3, DAY(2024, 1, 1), 1, 0, 0.9), (3, DAY(2024, 1, 1), 2, 1, 0.8)], "profile_id bigint, session_date date, title_id bigint, engagement_label int, score double")
    got = R.ndcg(rank, 10).first()
    assert got["groups"] == 1 and got["ndcg"] == pytest.approx(1 / 1.5849625007211562)


def test_vectors_history_and_cold_start(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.6, 0.8])], "title_id bigint, vector array<double>")
    h = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.0), (1, 99, 1.0), (2, 99, 1.0)], "profile_id bigint, title_id bigint, completion_ratio double")
    got = E.profile_vectors(h, v).collect()
    assert len(got) == 1 and got[0]["vector"] == pytest.approx([1 / (1 + 0.05**2) ** 0.5, 0.05 / (1 + 0.05**2) ** 0.5])
    cat = spark.createDataFrame([(1, "g", 0.2, ["EU"]), (2, "g", 0.9, ["EU", "US"]), (3, "g", 0.5, [])], "title_id bigint, primary_genre string, popularity_score double, regions array<string>")
    p = spark.createDataFrame([(1, "EU"), (2, "US")], "profile_id bigint, region_code string")
    found = R.candidates(p, E.profile_vectors(h, v), v, cat, 5)
    assert rows(found, "profile_id", "title_id", "reason") == [(1, 1, "similar_to_your_history"), (1, 2, "similar_to_your_history"), (2, 2, "popular_in_region")]
    same = E.recall(E.nearest(v.withColumnRenamed("title_id", "profile_id"), v, 2), E.nearest(v.withColumnRenamed("title_id", "profile_id"), v, 2), 2)
    assert same.first()["recall"] == 1.0


def test_embeddings_keep_the_gram_matrix(spark):
    pairs = spark.createDataFrame([(p, t, 1.0 + p % 2) for p in range(12) for t in range(5) if (p + t) % 3], "profile_id bigint, title_id bigint, weight double")
    got = E.title_embeddings(pairs, 3).collect()
    assert len(got) == 5 and all(sum(x * x for x in r["vector"]) == pytest.approx(1, abs=1e-5) for r in got)


def test_promotion_gate(spark):
    def gate(*m):
        return tuple(R.promotion(spark.createDataFrame(list(m), "role string, ndcg_at_10 double, ndcg_at_10_cold_start double")).first())

    assert gate(("candidate", 0.5, 0.3)) == (True, "no incumbent")
    assert gate(("candidate", 0.501, 0.3), ("incumbent", 0.5, 0.3)) == (False, "gain below threshold")
    assert gate(("candidate", 0.51, 0.28), ("incumbent", 0.5, 0.3)) == (False, "cold start regressed")
    assert gate(("candidate", 0.51, 0.29), ("incumbent", 0.5, 0.3)) == (True, "improved")


def test_parity_thresholds(spark):
    def drifting(n, bad, zero=False):
        f = spark.range(n).select(c("id").cast("string").alias("session_id"), c("id").alias("profile_id"), F.lit(0 if zero else 100).alias("seconds_watched"), F.lit(1.0).alias("rebuffer_seconds"), F.lit(0.5).alias("completion_ratio"))
        on = f.withColumn("seconds_watched", F.when(c("profile_id") < bad, c("seconds_watched") + 3).otherwise(c("seconds_watched")))
        return checks.parity(on, f).count()

    assert drifting(499, 400) == 0 and drifting(500, 5) == 0 and drifting(500, 6) == 6 and drifting(500, 6, True) == 6


def test_checks_freshness_and_contract(spark):
    d = spark.createDataFrame([(1, "x"), (None, "y"), (1, None)], "a int, b string")
    assert rows(checks.broken_counts(d, {"a": checks.not_null("a"), "b": checks.accepted("b", ["x"])}), "rule", "broken", "rows") == [("a", 1, 3), ("b", 1, 3)]
    assert checks.failures(d, {"a": checks.not_null("a")}).count() == 1 and checks.repeated(d, ["a"]).count() == 1
    assert checks.orphans(d, "a", spark.createDataFrame([(2,)], "id int"), "id").count() == 2
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    at = lambda t: checks.freshness(spark.createDataFrame([(t,)], "t timestamp"), "t", now, 1, 6).first()["status"]
    assert [at(T(2024, 1, 1, 23, 30)), at(T(2024, 1, 1, 20)), at(T(2024, 1, 1, 1)), at(None)] == ["pass", "warn", "error", "error"]
    assert S.contract_errors(d, "a int, b string") == [] and len(S.contract_errors(d, "a bigint, z int")) == 3
    with pytest.raises(ValueError):
        S.check_contract(d, "a bigint, b string")


def test_upsert_follows_a_key_to_its_new_partition(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    kind = "k int, x string, d string"
    IO.clustered(spark.createDataFrame([(1, "a", "d1"), (2, "a", "d1"), (3, "a", "d2"), (4, "a", "d3")], kind), path, "d", "k")
    IO.upsert_partitions(spark, path, spark.createDataFrame([(3, "b", "d1"), (2, "b", "d1"), (5, "b", "d4")], kind), ["k"], "d")
    assert rows(spark.read.parquet(path), "k", "x", "d") == [(1, "a", "d1"), (2, "b", "d1"), (3, "b", "d1"), (4, "a", "d3"), (5, "b", "d4")]
    table = IO.KeyedTable(spark, f"file://{tmp_path}/v", 4)
    assert table.read() is None
    table.upsert(spark.createDataFrame([(1, "a", "d"), (9, "z", "a")], kind), ["k"])
    table.upsert(spark.createDataFrame([(1, "b", "e"), (2, "c", "e")], kind), ["k"])
    assert rows(table.read(), "k", "x", "d") == [(1, "b", "e"), (2, "c", "e"), (9, "z", "a")]
    table.upsert(spark.createDataFrame([(1, "old", "c"), (2, "new", "f")], kind), ["k"], "d")  # the higher d stays
    table.upsert(spark.createDataFrame([], kind), ["k"], "d")
    assert rows(table.read(), "k", "x", "d") == [(1, "b", "e"), (2, "new", "f"), (9, "z", "a")]
    import os

    assert len(os.listdir(tmp_path / "v" / "current")) == 2


def test_served_features_and_bounded_list(spark):
    t = T(2024, 1, 2)
    p = spark.createDataFrame([(1,), (2,), (3,)], "profile_id bigint")
    kind = "profile_id bigint, value string, expires_at timestamp"
    on, off = spark.createDataFrame([(1, "n", t), (2, "n", T(2024, 1, 1))], kind), spark.createDataFrame([(2, "f", t)], kind)
    got = R.served_features(p, on, off, F.lit("2024-01-01 12:00:00").cast("timestamp"))
    assert rows(got, "profile_id", "value", "served_from") == [(1, "n", "online"), (2, "f", "offline_fallback"), (3, None, "popularity_fallback")]
    lists = spark.createDataFrame([([1, 2],), ([],)], "x array<int>").select(X.bounded_append(c("x"), F.lit(9), 2).alias("y"))
    assert rows(lists, "y") == [([2, 9],), ([9],)]


def test_stream_sessions_split_by_silence_in_one_batch_and_across(spark, tmp_path):
    base = T(2024, 1, 1)
    at = lambda s: base + dt.timedelta(seconds=s)
    long = [(f"a{k}", "s1", "HEARTBEAT", at(10 * k), at(10 * k)) for k in range(270)]  # 45 minutes without a break
    late = at(2690 + 31 * 60)
    batches = [long + [("a0", "s1", "HEARTBEAT", at(0), at(60))], [("b0", "s1", "HEARTBEAT", late, late)], [("c0", "s2", "START", at(90_000), at(90_000))], [("d0", "s3", "START", at(100_000), at(100_000))]]
    src = f"{tmp_path}/in"
    for k, b in enumerate(batches):
        raw_events(spark, b).coalesce(1).write.mode("append").parquet(src + f"/part={k}")
    titles = spark.createDataFrame([(1, 5400, "drama")], "title_id bigint, runtime_seconds int, primary_genre string")
    stream = spark.readStream.schema(S.PLAYBACK_EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    got: list = []
    q = SS.session_features(stream, titles).writeStream.outputMode("update").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).foreachBatch(lambda d, n: got.extend(d.collect())).start()
    q.awaitTermination()
    final = sorted((r["session_id"], r["session_start"], r["seconds_watched"], r["event_count"]) for r in got if r["final"])
    assert final[:2] == [("s1", base, 2700, 270), ("s1", late, 10, 1)]
    assert len([r for r in got if not r["final"]]) == 273  # every event emits at once, the retry does not
    first = [r for r in got if r["session_id"] == "s1" and not r["final"]]
    assert max(r["completion_ratio"] for r in first) == pytest.approx(0.5) and first[0]["sessions_last_7d"] == 1


def test_stream_keeps_nothing_of_profiles_that_stay_away(spark, tmp_path):
    """The last bucket leaves after seven days: state rows fall back to the profile that is still active."""
    base = T(2024, 1, 1)
    at = lambda day: base + dt.timedelta(days=day)
    batches = [[(f"p{p}-{d}", f"s{p}-{d}", "HEARTBEAT", at(d), at(d), {"profile_id": p}) for p in (1, 2) for d in (0, 1)], [("p3", "s3", "START", at(12), at(12), {"profile_id": 3})], [("p3b", "s3b", "START", at(12.5), at(12.5), {"profile_id": 3})]]
    for k, b in enumerate(batches):
        raw_events(spark, b).coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
    titles = spark.createDataFrame([(1, 5400, "drama")], "title_id bigint, runtime_seconds int, primary_genre string")
    stream = spark.readStream.schema(S.PLAYBACK_EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    got: list = []
    q = SS.session_features(stream, titles).writeStream.outputMode("update").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).foreachBatch(lambda d, n: got.extend(d.collect())).start()
    q.awaitTermination()
    kept = spark.read.format("statestore").option("stateVarName", "profile_v2").option("operatorId", 0).load(f"file://{tmp_path}/c").select("key.profile_id").collect()
    assert {r["profile_id"] for r in kept} == {3}
    assert len([r for r in got if r["final"] and r["profile_id"] in (1, 2)]) == 4
    first = [r for r in got if r["session_id"] == "s1-1" and not r["final"]][0]
    assert (first["sessions_last_7d"], first["distinct_titles_last_7d"], first["genre_affinity"]) == (2, 1, '{"drama": 1.0}')


def test_stream_detector_equals_the_fold(spark, tmp_path):
    base = T(2024, 1, 1)
    w = spark.createDataFrame([("p", "EU", base + dt.timedelta(seconds=15 * k), 30, 0, 0.0, 100.0, 1, 7, 0.01 if k % 60 < 40 else 0.4) for k in range(150)], S.TABLES["qoe_windows"])
    w.repartition(3).write.parquet(f"{tmp_path}/w")
    got: list = []
    q = qoe.detect_stream(spark.readStream.schema(w.schema).parquet(f"{tmp_path}/w")).writeStream.outputMode("append").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).foreachBatch(lambda d, n: got.extend(d.collect())).start()
    q.awaitTermination()
    want = qoe.detect(w)
    names = ("detected_at", "severity", "rebuffer_ratio", "baseline_ratio", "z_score", "sessions_affected")
    assert sorted(tuple(r[n] for n in names) for r in got) == rows(want, *names) and got


def test_windows_of_a_stream_equal_those_of_a_table(spark, tmp_path):
    base = T(2024, 1, 1)
    kinds = ["HEARTBEAT", "REBUFFER", "ERROR", "START"]
    e = raw_events(spark, [(str(k), f"s{k % 7}", kinds[k % 4], base + dt.timedelta(seconds=3 * k), base, {"cdn_pop": f"p{k % 2}" if k % 11 else None, "rebuffer_ms": 500, "startup_ms": k}) for k in range(200)] + [("end", "z", "START", base + dt.timedelta(hours=2), base, {"cdn_pop": "p0"})])
    e.coalesce(1).write.parquet(f"{tmp_path}/e")
    stream = spark.readStream.schema(e.schema).parquet(f"{tmp_path}/e").withWatermark("event_ts", "5 seconds")
    q = qoe.qoe_windows(stream).writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    names = ("pop", "window_end", "sessions", "rebuffer_seconds", "playback_seconds", "error_events", "p95_startup_ms", "rebuffer_ratio")
    got = rows(spark.read.parquet(f"{tmp_path}/out"), *names)
    assert got == rows(qoe.qoe_windows(e).filter("window_end < timestamp'2024-01-01 01:00:00'"), *names) and len(got) > 40
