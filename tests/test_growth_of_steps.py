"""What steps shuffle and list must grow no faster than their input; with the results of plain code."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinolytics.functions import expressions as X
from kinolytics.operators import ordering
from kinolytics.operators import timetravel as T
from kinolytics.plans import features as FT
from kinolytics.plans import marts as M
from kinolytics.plans import recommend as R
from kinolytics.sources.shared import CLEANED, stored

DAY = dt.date(2024, 1, 1)


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def some_sessions(spark, profiles=(1, 2, 3)):
    """Null titles and measures, invalid sessions, several sessions of a title on one day."""
    rows = [(p, None if k % 7 == 0 else (k * p) % 5, DAY + dt.timedelta(days=(k * k * p) % 140), 30 * k, None if k % 6 == 0 else k / 40, k % 3 == 0, float(k), k % 9 != 0) for p in profiles for k in range(40)]
    return rows, spark.createDataFrame(rows, "profile_id bigint, title_id bigint, session_date date, seconds_watched bigint, completion_ratio double, is_completed boolean, rebuffer_seconds_per_hour double, is_valid_session boolean")


def test_plain_join_copies_no_row_for_a_distinct_count(spark):
    rows, s = some_sessions(spark)
    found = T.profile_windows_at(s, T.change_days(s))
    assert "Expand" not in plan(found)
    got = {(r["profile_id"], r["feature_date"]): r for r in found.collect()}
    assert len(got) == T.change_days(s).count()
    for (p, d), r in got.items():
        for w in (7, 30, 90):
            near = [x for x in rows if x[0] == p and x[7] and d - dt.timedelta(days=w) <= x[2] < d]
            assert (r[f"active_days_{w}d"], r[f"sessions_{w}d"], r[f"distinct_titles_{w}d"]) == (len({x[2] for x in near}), sum(x[1] is not None for x in near), len({x[1] for x in near} - {None}))


def test_sums_of_days_list_no_row(spark):
    """Spans with and without an end, outside the days asked for, and without days to count from."""
    day = lambda k: None if k is None else DAY + dt.timedelta(days=k)
    rows = [(1, -5, 3, 2, 0.25, -9, None), (1, 3, None, None, 1.5, 1, 2), (2, 0, 12, 7, 0.1, None, -40), (2, 12, None, 1, 0.2, 11, -40), (3, 4, 4, 100, 9.0, 0, 0), (4, 20, None, 5, 1.0, 3, 3)]
    spans = spark.createDataFrame([(p, day(a), day(b), n, x, day(last), None, day(since)) for p, a, b, n, x, last, since in rows], "profile_id bigint, valid_from date, valid_to date, n bigint, x double, last_session_date date, first_session_date date, started_on date")
    found = FT.sums_by_day(spans, "2024-01-01", "2024-01-15", ["n", "x", "days_since_last_session", "profile_age_days", "tenure_days"])
    assert sum("Generate" in x for x in plan(found.select("rows")).splitlines()) == 2  # two edges of a span, and the days of the sums
    want = []
    for k in range(14):
        on = [r for r in rows if r[1] <= k and (r[2] is None or k < r[2])]
        want.append((day(k), len(on), sum(r[3] or 0 for r in on), round(sum(r[4] for r in on), 6), sum(999 if r[5] is None else k - r[5] for r in on), 0, sum(0 if r[6] is None else k - r[6] for r in on)))
    assert [(*r[:3], float(r[3]), *r[4:]) for r in found.orderBy("feature_date").collect()] == want


def test_days_of_titles_are_ranked_where_their_spans_are(spark):
    rows = [(p, t, DAY + dt.timedelta(days=d), 60, True, True) for p, t, d in [(1, 1, 0), (2, 1, 0), (1, 2, 3), (3, 3, 9), (3, 2, 40), (2, 3, 41)]]
    s = spark.createDataFrame(rows, "profile_id bigint, title_id bigint, session_date date, seconds_watched bigint, is_completed boolean, is_valid_session boolean")
    found = M.title_popularity(s, "2024-01-01", "2024-02-20")
    text = plan(found)
    assert not any("metric_date" in x for x in text.splitlines() if "Exchange" in x) and sum(x.strip(" +-:").startswith("Sort") for x in text.splitlines()) <= 2
    got = {(r["metric_date"], r["title_id"]): (r["popularity_rank"], r["popularity_score"], r["viewers_7d"]) for r in found.collect()}
    want = {}
    for k in range(50):
        seen = {t: [k - d for _, u, d in [(r[0], r[1], (r[2] - DAY).days) for r in rows] if u == t and 0 < k - d <= 60] for t in (1, 2, 3)}
        weight = {t: sum(0.5 ** (age / 14) for age in ages) for t, ages in seen.items() if ages}
        for n, t in enumerate(sorted(weight, key=lambda t: (-round(weight[t], 9), t))):
            want[(DAY + dt.timedelta(days=k), t)] = (n + 1, round(weight[t] / max(weight.values()), 6), sum(age <= 7 for age in seen[t]))
    assert got == want


def test_no_row_of_a_genre_carries_its_profiles_days(spark):
    s = some_sessions(spark)[1]
    of = spark.createDataFrame([(t, g) for t in range(5) for g in (t % 2, 2)], "title_id bigint, genre_id int")
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "genre_id int, genre_name string")
    found = T.genre_affinity(s, of, names)
    text = plan(found)
    assert "collect_list" not in text and not any("Exchange hashpartitioning" in x and "genre_name" in x for x in text.splitlines())
    rows = [r for r in some_sessions(spark)[0] if r[7] and r[1] is not None]
    for r in found.collect():
        seen: dict = {}
        for p, t, d, seconds, *_ in rows:
            if p == r["profile_id"] and r["valid_from"] - dt.timedelta(days=90) <= d < r["valid_from"]:
                for g in ("ab"[t % 2], "c"):
                    seen[g] = seen.get(g, 0) + seconds
        assert r["share"] == (pytest.approx(seen[r["genre_name"]] / sum(seen.values()), abs=6e-5) if sum(seen.values()) else None)


def test_lists_of_equal_profiles_are_made_once(spark, monkeypatch):
    cat = spark.createDataFrame([(t, f"g{t % 4}", 1 / (t + 1), ["EU", "US"] if t % 2 else ["EU"]) for t in range(20)], "title_id bigint, primary_genre string, popularity_score double, regions array<string>")
    who = spark.createDataFrame([(p, "EU" if p % 3 else "US") for p in range(40)], "profile_id bigint, region_code string")
    watched = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (4, 1), (4, 2), (5, 99), (3, 0), (3, 1), (6, 3)], "profile_id bigint, title_id bigint")
    read = lambda d: sorted(tuple(r) for r in d.select("profile_id", "rank", "title_id", "score", "primary_genre").collect())
    plain = R.cold_start(who, cat, 10).withColumnRenamed("retrieval_score", "score").join(cat.select("title_id", "primary_genre"), "title_id")
    want, whole, made = read(R.presented(plain, watched, 5)), R.presented, []
    monkeypatch.setattr(R, "presented", lambda ranked, *a: made.append(ranked.count()) or whole(ranked, *a))
    assert read(R.popular_lists(who, cat, watched, 10, 5)) == want
    assert made == [60]  # six sets of two regions instead of forty profiles, ten candidates each


def test_state_of_a_day_makes_no_marks_of_what_has_left(spark, monkeypatch, tmp_path):
    s = some_sessions(spark)[1]
    day = str(DAY + dt.timedelta(days=130))
    whole, seen = T.totals_on(T.window_marks(s.filter(F.col("session_date") < day)), day), []
    monkeypatch.setattr(FT, "window_marks", lambda x: seen.append(x.agg(F.min("session_date")).first()[0]) or T.window_marks(x))
    table = FT.FeatureTable(f"file://{tmp_path}/t")
    table.begin(s, day)
    assert seen == [min(r[2] for r in some_sessions(spark)[0] if (r[2] - DAY).days >= 40)]
    read = lambda d: sorted(tuple(r) for r in d.select(whole.columns).collect())
    assert read(spark.read.parquet(f"{tmp_path}/t/states/{day}")) == read(whole)


def test_decomposition_in_blocks_and_bounded_passes(spark, monkeypatch):
    """Several blocks of rows, buckets and chunks; a spectrum with a long tail, against a plain decomposition; no more passes than set."""
    from kinolytics.plans import decomposition as D

    for name, value in (("BUCKET", 64), ("CELLS", 3000), ("NUMBERS", 900), ("SLICE", 200)):
        monkeypatch.setattr(D, name, value)
    rng = np.random.default_rng(5)
    matrix = np.where(rng.random((240, 150)) < 0.3, rng.random((240, 150)), 0)
    cells = spark.createDataFrame([(int(p), int(t), float(matrix[p, t])) for p, t in zip(*np.nonzero(matrix), strict=True)], "row bigint, at bigint, w double")
    made, whole = [], D.multiplied
    monkeypatch.setattr(D, "multiplied", lambda *a: made.append(a[3:]) or whole(*a))
    found = np.array([r["vector"] for r in D.leading_vectors(cells, 150, 6).orderBy("at").collect()])
    want = np.linalg.svd(matrix)[2][:6].T
    assert len(made) == D.PASSES and made[0] == (4, 3)
    assert np.allclose(found.T @ found, np.eye(6), atol=1e-6)
    assert np.linalg.norm(matrix @ found) == pytest.approx(np.linalg.norm(matrix @ want), rel=1e-4)
    assert (found[np.abs(found).argmax(axis=0), range(6)] > 0).all()


def test_vectors_of_profiles_list_no_place_of_a_vector(spark):
    from kinolytics.plans import embeddings as E

    titles = spark.createDataFrame([(1, [1.0, 0.0, 2.0]), (2, [0.0, 3.0, 1.0]), (3, None), (4, [0.0, 0.0, 0.0])], "title_id bigint, vector array<double>")
    history = spark.createDataFrame([(1, 1, 0.5), (1, 2, None), (1, 3, 1.0), (2, 3, 1.0), (3, 4, 1.0), (4, 2, 0.01), (4, 9, 1.0)], "profile_id bigint, title_id bigint, completion_ratio double")
    found = E.profile_vectors(history, titles)
    assert "Generate" not in plan(found)
    v = np.array([0.5, 0.15, 1.05])
    got = {r["profile_id"]: r["vector"] for r in found.collect()}
    assert set(got) == {1, 4} and got[1] == pytest.approx((v / np.linalg.norm(v)).tolist()) and got[4] == pytest.approx((np.array([0, 3, 1]) / 10**0.5).tolist())


def test_share_of_the_own_genre_is_the_maps(spark):
    """The training set knows the affinity for each title's own genre without a map of all genres for any day."""
    _, s = some_sessions(spark)
    title_genres = spark.createDataFrame([(t, g) for t in range(5) for g in {t % 3, 3}], "title_id bigint, genre_id int")
    genres = spark.createDataFrame([(g, f"g{g}") for g in range(4)], "genre_id int, genre_name string")
    points = [(p, (DAY + dt.timedelta(days=d)), g) for p in (1, 2, 3, 9) for d in range(-3, 240, 5) for g in ("g0", "g3", "none", None)]
    t = spark.createDataFrame([(*x, "basic") for x in points], "profile_id bigint, session_date date, primary_genre string, tier string")
    found = FT.with_genre_share(t, s, title_genres, genres)
    assert found.columns == ["profile_id", "session_date", "primary_genre", "genre_affinity", "tier"]
    assert "map" not in plan(found).lower().replace("hashmap", "")
    got = {tuple(r)[:3]: r["genre_affinity"] for r in found.collect()}
    shares = {}
    for r in T.genre_affinity(s, title_genres, genres).collect():
        for day in (DAY + dt.timedelta(days=d) for d in range(-3, 240, 5)):
            if r["valid_from"] <= day and (r["valid_to"] is None or day < r["valid_to"]):
                shares[r["profile_id"], day, r["genre_name"]] = r["share"] or 0.0
    assert got == {x: shares.get(x, 0.0) for x in points}
    assert sum(x > 0 for x in got.values()) > 50


def test_candidates_of_all_regions_are_searched_once(spark, monkeypatch):
    """One search for all regions finds what one for each would."""
    rng = np.random.default_rng(5)
    unit = lambda n: [(k, (x / np.linalg.norm(x)).tolist()) for k, x in enumerate(rng.normal(size=(n, 4)))]
    titles, vectors = spark.createDataFrame(unit(30), "title_id bigint, vector array<double>"), spark.createDataFrame(unit(12), "profile_id bigint, vector array<double>")
    where = {t: [r for k, r in enumerate(("EU", "US", "AS")) if (t + k) % 3 or t % 5 == 0] for t in range(30)}
    cat = spark.createDataFrame([(t, "g", t / 30, w) for t, w in where.items()], "title_id bigint, primary_genre string, popularity_score double, regions array<string>")
    home = {p: ("EU", "US", "AS", "AF")[p % 4] for p in range(14)}
    p = spark.createDataFrame(list(home.items()), "profile_id bigint, region_code string")
    asked = []
    whole = R.nearest
    monkeypatch.setattr(R, "nearest", lambda *a, **k: asked.append(1) or whole(*a, **k))
    found = {(r["profile_id"], r["retrieval_rank"]): (r["title_id"], r["reason"]) for r in R.candidates(p, vectors, titles, cat, 6).collect()}
    assert len(asked) == 1
    x, t, want = {r["profile_id"]: r["vector"] for r in vectors.collect()}, {r["title_id"]: r["vector"] for r in titles.collect()}, {}
    for who, region in home.items():
        here = [k for k, w in where.items() if region in w]
        near = who in x
        order = sorted(here, key=lambda k: (-round(float(np.dot(x[who], t[k])), 12), k) if near else (-k, k))[:6]  # noqa: B023
        want |= {(who, n + 1): (k, "similar_to_your_history" if near else "popular_in_region") for n, k in enumerate(order)}
    assert found == want


def test_medians_order_only_what_lies_near_them(spark, monkeypatch):
    """Distinct values, few values, nulls, an even count, infinite ends; and bounds that miss the median are not trusted."""
    rng = np.random.default_rng(11)
    n = 20_000
    x = {"far": rng.normal(0, 1, n).tolist(), "few": rng.integers(0, 3, n).astype(float).tolist(), "holes": [None if k % 3 else float(k) for k in range(n)], "none": [None] * n, "ends": [float("-inf")] * (n // 2) + [float("inf")] * (n // 2 - 1) + [5.0]}
    d = spark.createDataFrame(list(zip(*x.values(), strict=True)), ", ".join(f"{k} double" for k in x)).repartition(3)
    counted = []
    plain = ordering.running_totals
    monkeypatch.setattr(ordering, "running_totals", lambda per, *rest: (counted.append(per.count()), plain(per, *rest))[1])
    got = {r["feature"]: r["median"] for r in ordering.medians(d, list(x)).collect()}
    want = {k: float(np.median([z for z in v if z is not None])) for k, v in x.items() if k != "none"}
    assert got == want and counted[0] < 500
    monkeypatch.setattr(F, "percentile_approx", lambda col, at, accuracy, f=F.percentile_approx: f(col, F.lit([0.1, 0.2]) if len(counted) == 1 else at, accuracy))
    counted[:] = [0]
    assert {r["feature"]: r["median"] for r in ordering.medians(d, list(x)).collect()} == want


def test_a_stored_step_leaves_no_shuffle_files(spark, tmp_path):
    import glob
    import os

    top = spark.conf.get("spark.local.dir")
    files = lambda: set(glob.glob(f"{top}/blockmgr-*/*/shuffle_*.data"))
    before, held = files(), spark.conf.get(CLEANED, "false")
    t = stored(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("x")))
    assert t.count() == 100 and not [x for x in files() - before if os.path.getsize(x) > 500] and spark.conf.get(CLEANED, "false") == held


def test_features_and_scores_move_narrow_rows_only(spark):
    """What is made of a profile's or a title's days stays where its sessions were dealt to: nothing is dealt by profile and day, or by title and day, again."""
    s = some_sessions(spark)[1]
    profiles = spark.createDataFrame([(p, p) for p in (1, 2, 3, 4)], "profile_id bigint, subscriber_id bigint")
    history = spark.createDataFrame([(1, DAY, None, "active", DAY, 1, "basic"), (2, DAY, None, "paused", DAY, 2, "premium")], "subscriber_id bigint, valid_from date, valid_to date, status string, started_at date, __lsn bigint, tier string")
    history = history.withColumns({x: F.col(x).cast("timestamp") for x in ("valid_from", "valid_to", "started_at")})
    points = s.select("profile_id", F.col("session_date").alias("feature_date"))
    found = FT.features_at(s, profiles, None, None, history, points, affinity=False)
    dealt = [x for x in plan(found).splitlines() if "Exchange hashpartitioning" in x]
    assert sum("profile_id" in x and " at#" in x for x in dealt) == 1  # the points' own rows, made distinct before they are dealt
    want = {(r["profile_id"], r["feature_date"]): r["sessions_90d"] for r in T.profile_windows_at(s, points.distinct()).collect()}
    assert {(r["profile_id"], r["feature_date"]): r["sessions_90d"] for r in found.collect()} == want
    scores = M.title_popularity_at(s, s.select("title_id", F.col("session_date").alias("metric_date")), "2024-01-01", "2024-07-01")
    assert not any("title_id" in x and " at#" in x for x in plan(scores).splitlines() if "Exchange hashpartitioning" in x)


def test_rounding_by_whole_numbers_is_the_same(spark):
    """Ties, numbers a hair beside them, signs, zeros, very large and small ones, null, nan and infinity; and few rows need the decimal."""
    rng = np.random.default_rng(14)
    plain = (rng.normal(0, 1, 4000) * 10.0 ** rng.integers(-8, 9, 4000)).tolist()
    ties = [k / 2 / 10**p * s for p in (4, 6, 9) for k in (1, 3, 5, 12345, 99999) for s in (1, -1)]
    odd = [0.0, -0.0, -1e-12, 1e300, -1e18, float("nan"), float("inf"), float("-inf"), 2.675, 1.005, 0.1 + 0.2, None, *[float(np.nextafter(x, x * 2)) for x in ties], *ties]
    d = spark.createDataFrame([(x,) for x in plain + odd], "x double")
    for places in (4, 6, 9):
        pairs = d.select(X.rounded(F.col("x"), places).alias("a"), F.round("x", places).alias("b")).collect()
        assert [repr(r["a"]) for r in pairs] == [repr(r["b"]) for r in pairs]
