"""Sources, sinks, artefacts, the ranking chain and the nightly job, each run for real on small tables."""

from __future__ import annotations

import datetime as dt
import math
import os
import time

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kinolytics import job, registry
from kinolytics import schemas as S
from kinolytics.operators import cdc, checks, ordering, timetravel
from kinolytics.plans import embeddings as E
from kinolytics.plans import features as FT
from kinolytics.plans import recommend as R
from kinolytics.sources import io as IO
from kinolytics.streaming import qoe, sinks
from tests.test_domain import raw_events, rows

c = F.col
T = dt.datetime


def events_of(spark, n=40):
    base = T(2024, 1, 1, 22)
    kinds = ["HEARTBEAT", "REBUFFER", "ERROR", "START"]
    return raw_events(spark, [(str(k), f"s{k % 5}", kinds[k % 4], base + dt.timedelta(minutes=5 * k), base, {"cdn_pop": f"p{k % 2}", "rebuffer_ms": 100}) for k in range(n)])


def test_file_stream_is_decoded_and_landed_by_hour(spark, tmp_path):
    e = events_of(spark).withColumns({"event_ts": F.unix_millis("event_ts"), "ingest_ts": F.unix_millis("ingest_ts")})
    e.select(F.to_json(F.struct(*e.columns)).alias("value")).union(spark.sql("select cast(null as string)")).write.parquet(f"{tmp_path}/in")
    stream = IO.decoded(IO.file_events(spark, f"{tmp_path}/in", kind="parquet", files_per_batch=1))
    IO.land_stream(stream, f"{tmp_path}/out", f"file://{tmp_path}/mark", rows_per_file=3, once=True).awaitTermination()
    got = IO.landed(spark, f"{tmp_path}/out")
    assert rows(got.groupBy("dt", "hour").count(), "dt", "hour", "count") == rows(IO.lake_columns(events_of(spark)).groupBy("dt", "hour").count(), "dt", "hour", "count")
    assert IO.landed(spark, f"{tmp_path}/out", "2024-01-02").filter("dt < '2024-01-02'").count() == 0
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "out") for f in fs if f.endswith(".parquet")]
    assert max(spark.read.parquet(f).count() for f in files) <= 3 and len(files) > 4
    # a second run of the same stream adds nothing: offsets are in the checkpoint
    IO.land_stream(stream, f"{tmp_path}/out", f"file://{tmp_path}/mark", rows_per_file=3, once=True).awaitTermination()
    assert IO.landed(spark, f"{tmp_path}/out").count() == 40


def test_brokers_need_the_kafka_package(spark, tmp_path):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        IO.kafka_events(spark, "host:9092")
    stream = IO.file_events(spark, str(tmp_path), "k string, x int", "parquet")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        sinks.kafka_sink(stream, "k", "host:9092", "qoe.windows", f"file://{tmp_path}/c")
    assert rows(IO.as_messages(spark.createDataFrame([("a", 1)], "k string, x int"), "k"), "key", "value") == [("a", '{"k":"a","x":1}')]


def test_relations_by_contract_and_change_topics(spark, tmp_path):
    with open(tmp_path / "costs.csv", "w") as f:
        f.write("title_id,licence_cost_usd,production_cost_usd,licence_start,licence_end,cost_type\n1,10.50,,2024-01-01,2024-02-01,licensed\n")
    got = IO.checked(IO.read_table(spark, f"file://{tmp_path}/costs.csv", "title_costs"), "title_costs")
    assert got.first()["licence_end"] == dt.date(2024, 2, 1) and float(got.first()["licence_cost_usd"]) == 10.5
    with pytest.raises(ValueError, match="missing: licence_end"):
        IO.checked(got.drop("licence_end"), "title_costs")
    m = spark.createDataFrame([("streaming.streaming.titles", "a"), ("streaming.streaming.genres", "b"), ("other", "c"), ("streaming.streaming.titles", "d")], "topic string, value string")
    IO.route_changes(m, f"file://{tmp_path}/cdc")
    assert rows(spark.read.parquet(f"{tmp_path}/cdc"), "_table", "value") == [("genres", "b"), ("titles", "a"), ("titles", "d")]


FEATURES = "session_id string, profile_id bigint, seconds_watched bigint, rebuffer_seconds double, completion_ratio double, event_count bigint, updated_ts timestamp"


def test_online_sink_keeps_the_newest_whatever_the_order(spark, tmp_path):
    t = lambda m: T(2024, 1, 1, 0, m)
    batches = [[("s1", 1, 100, 0.0, 0.1, 5, t(5)), ("s2", 2, 10, 0.0, 0.1, 1, t(1))], [("s1", 1, 50, 0.0, 0.1, 3, t(3))], [("s3", 2, 70, 0.0, 0.2, 2, t(9))]]
    for k, b in enumerate(batches):
        spark.createDataFrame(b, FEATURES).coalesce(1).write.parquet(f"{tmp_path}/in/b={k}")
    table = IO.KeyedTable(spark, f"file://{tmp_path}/online", 4)
    key = F.concat(F.lit("feat:session:"), c("profile_id").cast("string"))
    metrics = sinks.Metrics()
    spark.streams.addListener(metrics)
    for run in range(2):  # the second run reads everything again
        stream = spark.readStream.schema(FEATURES).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        stream = stream.observe("seen", F.count(F.lit(1)).alias("n"))
        q = sinks.online_sink(stream, table, f"file://{tmp_path}/mark{run}", key, audit=f"file://{tmp_path}/audit", once=True)
        q.awaitTermination()
        assert q.kinolytics_counts == {"written": 4, "errors": 0}
        got = table.read().select("key", F.get_json_object("value", "$.seconds_watched").alias("s"), "updated_ts")
        assert rows(got, "key", "s", "updated_ts") == [("feat:session:1", "100", t(5)), ("feat:session:2", "70", t(9))]
    for _ in range(100):  # the listener hears of a batch a little later
        if sum(metrics.rows.values()) == 8:
            break
        time.sleep(0.1)
    spark.streams.removeListener(metrics)
    assert sum(metrics.rows.values()) == 8 and "seen" in next(iter(metrics.observed.values()))
    assert spark.read.parquet(f"{tmp_path}/audit").filter("snapshot_date = date'2024-01-01'").count() == 8
    lag = sinks.freshness(spark.createDataFrame([(t(0), t(1)), (t(0), t(3))], "updated_ts timestamp, written_at timestamp")).first()
    assert tuple(lag) == (60.0, 180.0, 2)


def test_a_failing_batch_is_counted_not_raised(spark, tmp_path):
    class Broken(IO.KeyedTable):
        def upsert(self, *a):  # noqa: ANN002
            raise OSError("store is away")

    spark.createDataFrame([("s", 1, 1, 0.0, 0.1, 1, T(2024, 1, 1))], FEATURES).write.parquet(f"{tmp_path}/in")
    q = sinks.online_sink(spark.readStream.schema(FEATURES).parquet(f"{tmp_path}/in"), Broken(spark, f"file://{tmp_path}/x"), f"file://{tmp_path}/m", c("session_id"), once=True)
    q.awaitTermination()
    assert q.kinolytics_counts == {"written": 0, "errors": 1}


def test_windows_detector_and_sink_go_on_after_a_restart(spark, tmp_path):
    """Windows of a stream, then the detector over them as a second stream; both stop and start again on their checkpoints."""
    base = T(2024, 1, 1)

    def part(lo, hi):
        return raw_events(spark, [(f"{k}-{s}", f"s{s}", "REBUFFER" if k > 55 and s % 2 else "HEARTBEAT", base + dt.timedelta(seconds=15 * k), base, {"cdn_pop": "p", "rebuffer_ms": 9000}) for k in range(lo, hi) for s in range(30)])

    def run():
        events = spark.readStream.schema(S.PLAYBACK_EVENTS).parquet(f"{tmp_path}/e").withWatermark("event_ts", "5 seconds")
        w = qoe.qoe_windows(events).writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/cw").trigger(availableNow=True).start(f"{tmp_path}/w")
        w.awaitTermination()
        windows = spark.readStream.schema(S.TABLES["qoe_windows"]).parquet(f"{tmp_path}/w")
        sinks.parquet_sink(qoe.detect_stream(windows), f"{tmp_path}/a", f"file://{tmp_path}/ca", once=True).awaitTermination()
        return spark.read.parquet(f"{tmp_path}/a")

    part(0, 40).coalesce(1).write.mode("append").parquet(f"{tmp_path}/e")
    assert run().count() == 0
    part(40, 80).coalesce(1).write.mode("append").parquet(f"{tmp_path}/e")
    got = run()
    names = ("cdn_pop", "detected_at", "severity", "rebuffer_ratio", "baseline_ratio", "z_score")
    assert rows(got, *names) == rows(qoe.detect(spark.read.parquet(f"{tmp_path}/w")), *names) and got.count() == 1


def test_late_events_are_dropped_and_counted(spark, tmp_path):
    e = events_of(spark)
    e.filter("event_id >= '0'").coalesce(1).write.parquet(f"{tmp_path}/e/b=0")
    raw_events(spark, [("late", "s9", "START", T(2024, 1, 1), T(2024, 1, 1), {"cdn_pop": "p0"}), ("next", "s9", "START", T(2024, 1, 3), T(2024, 1, 3), {"cdn_pop": "p0"})]).coalesce(1).write.parquet(f"{tmp_path}/e/b=1")
    # what is late is judged by the watermark of the batch before
    raw_events(spark, [("then", "s9", "START", T(2024, 1, 3, 1), T(2024, 1, 3), {"cdn_pop": "p0"})]).coalesce(1).write.parquet(f"{tmp_path}/e/b=2")
    raw_events(spark, [("late2", "s9", "START", T(2024, 1, 1, 1), T(2024, 1, 1), {"cdn_pop": "p0"})]).coalesce(1).write.parquet(f"{tmp_path}/e/b=3")
    for k in range(4):  # files are read by their age
        for f in os.listdir(tmp_path / "e" / f"b={k}"):
            os.utime(tmp_path / "e" / f"b={k}" / f, (1_700_000_000 + 10 * k,) * 2)
    metrics = sinks.Metrics()
    spark.streams.addListener(metrics)
    stream = spark.readStream.schema(S.PLAYBACK_EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/e").withWatermark("event_ts", "5 seconds")
    q = qoe.qoe_windows(stream).writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/o")
    q.awaitTermination()
    late = sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)
    for _ in range(100):  # the listener hears of a batch a little later
        if sum(metrics.late.values()) == late and sum(metrics.rows.values()) == 44:
            break
        time.sleep(0.1)
    spark.streams.removeListener(metrics)
    assert sum(metrics.late.values()) == late > 0 and sum(metrics.rows.values()) == 44, [(p.batchId, p.numInputRows, p.eventTime, [s.numRowsDroppedByWatermark for s in p.stateOperators]) for p in q.recentProgress]


def test_model_index_and_versions_are_stored_and_read(spark, tmp_path):
    rng = np.random.default_rng(2)
    kinds = "profile_id bigint, session_date date, x double, y int, tier string, genre_affinity map<string,double>, primary_genre string, engagement_label int"
    data = [(k % 9, dt.date(2024, 1, 1 + k % 28), float(v), k % 3, "basic" if k % 2 else None, {"g": 0.25}, "g" if k % 5 else None, int(v > 0.3)) for k, v in enumerate(rng.normal(size=300))]
    df = R.with_own_genre(spark.createDataFrame([(*r[:2], None if k % 50 == 7 else r[2], *r[3:]) for k, r in enumerate(data)], kinds))
    assert rows(df.select("genre_affinity").distinct(), "genre_affinity") == [(0.0,), (0.25,)]
    train, valid = FT.temporal_split(df)
    model, names, defaults = R.fit_ranker(train, valid, 3)
    assert names == ["x", "y", "genre_affinity", "tier"] and defaults["x"] != 0
    path = f"file://{tmp_path}/model"
    IO.save_model(spark, model, path, "7", names, defaults, {"ndcg": 0.5}, {"maxIter": "3"})
    again, names2, defaults2, version = IO.load_model(spark, path)
    assert (names2, defaults2, version) == (names, defaults, "7") and spark.read.parquet(f"{path}/metadata").first()["params"] == {"maxIter": "3"}
    a, b = (R.scored(m, valid, names, defaults).select("x", "y", "score") for m in (model, again))
    assert rows(a, "x", "y", "score") == rows(b, "x", "y", "score")
    # a missing column is its median, a missing category unknown
    assert R.scored(model, valid.drop("x", "tier"), names, defaults).count() == valid.count()
    runs = spark.createDataFrame([("9", "a"), ("10", "b"), ("x", "c")], "version string, run string")
    assert R.latest_version(runs).first()["run"] == "b"
    with pytest.raises(ValueError, match="only 3"):
        FT.refuse_small(runs)
    assert FT.refuse_small(runs, 3) is runs
    vectors = spark.createDataFrame([(1, [0.1, 0.2])], "title_id bigint, vector array<float>")
    IO.export_index(vectors.select("title_id"), vectors, f"file://{tmp_path}/index", 0.97, 180)
    assert tuple(spark.read.parquet(f"{tmp_path}/index/metadata").first()) == (1, 2, 0.97, 180)


def test_ranking_rows_and_smoke(spark):
    found = spark.createDataFrame([(1, 10, 0.5, "film"), (1, 11, 0.4, "show"), (2, 10, 0.1, "film")], "profile_id bigint, title_id bigint, retrieval_score double, content_type string")
    features = spark.createDataFrame([(1, "other", 3)], "profile_id bigint, content_type string, sessions_7d int")
    assert rows(R.ranking_rows(found, features), "title_id", "content_type", "sessions_7d") == [(10, "film", 3), (10, "film", None), (11, "show", 3)]
    ranked = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.5), (2, 1, 0.1)], "profile_id bigint, rank int, score double")
    assert tuple(R.smoke(ranked).first()) == (True, True, True)
    assert tuple(R.smoke(ranked.withColumn("score", c("rank") / 10.0)).first())[2] is False and tuple(R.smoke(ranked.limit(0)).first())[:2] == (False, False)


def test_order_statistics_against_brute_force(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=2001), 1)
    df = spark.createDataFrame([(float(v), None if k % 3 else float(k), None, int(v > rng.normal())) for k, v in enumerate(x)], "a double, b double, n double, label int")
    got = {r["feature"]: r["median"] for r in ordering.medians(df, ["a", "b", "n"]).collect()}
    assert got == {"a": pytest.approx(np.median(x)), "b": pytest.approx(np.median(np.arange(0, 2001, 3)))}
    y = np.array([r["label"] for r in df.collect()])
    pairs = x[y == 1][:, None] - x[y == 0][None, :]
    assert R.auc(df, "label", "a").first()["auc"] == pytest.approx(((pairs > 0) + 0.5 * (pairs == 0)).mean())
    assert R.auc(df.filter("label = 1"), "label", "a").first()["auc"] is None
    plan = R.auc(df, "label", "a")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan


def test_ndcg_against_brute_force(spark):
    rng = np.random.default_rng(7)
    data = [(int(k % 40), k, int(rng.random() < 0.4), float(np.round(rng.random(), 1))) for k in range(300)]
    df = spark.createDataFrame(data, "profile_id bigint, session_id bigint, engagement_label int, score double")
    per = []
    for p in range(40):
        mine = [r for r in data if r[0] == p]
        gain = lambda order: sum(r[2] / math.log2(n + 2) for n, r in enumerate(order[:5]))
        if sum(r[2] for r in mine):
            per.append(gain(sorted(mine, key=lambda r: (-r[3], r[1]))) / gain(sorted(mine, key=lambda r: (-r[2], r[1]))))
    got = R.ndcg(df, 5, ("profile_id",), tie="session_id").first()
    assert got["groups"] == len(per) and got["ndcg"] == pytest.approx(np.mean(per))


def test_embeddings_equal_a_plain_decomposition(spark, monkeypatch):
    rng = np.random.default_rng(3)
    matrix = np.where(rng.random((60, 25)) < 0.4, rng.random((60, 25)), 0)
    pairs = spark.createDataFrame([(int(p), int(t), float(matrix[p, t])) for p, t in zip(*np.nonzero(matrix), strict=True)], "profile_id bigint, title_id bigint, weight double")
    viewers = (matrix > 0).sum(axis=0)
    weighted = matrix * np.log1p(len(matrix) / np.maximum(viewers, 1))
    _, _, vt = np.linalg.svd(weighted)
    want = vt[:4].T / np.linalg.norm(vt[:4].T, axis=1, keepdims=True)
    for most in (E.GRAM_TITLES, 3):  # summed whole, and by Spark's decomposition
        monkeypatch.setattr(E, "GRAM_TITLES", most)
        got = np.array([r["vector"] for r in E.title_embeddings(pairs, 4).orderBy("title_id").collect()])
        assert np.allclose(got @ got.T, want @ want.T, atol=1e-4)
    assert E.title_embeddings(pairs.limit(0), 4).count() == 0


def test_nearest_by_blocks_and_approximate_recall(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 12))
    x[150:] = x[:150] + 0.2 * rng.normal(size=(150, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    titles = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "title_id bigint, vector array<double>")
    queries = titles.filter("title_id % 3 = 0").withColumnRenamed("title_id", "profile_id")
    one = E.nearest(queries, titles, 5)
    monkeypatch.setattr(E, "TITLE_BLOCK", 70), monkeypatch.setattr(E, "QUERY_BLOCK", 40)
    many = E.nearest(queries, titles, 5)
    names = ("profile_id", "rank", "title_id", "similarity")
    assert rows(one, *names) == rows(many, *names)
    s = np.round(x @ x.T, 12)
    for r in one.filter("profile_id = 9").collect():
        assert r["title_id"] == np.argsort(-s[9], kind="stable")[r["rank"] - 1]
    assert E.nearest(queries, titles.limit(0), 5).count() == 0
    assert E.recall(one, E.nearest_approximate(queries, titles, 5, tables=12, bucket=1.2), 5).first()["recall"] >= 0.9


def test_days_of_intervals_equal_the_range_join(spark):
    t = lambda d, h=0: T(2024, 1, d, h)
    h = spark.createDataFrame([(1, t(1), t(3)), (2, t(5, 13), None), (3, t(4), t(4, 9)), (4, T(2023, 1, 1), T(2025, 1, 1)), (5, t(9), t(20)), (6, t(7), t(5))], "k int, valid_from timestamp, valid_to timestamp")
    days = timetravel.date_spine(h, "2024-01-02", "2024-01-10")
    cut = h.withColumns({x: F.to_date(x) for x in ("valid_from", "valid_to")})
    assert rows(timetravel.listed(cut, "2024-01-02", "2024-01-10"), "k", "feature_date") == rows(h.join(days, cdc.as_of(h, days["feature_date"])), "k", "feature_date")


def test_job_gates_backfills_and_audits(spark, sf_dir, tmp_path):
    run = job.Run(spark, sf_dir, f"file://{tmp_path}/w", "2024-01-31")
    got = {r["stage"]: r for r in job.build(run).collect()}
    assert [s.name for s in job.stages()] == list(got) or set(got) == {s.name for s in job.stages()}
    assert {r["status"] for r in got.values()} <= {"success", "warn"}
    before = run.built("watch_sessions")
    old = rows(before.filter("session_date < date'2024-01-20'").select("session_id", "_built_at"), "session_id", "_built_at")
    later = job.Run(spark, sf_dir, run.target, "2024-01-31", "2024-01-20")
    job.build(later, ["staged_events", "watch_sessions"])
    after = spark.read.parquet(f"{run.target}/watch_sessions")
    assert rows(after.filter("session_date < date'2024-01-20'").select("session_id", "_built_at"), "session_id", "_built_at") == old
    assert after.count() == got["watch_sessions"]["rows_affected"] and after.filter("session_date >= date'2024-01-20'").agg(F.min("_built_at")).first()[0] > max(r[1] for r in old)
    # a backfill gives the features and scores of a full build, and counts the days that it wrote
    names = {n: sorted(x for x in run.built(n).columns if x not in ("_built_at", "genre_affinity")) for n in ("profile_features", "title_popularity")}
    full = {n: rows(run.built(n).filter(c(job_day) >= "2024-01-29"), *names[n]) for n, job_day in (("profile_features", "feature_date"), ("title_popularity", "metric_date"))}
    tail = job.Run(spark, sf_dir, run.target, "2024-01-31", "2024-01-29")
    counts = {r["stage"]: r["rows_affected"] for r in job.build(tail, ["title_popularity", "profile_features", "published_features"]).collect()}
    assert counts["profile_features"] == 3 * counts["published_features"] == len(full["profile_features"])
    assert {n: rows(run.built(n).filter(c(d) >= "2024-01-29"), *names[n]) for n, d in (("profile_features", "feature_date"), ("title_popularity", "metric_date"))} == full
    # a broken rule stops what needs the stage, leaves the old table, stores the failing rows and says why
    plan = job.stages()
    plan[1].rules["no_seeks"] = c("seek_count") == 0
    bad = job.Run(spark, sf_dir, run.target, "2024-01-31")
    status = {r["stage"]: (r["status"], r["error_message"]) for r in job.build(bad, plan=plan).collect()}
    assert status["watch_sessions"][0] == "error" and "no_seeks" in status["watch_sessions"][1] and status["qoe_daily"] == ("skipped", None)
    assert spark.read.parquet(f"{run.target}/failures_watch_sessions").filter(c("run_id") == bad.run_id).count() > 0
    assert spark.read.parquet(f"{run.target}/run_results").count() == 7 + 2 + 3 + 7
    assert job.main(["--source", sf_dir, "--target", f"file://{tmp_path}/cli", "--as-of", "2024-01-31", "--only", "staged_events"]) == 0


def test_audit_rows_and_severity(spark):
    d = spark.createDataFrame([("error", "m" * 2000, 1.23456, None), ("success", "noise", 0.5, 3)], "status string, error_message string, execution_seconds double, rows_affected bigint")
    got = checks.run_results(d).orderBy("status").collect()
    assert len(got[0]["error_message"]) == 1000 and got[0]["execution_seconds"] == 1.235 and got[0]["rows_affected"] == 0 and got[1]["error_message"] is None
    counts = spark.createDataFrame([("a", 0, 5), ("b", 1, 5), ("c", 1, 5)], "rule string, broken int, rows int")
    assert rows(checks.verdicts(counts, {"b"}), "rule", "status") == [("a", "pass"), ("b", "warn"), ("c", "error")]


@pytest.mark.parametrize("name", ["d09_subscription_as_of", "d10_profile_features", "d12_training_set", "e01_watch_sessions", "f09_recent_history", "l07_profile_vectors", "l08_ndcg", "l15_presentation"])
def test_no_single_task_window_and_no_nested_loop(spark, sf_dir, name):
    plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    # the spine of days and the regions of a title are cross joins by definition
    assert "NestedLoopJoin" not in plan or name in ("d10_profile_features", "d12_training_set", "l15_presentation")
    lines = plan.splitlines()
    for k, line in enumerate(lines):
        if " Window [" in line and not any(x in line for x in ("popularity_score", "genre_name", "name")):
            assert not any("SinglePartition" in x for x in lines[k : k + 4]), line
