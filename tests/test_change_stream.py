"""The change stream against one build over the whole log: disorder, replays, deletions, several topics, a restart."""

from __future__ import annotations

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from kinolytics import schemas as S
from kinolytics.operators import cdc
from kinolytics.sources import io as IO
from kinolytics.streaming.changes import ChangedTable, change_sink

ROW = "id bigint, tier string, updated_at timestamp"


def message(topic, key, lsn, tier, day, op="u"):
    row = {"id": key, "tier": tier, "updated_at": str(dt.date(2024, 1, 1) + dt.timedelta(days=day))}
    state = {"before": row} if op == "d" else {"after": row}
    return f"streaming.streaming.{topic}", json.dumps({"op": op, **state, "source": {"lsn": lsn, "ts_ms": 0}})


def plain(df, names):
    return sorted(map(repr, df.select(*names).collect()))


def test_stream_equals_build(spark, tmp_path):
    rng = random.Random(5)
    changes = []
    for lsn in range(1, 80):
        key = 1 if lsn % 3 else rng.randint(2, 9)  # key 1 has two thirds of all rows
        changes.append(message("subs", key, lsn, rng.choice("abc"), rng.randint(0, 20), "d" if rng.random() < 0.2 else "u"))
    other = [message("other", k, k, "z", k) for k in range(5)]
    sent = [*changes, *other, *changes[::4], ("streaming.streaming.subs", None), ("streaming.streaming.subs", "broken"), ("elsewhere", "{}")]
    rng.shuffle(sent)
    source, mark = f"{tmp_path}/in", f"file://{tmp_path}/mark"
    table = lambda name: ChangedTable(IO.KeyedTable(spark, f"file://{tmp_path}/{name}-now", 2), IO.KeyedTable(spark, f"file://{tmp_path}/{name}-past", 2), S.schema(ROW), "id")
    for part in (sent[:40], sent[40:70], sent[70:]):  # each time the query starts again from its checkpoint, with tables that know no more than their folders
        spark.createDataFrame(part, "topic string, value string").coalesce(1).write.mode("append").parquet(source)
        tables = {"subs": table("subs"), "other": table("other")}
        stream = spark.readStream.schema("topic string, value string").parquet(source)
        change_sink(stream, tables, mark, once=True).awaitTermination()
    tables["subs"].apply(spark.createDataFrame(sent[:30], "topic string, value string").filter("topic like '%subs'"))  # a batch once more
    log = cdc.unwrap(spark.createDataFrame(changes, "topic string, value string"), S.schema(ROW))
    names = ["id", "tier", "valid_from", "valid_to", "__lsn"]
    assert plain(tables["subs"].intervals(), names) == plain(cdc.history(log, "id", ["tier"]), names)
    assert plain(tables["subs"].rows(), ["id", "tier", "__lsn"]) == plain(cdc.current_state(log, ["id"]), ["id", "tier", "__lsn"])
    assert tables["other"].rows().count() == tables["other"].intervals().filter(F.col("valid_to").isNull()).count() == 5


def test_no_changes(spark, tmp_path):
    t = ChangedTable(IO.KeyedTable(spark, f"file://{tmp_path}/now"), IO.KeyedTable(spark, f"file://{tmp_path}/past"), S.schema(ROW), "id")
    t.apply(spark.createDataFrame([("a", None)], "topic string, value string"))
    assert t.rows() is None and t.intervals() is None


def test_files_and_buckets_grow_in_number(spark, tmp_path, monkeypatch):
    from kinolytics.streaming import changes as C

    monkeypatch.setattr(C, "FILE_ROWS", 50)
    monkeypatch.setattr(C, "BUCKET_ROWS", 50)
    m = spark.range(2000).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("value"), (F.col("id") % 4).alias("part"), F.xxhash64("id").alias("deal"))
    files = C.written_in_batches(m, f"file://{tmp_path}/in", 4, 2000, ["part", "deal"])
    back = spark.read.parquet(f"file://{tmp_path}/in")
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert files == 10 and len(sizes) == 40 and max(sizes) < 150 and sum(sizes) == back.select("value").distinct().count() == 2000
    assert (C.buckets_for(10), C.buckets_for(2000)) == (16, 40)
