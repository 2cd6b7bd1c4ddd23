"""Sources and sinks: streams, landing zone, change topics, keyed tables, versioned tables, artefacts."""

from __future__ import annotations

import uuid
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolytics import schemas as S
from kinolytics.operators.cdc import routed_table
from kinolytics.sources.shared import stored

c = F.col


# --- streams in -------------------------------------------------------------------------------------------------------
def kafka_events(spark: SparkSession, brokers: str, topic: str = "playback.events", starting: str = "earliest") -> DataFrame:
    """Messages (key, value, topic, timestamp).  With a checkpoint, offsets go on where they stopped; ``starting`` counts for a new one ("latest" for alerting).
    The Kafka package must be on the classpath."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", "false").load()


def file_events(spark: SparkSession, path: str, schema: str = "value string", kind: str = "json", files_per_batch: int | None = None) -> DataFrame:
    """The same from files, one message for each row."""
    reader = spark.readStream.format(kind).schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def decoded(messages: DataFrame, decoder: str = "json", value: str = "value", avro_schema: str | None = None) -> DataFrame:
    """Typed events by the contract.  Null messages are ignored; broken ones are left to ``split_bad``."""
    raw = c(value).cast("string") if decoder == "json" else c(value)
    if decoder == "avro":
        from pyspark.sql.avro.functions import from_avro  # needs Spark's Avro package

        event = from_avro(raw, avro_schema)
    else:
        event = F.from_json(raw, S.PLAYBACK_WIRE)
    e = messages.filter(c(value).isNotNull()).select(event.alias("e"))
    return e.select("e.*").withColumns({"event_ts": F.timestamp_millis("event_ts"), "ingest_ts": F.timestamp_millis("ingest_ts")})


def split_bad(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good events, bad messages): bad is what is no JSON by the contract or has no event_id, session_id or event_ts.  Nulls are in neither."""
    kind = S.PLAYBACK_WIRE + ", _broken string"
    parsed = messages.filter(c(value).isNotNull()).withColumn("e", F.from_json(c(value).cast("string"), kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    good = c("e._broken").isNull() & c("e.event_id").isNotNull() & c("e.session_id").isNotNull() & c("e.event_ts").isNotNull()
    good = F.coalesce(good, F.lit(False))
    events = parsed.filter(good).select("e.*").drop("_broken").withColumns({"event_ts": F.timestamp_millis("event_ts"), "ingest_ts": F.timestamp_millis("ingest_ts")})
    return events, parsed.filter(~good).select(c(value).cast("string").alias("value"))


# --- landing zone -----------------------------------------------------------------------------------------------------
def lake_columns(events: DataFrame, ts: str = "event_ts") -> DataFrame:
    """dt and hour from the event's own time in UTC (the session zone), never from its arrival."""
    return events.withColumns({"dt": F.date_format(ts, "yyyy-MM-dd"), "hour": F.date_format(ts, "HH")})


def land(events: DataFrame, path: str, ts: str = "event_ts", rows_per_file: int = 200_000) -> None:
    """Append to dt=/hour= folders; files roll at ``rows_per_file``."""
    lake_columns(events, ts).repartition("dt", "hour").sortWithinPartitions("dt", "hour", "session_id").write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("dt", "hour").parquet(path)


def land_stream(events: DataFrame, path: str, checkpoint: str, ts: str = "event_ts", every: str = "5 minutes", rows_per_file: int = 200_000, once: bool = False):
    """The same as a streaming sink; the trigger is the time at which files roll."""
    writer = lake_columns(events, ts).writeStream.format("parquet").option("maxRecordsPerFile", rows_per_file).option("checkpointLocation", checkpoint).partitionBy("dt", "hour")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start(path)


def landed(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The landing table; ``since`` (a day) prunes partitions."""
    df = spark.read.option("recursiveFileLookup", "false").parquet(path).withColumns({"dt": c("dt").cast("string"), "hour": F.lpad(c("hour").cast("string"), 2, "0")})
    return df.filter(c("dt") >= since) if since else df


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A relation by its contract's schema; CSV for the cost seed."""
    reader = spark.read.schema(S.TABLES[name])
    return reader.csv(path, header=True) if path.endswith(".csv") else reader.parquet(path)


def route_changes(messages: DataFrame, path: str) -> None:
    """Messages of all change topics appended to one folder for each table (``_table=``), in one pass over the source."""
    routed = messages.withColumn("_table", F.regexp_extract(routed_table(c("topic")), r"^cdc\.(.*)$", 1)).filter("_table <> ''")
    routed.repartition("_table").write.mode("append").partitionBy("_table").parquet(path)


def checked(df: DataFrame, name: str) -> DataFrame:
    """The rows of a relation if they keep its contract; writers call this before anything is written."""
    return S.check_contract(df, S.TABLES[name])


# --- keyed tables (online features) -----------------------------------------------------------------------------------
def online_rows(features: DataFrame, key: Column, updated: str, ttl_hours: float, written_at: Column | None = None) -> DataFrame:
    """(key, value, updated_ts, written_at, expires_at): one JSON value for each key, the last update wins."""
    at = written_at if written_at is not None else F.current_timestamp()
    rows = features.select(key.alias("key"), F.to_json(F.struct(*features.columns)).alias("value"), c(updated).alias("updated_ts"))
    best = rows.groupBy("key").agg(F.max_by("value", F.struct("updated_ts", "value")).alias("value"), F.max("updated_ts").alias("updated_ts"))
    return best.select("*", at.alias("written_at"), (at + F.make_dt_interval(hours=F.lit(int(ttl_hours)))).alias("expires_at"))


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same keys."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder, whatever file system it lies in."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class KeyedTable:
    """A Parquet table by key, in buckets of the key's hash; a write replaces the buckets that it touches, as whole versions.

    Readers see each write wholly or not at all: ``current`` names the live version of every bucket, and a new such row is the
    last thing that a write adds.  The version before stays for readers that began earlier; older ones are deleted.  One
    writer at a time.  Where a table format with MERGE is at hand, use that instead.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _states(self) -> list[tuple[int, dict[str, str]]]:
        """(number, versions by bucket), the newest first; at most the two that are kept."""
        try:
            rows = self.spark.read.schema("at bigint, versions map<string,string>").json(f"{self.path}/current/*").orderBy(F.desc("at")).limit(2).collect()
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise
        return [(r["at"], dict(r["versions"])) for r in rows]

    def _folders(self, versions: dict[str, str], only: set[str] | None = None) -> list[str]:
        return [f"{self.path}/{v}/_bucket={b}" for b, v in sorted(versions.items()) if only is None or b in only]

    def read(self) -> DataFrame | None:
        states = self._states()
        return self.spark.read.parquet(*self._folders(states[0][1])) if states else None

    def _bucket(self, by: list[str]) -> Column:
        return F.pmod(F.xxhash64(*by), F.lit(self.buckets)).cast("string")

    def read_touched(self, rows: DataFrame, by: list[str]) -> DataFrame | None:
        """The table's rows in the buckets where rows lie, for a table that is dealt to buckets ``by`` these columns."""
        states = self._states()
        old = self._folders(states[0][1], {r[0] for r in rows.select(self._bucket(by)).distinct().collect()}) if states else []  # as many as there are buckets
        return self.spark.read.parquet(*old) if old else None

    def upsert(self, rows: DataFrame, keys: list[str], updated: str | None = None, by: list[str] | None = None) -> None:
        """Insert or replace by key.  With ``updated``, the row of the highest value stays, so that an old batch that is written again changes nothing.
        ``by``: those of the keys that buckets go by, always the same ones for a table."""
        states = self._states()
        at, versions = states[0] if states else (0, {})
        bucket = self._bucket(by or keys)
        rows = rows.persist()
        touched = {r[0] for r in rows.select(bucket).distinct().collect()}  # as many as there are buckets
        if not touched:
            rows.unpersist()
            return
        old = self._folders(versions, touched)
        if old:
            held = self.spark.read.parquet(*old)
            if updated:
                rest = [x for x in held.columns if x not in keys]
                best = held.unionByName(rows).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(updated, *[x for x in rest if x != updated])).alias("_r"))
                new = best.select(*[c(x) if x in keys else c("_r")[x].alias(x) for x in held.columns])
            else:
                new = merged(held, rows, keys)
        else:
            new = rows
        name = f"v-{uuid.uuid4().hex}"
        new.withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
        rows.unpersist()
        now = versions | dict.fromkeys(touched, name)
        state = self.spark.createDataFrame([(at + 1, now)], "at bigint, versions map<string,string>")
        state.coalesce(1).write.json(f"{self.path}/current/{at + 1:012d}")
        kept = {v for n in (now, versions) for v in n.values()}
        for number, before in states[1:]:
            removed(self.spark, f"{self.path}/current/{number:012d}")
            for v in set(before.values()) - kept:
                removed(self.spark, f"{self.path}/{v}")


def upsert_partitions(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], partition: str) -> None:
    """Incremental merge that rewrites only the partitions it touches: those of the new rows, and those where their keys lie now.

    Partitions are replaced one by one: readers that must not see a mixture take ``KeyedTable`` or a table format.  A run that
    failed on the way is repaired by running it again.
    """
    held = spark.read.parquet(path)
    rows = stored(rows.select(*held.columns))  # computed once
    staged = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex}"
    before = held.join(rows.select(*keys), keys, "left_semi").select(partition)
    touched = before.union(rows.select(partition)).distinct()
    kept = held.join(touched, partition, "left_semi")
    emptied = [r[0] for r in before.distinct().join(rows.select(partition).distinct(), partition, "left_anti").collect()]  # days
    merged(kept, rows, keys).write.parquet(staged)
    out = spark.read.schema(held.schema).parquet(staged)
    left = {r[0] for r in out.select(partition).distinct().collect()} if emptied else set()
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for value in set(emptied) - left:  # all rows of a partition have moved away
        removed(spark, f"{path}/{partition}={value}")


def clustered(df: DataFrame, path: str, day: str, cluster: str, mode: str = "overwrite") -> None:
    """One folder for each day, rows sorted by the cluster column so that row groups can be skipped."""
    df.repartition(day).sortWithinPartitions(day, cluster).write.mode(mode).partitionBy(day).parquet(path)


def publish_daily(features: DataFrame, day: str, ttl_hours: float = 30, written_at: Column | None = None) -> DataFrame:
    """One day's features as online rows under ``feat:daily:<profile>``."""
    today = features.filter(c("feature_date") == F.lit(day).cast("date"))
    return online_rows(today, F.concat(F.lit("feat:daily:"), c("profile_id").cast("string")), "feature_date", ttl_hours, written_at)


# --- streams out and artefacts ----------------------------------------------------------------------------------------
def as_messages(df: DataFrame, key: str) -> DataFrame:
    """(key, value) with the row as JSON, as a message sink takes it."""
    return df.select(c(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def save_model(spark: SparkSession, model, path: str, version: str, names: list[str], defaults: dict[str, float], metrics: dict[str, float], params: dict[str, str] | None = None) -> None:
    """The model with a one-row table of its feature order, defaults, metrics and parameters, so that nobody keeps a second copy of them."""
    model.write().overwrite().save(f"{path}/model")
    kind = "version string, feature_names array<string>, feature_defaults map<string,double>, metrics map<string,double>, params map<string,string>"
    spark.createDataFrame([(version, names, defaults, metrics, params or {})], kind).write.mode("overwrite").parquet(f"{path}/metadata")


def load_model(spark: SparkSession, path: str):
    from pyspark.ml import PipelineModel

    meta = spark.read.parquet(f"{path}/metadata").first()
    return PipelineModel.load(f"{path}/model"), list(meta["feature_names"]), dict(meta["feature_defaults"]), meta["version"]


def export_index(catalogue: DataFrame, vectors: DataFrame, path: str, recall: float, days: int) -> None:
    """Catalogue, vectors and one metadata row."""
    catalogue.write.mode("overwrite").parquet(f"{path}/catalogue")
    vectors.write.mode("overwrite").parquet(f"{path}/vectors")
    vectors.agg(F.count("*").alias("titles"), F.max(F.size("vector")).alias("dimensions")).withColumns({"recall": F.lit(recall), "interaction_days": F.lit(days)}).write.mode("overwrite").parquet(f"{path}/metadata")
