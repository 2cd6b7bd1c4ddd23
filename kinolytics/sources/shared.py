"""Folders that all executors see, for tables that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; only where that is unset (one machine), below a temporary one that then becomes it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


#: Spark's setting by which the shuffle files of a finished write are removed: they are of this write alone, nothing reads them again.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Written once and read back: lineage ends here and survives lost executors, and of a long job only the tables stay on disk, not each step's shuffles."""
    spark = df.sparkSession
    path = shared_dir(spark)
    before = spark.conf.get(CLEANED, "false")
    spark.conf.set(CLEANED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)
