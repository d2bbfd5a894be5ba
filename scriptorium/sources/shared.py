"""The folder that the driver and all executors share, for what a query writes and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir as a full address; set here to a temporary folder only where it's unset and Spark is local."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scriptorium-"))
        base = spark.sparkContext.getCheckpointDir()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(base)
    full = path.getFileSystem(conf).makeQualified(path).toString()
    return re.sub(r"^file:/(?=[^/])", "file:///", full).rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new address below the shared folder; nothing is there yet."""
    return f"{shared_dir(spark)}/scriptorium/{tag}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    system, p = _path(spark, path)
    return system.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    system, p = _path(spark, path)
    system.delete(p, True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df in as many partitions as shuffles have, rows of equal keys together: before work that makes much of few bytes. Spark deals by bytes, so what is small but far to go would all be one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder, read back; discard() deletes it."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what written() wrote; to be called when nothing reads it any more."""
    if path := getattr(df, "_scratch", None):
        remove(df.sparkSession, path)
