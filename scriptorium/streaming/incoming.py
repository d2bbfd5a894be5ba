"""A folder that texts arrive in, as a stream: the checkpoint takes the place of a number to start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scriptorium.functions.text import unix_lines
from scriptorium.operators.split import fixed_chunks


def texts(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """doc_id (file name), text of every file that arrives, whole."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder, wholetext=True)
    named = raw.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("doc_id"), "value")
    return named.select("doc_id", unix_lines(F.col("value")).alias("text"))


def chunks(spark: SparkSession, folder: str, size: int = 2000, files_per_batch: int = 100) -> DataFrame:
    return fixed_chunks(texts(spark, folder, files_per_batch), size)


def run_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Works off what has arrived since the last run, each file once, and ends."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
