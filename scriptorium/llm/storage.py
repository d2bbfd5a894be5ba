"""The shared folder that operators write to between their stages, for the driver and for tasks.

Spark tables go through Spark's own writers. Tasks that write formats of their own (archives, token shards) go through
``pyarrow.fs``, each attempt under a new name; the table of names that the stage returns is what commits them, so a
repeated or lost task leaves only files that nobody reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from scriptorium.sources.shared import scratch


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def reading(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """df, with a note of the written tables that it still reads."""
    df._reads = tables
    return df


def discard(df: DataFrame) -> None:
    """Deletes what materialize() wrote, and what reading() noted; to be called when nothing reads it any more."""
    if path := getattr(df, "_scratch", None):
        remove(df.sparkSession, path)
    for table in getattr(df, "_reads", ()):
        discard(table)


@contextmanager
def tables() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a function like materialize() whose tables are deleted at the end of the block, whether it failed or not."""
    held: list[DataFrame] = []

    def keep(df: DataFrame, tag: str) -> DataFrame:
        held.append(materialize(df, tag))
        return held[-1]

    try:
        yield keep
    finally:
        for df in held:
            discard(df)


ARROW_ROWS, ARROW_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of texts that go to Python at once: a longer text goes alone.
TEXT_BYTES = 8 << 20


def few_texts(spark: SparkSession, rows: int = 1000) -> None:
    """From now on so many rows and 8 MB at most go to Python at once, in this session: for queries, whose frames are worked out after they've returned."""
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= rows:
        spark.conf.set(ARROW_ROWS, rows)
    if not 0 < int(spark.conf.get(ARROW_BYTES).rstrip("bB")) <= TEXT_BYTES:
        spark.conf.set(ARROW_BYTES, f"{TEXT_BYTES}b")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """For what is written within the block: so many rows and 8 MB at most go to Python at once. A batch of whole texts is held several times over, by the executor and by Python."""
    before = {k: spark.conf.get(k) for k in (ARROW_ROWS, ARROW_BYTES)}
    few_texts(spark, rows)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def task_fs(uri: str):
    """In a task: the file system of an address and the path in it, its folder made."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system, path


def task_write(uri_dir: str, stem: str, data: bytes) -> str:
    """In a task: writes one file under a name no other attempt has; returns its address."""
    system, path = task_fs(uri_dir)
    system.create_dir(path, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{path}/{name}", compression=None) as f:
        f.write(data)
    return f"{uri_dir}/{name}"
