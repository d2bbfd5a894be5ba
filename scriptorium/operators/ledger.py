"""Calls of outside models as a ledger of attempts, at one rate for the whole cluster.

A ledger is a folder of Parquet files, a row for each attempt: prompt_hash, response (null: failed), attempt (from 1, within a run), cause, asked_at. A task writes its attempts down every few calls, under names of its own, so what was
paid for is there whatever becomes of the task, the job or the cluster: the next run asks only prompts that no attempt has answered, and a task that is repeated within a run first reads what it had written before. Equal
prompts are asked once. Nothing that is read twice asks twice, as frames read the ledger and never the service.

Rate: prompts are dealt into lanes, as many as calls may run side by side, and take turns: the first of each lane, then the second of each, and so on, so the number of a call follows from the counts of
the lanes alone. Call k isn't made before k pauses after the start, however many tasks there are. A lane that begins late or waits for a slow answer moves all its later calls by as much, so it never catches up in a burst. Machines' clocks are compared once, at the start of a lane.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions.pieces import few_bytes
from scriptorium.sources.shared import discard, exists, written

ATTEMPT = "prompt_hash string, response string, attempt int, cause string, asked_at timestamp"


@dataclass(frozen=True)
class Policy:
    """attempts: of one prompt in a run; wait: seconds between them; pause: seconds between two calls of all lanes together; lanes: calls side by side; every: attempts that a task
    holds before it writes them down."""

    attempts: int = 3
    wait: float = 0.0
    pause: float = 0.0
    lanes: int = 8
    every: int = 50


def told(backend, prompt: str) -> tuple[str | None, str | None]:
    """An answer, or null and the cause."""
    try:
        answer = backend.one(prompt) if hasattr(backend, "one") else backend.complete([prompt])[0]
    except Exception as e:  # noqa: BLE001  a service's failures are data here
        return None, f"{type(e).__name__}: {e}"[:500]
    return answer, None if answer is not None else "no answer"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All attempts; none where the folder isn't there yet."""
    if not exists(spark, folder):
        return spark.createDataFrame([], ATTEMPT)
    return spark.read.schema(ATTEMPT).option("recursiveFileLookup", "true").parquet(folder)


def answers(attempts: DataFrame) -> DataFrame:
    """prompt_hash, response: of several answers to one prompt the least."""
    return attempts.where("response is not null").groupBy("prompt_hash").agg(F.min("response").alias("response"))


def _lane(lanes: int) -> Column:
    return F.conv(F.left("prompt_hash", F.lit(8)), 16, 10).cast("long") % lanes


def _held(dealt: DataFrame, lanes: int) -> list[int]:
    """How many prompts each lane has."""
    held = {r["lane"]: r["n"] for r in dealt.groupBy("lane").agg(F.count("*").alias("n")).collect()}
    return [held.get(k, 0) for k in range(lanes)]


def slots(prompts: DataFrame, lanes: int) -> DataFrame:
    """prompts (prompt_hash, ...) with lane, place in the lane and slot, the number of the call, all from 0."""
    dealt = prompts.withColumn("lane", _lane(lanes))
    counts = F.array(*map(F.lit, _held(dealt, lanes)))
    placed = dealt.withColumn("place", F.row_number().over(Window.partitionBy("lane").orderBy("prompt_hash")).cast("long") - 1)
    # of every lane the calls of earlier rounds, and those of this round in lanes before
    before = F.aggregate(counts, F.lit(0).cast("long"), lambda n, c: n + F.least(c.cast("long"), F.col("place")))
    same = F.size(F.filter(F.slice(counts, F.lit(1), F.col("lane").cast("int")), lambda c: c > F.col("place")))
    return placed.withColumn("slot", before + same)


def slot(counts: list[int], lane: int, place: int) -> int:
    """The number of one call, as slots() has it."""
    return sum(min(c, place) for c in counts) + sum(c > place for c in counts[:lane])


def ask(prompts: DataFrame, backend, folder: str, policy: Policy = Policy()) -> None:
    """Asks prompts (prompt_hash, prompt; one row each) and writes every attempt into the ledger."""
    run = f"{folder}/{uuid.uuid4().hex}"
    dealt = prompts.withColumn("lane", _lane(policy.lanes))
    counts = _held(dealt, policy.lanes)
    begin = time.time() + 0.5

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        from pyarrow import fs, parquet
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, base = fs.FileSystem.from_uri(run)
        system.create_dir(base, recursive=True)
        kind = pa.schema([("prompt_hash", pa.string()), ("response", pa.string()), ("attempt", pa.int32()), ("cause", pa.string()), ("asked_at", pa.timestamp("us", tz="UTC"))])
        mine = [f.path for f in system.get_file_info(fs.FileSelector(base)) if f.base_name.startswith(f"{part:06d}-")]
        done = {r["prompt_hash"] for path in mine for r in parquet.read_table(path, filesystem=system).to_pylist() if r["response"] is not None}
        rows: list[tuple] = []

        def flush() -> None:
            if rows:
                # under a hidden name until it's whole
                name = f"{part:06d}-{uuid.uuid4().hex}.parquet"
                parquet.write_table(pa.Table.from_pydict(dict(zip(kind.names, map(list, zip(*rows)))), kind), f"{base}/_{name}", filesystem=system)
                system.move(f"{base}/_{name}", f"{base}/{name}")
                rows.clear()

        started, slot_before, n, places = None, 0, 0, [0] * policy.lanes
        try:
            for batch in batches:
                for key, prompt, lane in zip(batch["prompt_hash"], batch["prompt"], batch["lane"]):
                    # a lane's prompts come in order, so each has the place that slots() gives it
                    turn = slot(counts, lane, places[lane])
                    places[lane] += 1
                    if key in done:
                        continue
                    at = begin + turn * policy.pause if started is None else started + (turn - slot_before) * policy.pause
                    for k in range(1, policy.attempts + 1):
                        time.sleep(max(0.0, at - time.time()))
                        started, slot_before = time.time(), turn
                        answer, cause = told(backend, prompt)
                        rows.append((key, answer, k, cause, datetime.fromtimestamp(started, timezone.utc)))
                        n += 1
                        if len(rows) >= policy.every:
                            flush()
                        if answer is not None:
                            break
                        at = time.time() + max(policy.wait, policy.pause * policy.lanes)
        finally:
            flush()
        yield pd.DataFrame({"n": [n]})

    # texts move once and are sorted once; a task is a lane, as two in one would wait for each other
    few_bytes(prompts.sparkSession)
    dealt.repartitionById(policy.lanes, F.col("lane").cast("int")).select("prompt_hash", "prompt", "lane").sortWithinPartitions("prompt_hash").mapInPandas(call, "n long").agg(F.sum("n")).collect()


def answered(df: DataFrame, backend, folder: str, prompt: str = "prompt", out: str = "raw", policy: Policy = Policy()) -> DataFrame:
    """df with the backend's answers by way of a ledger; null where the prompt is null or all attempts failed."""
    spark = df.sparkSession
    hashed = df.withColumn("__h", F.sha2(F.col(prompt), 256))
    known = read(spark, folder).where("response is not null").select(F.col("prompt_hash").alias("__h")).distinct()
    new = hashed.where(F.col(prompt).isNotNull()).groupBy("__h").agg(F.any_value(prompt).alias("prompt")).join(known, "__h", "left_anti")
    new = written(new.withColumnRenamed("__h", "prompt_hash"), "prompts")
    try:
        ask(new, backend, folder, policy)
    finally:
        discard(new)
    done = answers(read(spark, folder)).select(F.col("prompt_hash").alias("__k"), F.col("response").alias(out))
    return (hashed.drop(out) if out != prompt else hashed).join(done, F.col("__h") == F.col("__k"), "left").drop("__h", "__k")
