"""Packing into optimal length buckets.

Every length up to a token budget is counted: at most ``budget`` rows (65,536), which is all that reaches the driver. Dynamic programming chooses at most ``buckets`` of
these lengths as bucket lengths so that the padding, the sum of (bucket length - length), is least; as the best place of the bucket before never moves back
for a longer length, a level takes n log n steps. A sequence goes to the smallest bucket that holds it. Within a bucket, sequences in doc_id order
fill batches of as many as the token budget holds, padded: budget // length. A sequence longer than the budget is a batch of its own in one more
bucket, at its own length, so it has no padding and no say in the other lengths.

Places within a bucket come from counts of each bucket in each range of doc_id, summed over the ranges before: no window
runs over a whole bucket, which may hold most rows. Texts don't move; only id and length are shuffled. :func:`batches` then brings the token ids of a batch
together, as one row of equally long sequences.

Defined results: a null text counts as empty; every sequence has an end token, so the shortest length is 1. Very long texts are counted whole.
Rows with equal doc_id are ordered by length; equal rows get places in any order, and however many they are, they're many tasks' work. A null
doc_id comes first. An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.storage import materialize, reading, tables

BUCKETS, BUDGET = 8, 65_536


def n_tokens(text: str = "text") -> Column:
    """Tokens of the byte vocabulary (one for each UTF-8 byte) and an end token."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _level(filled: np.ndarray, count: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each j > 0 the least filled[i] + (count[j] - count[i]) * ends[j - 1] over i < j, and the least such i. Middles first: the place of a middle bounds
    those on both sides of it, and all middles of a round are worked out at once."""
    n = len(ends)
    best, back = np.full(n + 1, _NEVER), np.zeros(n + 1, dtype=np.int64)
    low, high, first, last = (np.array([x], dtype=np.int64) for x in (1, n, 0, n - 1))
    while len(low):
        mid = (low + high) // 2
        stop = np.minimum(last, mid - 1)
        sizes = stop - first + 1
        begins = np.cumsum(sizes) - sizes
        i = np.arange(sizes.sum()) - np.repeat(begins - first, sizes)
        j = np.repeat(mid, sizes)
        costs = filled[i] + (count[j] - count[i]) * ends[j - 1]
        best[mid] = np.minimum.reduceat(costs, begins)
        hit = np.flatnonzero(costs == np.repeat(best[mid], sizes))
        back[mid] = i[hit[np.searchsorted(hit, begins)]]
        left, right = mid > low, mid < high
        parts = ((low[left], mid[left] - 1, first[left], back[mid][left]), (mid[right] + 1, high[right], back[mid][right], last[right]))
        low, high, first, last = (np.concatenate(x) for x in zip(*parts))
    return best, back


_NEVER = np.iinfo(np.int64).max // 4


def optimal_lengths(rows: list[tuple[int, int]], buckets: int) -> list[int]:
    """Bucket lengths that waste least, from (length, rows of that length) in ascending order."""
    if not rows:
        return []
    ends = np.array([r[0] for r in rows], dtype=np.int64)
    count = np.concatenate(([0], np.cumsum([r[1] for r in rows], dtype=np.int64)))
    n = len(rows)
    # filled[j]: padded tokens of the first j lengths at best; tokens themselves are a constant
    filled, choice = np.where(np.arange(n + 1) == 0, 0, _NEVER), []
    best, at_best = None, 0
    for k in range(min(buckets, n)):
        filled, back = _level(filled, count, ends)
        choice.append(back)
        if best is None or filled[n] < best:
            best, at_best = filled[n], k
    out, j = [], n
    for k in range(at_best, -1, -1):
        out.append(int(ends[j - 1]))
        j = int(choice[k][j])
    return out[::-1]


def bucket_lengths(lengths: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> list[int]:
    """From a column n_tokens; at most budget rows reach the driver."""
    counts = lengths.where(F.col("n_tokens") <= budget).groupBy("n_tokens").agg(F.count("*").alias("n"))
    return optimal_lengths([(r["n_tokens"], r["n"]) for r in counts.orderBy("n_tokens").collect()], buckets)


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, length: Column | None = None) -> DataFrame:
    """doc_id, n_tokens, bucket (from 0), bucket_tokens, batch (within the bucket, from 0), slot (from 0), padding. length: the tokens of a row, at
    least 1; without it those of the byte vocabulary and an end token."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with tables() as keep:
        counted = (n_tokens() if length is None else length).cast("long").alias("n_tokens")
        # rows of one id, or without one, are told apart by a number, fixed as it's written, so they aren't all one task's
        own = keep(docs.select("doc_id", counted, F.monotonically_increasing_id().alias("salt")), "packing")
        ends = bucket_lengths(own, buckets, budget)
        bucket, size, room = F.lit(len(ends)), F.col("n_tokens"), F.lit(1).cast("long")
        for k, end in reversed(list(enumerate(ends))):
            fits = F.col("n_tokens") <= end
            bucket = F.when(fits, F.lit(k)).otherwise(bucket)
            size = F.when(fits, F.lit(end).cast("long")).otherwise(size)
            room = F.when(fits, F.lit(budget // end).cast("long")).otherwise(room)
        dealt = own.withColumns({"bucket": bucket, "bucket_tokens": size, "room": room}).repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "n_tokens", "salt").withColumn("part", F.spark_partition_id())
        dealt = materialize(dealt, "packing-parts")
    # a row for each bucket and part: at most (buckets + 1) * partitions
    held = dealt.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = held.withColumn("before", F.sum("n").over(Window.partitionBy("bucket").orderBy("part")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("part", "bucket").orderBy(F.col("doc_id").asc_nulls_first(), "n_tokens")) - 1 + F.col("before")
    out = dealt.join(F.broadcast(before), ["bucket", "part"]).withColumn("place", place)
    out = out.select(
        "doc_id", "n_tokens", "bucket", "bucket_tokens", F.floor(F.col("place") / F.col("room")).alias("batch"), (F.col("place") % F.col("room")).alias("slot"), (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding")
    )
    return reading(out, dealt)


def batches(packed: DataFrame, tokens: DataFrame, end_id: int, pad_id: int = 0) -> DataFrame:
    """bucket, batch, bucket_tokens, doc_ids, lengths (each with the end token), input_ids: a row for each batch, whose sequences are equally long, in order of slot. tokens:
    doc_id (one row each) and ids, of which pack() was given size(ids) + 1 as length. A row holds the token budget at most, or one longer sequence."""
    own = tokens.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    placed = packed.hint("merge").join(own.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")))
    ended = F.concat("ids", F.array(F.lit(end_id)))
    filled = F.concat(ended, F.array_repeat(F.lit(pad_id), F.col("padding").cast("int")))
    rows = placed.groupBy("bucket", "batch").agg(F.any_value("bucket_tokens").alias("bucket_tokens"), F.array_sort(F.collect_list(F.struct("slot", "doc_id", "n_tokens", filled.alias("x")))).alias("r"))
    return rows.select("bucket", "batch", "bucket_tokens", F.col("r.doc_id").alias("doc_ids"), F.col("r.n_tokens").alias("lengths"), F.col("r.x").alias("input_ids"))
