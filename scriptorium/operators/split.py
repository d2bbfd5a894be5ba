"""Text splitters: fixed chunks, paragraphs packed greedily, and overlapping windows that seek a boundary.

The columns that a splitter adds take the place of columns of those names in its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.pieces import few_bytes, in_pieces

SEGMENT = "array<struct<seg_no:int,start:int,end:int,text:string>>"


def _others(df: DataFrame, *taken: str) -> list[str]:
    return [c for c in df.columns if c not in taken]


def fixed_chunks(df: DataFrame, size: int = 2000, text: str = "text") -> DataFrame:
    """The other columns, chunk_no (from 1), chunk: consecutive pieces of so many characters, the last one short. No
    chunk for an empty or null text."""
    others = _others(df, text, "chunk_no", "chunk")
    starts = F.sequence(F.lit(0), F.floor((F.char_length(text) - 1) / size).cast("int"))
    pieces = F.when(F.char_length(text) > 0, F.transform(starts, lambda i: F.col(text).substr(i * size + 1, F.lit(size))))
    # the outer form, and the filter after it: a filter on the text would be pushed below and work the text out a second time
    rows = df.select(*others, F.posexplode_outer(pieces).alias("__pos", "chunk")).where(F.col("__pos").isNotNull())
    return rows.select(*others, (F.col("__pos") + 1).alias("chunk_no"), "chunk")


def resume(df: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys have no row in done: how a run goes on after an interruption."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def packed(text: Column, limit: int = 1000) -> Column:
    """Paragraphs (between newlines) joined by newline as long as their characters, without separators, come to no more
    than limit. A paragraph is never cut; joining the segments by newline gives the text."""
    add = lambda acc, p: F.when(
        (acc["n"] + F.char_length(p) > limit) & (acc["members"] > 0),
        F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"), p.alias("open"), F.char_length(p).alias("n"), F.lit(1).alias("members")),
    ).otherwise(
        F.struct(acc["done"].alias("done"), F.when(acc["members"] > 0, F.concat(acc["open"], F.lit("\n"), p)).otherwise(p).alias("open"), (acc["n"] + F.char_length(p)).alias("n"), (acc["members"] + 1).alias("members"))
    )
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"), F.lit(0).alias("members"))
    return F.aggregate(F.split(text, "\n", -1), empty, add, lambda acc: F.concat(acc["done"], F.array(acc["open"])))


def paragraph_pack(df: DataFrame, limit: int = 1000, text: str = "text") -> DataFrame:
    """The other columns, seg_no (from 1), segment."""
    others = _others(df, text, "seg_no", "segment")
    out = df.where(F.col(text).isNotNull()).select(*others, F.posexplode(packed(F.col(text), limit)).alias("__pos", "segment"))
    return out.select(*others, (F.col("__pos") + 1).alias("seg_no"), "segment")


# Sentence ends at which a window may close, and how near a newline must be (characters before, after).
SENTENCE_ENDS = "。！？.!?"
NEAR_BEFORE, NEAR_AFTER = 10, 10


def boundaries(text: str) -> list[int]:
    """Ascending positions, from the tenth on, of sentence ends with a newline among the ten characters before or the ten
    from there on. Looks around each newline, so the cost follows the number of lines and not the length."""
    found, seen, line = [], NEAR_BEFORE - 1, text.find("\n")
    while line >= 0:
        for i in range(max(seen + 1, line - NEAR_AFTER + 1), min(len(text), line + NEAR_BEFORE + 1)):
            seen = i
            if text[i] in SENTENCE_ENDS:
                found.append(i)
        line = text.find("\n", line + 1)
    return found


def closing(marks: list[int], start: int, longest: int, overlap: int) -> int:
    """The last position of the window that begins at start: the last boundary within reach, if the next window then begins further on."""
    from bisect import bisect_right

    reach = start + longest
    last = marks[k - 1] if (k := bisect_right(marks, reach)) else 0
    return last if last > start + overlap else reach


def windows(text: str, longest: int, overlap: int) -> list[tuple[int, int, int, str]]:
    """(number from 1, start, end exclusive, text). A window closes after the last boundary within reach; where there is
    none, or where closing there would not move the next start forward, after longest + 1 characters. The next window
    starts overlap characters before the last character of this one; the last one holds what is left."""
    if not 0 <= overlap < longest or longest < 20:
        raise ValueError("0 <= overlap < longest and longest >= 20 are needed")
    starts, ends = [0], []
    marks = boundaries(text) if len(text) > longest else []
    while starts[-1] + longest < len(text):
        last = closing(marks, starts[-1], longest, overlap)
        ends.append(last + 1)
        starts.append(last - overlap)
    spans = list(zip(starts, [*ends, len(text)])) if text else []
    return [(k, a, b, text[a:b]) for k, (a, b) in enumerate(spans, 1)]


def overlap_windows(df: DataFrame, longest: int = 8000, overlap: int = 1000, text: str = "text") -> DataFrame:
    """The other columns, seg_no, start, end, segment. In Python over Arrow batches: looking for boundaries in a JVM
    string starts again from its first byte at each candidate."""
    others = _others(df, text, "seg_no", "start", "end", "segment")

    @F.pandas_udf(SEGMENT)
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in in_pieces(batches):
            yield batch.map(lambda t: [dict(zip(("seg_no", "start", "end", "text"), w)) for w in windows(t, longest, overlap)] if t else [])

    if not 0 <= overlap < longest or longest < 20:
        raise ValueError("0 <= overlap < longest and longest >= 20 are needed")
    few_bytes(df.sparkSession)
    out = df.select(*others, F.explode(cut(F.col(text))).alias("__w"))
    return out.select(*others, "__w.seg_no", "__w.start", "__w.end", F.col("__w.text").alias("segment"))
