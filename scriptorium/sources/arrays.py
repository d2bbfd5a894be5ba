"""One JSON array as one file, written and read by many tasks.

Written: rows in order are rendered by the tasks that hold them, each into a piece of its own; sums of the pieces' bytes give their places, and tasks then copy them there side by side. Where a file system has no writing at places, one task streams
them one after the other. Read: a file is cut into ranges of bytes. What a range does to "inside of a string" and to the depth of brackets is worked out for each range alone, in both cases of how it may begin; putting these together in order, a row a range, tells how
each does begin, and with that each task finds the elements that begin in its range. Rows of the array never come to the driver.

Both want addresses that pyarrow's file systems open.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.sources.shared import discard, remove, scratch, written

#: Bytes of a range, and of what is copied at once.
RANGE, CHUNK = 1 << 25, 1 << 24


def _open(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address)


def write_array(df: DataFrame, address: str, order: list[str], drop: list[str] = (), indent: int = 4) -> int:
    """df in order as one pretty JSON array, non-ASCII kept; the number of items. A failure is raised and leaves no file under that name."""
    spark = df.sparkSession
    folder = scratch(spark, "array")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        name = f"{part:06d}-{TaskContext.get().taskAttemptId()}"
        with system.open_output_stream(f"{base}/{name}", compression=None) as out:
            for batch in batches:
                for item in batch.to_pylist(maps_as_pydicts="strict"):
                    text = json.dumps(item, ensure_ascii=False, indent=indent)
                    out.write(((",\n" if n else "") + "\n".join(" " * indent + line for line in text.split("\n"))).encode())
                    n += 1
            size = out.tell()
        yield pa.RecordBatch.from_pydict({"part": [part], "name": [name], "n": [n], "size": [size]}, pa.schema([("part", pa.int64()), ("name", pa.string()), ("n", pa.int64()), ("size", pa.int64())]))

    pieces = written(df.orderBy(*order).drop(*drop).mapInArrow(render, "part long, name string, n long, size long"), "pieces")
    try:
        # a row a task: the first piece follows a line end, the others a comma and a line end, behind the opening bracket
        own = pieces.where("n > 0")
        before = F.sum(F.col("size") + 2).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") - 2
        placed = written(own.select("part", "name", "size", before.alias("at")), "places")
        n, size = own.agg(F.sum("n"), F.sum(F.col("size") + 2)).first()
        if address.startswith("file:"):
            _at_places(placed, folder, address, size or 0)
        else:
            _one_by_one(placed, folder, address)
        discard(placed)
    finally:
        discard(pieces)
        remove(spark, folder)
    return n or 0


def _lead(at: int) -> bytes:
    return b"\n" if at == 0 else b",\n"


def _at_places(placed: DataFrame, folder: str, address: str, size: int) -> None:
    import os

    _, path = _open(address)
    hidden = f"{path}.part"
    with open(hidden, "wb") as f:
        # brackets, a line end after the first and before the last; one lead is a byte shorter
        f.truncate(size + 2 if size else 2)
        f.write(b"[")
        f.seek(size or 1)
        f.write(b"\n]" if size else b"]")

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _open(folder)
        for batch in batches:
            for name, at in zip(batch["name"], batch["at"]):
                with open(hidden, "r+b") as out, system.open_input_stream(f"{base}/{name}", compression=None) as piece:
                    out.seek(1 + at - (at > 0))
                    out.write(_lead(at))
                    while data := piece.read(CHUNK):
                        out.write(data)
            yield pd.DataFrame({"n": [len(batch)]})

    placed.repartition("part").mapInPandas(copy, "n long").agg(F.sum("n")).collect()
    os.replace(hidden, path)


def _one_by_one(placed: DataFrame, folder: str, address: str) -> None:
    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _open(folder)
        there, path = _open(address)
        with there.open_output_stream(f"{path}.part", compression=None) as out:
            out.write(b"[")
            n = 0
            for batch in batches:
                for name, at in zip(batch["name"], batch["at"]):
                    out.write(_lead(at))
                    with system.open_input_stream(f"{base}/{name}", compression=None) as piece:
                        while data := piece.read(CHUNK):
                            out.write(data)
                    n += 1
            out.write(b"\n]" if n else b"]")
        there.move(f"{path}.part", path)
        yield pd.DataFrame({"n": [n]})

    placed.coalesce(1).sortWithinPartitions("part").mapInPandas(copy, "n long").agg(F.sum("n")).collect()


def _marks(data: np.ndarray, odd_before: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of unescaped quotes, and for each byte whether an odd number of them stands before it. odd_before: an odd number of backslashes ends what comes before."""
    slash = data == 0x5C
    place = np.arange(len(data))
    # the last byte before each one that is no backslash
    last = np.maximum.accumulate(np.where(slash, -1, place))
    before = np.concatenate(([-1], last[:-1]))
    run = place - before - 1 + (odd_before & (before < 0))
    quotes = (data == 0x22) & (run % 2 == 0)
    return quotes, np.cumsum(quotes) - quotes


def _depth(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    up, down = (data == 0x5B) | (data == 0x7B), (data == 0x5D) | (data == 0x7D)
    return (up & ~inside).astype(np.int64) - (down & ~inside)


def _odd_slashes(file, at: int) -> bool:
    n, step = 0, 64
    while at - n > 0:
        back = file.read_at(min(step, at - n), max(0, at - n - step))
        kept = back.rstrip(b"\\")
        n += len(back) - len(kept)
        if kept:
            break
    return n % 2 == 1


def _tasks(spark: SparkSession, n: int) -> int:
    return max(1, min(n, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def ranges(spark: SparkSession, address: str, size: int = RANGE) -> DataFrame:
    """at, upto: the ranges of a file, in four times as many tasks as shuffles have at most: a task takes one after the other."""
    system, path = _open(address)
    whole = system.get_file_info(path).size
    n = -(-whole // size)
    return spark.range(0, n, 1, _tasks(spark, n)).select((F.col("id") * size).alias("at"), F.least((F.col("id") + 1) * size, F.lit(whole)).alias("upto"))


def read_array(spark: SparkSession, address: str, size: int = RANGE) -> DataFrame:
    """at (the byte at which it begins), item: every element of the JSON array in a file, as text, by ranges of so many bytes, of which a task takes some one after the other. An element is read with the range in which it begins."""
    cut = ranges(spark, address, size)

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _open(address)
        with system.open_input_file(path) as file:
            for batch in batches:
                rows = []
                for at, upto in zip(batch["at"], batch["upto"]):
                    data = np.frombuffer(file.read_at(int(upto - at), int(at)), dtype=np.uint8)
                    quotes, parity = _marks(data, _odd_slashes(file, int(at)))
                    rows.append((at, int(quotes.sum()) % 2, *(int(_depth(data, (parity + begin) % 2 == 1).sum()) for begin in (0, 1))))
                yield pd.DataFrame(rows, columns=["at", "odd", "outside", "inside"])

    # a row a range
    told = cut.mapInPandas(summary, "at long, odd int, outside long, inside long").orderBy("at").collect()
    begins, inside, depth = [], 0, 0
    for r in told:
        begins.append((r["at"], inside, depth))
        depth += r["inside"] if inside else r["outside"]
        inside ^= r["odd"]
    if not told or inside or depth:
        raise ValueError(f"{address} holds no whole JSON array")
    state = spark.createDataFrame(begins, "at long, inside int, depth long")

    def elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _open(address)
        with system.open_input_file(path) as file:
            for batch in batches:
                for at, upto, begin, deep in zip(batch["at"], batch["upto"], batch["inside"], batch["depth"]):
                    yield from _elements(file, int(at), int(upto), int(begin), int(deep))

    return cut.join(state, "at").repartition(_tasks(spark, len(told)), "at").mapInPandas(elements, "at long, item string")


def _elements(file, at: int, upto: int, inside: int, depth: int) -> Iterator[pd.DataFrame]:
    """Elements that begin behind a bracket or comma of this range."""
    starts, ends, data, read = [], [], b"", at
    while True:
        more = file.read_at(min(RANGE, max(upto - read, 1 << 16)), read)
        if not more:
            break
        part = np.frombuffer(more, dtype=np.uint8)
        quotes, parity = _marks(part, _odd_slashes(file, read))
        within = (parity + inside) % 2 == 1
        change = _depth(part, within)
        after = depth + np.cumsum(change)
        place = read + np.arange(len(part))
        comma = (part == 0x2C) & (after == 1) & ~within
        opens = (change == 1) & (after == 1)
        closes = (change == -1) & (after == 0)
        found = place[comma | opens]
        starts += found[found < upto].tolist()
        ends += place[comma | closes].tolist()
        data += more
        read += len(more)
        inside, depth = int((inside + quotes.sum()) % 2), int(after[-1])
        if read >= upto and (not starts or ends and ends[-1] > starts[-1]):
            break
    rows, k = [], 0
    for s in starts:
        while k < len(ends) and ends[k] <= s:
            k += 1
        text = data[s + 1 - at : ends[k] - at].strip(b" \t\r\n") if k < len(ends) else b""
        if text:
            rows.append((s + 1, text.decode()))
        if len(rows) >= 10_000:
            yield pd.DataFrame(rows, columns=["at", "item"])
            rows = []
    if rows:
        yield pd.DataFrame(rows, columns=["at", "item"])


def read_large_rows(spark: SparkSession, address: str, schema: str, size: int = RANGE) -> DataFrame:
    """The elements of a JSON array in one file as rows of a schema."""
    return read_array(spark, address, size).select(F.from_json("item", schema).alias("r")).select("r.*")
