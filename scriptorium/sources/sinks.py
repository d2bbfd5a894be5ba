"""Results as files."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines, null fields kept, in as many files as there are partitions."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_parts(df: DataFrame, path: str, key: str = "seg_no", mode: str = "error") -> None:
    """A folder for each value of key."""
    df.write.mode(mode).partitionBy(key).option("ignoreNullFields", "false").json(path)


def part_name(seg_no):
    """The name of a part's file: part_001.json and so on."""
    return F.format_string("part_%03d.json", seg_no)


def write_texts(df: DataFrame, path: str, name: str = "doc_id", text: str = "text", mode: str = "error") -> None:
    """Texts by name, as a table: a file for each of very many names is no use on a cluster."""
    df.select(name, text).write.mode(mode).parquet(path)


def write_images(df: DataFrame, folder: str, path: str = "path", image: str = "png") -> DataFrame:
    """Each image as a file of its own below a folder that all machines share (an address); path, bytes of each. Run by whoever reads the result; a repeated task writes the
    same files again."""

    def run(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            sizes = []
            for name, png in zip(batch[path], batch[image]):
                system.create_dir(f"{base}/{name}".rpartition("/")[0], recursive=True)
                with system.open_output_stream(f"{base}/{name}", compression=None) as f:
                    f.write(bytes(png))
                sizes.append(len(png))
            yield pd.DataFrame({"path": batch[path], "bytes": sizes})

    return df.select(path, image).mapInPandas(run, "path string, bytes long")


def write_with_quarantine(good: DataFrame, bad: DataFrame, path: str, mode: str = "error") -> None:
    """Good rows and what was set aside, side by side."""
    good.write.mode(mode).parquet(f"{path}/good")
    bad.write.mode(mode).parquet(f"{path}/quarantine")


def export_array(df: DataFrame, path: str, order: list[str], drop: list[str] = (), indent: int = 4, encoding: str = "utf-8") -> int:
    """One pretty JSON array on the driver's own disk, in order, non-ASCII kept; the number of items. Rows come to the driver partition by partition,
    so it never holds more than one. A failure is raised, and leaves no half-written file under that name."""
    import os

    n, rows = 0, df.orderBy(*order).drop(*drop)
    with open(f"{path}.part", "w", encoding=encoding) as f:
        f.write("[")
        for row in rows.toLocalIterator():
            text = json.dumps(row.asDict(recursive=True), ensure_ascii=False, indent=indent)
            f.write((",\n" if n else "\n") + "\n".join(" " * indent + line for line in text.split("\n")))
            n += 1
        f.write("\n]" if n else "]")
    os.replace(f"{path}.part", path)
    return n
