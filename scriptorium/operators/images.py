"""Images through outside detectors, readers and caption models, all passed in as functions of the encoded image."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.figures import BOX, LINE, NO_ANALYSIS, caption, description, features, is_region, kept_boxes


class Found(NamedTuple):
    """What a detector sees: circles (x, y, r) or None, boxes (x, y, w, h), lines (x1, y1, x2, y2) or None, and the text that is read."""

    circles: list[tuple[int, int, int]] | None
    boxes: list[tuple[int, int, int, int]]
    lines: list[tuple[int, int, int, int]] | None
    text: str


FOUND = f"struct<ok:boolean,circles:array<struct<x:int,y:int,r:int>>,boxes:array<{BOX}>,lines:array<{LINE}>,text:string>"


def detected(detect: Callable[[bytes], Found]):
    """A column function: what detect finds on each image; ok is false where it fails."""

    @F.pandas_udf(FOUND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for png in batch:
                try:
                    f = detect(bytes(png))
                    shapes = lambda items, names: None if items is None else [dict(zip(names, map(int, i))) for i in items]
                    rows.append((True, shapes(f.circles, ("x", "y", "r")), shapes(f.boxes, ("x", "y", "w", "h")), shapes(f.lines, ("x1", "y1", "x2", "y2")), f.text.strip()))
                except Exception:  # noqa: BLE001  a detector's failure is a row with its status
                    rows.append((False, None, None, None, None))
            yield pd.DataFrame(rows, columns=["ok", "circles", "boxes", "lines", "text"])

    return run


def captioned(write: Callable[[list[bytes]], list[str | None]]):
    """A column function: a model's captions, a batch at a time; null where it gives none or the batch fails."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            try:
                out = list(write([bytes(x) for x in batch]))
            except Exception:  # noqa: BLE001  a model's failure is a missing caption
                out = [None] * len(batch)
            yield pd.Series(out, dtype=object)

    return run.asNondeterministic()


def describe_images(images: DataFrame, detect: Callable[[bytes], Found], write: Callable[[list[bytes]], list[str | None]] | None = None, image: str = "content") -> DataFrame:
    """The other columns, status (ok or failed), analysis, caption: each image is looked at once and captioned once. Failures have the fixed texts, so
    that they can be told apart from rows without a figure."""
    others = [c for c in images.columns if c != image]
    seen = images.withColumn("__d", detected(detect)(F.col(image)))
    told = F.when(F.col("__d.ok"), description(features(F.col("__d.circles"), F.col("__d.boxes"), F.col("__d.lines")), F.col("__d.text"))).otherwise(NO_ANALYSIS)
    given = captioned(write)(F.col(image)) if write else F.lit(None).cast("string")
    rows = seen.select(*others, F.when(F.col("__d.ok"), "ok").otherwise("failed").alias("status"), told.alias("analysis"), given.alias("__c"))
    return rows.select(*others, "status", "analysis", (caption(F.col("analysis"), F.col("__c")) if write else F.lit(None).cast("string")).alias("caption"))


def split_regions(images: DataFrame, find: Callable[[bytes], list], cut: Callable[[bytes, tuple], bytes], image: str = "content", path: str = "path") -> DataFrame:
    """path, region (from 0, of those kept), png: the regions of each image with sides over 50, cut out. An image on which find fails is one row without a region, a region that can't be cut out one without an image."""
    from scriptorium.sources.files import cropped

    @F.pandas_udf(f"struct<ok:boolean,boxes:array<{BOX}>>")
    def found(pngs: pd.Series) -> pd.DataFrame:
        rows = []
        for png in pngs:
            try:
                rows.append((True, [dict(zip("xywh", map(int, b))) for b in find(bytes(png))]))
            except Exception:  # noqa: BLE001  a finder's failure is a row with its status
                rows.append((False, []))
        return pd.DataFrame(rows, columns=["ok", "boxes"])

    kept = F.transform(kept_boxes(F.col("f.boxes"), is_region), lambda b, k: F.struct(k.alias("region"), b.alias("b")))
    none = F.array(F.struct(F.lit(None).cast("int").alias("region"), F.lit(None).cast(BOX).alias("b")))
    rows = images.select(path, image, found(F.col(image)).alias("f")).select(path, image, F.explode(F.when(F.col("f.ok"), kept).otherwise(none)).alias("r"))
    return rows.select(path, F.col("r.region").alias("region"), cropped(cut)(F.col(image), F.col("r.b")).alias("png"))
