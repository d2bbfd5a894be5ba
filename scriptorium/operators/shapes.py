"""Shapes on gray images, as plans over rows of pixels: thresholds from histograms, and connected regions with their boxes.

An image is a row (path, content) whose content is a binary PGM (P5, 8 bits), the plainest format that readers and scanners write. A row of pixels is an array of numbers. For regions an image is cut into strips of whole rows; what is connected within a
strip is a piece, one row, so what is joined and labelled follows the number of pieces and not of rows or pixels. Pieces of neighbouring strips are joined by the runs of pixels in the strips' outer rows, by row and by blocks of columns, never all with all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions.pieces import HELD, few_bytes
from scriptorium.operators.components import connected
from scriptorium.sources.shared import dealt, discard, written

#: Columns of a block in which runs look for their neighbours.
BLOCK = 64
#: Pixels of a strip; a longer row is a strip of its own.
STRIP = 1 << 16
# A page's regions are lighter than this.
LIGHT = 127
HEADER = r"^P5\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s"


def _whole(images: DataFrame, content: str) -> DataFrame:
    """path, width, height, from (bytes of the header), content of what is a whole binary PGM image."""
    # the header is ASCII; one character a byte keeps all places
    told = images.select("path", content, F.decode(F.substring(content, 1, 200), "ISO-8859-1").alias("head"))
    size = lambda k: F.regexp_extract("head", HEADER, k)
    known = told.where(size(0) != "").select("path", content, F.char_length(size(0)).alias("from"), size(1).cast("int").alias("width"), size(2).cast("int").alias("height"))
    return known.where(F.octet_length(content) >= F.col("from") + F.col("width") * F.col("height")).where("width > 0 and height > 0")


def pixel_rows(images: DataFrame, content: str = "content") -> DataFrame:
    """path, y, width, height, pixels (array<int>) of each row of binary PGM images. What is no such image, or is cut off, has no rows."""
    rows = _whole(images, content).select("path", "width", "height", "from", content, F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"))
    line = F.decode(F.substring(F.col(content), F.col("from") + 1 + F.col("y") * F.col("width"), F.col("width")), "ISO-8859-1")
    return rows.select("path", "y", "width", "height", F.transform(F.split(line, ""), lambda c: F.ascii(c)).alias("pixels"))


def histograms(rows: DataFrame) -> DataFrame:
    """path, value, n: how many pixels of each gray value an image has."""
    return rows.select("path", F.explode("pixels").alias("value")).groupBy("path", "value").agg(F.count("*").alias("n"))


def otsu(counts: DataFrame) -> DataFrame:
    """path, threshold: the gray value up to and above which pixels differ most, by the variance between both sides; the smallest of equal ones, 0 for an image of one value. counts: as histograms() gives them, at most 256 rows an image."""
    order = Window.partitionBy("path").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("path")
    told = counts.select(
        "path", "value", F.sum("n").over(order).alias("n0"), F.sum(F.col("n") * F.col("value")).over(order).alias("s0"), F.sum("n").over(every).alias("n"), F.sum(F.col("n") * F.col("value")).over(every).alias("s")
    )
    apart = (F.col("s").cast("double") * F.col("n0") - F.col("s0").cast("double") * F.col("n")) / F.col("n")
    between = F.when(F.col("n0") < F.col("n"), apart * apart / (F.col("n0").cast("double") * (F.col("n") - F.col("n0")))).otherwise(0.0)
    best = told.groupBy("path").agg(F.max(F.struct(between.alias("v"), (-F.col("value")).alias("t"))).alias("b"))
    return best.select("path", F.when(F.col("b.v") > 0, -F.col("b.t")).otherwise(0).alias("threshold"))


def binarised(images: DataFrame, content: str = "content") -> DataFrame:
    """The images in black and white by their own thresholds; path, content."""
    rows = pixel_rows(images, content)
    found = rows.join(otsu(histograms(rows)), "path")
    line = F.array_join(F.transform("pixels", lambda v: F.when(v > F.col("threshold"), "\xff").otherwise("\0")), "")
    whole = found.groupBy("path", "width", "height").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", line.alias("line")))), lambda r: r["line"]), "").alias("body"))
    return whole.select("path", F.encode(F.concat(F.format_string("P5\n%d %d\n255\n", "width", "height"), "body"), "ISO-8859-1").alias("content"))


def strips(images: DataFrame, content: str = "content", strip: int = STRIP) -> DataFrame:
    """path, y (of the first row), width, height (of the image), pixels (binary): binary PGM images in strips of whole rows, so many pixels or one row each. What is no such image, or is cut off, has none."""
    whole = _whole(images, content).withColumn("rows", F.greatest(F.lit(1), F.floor(F.lit(strip) / F.col("width"))).cast("int"))
    each = whole.select("*", F.explode(F.sequence(F.lit(0), F.col("height") - 1, F.col("rows"))).alias("y"))
    some = F.least("rows", F.col("height") - F.col("y")) * F.col("width")
    return each.select("path", "y", "width", "height", F.substring(F.col(content), F.col("from") + 1 + F.col("y") * F.col("width"), some).alias("pixels"))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of n numbers that each is connected with by edges a, b: each hangs on its smallest neighbour, then edges within a tree go."""
    root = np.arange(n)
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    return root


def _pieces(batch: pa.RecordBatch, light: np.ndarray, ids: int) -> pa.RecordBatch:
    """The pieces of a few strips, numbered from ids: runs of pixels that are alike, one after another in all rows of all strips, and edges between those that touch in neighbouring rows."""
    y, width, height = (batch.column(c).to_numpy().astype(np.int64) for c in ("y", "width", "height"))
    lit = light[np.frombuffer(b"".join(batch.column("pixels").to_pylist()), np.uint8)]
    rows = pc.binary_length(batch.column("pixels")).to_numpy() // width
    of = np.repeat(np.arange(len(y)), rows)
    begin = np.cumsum(width[of]) - width[of]
    change = np.append(True, lit[1:] != lit[:-1])
    change[begin] = True
    start = np.flatnonzero(change)
    row = np.searchsorted(begin, start, "right") - 1
    strip, bright = of[row], lit[start]
    x0, x1 = start - begin[row], np.append(start[1:], len(lit)) - 1 - begin[row]
    at = y[strip] + row - (np.cumsum(rows) - rows)[strip]
    run = lambda place: np.searchsorted(start, place, "right") - 1
    # light ones touch by their corners, too
    inner = at > y[strip]
    low = np.flatnonzero(inner)
    above = begin[row[low] - 1]
    first, last = run(above + np.maximum(x0[low] - bright[low], 0)), run(above + np.minimum(x1[low] + bright[low], width[strip[low]] - 1))
    n = last - first + 1
    b, a = np.repeat(low, n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    alike = bright[a] == bright[b]
    # a piece's first run is its smallest number
    top, piece = np.unique(_roots(len(start), a[alike], b[alike]), return_inverse=True)
    x, right, bottom = x0[top], x1[top], at[top]
    np.minimum.at(x, piece, x0)
    np.maximum.at(right, piece, x1)
    np.maximum.at(bottom, piece, at)
    pixels = np.zeros(len(top), np.int64)
    np.add.at(pixels, piece, x1 - x0 + 1)
    free = np.zeros(len(top), bool)
    free[piece[~bright & ((at == 0) | (at == height[strip] - 1) | (x0 == 0) | (x1 == width[strip] - 1))]] = True
    over = piece[run(begin[np.maximum(row[top] - 1, 0)] + np.where(inner[top], x0[top], 0))]
    outer = np.flatnonzero(((at == y[strip]) & (at > 0)) | ((at == y[strip] + rows[strip] - 1) & (at < height[strip] - 1)))
    outer = outer[np.argsort(piece[outer], kind="stable")]
    ends = pa.StructArray.from_arrays([pa.array(v[outer], pa.int32()) for v in (at, x0, x1)], ["y", "x0", "x1"])
    border = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(piece[outer], minlength=len(top)))), pa.int32()), ends)
    whole = [pa.array(v, pa.int32()) for v in (at[top], x0[top], x, right, bottom)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids + np.arange(len(top))), batch.column("path").take(pa.array(strip[top])), pa.array(bright[top]), *whole, pa.array(pixels), pa.array(free), pa.array(ids + over, mask=~inner[top]), border],
        ["id", "path", "light", "y", "x0", "x", "x1", "y1", "pixels", "free", "around", "border"],
    )


def pieces(cut: DataFrame, light=None) -> DataFrame:
    """id, path, light, y, x0, x, x1, y1, pixels, free, around, border: what is connected within a strip, light pixels by eight neighbours and dark ones by four. y and x0 are those of its first pixel, x to x1 and down to y1 is its box. A dark piece is free
    that meets the image's edge. around: the piece above the first pixel, null if that's in another strip or beyond the image. border: its runs (y, x0, x1) in rows next to another strip. The ids are for one run of the plan: write them before they're read twice."""
    test, spark = light or (lambda v: v > LIGHT), cut.sparkSession
    values = spark.range(256).select("id", F.coalesce(test(F.col("id").cast("int")), F.lit(False)).alias("light")).collect()
    known = np.array([r.light for r in sorted(values)], bool)
    few_bytes(spark)

    def run(batches):
        from pyspark import TaskContext

        ids = TaskContext.get().partitionId() << 40
        for batch in batches:
            # so many pixels at once, or one strip
            group = np.cumsum(pc.binary_length(batch.column("pixels")).to_numpy().astype(np.int64)) // HELD
            cuts = [*np.flatnonzero(np.diff(group, prepend=-1)), batch.num_rows]
            for k, end in zip(cuts, cuts[1:]):
                found = _pieces(batch.slice(k, end - k), known, ids)
                ids += found.num_rows
                yield found

    kind = cut.schema["path"].dataType.simpleString()
    schema = f"id long, path {kind}, light boolean, y int, x0 int, x int, x1 int, y1 int, pixels long, free boolean, around long, border array<struct<y: int, x0: int, x1: int>>"
    return cut.mapInArrow(run, schema)


def _in_blocks(df: DataFrame, low: Column, high: Column) -> DataFrame:
    return df.withColumn("block", F.explode(F.sequence(F.floor(low / BLOCK), F.floor(high / BLOCK))))


def touching(found: DataFrame) -> DataFrame:
    """a, b: runs (id, path, y, x0, x1, light) of neighbouring rows that belong together: light ones also by their corners, dark ones by their sides."""
    above = _in_blocks(found, F.col("x0"), F.col("x1")).select("path", "block", "light", F.col("y").alias("y"), F.col("id").alias("a"), F.col("x0").alias("a0"), F.col("x1").alias("a1"))
    reach = F.when(F.col("light"), 1).otherwise(0)
    below = _in_blocks(found, F.col("x0") - reach, F.col("x1") + reach).select("path", "block", "light", (F.col("y") - 1).alias("y"), F.col("id").alias("b"), (F.col("x0") - reach).alias("b0"), (F.col("x1") + reach).alias("b1"))
    return above.join(below, ["path", "y", "block", "light"]).where("a0 <= b1 and b0 <= a1").select("a", "b").distinct()


def boxes(images: DataFrame, light=None, content: str = "content", strip: int = STRIP) -> DataFrame:
    """path, x, y, w, h, pixels: the boxes around connected light regions (eight neighbours) of binary PGM images that lie within no other region; pixels is how many of the region's own are in it. light: a function of a pixel's value, without it
    "over 127"; pass one of the dark values for ink on paper. strip: pixels of a strip. Use figures.kept_boxes' tests on them."""
    found = written(pieces(dealt(strips(images, content, strip)), light), "pieces")
    ends = found.select("id", "path", "light", F.explode("border").alias("r")).select("id", "path", "light", "r.*")
    edges = written(touching(ends).where("a <> b"), "touching")
    roots = connected(edges)
    discard(edges)
    own = found.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    top = F.min(F.struct("y", "x0", "around")).alias("top")
    regions = own.where("light").groupBy("path", "root").agg(F.min("x").alias("x"), F.min("y").alias("y"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.sum("pixels").alias("pixels"), top)
    # above its first pixel a region meets what is around it: the image's edge, a dark region that goes there, or a hole of another
    placed = regions.select("path", "x", "y", "x1", "y1", "pixels", F.col("top.x0").alias("x0"), F.col("top.around").alias("around"))
    dark = _in_blocks(ends.where("not light"), F.col("x0"), F.col("x1")).select("path", (F.col("y") + 1).alias("y"), "block", F.col("x0").alias("d0"), F.col("x1").alias("d1"), F.col("id").alias("above"))
    apart = placed.where("around is null and y > 0").withColumn("block", F.floor(F.col("x0") / BLOCK)).join(dark, ["path", "y", "block"]).where("x0 between d0 and d1")
    within = placed.where("around is not null").unionByName(apart.withColumn("around", F.col("above")).select(placed.columns))
    outer = own.where("not light").groupBy("root").agg(F.max("free").alias("free")).where("free").select("root")
    free = own.where("not light").select(F.col("id").alias("around"), "root").join(outer, "root")
    kept = placed.where("y = 0").unionByName(within.join(free, "around").select(placed.columns))
    out = written(kept.select("path", "x", "y", (F.col("x1") - F.col("x") + 1).alias("w"), (F.col("y1") - F.col("y") + 1).alias("h"), "pixels"), "boxes")
    discard(found)
    discard(roots)
    return out
