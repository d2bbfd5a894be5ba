"""Lines and circles on gray images by voting: every edge point is a row, votes are counted by map-side aggregates, and what remains after the counts is small.

Lines: a point votes for its distance from the origin at each angle. Peaks of the votes are lines, the points on a peak's line in order along it are cut at gaps into segments (gaps and islands). Circles: a point votes for the centres that lie across its edge, along the
gradient, at each radius. Of peaks near one another the strongest counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.operators.shapes import LIGHT, pixel_rows
from scriptorium.sources.shared import dealt, discard, written

# The detectors' settings. Votes of a line, length of a segment, gap within one; radii and least distance of circles.
LINE_VOTES, LEAST_LENGTH, MOST_GAP = 50, 50, 10
RADII, LEAST_DISTANCE = (30, 100), 50
#: Share of a circle's points that have to be there.
ROUND = 0.5
#: Degrees to either side of a gradient in which a circle's centre may lie.
FAN = 12
#: How far, in degrees and pixels, a line's votes spread around its peak.
SPREAD = 3


def edge_points(images: DataFrame, light=None, content: str = "content") -> DataFrame:
    """path, x, y, gx, gy: the light pixels that have a dark neighbour beside, above or below them, and the direction in which it grows lighter. light: as for shapes.boxes."""
    test = light or (lambda v: v > LIGHT)
    # images are dealt out as they are, so the window over their rows finds them together
    rows = pixel_rows(dealt(images, "path"), content).select("path", "y", F.transform("pixels", lambda v: test(v).cast("int")).alias("b"))
    order = Window.partitionBy("path").orderBy("y")
    three = rows.withColumn("up", F.lag("b").over(order)).withColumn("down", F.lead("b").over(order))
    at = lambda row, i: F.when(F.col(row).isNull() | (i < 0), 0).otherwise(F.coalesce(F.get(row, F.greatest(i, F.lit(0))), F.lit(0)))

    def point(i: Column) -> Column:
        gx = at("up", i + 1) + 2 * at("b", i + 1) + at("down", i + 1) - at("up", i - 1) - 2 * at("b", i - 1) - at("down", i - 1)
        gy = at("down", i - 1) + 2 * at("down", i) + at("down", i + 1) - at("up", i - 1) - 2 * at("up", i) - at("up", i + 1)
        return F.struct(i.alias("x"), gx.alias("gx"), gy.alias("gy"))

    edge = lambda i: (at("b", i) == 1) & (at("b", i - 1) + at("b", i + 1) + at("up", i) + at("down", i) < 4)
    found = F.transform(F.filter(F.sequence(F.lit(0), F.size("b") - 1), edge), point)
    return three.select("path", "y", F.explode(found).alias("p")).select("path", "p.x", "y", "p.gx", "p.gy")


def _voted(points: DataFrame) -> DataFrame:
    """path, x, y, angle (whole degrees, 0 to 179, of the line's normal), rho: for each point and angle the distance of the line through it."""
    each = points.select("path", "x", "y", F.explode(F.sequence(F.lit(0), F.lit(179))).alias("angle"))
    turn = F.radians(F.col("angle").cast("double"))
    return each.withColumn("rho", F.round(F.col("x") * F.cos(turn) + F.col("y") * F.sin(turn)).cast("int"))


def lines(points: DataFrame, votes: int = LINE_VOTES, least: int = LEAST_LENGTH, gap: int = MOST_GAP) -> DataFrame:
    """path, x1, y1, x2, y2 (from left to right, or from top to bottom where upright), points: segments along lines with so many points, no shorter than least, without gaps over gap."""
    points = written(points, "points")
    # dealt by image, the votes of one are counted where they're cast
    strong = written(_voted(dealt(points, "path")).groupBy("path", "angle", "rho").agg(F.count("*").alias("n")).where(F.col("n") >= votes), "votes")
    # a line's votes spread over neighbouring angles and distances; past 179 degrees an angle begins again at 0 and the distance turns its sign
    steps = [(a, r) for a in range(-SPREAD, SPREAD + 1) for r in range(-SPREAD, SPREAD + 1)]
    near = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(r).alias("r")) for a, r in steps]))
    # one number for votes, then angle, then distance
    rank = F.shiftleft(F.col("n"), 32) + F.shiftleft(F.col("angle").cast("long"), 24) + F.col("rho") + (1 << 23)
    around = dealt(strong, "path").select("path", "angle", "rho", rank.alias("rank"), near.alias("s")).select("path", (F.col("angle") + F.col("s.a")).alias("a"), (F.col("rho") + F.col("s.r")).alias("r"), "rank", ((F.col("s.a") == 0) & (F.col("s.r") == 0)).alias("own"))
    turned = (F.col("a") < 0) | (F.col("a") > 179)
    around = around.select("path", F.pmod("a", F.lit(180)).alias("angle"), F.when(turned, -F.col("r")).otherwise(F.col("r")).alias("rho"), "rank", "own")
    met = around.groupBy("path", "angle", "rho").agg(F.max(F.when(F.col("own"), F.col("rank"))).alias("mine"), F.max("rank").alias("best"))
    turn = F.radians(F.col("angle").cast("double"))
    peaks = met.where("mine = best").select("path", "angle", "rho", F.cos(turn).alias("cos"), F.sin(turn).alias("sin"))
    # peaks are few an image
    on = points.join(peaks, "path").where(F.round(F.col("x") * F.col("cos") + F.col("y") * F.col("sin")).cast("int") == F.col("rho"))
    on = on.withColumn("t", F.round(F.col("y") * F.col("cos") - F.col("x") * F.col("sin"), 3))
    order = Window.partitionBy("path", "angle", "rho").orderBy("t", "x", "y")
    cut = F.when(F.col("t") - F.lag("t").over(order) <= gap, 0).otherwise(1)
    island = on.withColumn("cut", cut).withColumn("island", F.sum("cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    end = F.struct("x", "y")
    told = island.groupBy("path", "angle", "rho", "island").agg(F.min(end).alias("a"), F.max(end).alias("b"), (F.max("t") - F.min("t")).alias("length"), F.count("*").alias("points"))
    long = told.where(F.col("length") >= least - 1).select("path", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"), "points")
    out = written(long, "segments")
    discard(points)
    discard(strong)
    return out


def circles(points: DataFrame, radii: tuple[int, int] = RADII, distance: int = LEAST_DISTANCE, share: float = ROUND) -> DataFrame:
    """path, x, y, r, votes: circles with at least that share of their points' votes, no two centres nearer than distance: the one with more votes for its size stays."""
    sloped = points.where((F.col("gx") != 0) | (F.col("gy") != 0)).select("path", "x", "y", F.atan2("gy", "gx").alias("angle"))
    each = sloped.withColumn("r", F.explode(F.sequence(F.lit(radii[0]), F.lit(radii[1]))))
    # a gradient of nine pixels is only so exact: a point votes for all pixels near the arc of centres that it allows, once for each
    turns = [math.radians(side + FAN * k / 2) for side in (0, 180) for k in range(-2, 3)]
    around = lambda t, i, j: F.struct((F.round(F.col("x") + F.col("r") * F.cos(F.col("angle") + t)).cast("int") + i).alias("cx"), (F.round(F.col("y") + F.col("r") * F.sin(F.col("angle") + t)).cast("int") + j).alias("cy"))
    allowed = F.array_distinct(F.flatten(F.transform(F.array(*map(F.lit, turns)), lambda t: F.array(*[around(t, i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]))))
    votes = each.select("path", "r", F.explode(allowed).alias("c")).groupBy("path", "c.cx", "c.cy", "r").agg(F.count("*").alias("votes"))
    likely = written(votes.withColumn("share", F.col("votes") / (2 * F.pi() * F.col("r"))).where(F.col("share") >= share), "votes")
    # candidates are few and meet in cells as wide as the least distance: a candidate gives way to a better one nearer than that
    rank = F.struct(F.round("share", 6).alias("share"), (-F.col("r")).alias("r"), (-F.col("cx")).alias("x"), (-F.col("cy")).alias("y"))
    ranked = likely.withColumn("rank", rank)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    cell = lambda c: F.floor(F.col(c) / distance)
    own = ranked.select("path", "cx", "cy", "r", "votes", "rank", cell("cx").alias("ux"), cell("cy").alias("uy"))
    # of each cell the best candidate of each centre is enough
    others = ranked.groupBy("path", "cx", "cy").agg(F.max("rank").alias("other")).withColumn("s", cells).select("path", F.col("cx").alias("ox"), F.col("cy").alias("oy"), "other", (cell("cx") + F.col("s.i")).alias("ux"), (cell("cy") + F.col("s.j")).alias("uy"))
    beaten = own.join(others, ["path", "ux", "uy"]).where((F.col("other") > F.col("rank")) & ((F.col("cx") - F.col("ox")) * (F.col("cx") - F.col("ox")) + (F.col("cy") - F.col("oy")) * (F.col("cy") - F.col("oy")) < distance * distance))
    out = own.join(beaten.select("path", "cx", "cy", "r").distinct(), ["path", "cx", "cy", "r"], "left_anti")
    out = out.select("path", F.col("cx").alias("x"), F.col("cy").alias("y"), "r", "votes")
    out._scratch = likely._scratch
    return out
