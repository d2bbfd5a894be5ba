"""Geometry of figures and their descriptions, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<x:int,y:int,w:int,h:int>"
LINE = "struct<x1:int,y1:int,x2:int,y2:int>"

# Texts of a description and of failures.
INTRO = "图中"
CIRCLE_AND_SQUARE, CIRCLE, SQUARE = "包含圆形和方形卦象结构，", "包含圆形卦象结构，", "包含方形卦象结构，"
LINES_BEFORE, LINES_AFTER = "检测到", "条线条，"
FITS, FITS_NOT = "符合卦象基本特征。", "不完全符合卦象特征。"
HAS_TEXT = "\n图中包含文字信息："
CAPTION = "\n基础图像描述："
NO_FEATURES, NO_ANALYSIS, NO_CAPTION = "无法识别卦象特征", "图片分析失败", "图片描述生成失败"


def is_figure(box: Column) -> Column:
    """Sides over 100 and nearly square: a ratio strictly between 0.8 and 1.2."""
    ratio = box["w"] / box["h"]
    return (box["w"] > 100) & (box["h"] > 100) & (ratio > 0.8) & (ratio < 1.2)


def is_region(box: Column) -> Column:
    return (box["w"] > 50) & (box["h"] > 50)


def is_rectangle(box: Column) -> Column:
    return (box["w"] > 30) & (box["h"] > 30)


def kept_boxes(boxes: Column, test=is_figure) -> Column:
    """The boxes that pass; their places in the result number the crops."""
    return F.filter(boxes, test)


def n_horizontal(lines: Column) -> Column:
    """Lines under ten degrees from the horizontal, drawn to the right; 0 for null."""
    flat = lambda v: F.abs(F.atan2(v["y2"] - v["y1"], v["x2"] - v["x1"]) * 180 / F.pi()) < 10
    return F.coalesce(F.size(F.filter(lines, flat)), F.lit(0))


def looks_like_hexagram(lines: Column) -> Column:
    """Six to eight horizontal lines; false for null."""
    return F.when(lines.isNull(), False).otherwise(n_horizontal(lines).between(6, 8))


def features(circles: Column, boxes: Column, lines: Column) -> Column:
    """has_circle, has_rectangle, line_count, is_hexagram, rectangles, from what a detector found."""
    rectangles = F.filter(boxes, is_rectangle)
    return F.struct(
        circles.isNotNull().alias("has_circle"),
        (F.size(rectangles) > 0).alias("has_rectangle"),
        F.when(lines.isNull(), 0).otherwise(F.size(lines)).alias("line_count"),
        looks_like_hexagram(lines).alias("is_hexagram"),
        rectangles.alias("rectangles"),
    )


def description(f: Column, text: Column) -> Column:
    """The sentence on a figure; a fixed one where there are no features."""
    shape = F.when(f["has_circle"] & f["has_rectangle"], CIRCLE_AND_SQUARE).when(f["has_circle"], CIRCLE).when(f["has_rectangle"], SQUARE).otherwise("")
    count = F.when(f["line_count"] > 0, F.concat(F.lit(LINES_BEFORE), f["line_count"].cast("string"), F.lit(LINES_AFTER))).otherwise("")
    fits = F.when(f["is_hexagram"], FITS).otherwise(FITS_NOT)
    words = F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit(HAS_TEXT), text)).otherwise("")
    return F.when(f.isNull(), NO_FEATURES).otherwise(F.concat(F.lit(INTRO), shape, count, fits, words))


def caption(told: Column, model_caption: Column) -> Column:
    """A description followed by a model's caption; the fixed failure text where the model gave none."""
    return F.when(model_caption.isNull(), NO_CAPTION).otherwise(F.concat(told, F.lit(CAPTION), model_caption))
