"""Files as DataFrames: texts in several encodings, JSON arrays, numbered file sets, pages and images. Spark's file sources list no empty files,
so such a file has no row."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions.text import unix_lines
from scriptorium.operators.assemble import merge_numbered
from scriptorium.sources import charsets

# Numbered file sets and the patterns of their numbers.
SUCCESS_GLOB, SUCCESS_NUMBER = "success*.json", r"success(\d+)\.json$"
PAIRS_GLOB, PAIRS_NUMBER = "qa_pairs_*.json", r"qa_pairs_(\d+)"


def decode(content: bytes | None) -> tuple[str | None, str | None]:
    """Text and encoding, told from all bytes; see sources.charsets."""
    return charsets.detect(content)


def decoded(content: Column) -> Column:
    """struct<text, encoding> of binary contents."""

    def run(contents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode(c) for c in contents], columns=["text", "encoding"])

    return F.pandas_udf(run, "struct<text:string,encoding:string>")(content)


def _name(path: str = "path"):
    return F.element_at(F.split(path, "/"), -1)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (file name), text: UTF-8 files whole, with all line ends as newline."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return raw.select(_name().alias("doc_id"), unix_lines(F.col("value")).alias("text"))


def read_any_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """doc_id (file name), text, encoding: files of unknown encoding; text is null where none fits (quarantine those)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", decoded(F.col("content")).alias("d"))
    return raw.select(_name().alias("doc_id"), unix_lines(F.col("d.text")).alias("text"), "d.encoding")


def read_training_rows(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """type, content, page, image_path, from files that are a JSON array each, or (lines) an object a line, which Spark can split."""
    return spark.read.schema("type string, content string, page int, image_path string").option("multiLine", not lines).json(path)


def read_file_set(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """name, raw: JSON files whole, as text."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return raw.select(_name().alias("name"), F.try_validate_utf8("content").alias("raw"))


def read_numbered(spark: SparkSession, path: str, glob: str = SUCCESS_GLOB, pattern: str = SUCCESS_NUMBER) -> tuple[DataFrame, DataFrame]:
    """name, raw, file_no of the files whose name has a number (2 before 10), and name, raw of the others."""
    return merge_numbered(read_file_set(spark, path, glob), pattern)


def read_images(spark: SparkSession, path: str, glob: str = "*.png") -> DataFrame:
    """path, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")


#: Renders a document: an image for each page, in order.
Renderer = Callable[[bytes], Iterable[bytes]]
#: Reads an image's text.
Reader = Callable[[bytes], str]
#: Finds boxes (x, y, w, h) on an image.
Finder = Callable[[bytes], Iterable[tuple[int, int, int, int]]]
#: Cuts a box out of an image.
Cutter = Callable[[bytes, tuple[int, int, int, int]], bytes]


#: Bytes and rows of images that go out at once.
BATCH_BYTES, BATCH_ROWS = 1 << 24, 1000


def render_pages(documents: DataFrame, render: Renderer) -> DataFrame:
    """doc_id, page_number (from 1), png, status of documents (path, content). A document is rendered page by page, never all at once, and pages go out in batches of some MB. Where rendering fails, a row without an image
    says so, with the number of the page that should have come; the pages before stay."""

    def pages(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                name, k = path.rsplit("/", 1)[-1], 0
                try:
                    for k, png in enumerate(render(bytes(content)), 1):
                        yield name, k, png, "ok"
                except Exception as e:  # noqa: BLE001  a document that can't be rendered is a row with its status
                    yield name, k + 1, None, f"not rendered: {type(e).__name__}"

    def run(batches):
        rows, held = [], 0
        for row in pages(batches):
            rows.append(row)
            held += len(row[2] or b"")
            if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield pd.DataFrame(rows, columns=["doc_id", "page_number", "png", "status"])
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["doc_id", "page_number", "png", "status"])

    return documents.select("path", "content").mapInPandas(run, "doc_id string, page_number int, png binary, status string")


def prepared(rendered: DataFrame, prepare: Callable[[bytes], bytes], image: str = "png") -> DataFrame:
    """The rows with each image as prepare makes it; where it fails, as it was."""

    @F.pandas_udf("binary")
    def run(images: pd.Series) -> pd.Series:
        def one(png):
            try:
                return prepare(bytes(png))
            except Exception:  # noqa: BLE001  an image that can't be prepared is read as it is
                return png

        return images.map(one)

    return rendered.withColumn(image, run(F.col(image)))


def read_pages(rendered: DataFrame, read: Reader, find: Finder, keep: Callable = None) -> DataFrame:
    """doc_id, page_number, text, images, png, status: each page's text, and its figures that pass the box test, numbered in the order found; a figure's path is made of
    document, page and number, so none overwrites another's crop. The page keeps its image for cutting the crops. What can't be read has no text, what a finder fails on no figures; status says so."""
    from scriptorium.functions.figures import BOX, is_figure, kept_boxes

    @F.pandas_udf(f"struct<text:string,boxes:array<{BOX}>,status:string>")
    def seen(images: pd.Series) -> pd.DataFrame:
        rows = []
        for png in images:
            text, boxes, causes = "", [], []
            if png is not None:
                try:
                    text = read(bytes(png)).strip()
                except Exception as e:  # noqa: BLE001  a reader's failure is an empty text
                    causes.append(f"not read: {type(e).__name__}")
                try:
                    boxes = [dict(zip("xywh", map(int, b))) for b in find(bytes(png))]
                except Exception as e:  # noqa: BLE001  a detector's failure is a page without figures
                    causes.append(f"no figures: {type(e).__name__}")
            rows.append((text, boxes, "; ".join(causes) or "ok"))
        return pd.DataFrame(rows, columns=["text", "boxes", "status"])

    pages = rendered.withColumn("s", seen("png")).withColumn("boxes", kept_boxes(F.col("s.boxes"), keep or is_figure))
    path = lambda k: F.concat(F.lit("figures/"), F.col("doc_id"), F.lit("/"), F.format_string("page_%05d_figure_%03d.png", F.col("page_number"), k))
    position = lambda b: F.struct(b["x"].alias("x"), b["y"].alias("y"), b["w"].alias("width"), b["h"].alias("height"))
    images = F.transform("boxes", lambda b, k: F.struct(path(k).alias("path"), position(b).alias("position"), F.lit(None).cast("string").alias("analysis"), F.lit(None).cast("string").alias("caption")))
    status = F.when(F.col("png").isNull(), F.col("status")).otherwise(F.col("s.status")) if "status" in rendered.columns else F.col("s.status")
    return pages.select("doc_id", "page_number", F.col("s.text").alias("text"), images.alias("images"), "png", status.alias("status"))


def cut_figures(pages: DataFrame, cut: Cutter) -> DataFrame:
    """doc_id, path, png of each figure of pages (with png); no image where cutting fails."""
    figures = pages.select("doc_id", "png", F.explode("images").alias("i"))
    return figures.select("doc_id", F.col("i.path").alias("path"), cropped(cut)(F.col("png"), F.struct(F.col("i.position.x").alias("x"), F.col("i.position.y").alias("y"), F.col("i.position.width").alias("w"), F.col("i.position.height").alias("h"))).alias("png"))


def cropped(cut: Cutter):
    """A column function: the part of an image in a box (x, y, w, h); null where cutting fails."""

    @F.pandas_udf("binary")
    def crop(images: pd.Series, boxes: pd.DataFrame) -> pd.Series:
        out = []
        for png, x, y, w, h in zip(images, boxes["x"], boxes["y"], boxes["w"], boxes["h"]):
            try:
                out.append(None if png is None or pd.isna(x) else cut(bytes(png), (int(x), int(y), int(w), int(h))))
            except Exception:  # noqa: BLE001  a figure that can't be cut out is a row without an image
                out.append(None)
        return pd.Series(out, dtype=object)

    return crop
