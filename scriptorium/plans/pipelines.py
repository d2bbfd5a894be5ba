"""The three ways through the engine: documents with figures to training rows, books to question and answer records, and texts in fixed chunks to the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import clean
from scriptorium.operators import flatten, images, models, qa, split
from scriptorium.sources import files
from scriptorium.sources.shared import written


def pages_to_training_rows(pages: DataFrame, figures: DataFrame | None = None, correct=None, limit: int = 1000, prompt=lambda s: s) -> DataFrame:
    """Figures described (figures: doc_id, path, analysis, caption), texts cleaned and then corrected (correct: what models.calls() gives; prompt: what is said around a
    segment), and all flattened. What the corrector returns is kept as it is."""
    described = flatten.describe_figures(pages, figures) if figures is not None else pages
    cleaned = described.withColumn("text", clean(F.col("text")))
    return flatten.training_rows(models.corrected(cleaned, correct, limit, prompt=prompt) if correct is not None else cleaned)


def documents_to_training_rows(documents: DataFrame, render, read, find, cut, detect, write=None, prepare=None, correct=None, limit: int = 1000, prompt=lambda s: s, keep=None) -> DataFrame:
    """Documents (path, content) to training rows in one go: pages rendered, prepared (a function of an image, if one is given), read, their figures cut out, looked
    at and captioned, texts cleaned and corrected. What renders, reads, finds, cuts, detects and writes captions is passed in; see sources.files and operators.images. Pages are rendered and read once: keep writes them
    somewhere and reads them back, without it a table in the shared folder does, which the result reads. A page or figure on which one of these fails takes nothing else with it; files.read_pages says what failed."""
    rendered = files.render_pages(documents, render)
    read_once = files.read_pages(files.prepared(rendered, prepare) if prepare else rendered, read, find)
    pages = keep(read_once) if keep else written(read_once, "pages")
    told = images.describe_images(files.cut_figures(pages, cut), detect, write, image="png")
    out = pages_to_training_rows(pages.drop("png", "status"), told.select("doc_id", "path", "analysis", "caption"), correct, limit, prompt)
    out._scratch = getattr(pages, "_scratch", None)
    return out


def regions_to_analysis(pictures: DataFrame, find, cut, detect) -> DataFrame:
    """path, region, status, analysis of each region of pictures (path, content), cut out and looked at by itself."""
    regions = images.split_regions(pictures, find, cut)
    return images.describe_images(regions, detect, image="png").drop("caption")


def book_segments(books: DataFrame, longest: int = 8000, overlap: int = 1000) -> DataFrame:
    """doc_id, seg_no, segment."""
    return split.overlap_windows(books.select("doc_id", "text"), longest, overlap).select("doc_id", "seg_no", "segment")


def books_to_answers(books: DataFrame, ask, longest: int = 8000, overlap: int = 1000) -> DataFrame:
    """doc_id, seg_no, raw, status, items, bad_items: overlapping windows, each asked of the model (ask: a column function of a segment), answers strictly read."""
    asked = book_segments(books, longest, overlap).withColumn("raw", ask(F.col("segment"))).drop("segment")
    return qa.parse_answers(asked)


def books_to_records(books: DataFrame, ask, longest: int = 8000, overlap: int = 1000, system: str = qa.BOOK_SYSTEM) -> DataFrame:
    """doc_id, seg_no, pair_no, instruction, output, system."""
    return qa.records(books_to_answers(books, ask, longest, overlap), system)


def training_rows_to_pairs(rows: DataFrame, ask, longest: int = 8000, overlap: int = 1000) -> DataFrame:
    """doc_id, seg_no, pair_no, has_both, question, answer: the text rows of each document put together, in windows, asked and read; pairs aren't reshaped."""
    from scriptorium.operators.assemble import training_text

    texts = training_text(rows.where("type = 'text'"), ["doc_id"], ["page", "seq"], out="text")
    return qa.pairs(books_to_answers(texts, ask, longest, overlap))


def texts_to_chunks(texts: DataFrame, size: int = 2000, done: DataFrame | None = None, start_index: int = 0) -> DataFrame:
    """doc_id, chunk_no, chunk: chunks not yet done, by a number to start after, or a table of those that are."""
    if start_index < 0:
        raise ValueError("start_index counts chunks from 0")
    chunks = split.fixed_chunks(texts.select("doc_id", "text"), size)
    chunks = chunks.where(F.col("chunk_no") > start_index) if start_index else chunks
    return split.resume(chunks, done, "doc_id", "chunk_no") if done is not None else chunks


def chunks_to_json(chunks: DataFrame, ask) -> tuple[DataFrame, DataFrame]:
    """Chunks whose answer is JSON of any kind (with raw, json_type, and file_name), and those to set aside."""
    asked = chunks.withColumn("raw", ask(F.col("chunk"))).drop("chunk")
    good, bad = qa.any_json(asked)
    return good.withColumn("file_name", F.format_string("success%d.json", "chunk_no")), bad
