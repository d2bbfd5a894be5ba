"""Putting pieces together in order, and cutting conversations off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions.pieces import few_bytes
from scriptorium.functions.strictjson import elements


def ordered_concat(df: DataFrame, keys: list[str], order: list[str], text: str, out: str, between: str = "", after: str = "") -> DataFrame:
    """keys, out: the texts of a key in order, joined by between, each followed by after; nulls are skipped, none gives ''. The result is one
    string a key, so a key's texts meet in one task: that's the result's own shape, and keys are documents or calls."""
    rows = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(*order, F.col(text).alias("__t")))))
    texts = F.transform(rows, lambda r: F.concat(r["__t"], F.lit(after)))
    return df.groupBy(*keys).agg(F.array_join(texts, between).alias(out))


def training_text(rows: DataFrame, keys: list[str], order: list[str], text: str = "content", out: str = "all_text") -> DataFrame:
    """All texts of a key, each followed by a blank line."""
    return ordered_concat(rows, keys, order, text, out, after="\n\n")


def accumulate(deltas: DataFrame, call: str = "call_id", seq: str = "seq", content: str = "content", out: str = "full_text") -> DataFrame:
    """The whole answer of each streamed call; deltas without a choice or content are skipped, a call of such only gives ''."""
    kept = deltas.withColumn(content, F.when(F.col("has_choice"), F.col(content))) if "has_choice" in deltas.columns else deltas
    return ordered_concat(kept, [call], [seq], content, out)


EXIT_WORDS = ("exit", "quit")


def until_exit(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", words: tuple[str, ...] = EXIT_WORDS) -> DataFrame:
    """The turns before a conversation's first exit word, whatever its case."""
    over = Window.partitionBy(conv)
    first = F.min(F.when(F.lower(text).isin(*words), F.col(turn))).over(over)
    return turns.withColumn("__first", first).where(F.col("__first").isNull() | (F.col(turn) < F.col("__first"))).drop("__first")


def number(name: Column, pattern: str) -> Column:
    """The number that a pattern's group finds in a file name; null where it's none."""
    return F.regexp_extract(name, pattern, 1).try_cast("int")


def merge_numbered(files: DataFrame, pattern: str, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """Files with file_no, and those whose name has no number. A bag: nothing is deduplicated; order is in the keys."""
    marked = files.withColumn("file_no", number(F.col(name), pattern))
    return marked.where("file_no is not null"), marked.where("file_no is null").drop("file_no")


def merged(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """file_no, item_no (from 1), item: every element of numbered files (file_no, raw), each whole as JSON of its own, whatever its fields; and the files that
    aren't a JSON list. The order of the merged list is by file_no, item_no."""
    few_bytes(files.sparkSession)
    read = files.withColumn("__e", elements(F.col("raw")))
    rows = read.select("file_no", F.posexplode("__e").alias("__k", "item")).select("file_no", (F.col("__k") + 1).alias("item_no"), "item")
    return rows, read.where("__e is null").drop("__e")
