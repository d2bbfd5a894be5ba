"""A corpus pipeline: language ID, quality rules, line dedup, near-duplicate groups, packing.

Every stage works on all that the one before kept. Stages but the last return the columns of documents; the last has a row a
document with its place in a batch.

Defined results: null and empty texts go at the first stage (no language). Rows that share a doc_id are one document, rows without one that share a text are, too; a row without an id is the one kept for a group only where
the group has no id. Ties (equal texts) are of one group. Very long texts are worked on whole. An empty table gives no rows at any stage. Extra columns are carried along, whatever their names, but for the stages' own, which begin with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import crf, linededup, packing, ppm, simhash
from scriptorium.llm.storage import discard, few_texts, materialize, reading

BEFORE = "__hash_before_line_dedup"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of 0.5 or more; learnt from the rows that aren't held out."""
    few_texts(spark)
    trees = ppm.train(docs.where(ppm.fold_of("doc_id") != 0))
    return ppm.accepted(docs, trees)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are content for the most part; learnt from the labels table."""
    few_texts(spark)
    field = crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return crf.accepted(docs, field)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs; n_chars, where there is one, follows the text. Near copies as a whole are for the next stage to decide: what they share
    with each other isn't cut, else scraps of them would come through. Of what loses words, documents with fewer words left than the base rules ask for go."""
    few_texts(spark)
    groups = simhash.near_duplicate_groups(docs)
    found = linededup.dedup_lines(docs.withColumn(BEFORE, F.xxhash64("text")), groups=groups)
    changed = ~F.xxhash64("text").eqNullSafe(F.col(BEFORE))
    out = found.where(~changed | (crf.n_words(F.col("text")) >= crf.LEAST_WORDS)).drop(BEFORE)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return reading(out, found, groups)


def identity(docs: DataFrame) -> Column:
    """What tells documents apart: their id, or their text where they have none, which come last."""
    none = F.col("doc_id").isNull()
    return F.struct(none.alias("none"), F.col("doc_id").alias("id"), F.when(none, F.xxhash64("text")).otherwise(0).alias("text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id, or of the smallest hash of its text where none has an id: five-word shingles, similarity 0.8."""
    groups = simhash.near_duplicate_groups(docs.select(identity(docs).alias("doc_id"), "text"))
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    table = materialize(kept, "kept")
    discard(groups)
    kept = table.withColumnRenamed("doc_id", "__kept")
    # one plan at every size: the kept ids grow with the documents, so they aren't broadcast where they happen to be few
    mine = docs.withColumn("__own", identity(docs))
    met = [F.col(f"__own.{k}").eqNullSafe(F.col(f"__kept.{k}")) for k in ("none", "id", "text")]
    return reading(mine.join(kept.hint("merge"), met[0] & met[1] & met[2], "left_semi").drop("__own"), table)


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's length bucket and place in a batch of 65,536 tokens."""
    return packing.pack(docs)


STAGES = [("language_id", language), ("quality_rules", quality), ("line_dedup", lines), ("simhash_near_dedup", near_duplicates), ("packing", batches)]
# SQL can express neither the language model nor the random field; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written before the next; what a stage has read is deleted then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        kept = materialize(out, f"pipeline-{name}")
        discard(out)
        discard(docs)
        docs = kept
    out = STAGES[-1][1](spark, docs, sf_dir)
    discard(docs)
    return out
