"""The engine from a shell: python -m scriptorium COMMAND ... Each command prints how many rows it wrote and set aside."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from scriptorium.functions.text import clean
from scriptorium.operators import assemble, ledger, models, prompts, qa
from scriptorium.plans import pipelines
from scriptorium.sources import config, files, sinks
from scriptorium.sources.shared import remove, scratch


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="scriptorium", description=__doc__)
    parser.add_argument("--config", help="a YAML file of settings")
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, said: str, *more: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=said)
        for x in ("input", "output", *more):
            p.add_argument(x)
        return p

    add("clean", "texts of any encoding, cleaned")
    add("rows", "a Parquet table of pages to training rows")
    add("book", "texts to question and answer records").add_argument("--answers", help="a ledger of attempts: what it answers isn't asked again")
    chunks = add("chunks", "texts in fixed chunks to JSON answers")
    chunks.add_argument("start_index", nargs="?", type=int, default=0)
    chunks.add_argument("--answers")
    add("merge", "success*.json files to records")
    add("convert", "qa_pairs_*.json files to records")
    add("reshape", "any *.json files of input and output to records").add_argument("--system", default="")
    return parser


def _write(good: DataFrame, bad: DataFrame, path: str) -> dict[str, int]:
    counts = [Observation(), Observation()]
    sinks.write_with_quarantine(good.observe(counts[0], F.count(F.lit(1)).alias("n")), bad.observe(counts[1], F.count(F.lit(1)).alias("n")), path)
    return {"written": counts[0].get["n"], "set aside": counts[1].get["n"]}


def _records(found: DataFrame, system: str, question: str = "input", answer: str = "output") -> tuple[DataFrame, DataFrame]:
    return qa.records(found, system, question, answer), qa.quarantine(found, question, answer)


def _asked(df: DataFrame, prompt: str, backend, folder: str, pairs: config.PairSettings) -> DataFrame:
    """df with raw: every prompt asked once, its attempts written down before anything reads an answer."""
    return ledger.answered(df, backend, folder, prompt, "raw", ledger.Policy(pairs.max_retries, pairs.retry_delay, pairs.pause, pairs.lanes))


def run(spark: SparkSession, args: argparse.Namespace, backend: models.ModelBackend | None = None) -> dict[str, int]:
    """Does what a command asks for; backend: instead of the service that the settings name."""
    settings = config.load(args.config) if args.config else config.Settings()
    pairs, fix = settings.qa_generation, settings.text_correction
    if args.command == "clean":
        texts = files.read_any_texts(spark, args.input)
        return _write(texts.where("text is not null").withColumn("text", clean(F.col("text"))), texts.where("text is null").select("doc_id"), args.output)
    if args.command == "rows":
        ask = models.calls(backend or prompts.CORRECT.backend(fix.endpoint, fix.model_name), fix.max_retries, fix.retry_delay, fix.pause) if fix.enable else None
        rows = pipelines.pages_to_training_rows(spark.read.parquet(args.input), correct=ask, limit=fix.batch_size, prompt=prompts.CORRECT.prompt)
        return _write(rows, rows.where("false"), args.output)
    if args.command in ("book", "chunks") and not args.answers:
        args.answers = scratch(spark, "answers")
        try:
            return run(spark, args, backend)
        finally:
            remove(spark, args.answers)
    answers = getattr(args, "answers", None)
    if args.command == "book":
        segments = pipelines.book_segments(files.read_texts(spark, args.input), pairs.max_segment_length, pairs.overlap_length)
        asked = _asked(segments.withColumn("segment", prompts.PAIRS.prompt(F.col("segment"))), "segment", backend or prompts.PAIRS.backend(pairs.endpoint, pairs.model_name), answers, pairs)
        return _write(*_records(qa.parse_answers(asked.drop("segment")), qa.BOOK_SYSTEM), args.output)
    if args.command == "chunks":
        chunks = pipelines.texts_to_chunks(files.read_texts(spark, args.input), start_index=args.start_index)
        asked = _asked(chunks.withColumn("chunk", prompts.CHUNK.prompt(F.col("chunk"))), "chunk", backend or prompts.CHUNK.backend(pairs.endpoint, pairs.model_name), answers, pairs)
        return _write(*qa.any_json(asked.drop("chunk")), args.output)
    if args.command == "merge":
        good, unnumbered = files.read_numbered(spark, args.input)
        rows, broken = assemble.merged(good)
        return _write(rows, broken.select("file_no", F.lit("not_list").alias("reason"), "raw").unionByName(unnumbered.select(F.lit(None).cast("int").alias("file_no"), F.lit("no_number").alias("reason"), "raw")), args.output)
    if args.command == "convert":
        good, unnumbered = files.read_numbered(spark, args.input, files.PAIRS_GLOB, files.PAIRS_NUMBER)
        return _write(qa.convert_legacy(good), unnumbered, args.output)
    found = qa.parse_answers(files.read_file_set(spark, args.input))
    return _write(*_records(found, args.system), args.output)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("scriptorium").getOrCreate()
    for what, n in run(spark, args).items():
        print(f"{n} {what}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
