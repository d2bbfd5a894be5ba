"""Question and answer records: from answers of a model to instruction, output, system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.pieces import few_bytes
from scriptorium.functions.strictjson import json_type, parsed

# The roles that records are given by default; {{QUESTION}} stands there literally.
BOOK_SYSTEM = """你将扮演一位既精通玄学（梅花易数）又精通科学的大师，使用梅花易数的知识来为用户解决问题。当我提供一个问题时，你需要根据你的知识进行解答。
                                 这是用户的问题：
                                    <question>
                                    {{QUESTION}}
                                    </question>
                                    在回答问题时，请遵循以下原则：
                                    1. 答案应结合梅花易数的原理和科学思维，尽量做到合理、客观、有依据。
                                    2. 如果问题与梅花易数无关，请尝试从科学的角度给出合理的解释或建议。
                                    3. 用简洁、清晰的语言表达你的观点，避免使用过于复杂或模糊的表述。
                                    请在<answer>标签内给出你的回答。"""
LEGACY_SYSTEM = "你是一个占卜和算命解释专家，你需要遵循文本标准来帮我解决相关问题。"


def parse_answers(df: DataFrame, raw: str = "raw", last_commas: bool = False) -> DataFrame:
    """The other columns, raw, status, items, bad_items. Read once a row; the rows are few and long, so the parse is kept as a column. last_commas: see strictjson.parse."""
    few_bytes(df.sparkSession)
    others = [c for c in df.columns if c != raw]
    return df.select(*others, raw, parsed(F.col(raw), last_commas).alias("__p")).select(*others, raw, "__p.status", "__p.items", "__p.bad_items")


def pairs(answers: DataFrame, question: str = "input", answer: str = "output") -> DataFrame:
    """A row for each object: the key columns, pair_no, has_both, and the two fields (null where missing or null)."""
    keys = [c for c in answers.columns if c not in ("raw", "status", "items", "bad_items")]
    rows = answers.select(*keys, F.explode("items").alias("i"))
    f = F.col("i.fields")
    both = F.map_contains_key(f, question) & F.map_contains_key(f, answer)
    return rows.select(*keys, F.col("i.no").alias("pair_no"), both.alias("has_both"), F.try_element_at(f, F.lit(question)).alias("question"), F.try_element_at(f, F.lit(answer)).alias("answer"))


def records(answers: DataFrame, system: str, question: str = "input", answer: str = "output") -> DataFrame:
    """The key columns, pair_no, instruction, output, system; objects without one of the two keys are left out (see quarantine)."""
    rows = pairs(answers, question, answer).where("has_both")
    keys = [c for c in rows.columns if c not in ("has_both", "question", "answer")]
    return rows.select(*keys, F.col("question").alias("instruction"), F.col("answer").alias("output"), F.lit(system).alias("system"))


def quarantine(answers: DataFrame, question: str = "input", answer: str = "output") -> DataFrame:
    """What gave no record: the key columns, reason, item_no (null: the whole answer), raw."""
    keys = [c for c in answers.columns if c not in ("raw", "status", "items", "bad_items")]
    whole = answers.where("status <> 'ok'").select(*keys, F.col("status").alias("reason"), F.lit(None).cast("int").alias("item_no"), "raw")
    odd = answers.select(*keys, F.explode("bad_items").alias("b")).select(*keys, F.lit("not_object").alias("reason"), F.col("b.no").alias("item_no"), F.col("b.raw").alias("raw"))
    lost = answers.select(*keys, F.explode("items").alias("i")).where(~(F.map_contains_key("i.fields", question) & F.map_contains_key("i.fields", answer)))
    lost = lost.select(*keys, F.lit("missing_key").alias("reason"), F.col("i.no").alias("item_no"), F.to_json("i.fields", {"ignoreNullFields": "false"}).alias("raw"))
    return whole.unionByName(odd).unionByName(lost)


def any_json(df: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Rows whose answer is JSON of any kind, with json_type; and those whose answer is not."""
    marked = df.withColumn("json_type", json_type(F.col(raw)))
    return marked.where("json_type is not null"), marked.where("json_type is null").drop("json_type")


def legacy_first(raw: Column) -> Column:
    """The first element of a legacy file, as JSON text: it's a list of objects, or a string that holds one."""
    return F.get(F.from_json(raw, "array<string>"), F.lit(0))


def convert_legacy(df: DataFrame, raw: str = "raw", system: str = LEGACY_SYSTEM) -> DataFrame:
    """Records of legacy files of {question, answer}; other elements than the first don't count."""
    first = df.withColumn(raw, legacy_first(F.col(raw)))
    return records(parse_answers(first, raw), system, "question", "answer")
