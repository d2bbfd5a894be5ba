"""Strict reading of JSON that a model has written.

A scalar pandas UDF over the standard library: quotes, trailing words, duplicate keys and numbers are read as Python's own
reader does it, which Spark's lenient reader doesn't.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions.pieces import in_pieces

#: status: ok, empty, bad_json, not_list. items: the objects with their place in the list (from 1), values as text.
#: bad_items: what isn't an object, with its place.
PARSED = "struct<status:string, items:array<struct<no:int,fields:map<string,string>>>, bad_items:array<struct<no:int,raw:string>>>"


def as_text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


#: Strings, commas that follow no value, and commas right before a closing bracket.
COMMAS = re.compile(r'"(?:[^"\\]++|\\.)*+"?|[\[{,:][ \t\n\r]*,|,(?=[ \t\n\r]*[\]}])', re.DOTALL)


def without_last_commas(text: str) -> str:
    """A text of JSON without the commas between a last element and its closing bracket."""
    return COMMAS.sub(lambda m: "" if m[0] == "," else m[0], text)


def parse(text: str | None, last_commas: bool = False) -> dict:
    """A list of objects from one answer; outer white space doesn't count. last_commas: a comma may follow the last element of a list or object, as in SQL engines' readers."""
    if not text:
        return {"status": "empty", "items": [], "bad_items": []}
    try:
        text = text.strip()
        try:
            value = json.loads(text)
        except ValueError:
            if not last_commas or (less := without_last_commas(text)) == text:
                raise
            value = json.loads(less)
    except (ValueError, RecursionError):
        return {"status": "bad_json", "items": [], "bad_items": []}
    if not isinstance(value, list):
        return {"status": "not_list", "items": [], "bad_items": []}
    items = [{"no": k, "fields": {str(a): as_text(b) for a, b in x.items()}} for k, x in enumerate(value, 1) if isinstance(x, dict)]
    bad = [{"no": k, "raw": json.dumps(x, ensure_ascii=False)} for k, x in enumerate(value, 1) if not isinstance(x, dict)]
    return {"status": "ok", "items": items, "bad_items": bad}


def parsed(text: Column, last_commas: bool = False) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in in_pieces(batches):
            yield pd.DataFrame([parse(t, last_commas) for t in texts], columns=["status", "items", "bad_items"])

    return F.pandas_udf(run, PARSED)(text)


def list_elements(text: str | None) -> list[str] | None:
    """The elements of a JSON list, each whole, as JSON of its own; None for anything else."""
    try:
        value = json.loads((text or "").strip())
    except (ValueError, RecursionError):
        return None
    return [json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in value] if isinstance(value, list) else None


def elements(text: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in in_pieces(batches):
            yield texts.map(list_elements)

    return F.pandas_udf(run, "array<string>")(text)


def json_kind(text: str | None) -> str | None:
    """object, array, string, number, boolean or null; None for what isn't JSON."""
    try:
        value = json.loads(text)
    except (TypeError, ValueError, RecursionError):
        return None
    kinds = ((dict, "object"), (list, "array"), (str, "string"), (bool, "boolean"), ((int, float), "number"))
    return next((name for kind, name in kinds if isinstance(value, kind)), "null")


def json_type(text: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(json_kind)

    return F.pandas_udf(run, "string")(text)
