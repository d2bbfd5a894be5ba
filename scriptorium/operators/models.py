"""Calls of outside models behind one small interface.

A backend answers a list of prompts; null is a failure. Calls run in an iterator pandas UDF: one client a partition, retries inside, a pause between calls.
The UDF is marked non-deterministic. Paid calls go through operators.ledger, which writes answers down before anything reads them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.operators.split import packed


class ModelBackend(Protocol):
    """Something that answers prompts; made afresh in each task by its own pickled state."""

    def complete(self, prompts: list[str | None]) -> list[str | None]: ...


@dataclass(frozen=True)
class RuleBackend:
    """A pure function of the prompt; an exception is a failure."""

    rule: Callable[[str], str | None]

    def one(self, prompt: str) -> str | None:
        return self.rule(prompt)

    def complete(self, prompts: list[str | None]) -> list[str | None]:
        out: list[str | None] = []
        for p in prompts:
            try:
                out.append(None if p is None else self.rule(p))
            except Exception:  # noqa: BLE001  the rule stands for a service, whose failures are data here
                out.append(None)
        return out


@dataclass(frozen=True)
class HttpBackend:
    """A chat completion service. The key is read from an environment variable in the task and is never in a table."""

    url: str
    model: str
    system: str = ""
    key_variable: str = "MODEL_API_KEY"
    temperature: float | None = 0.7
    top_p: float | None = 0.9
    max_tokens: int | None = 4096
    timeout: float = 120.0
    strip: bool = False
    stream: bool = False

    def body(self, prompt: str) -> dict:
        """What is sent; settings that aren't given are left to the service."""
        messages = [{"role": "system", "content": self.system}] * bool(self.system) + [{"role": "user", "content": prompt}]
        given = {"temperature": self.temperature, "top_p": self.top_p, "max_tokens": self.max_tokens, "stream": self.stream or None}
        return {"model": self.model, "messages": messages, **{k: v for k, v in given.items() if v is not None}}

    def one(self, prompt: str) -> str | None:
        """One answer; a failure is raised."""
        import os

        import requests

        headers = {"Authorization": f"Bearer {os.environ.get(self.key_variable, '')}"}
        r = requests.post(self.url, json=self.body(prompt), timeout=self.timeout, stream=self.stream, headers=headers)
        r.raise_for_status()
        told = streamed(r.iter_lines()) if self.stream else r.json()["choices"][0]["message"]["content"]
        return (told.strip() if self.strip and told else told) or None

    def complete(self, prompts: list[str | None]) -> list[str | None]:
        import requests

        out: list[str | None] = []
        for p in prompts:
            try:
                out.append(self.one(p))
            except (requests.RequestException, KeyError, IndexError, ValueError):
                out.append(None)
        return out


def streamed(lines: Iterable[bytes]) -> str:
    """The text of server-sent events, a JSON object each, until [DONE]: pieces without a choice or without content add nothing."""
    import json

    parts = []
    for line in lines:
        name, _, data = line.partition(b":")
        if name != b"data" or not data.strip():
            continue
        if data.strip() == b"[DONE]":
            break
        for choice in json.loads(data).get("choices") or []:
            parts.append((choice.get("delta") or {}).get("content") or "")
            break
    return "".join(parts)


def _asked(backend: ModelBackend, prompt: str | None, attempts: int, wait: float, pause: float) -> str | None:
    if prompt is None:
        return None
    answer = None
    for k in range(attempts):
        if k and wait:
            time.sleep(wait)
        answer = backend.complete([prompt])[0]
        if answer is not None:
            break
    if pause:
        time.sleep(pause)
    return answer


def calls(backend: ModelBackend, attempts: int = 3, wait: float = 0.0, pause: float = 0.0):
    """A column function: the backend's answer to each prompt, asked up to so many times; null where all failed. Its attribute each does the same for
    arrays of prompts, so that the parts of a text needn't be rows."""

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_asked(backend, p, attempts, wait, pause) for p in batch], dtype=object)

    @F.pandas_udf("array<string>")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if ps is None else [_asked(backend, p, attempts, wait, pause) for p in ps] for ps in batch], dtype=object)

    out = ask.asNondeterministic()
    out.each = each.asNondeterministic()
    return out


def prompt_key(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def replay(df: DataFrame, recorded: DataFrame, prompt: str = "prompt", out: str = "raw") -> DataFrame:
    """df with the recorded answers (prompt_hash, response) of its prompts; null where none is recorded. Of several answers to one prompt the least counts, so
    there are as many rows as before. A column of that name in df gives way."""
    known = recorded.groupBy(F.col("prompt_hash").alias("__h")).agg(F.min("response").alias(out))
    df = df.drop(out) if out != prompt else df
    return df.join(known, prompt_key(F.col(prompt)) == F.col("__h"), "left").drop("__h")


def answer(df: DataFrame, backend: ModelBackend, table: str, prompt: str = "prompt", out: str = "raw", parallel: int | None = None, **policy) -> DataFrame:
    """df with the backend's answers, by way of a ledger at that address; see operators.ledger. policy: its settings."""
    from scriptorium.operators import ledger

    return ledger.answered(df, backend, table, prompt, out, ledger.Policy(**policy, **({"lanes": parallel} if parallel else {})))


def corrected(df: DataFrame, ask, limit: int = 1000, text: str = "text", failed: str | None = None, prompt: Callable[[Column], Column] = lambda s: s, blank: bool = False) -> DataFrame:
    """The rows of df with text corrected, all other columns as they are, and the number of failed segments in a column of that name if one is given. Null texts stay as
    they are, and so do blank ones unless blank has them asked for, too; others are packed into segments, corrected, and joined again; a segment whose call failed keeps
    its text. ask is what calls() gives, prompt what is said around a segment. Each row is worked out by itself, so rows of one id stay rows of their own and nothing is
    shuffled."""
    from scriptorium.functions.text import has_ink

    segments = packed(F.col(text), limit)
    parts = df.withColumn("__s", segments if blank else F.when(has_ink(F.col(text)), segments))
    asked = parts.withColumn("__a", ask.each(F.transform("__s", prompt)))
    whole = F.array_join(F.zip_with("__s", "__a", lambda s, a: F.coalesce(a, s)), "\n")
    lost = F.coalesce(F.size(F.filter("__a", lambda a: a.isNull())), F.lit(0)).cast("long")
    out = asked.withColumn(text, F.when(F.col("__s").isNotNull(), whole).otherwise(F.col(text)))
    return (out.withColumn(failed, F.when(F.col("__s").isNotNull(), lost).otherwise(0)) if failed else out).drop("__s", "__a")


def correct(df: DataFrame, ask, limit: int = 1000, text: str = "text", key: str = "doc_id", blank: bool = False) -> DataFrame:
    """key, text (corrected), n_failed of each row; see corrected()."""
    return corrected(df.select(key, text), ask, limit, text, "n_failed", blank=blank)
