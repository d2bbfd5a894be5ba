"""Texts in small pieces on their way through Python."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of texts that go to Python at once, and characters of which results are held at once: a longer text goes alone.
TEXT_BYTES, HELD = 4 << 20, 1 << 20


def few_bytes(spark: SparkSession) -> None:
    """Texts go to Python by bytes and not only by rows; a smaller limit that is set stays."""
    if not 0 < int(spark.conf.get(ARROW_BYTES).rstrip("bB")) <= TEXT_BYTES:
        spark.conf.set(ARROW_BYTES, f"{TEXT_BYTES}b")


def in_pieces(batches: Iterator[pd.Series], size: int = HELD) -> Iterator[pd.Series]:
    """The rows of all batches in order, in pieces of so many characters or one row: what a function makes of a piece is gone before the next one."""
    for batch in batches:
        held, first = 0, 0
        for k, text in enumerate(batch):
            n = len(text) if text is not None else 0
            if held + n > size and k > first:
                yield batch.iloc[first:k]
                held, first = 0, k
            held += n
        if len(batch):
            yield batch.iloc[first:]
