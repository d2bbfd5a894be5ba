"""Whitening of embeddings by the principal components of their covariance, worked out in two passes.

Each entry c of a vector becomes the whole number x = floor(256 * c). The fit list is each distinct x vector once, a written table. The first pass adds it up in whole numbers, exactly, which gives
the mean S / n; the second adds outer products of x - S/n, a batch of rows a matrix product. A task gives one sum, and sums meet in a tree (treeAggregate), so the driver gets one matrix of
dimension x dimension however many rows there are: 8 MB at 1,000 dimensions. LAPACK's symmetric eigh gives the components, which go to the tasks as one broadcast of that size. A third pass
over the fit list measures how near to the identity the covariance of what was whitened is.

Copies of a vector meet in a map-side aggregate, so a vector that most rows hold is one row a task. No pass sorts or gathers rows; the whitened rows come straight from the source.

Defined results: rows whose vector is null, or holds null, NaN or infinity, are left out. Vectors must have one dimension: that of most rows counts (the larger of two equally frequent), rows
of another are left out, as are those of none. A component whose eigenvalue isn't over dimension * 2.2e-16 times the greatest has no direction that could be divided by: it's left out, so n = 1 or equal
vectors give no rows. Entries beyond what a long holds (2**63 / 256) count as the nearest that it does. A deviation too large for 38 digits is null. Rows of equal or null ids are rows of their own;
ids are carried along as they are. Equal eigenvalues (ties) are numbered as eigh gives them, alike for all rows of a run. No rows: no rows. Columns other than the id and the vector are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.storage import discard, materialize

SCALE, COMPONENTS = 256, 4
#: Rows of a batch that are a matrix at once.
ROWS = 4096


def integers(vector: Column) -> Column:
    """array<long>: floor(256 * c) of each entry; null where the vector can't be used."""
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    odd = F.exists(vector, lambda c: F.coalesce(F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")), F.lit(True)))
    return F.when(F.size(vector) > 0, F.when(~odd, whole))


class Fit(NamedTuple):
    """n vectors with sums S by dimension, the components kept (columns) with their eigenvalues, and the covariance's trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def scaled(self) -> np.ndarray:
        """What a centred row is multiplied by."""
        return self.components / np.sqrt(self.values)


def matrices(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches and their vectors as a matrix of whole numbers, a row each."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def total(fit_list: DataFrame, of, plus):
    """What of(matrix) gives for all matrices of column x, put together by plus: in each task first, then in a tree. None where there are no rows."""
    import pickle

    def both(a, b):
        return b if a is None else a if b is None else plus(a, b)

    def run(batches):
        out = None
        for _, x in matrices(batches):
            out = both(out, of(x))
        yield pa.RecordBatch.from_pydict({"p": [pickle.dumps(out)]})

    return fit_list.select("x").mapInArrow(run, "p binary").rdd.map(lambda r: pickle.loads(r[0])).treeAggregate(None, both, both)


def sums(fit_list: DataFrame) -> tuple[int, list[int]]:
    """n and S: in halves, so that no sum of a matrix overflows, and then as Python's whole numbers."""

    def of(x):
        high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
        return len(x), [(int(h) << 32) + int(k) for h, k in zip(high, low)]

    return total(fit_list, of, lambda a, b: (a[0] + b[0], [p + q for p, q in zip(a[1], b[1])])) or (0, [])


def comoments(fit_list: DataFrame, centred) -> np.ndarray:
    """The sum of outer products of the rows of centred(matrix)."""

    def of(x):
        y = centred(x)
        return y.T @ y

    return total(fit_list, of, lambda a, b: a + b)


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> Fit:
    """From distinct vectors in column x."""
    n, s = sums(fit_list)
    if not n:
        return Fit(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    mean = np.array([v / n for v in s])
    covariance = comoments(fit_list, lambda x: x - mean) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(components, int((values > len(values) * np.finfo(float).eps * max(values[0], 0)).sum()))
    return Fit(n, s, vectors[:, :kept], values[:kept], float(np.trace(covariance)))


def identity_error(fit_list: DataFrame, model: Fit) -> float:
    """The largest entry of |covariance of the whitened fit list - identity|, centred on its own mean."""
    if not len(model.values):
        return 0.0
    mean, by = model.mean(), model.scaled()
    own = total(fit_list, lambda x: ((x - mean) @ by).sum(axis=0), lambda a, b: a + b) / model.n
    found = comoments(fit_list, lambda x: (x - mean) @ by - own) / model.n
    return float(np.abs(found - np.eye(len(by.T))).max())


def deviations(x: np.ndarray, n: int, s: list[int]) -> list[Decimal | None]:
    """The sum over dimensions of (n * x - S)**2 for each row, exact: in 64 bits where they hold it, else in Python's whole numbers."""
    far = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, s))
    if len(s) * far * far < 1 << 63:
        out = ((n * x - np.array(s, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    else:
        out = ((n * x.astype(object) - np.array(s, dtype=object)) ** 2).sum(axis=1).tolist()
    return [Decimal(v) if v < 10**38 else None for v in out]


def whiten(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The id, component (from 1), n, deviation decimal(38,0), whitened, explained, identity_error: a row for each remaining row and component."""
    spark, kind = rows.sparkSession, rows.schema[vec_id].dataType
    own = rows.select(F.col(vec_id).alias("id"), integers(F.col(vector)).alias("x")).where(F.col("x").isNotNull())
    # a row for each dimension that occurs
    sizes = own.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    own = own.where(F.size("x") == (sizes["d"] if sizes else 0))
    fit_list = materialize(own.select("x").distinct(), "whitening-fit")
    try:
        model = fit(fit_list, components)
        error = identity_error(fit_list, model)
    finally:
        discard(fit_list)
    k = len(model.values)
    held = spark.sparkContext.broadcast((model.n, model.sums, model.mean() if k else None, model.scaled() if k else None, (model.values / model.trace).tolist() if k else [], error))
    schema = f"{vec_id} {kind.simpleString()}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, mean, by, explained, error = held.value
        many = len(explained)
        for part, x in matrices(batches, 1):
            if not many:
                return
            every = np.repeat(np.arange(len(x)), many)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(every)), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))), pa.array(np.full(len(every), n)),
                    pa.array(deviations(x, n, s), pa.decimal128(38, 0)).take(pa.array(every)), pa.array(((x - mean) @ by).ravel()), pa.array(np.tile(np.array(explained), len(x))), pa.array(np.full(len(every), error)),
                ],
                [vec_id, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return own.mapInArrow(run, schema)
