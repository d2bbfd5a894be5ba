import math
from fractions import Fraction

import numpy as np
import pytest

from scriptorium.llm import queries, whitening


def brute(vectors):
    """Of usable vectors: x, n, S, exact deviations, eigenvalues, components and shares by falling eigenvalue, in plain loops and whole numbers as far as they go."""
    xs = [tuple(math.floor(Fraction(c) * 256) for c in v) for v in vectors]
    fit = sorted(set(xs))
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    cov = [[float(Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in fit), n**3)) for j in range(d)] for i in range(d)]
    values, vectors = np.linalg.eigh(np.array(cov))
    return xs, n, s, [sum((n * a - b) ** 2 for a, b in zip(x, s)) for x in xs], values[::-1], vectors[:, ::-1], np.trace(cov)


def held(got, rows, components):
    """got: result rows; rows: (id, vector) that remain, ids unique."""
    xs, n, s, dev, values, vectors, trace = brute([v for _, v in rows])
    k = min(components, len(values))
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(by) == k * len(rows)
    signs = {}
    for (i, _), x, y in zip(rows, xs, dev):
        for c in range(k):
            r = by[i, c + 1]
            want = float((np.array([float(Fraction(a) - Fraction(b, n)) for a, b in zip(x, s)]) @ vectors[:, c]) / math.sqrt(values[c]))
            assert (r.n, int(r.deviation)) == (n, y) and r.explained == pytest.approx(values[c] / trace, rel=1e-9) and r.identity_error < 1e-9
            if abs(want) > 1e-6:
                signs.setdefault(c, math.copysign(1, r.whitened * want))
                assert r.whitened * signs[c] == pytest.approx(want, rel=1e-6, abs=1e-8)


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = queries.op13_whitening(spark, sf_dir)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    held(got.collect(), rows, 4)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(k, [float(x) for x in rng.normal(size=3)]) for k in range(40)]
    copies = [(100 + k, good[0][1]) for k in range(300)]
    odd = [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan"), 0.0, 0.0]), (203, [float("inf"), 0.0, 0.0]), (204, [-float("inf"), 0.0, 0.0]), (205, []), (206, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + copies[:100] + odd], "vec_id long, embedding array<float>, component int, x string")
    left = [(r.vec_id, r.embedding) for r in df.collect() if r.embedding and r.vec_id not in range(200, 210)]
    held(whitening.whiten(df).collect(), left, 4)
    assert whitening.whiten(df.where("false")).collect() == [] and whitening.whiten(df.where("vec_id >= 200")).count() == 0
    one = spark.createDataFrame([(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, 0.25])], "vec_id long, embedding array<double>")
    assert whitening.whiten(one).collect() == []
    twice = spark.createDataFrame([(1, [0.5]), (1, [0.5]), (None, [0.75]), (None, [-0.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(twice).collect()
    assert sorted((r.vec_id is None, r.component, r.n, int(r.deviation)) for r in got) == [(False, 1, 3, 64**2), (False, 1, 3, 64**2), (True, 1, 3, (3 * 192 - 320) ** 2), (True, 1, 3, 320**2)]
    flat = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0]) for k in range(5)], "vec_id long, embedding array<float>")
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}


def test_large_numbers_stay_exact(spark):
    vectors = [[3.0e15, -7.0e14], [2.9e15, 1.0], [-3.0e15, 5.5]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    held(whitening.whiten(df).collect(), list(enumerate(vectors)), 4)
    huge = spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id long, embedding array<double>")
    assert len(whitening.whiten(huge).collect()) == 2
