import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from scriptorium.llm import mixing
from scriptorium.llm.storage import discard, tables

SCHEMA = "doc_id long, text string, source string, size string, rank int, key int, quota int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


def words(n):
    return " ".join(f"w{k}" for k in range(n))


def want_targets(sizes):
    """By sharing again until none is above, in fractions. sizes: in order of the sources."""
    weights = [(3, 1, 2)[k % 3] for k in range(len(sizes))]
    target, free, left = [Fraction(0)] * len(sizes), set(range(len(sizes))), Fraction(3 * sum(sizes), 2)
    while free:
        whole = sum(weights[k] for k in free)
        over = [k for k in free if left * weights[k] / whole > 2 * sizes[k]]
        if not over:
            for k in free:
                target[k] = left * weights[k] / whole
            break
        for k in over:
            target[k] = Fraction(2 * sizes[k])
            left -= target[k]
            free.remove(k)
    return target


@pytest.mark.parametrize("sizes", [[100], [1, 1000], [5000, 10, 300, 0, 7], [400] * 7, [0, 0], [900, 800, 3, 2000, 10, 60, 5]])
def test_targets(spark, sizes):
    rows = [(k, words(n), f"s{k:02d}") for k, n in enumerate(sizes)]
    got = {r.doc_id: r for r in mixing.mix(frame(spark, rows), block=1).collect()}
    for k, t in enumerate(want_targets(sizes)):
        assert got[k].target == pytest.approx(float(t)) and got[k].source_size == got[k].size == sizes[k]
        assert got[k].taken <= 2 * sizes[k] and abs(got[k].taken - t) <= 1


def test_highest_quotients(spark):
    rng = random.Random(4)
    rows = [(g, k, rng.choice([0, 1, 3, 3, 5, rng.randrange(1, 400)])) for g in range(6) for k in range(rng.choice([1, 2, 30]))]
    seats = {g: rng.choice([0, 1, 7, 100, 1000]) for g in range(6)}
    df = spark.createDataFrame([(g, k, v, seats[g]) for g, k, v in rows], "g int, k int, v int, seats int")
    with tables() as keep:
        got = {(r.g, r.k): r.quota for r in mixing.apportioned(df, "g", "k", "v", "seats", keep, "test").collect()}
    for g, n in seats.items():
        every = sorted(((-Fraction(v, 2 * j + 1), k, j) for h, k, v in rows if h == g and v for j in range(n)))[:n]
        want = Counter(k for _, k, _ in every)
        assert {k: q for (h, k), q in got.items() if h == g} == {k: want[k] for h, k, _ in rows if h == g}


def test_odd_rows(spark):
    hot = [(1000 + k, words(30 + k % 50), "hot") for k in range(400)]
    rows = hot + [(None, None, None), (None, "a b", None), (1, "", ""), (2, words(20_000), "long"), (3, "dup dup", "hot"), (3, "dup dup", "hot"), (3, "other", "hot"), (4, "é x\n\ty", "z"), (5, " \n ", "z")]
    df = frame(spark, rows)
    mixed = mixing.mix(df)
    got = mixed.collect()
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((i, len((t or "").encode().split()), s) for i, t, s in rows)
    assert sorted((r.doc_id or 0, r.size, r.taken) for r in got) == sorted((r.doc_id or 0, r.size, r.taken) for r in mixing.mix(df.repartition(7)).collect())
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert all(0 <= r.taken <= 2 * r.size for r in own) and abs(sum(r.taken for r in own) - own[0].target) <= max(16, 0.01 * own[0].target)
    assert sum(r.taken for r in got) == pytest.approx(1.5 * sum(r.size for r in got), rel=0.01)
    texts = {i: t for i, t, _ in rows if i is not None and i != 3}
    taken = Counter()
    for p in mixing.pieces(df, mixed).collect():
        if p.doc_id in texts:
            assert p.piece in texts[p.doc_id] and p.piece.split()[0] == texts[p.doc_id].split()[p.first]
        taken[p.doc_id] += len(p.piece.encode().split()) * p.times
    for i in texts:
        assert taken[i] == sum(r.taken for r in got if r.doc_id == i)
    discard(mixed)
    assert mixing.mix(df.where("false")).collect() == []
    assert [(r.size, r.target, r.taken) for r in mixing.mix(df.where("doc_id = 1")).collect()] == [(0, 0.0, 0)]


def test_no_python_and_no_text_is_moved(spark, sf_dir):
    got = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in got and "Arrow" not in got and "text" not in got


def test_a_third_in_one_source_is_dealt_by_shards(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 400).cast("string"))).alias("source"))
    mixed = mixing.mix(docs)
    (rows, _) = mixed._reads
    held = {(r["rank"], r["shard"]): r["count"] for r in rows.groupBy("rank", "shard").count().collect()}
    assert max(held.values()) < 1.3 * mixing.SHARD_DOCS and mixed.count() == 6000
