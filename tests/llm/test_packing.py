import itertools
import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from scriptorium.llm import packing, viterbi


def test_optimal_against_all_choices():
    rng = random.Random(3)
    for _ in range(40):
        n = rng.randint(1, 9)
        ends = sorted(rng.sample(range(1, 200), n))
        rows = [(e, rng.randint(1, 30)) for e in ends]
        for buckets in (1, 2, 4):
            def cost(chosen):
                return sum(c * min(x for x in chosen if x >= e) for e, c in rows)

            best = min(cost([*some, ends[-1]]) for k in range(buckets) for some in itertools.combinations(ends[:-1], k))
            got = packing.optimal_lengths(rows, buckets)
            assert cost(got) == best and len(got) <= buckets


def test_a_level_against_all_places():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 10, 257, 1000):
        ends = np.sort(rng.choice(np.arange(1, 5 * n + 1), size=n, replace=False)).astype(np.int64)
        count = np.concatenate(([0], np.cumsum(rng.integers(1, 4, size=n))))
        filled = np.where(np.arange(n + 1) == 0, 0, packing._NEVER)
        for _ in range(4):
            want, where = filled.copy(), np.zeros(n + 1, dtype=np.int64)
            want[0] = packing._NEVER
            for j in range(1, n + 1):
                costs = filled[:j] + (count[j] - count[:j]) * ends[j - 1]
                where[j] = costs.argmin()
                want[j] = costs.min()
            filled, back = packing._level(filled, count, ends)
            sure = want < packing._NEVER
            assert (filled[sure] == want[sure]).all() and (back[sure] == where[sure]).all()


def test_longer_than_the_budget(spark):
    df = spark.createDataFrame([(1, "x" * 9), (2, "x" * 99), (3, "x" * 10), (4, "x" * 200), (5, "x" * 99)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_tokens, r.bucket, r.bucket_tokens, r.batch, r.slot, r.padding) for r in packing.pack(df, buckets=1, budget=30).collect())
    assert got == [(1, 10, 0, 11, 0, 0, 1), (2, 100, 1, 100, 0, 0, 0), (3, 11, 0, 11, 0, 1, 0), (4, 201, 1, 201, 1, 0, 0), (5, 100, 1, 100, 2, 0, 0)]


def test_batches_of_a_real_tokenizer(spark, sf_dir):
    """Ids packed, padded, and taken out again."""
    ids = viterbi.encode(spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(spark.createDataFrame([(None, None)], "doc_id long, text string"), allowMissingColumns=True), public_tokenizers.path("piece_bpe_32k.model")).cache()
    packed = packing.pack(ids, budget=8192, length=F.coalesce(F.size("ids"), F.lit(0)) + 1)
    want = {r.doc_id: [*r.ids, 2] for r in ids.collect()}
    got = packing.batches(packed, ids, end_id=2).collect()
    seen = {}
    for r in got:
        assert r.bucket_tokens * len(r.doc_ids) <= 8192 or len(r.doc_ids) == 1
        for d, n, x in zip(r.doc_ids, r.lengths, r.input_ids):
            assert len(x) == r.bucket_tokens and not any(x[n:])
            seen[d] = x[:n]
    assert seen == want and sum(len(r.doc_ids) for r in got) == len(want)


def test_places(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.choice([3, 3, 3, 70, 500, rng.randrange(3000)]), 7) for i in range(500)] + [(None, "abc", 7), (900, None, 7), (901, "", 7), (7, "dup", 7), (7, "dup", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, batch int")
    got = packing.pack(df, buckets=5, budget=4000).collect()
    assert len(got) == len(rows)
    assert len({r.bucket for r in got}) <= 5 + 1
    seen = {}
    for r in got:
        assert r.padding == r.bucket_tokens - r.n_tokens >= 0
        seen.setdefault((r.bucket, r.batch), []).append(r)
    last = {b: max(k for x, k in seen if x == b) for b, _ in seen}
    for (b, k), members in seen.items():
        room = max(1, 4000 // members[0].bucket_tokens)
        assert sorted(m.slot for m in members) == list(range(len(members)))
        assert len(members) == room or k == last[b] and len(members) <= room
    for b in last:
        ids = [r.doc_id if r.doc_id is not None else -1 for r in sorted((r for r in got if r.bucket == b), key=lambda r: (r.batch, r.slot))]
        assert ids == sorted(ids)
    assert packing.pack(df.where("false")).collect() == []


def test_rows_of_one_id_go_to_many_tasks(spark):
    df = spark.createDataFrame([(None, "same")] * 500 + [(7, "same")] * 500, "doc_id long, text string").repartition(3)
    packed = packing.pack(df, budget=40)
    (dealt,) = packed._reads
    assert max(r["count"] for r in dealt.groupBy("part").count().collect()) < 500
    rows = sorted(packed.collect(), key=lambda r: (r.batch, r.slot))
    assert [r.doc_id for r in rows] == [None] * 500 + [7] * 500 and [(r.batch, r.slot) for r in rows] == [(k // 8, k % 8) for k in range(1000)]
