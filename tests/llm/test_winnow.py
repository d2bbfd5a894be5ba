import collections
import hashlib
import random
import re
import time

import pytest
import xxhash
from pyspark.sql import functions as F

from scriptorium.llm import winnow


def brute(text, k=5, w=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def h(part):
        seed = 42
        for x in part:
            seed = xxhash.xxh64_intdigest(x.encode(), seed)
        return seed >> 32

    def turned(x, bits):
        return (x << bits | x >> 64 - bits) & (1 << 64) - 1

    if len(words) < k:
        return [(h(words), 0)] if words else []
    grams = []
    for i in range(len(words) - k + 1):
        x = 0
        for j in range(k):
            x ^= turned(xxhash.xxh64_intdigest(words[i + j].encode(), 42), winnow.TURN * (k - 1 - j) % 64)
        grams.append(x >> 32)
    out = []
    for i in range(max(1, len(grams) - w + 1)):
        part = grams[i : i + w]
        pos = max(j for j in range(len(part)) if part[j] == min(part)) + i
        if not out or out[-1] != (grams[pos], pos):
            if (grams[pos], pos) not in out[-w:]:
                out.append((grams[pos], pos))
    return out


def jaccard(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return 1.0 if not a | b else len(a & b) / len(a | b)


def data():
    rng = random.Random(8)
    word = lambda: rng.choice(["a", "bé", "ccc", "漢字", "x😀"]) + str(rng.randrange(200))
    texts = ["", None, "one", "one two three four", "one two three four five", "x " * 60, " lead\ttab\x0bvt \n"] + [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(90)]
    texts += texts[10:14]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("parts", ["1", "4"])
def test_against_brute_force(spark, parts):
    rows = data()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, range int").repartition(3)
        got = {r.doc_id: r for r in winnow.compare_edits(df).collect()}
        prints = {r.doc_id: [(p.hash, p.pos) for p in r.prints] for r in winnow.fingerprints(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(got) == len(rows)
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        t, nxt = t or "", nxt or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        own = brute(t)
        assert prints[d] == own
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(own, brute(edited))) and r.near_next == pytest.approx(jaccard(own, brute(nxt)))
        assert r.n_prints == len(own) and len(r.fingerprint) == len(r.edited_fingerprint) == 16
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t or "", set()).add(got[d].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_other_sizes(spark):
    df = spark.createDataFrame(data(), "doc_id long, text string")
    for k, w in ((1, 1), (2, 3), (7, 5), (8, 4), (13, 9)):
        got = {r.doc_id: [(p.hash, p.pos) for p in r.prints] for r in df.select("doc_id", winnow.positions(winnow.selected(F.col("text"), k, w)).alias("prints")).collect()}
        assert got == {d: brute(t, k, w) for d, t in data()}


def test_one_id_and_null_ids_go_to_many_ranges(spark):
    rows = [(None, f"n{k} word") for k in range(300)] + [(7, f"t{k} word") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = winnow.with_next(df, 8).where("not ghost")
    assert max(r["count"] for r in found.groupBy("range").count().collect()) < 250
    got = winnow.compare_edits(df).collect()
    assert len(got) == 600 and {r.doc_id for r in got} == {None, 7}


def test_plans_do_not_grow_with_ranges(spark):
    rows = [(k if k % 7 else None, f"text {k} with some words") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keys = df.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("key"))
    plans = []
    for parts in (10, 3000):
        ends = winnow.range_ends(keys, parts)
        began = time.monotonic()
        found = winnow.with_range(keys, ends, parts)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
        got = sorted(((r.key.doc_id is not None, r.key.doc_id, r.key.h), r.range) for r in found.collect())
        assert time.monotonic() - began < 20
        # in order, and about equally many rows in each
        assert [r for _, r in got] == sorted(r for _, r in got) and {r for _, r in got} == set(range(ends.count()))
        assert ends.count() > parts * 0.6 and max(collections.Counter(r for _, r in got).values()) < 8 * 3000 / parts
    assert len(plans[1]) < len(plans[0]) + 200


def test_match_guarantee():
    rng = random.Random(1)
    for _ in range(50):
        shared = [str(rng.randrange(10**6)) for _ in range(winnow.K + winnow.WINDOW - 1)]
        a = " ".join([str(rng.random()) for _ in range(rng.randrange(30))] + shared + [str(rng.random()) for _ in range(rng.randrange(30))])
        b = " ".join([str(rng.random()) for _ in range(rng.randrange(30))] + shared + [str(rng.random()) for _ in range(rng.randrange(30))])
        assert {x for x, _ in brute(a)} & {x for x, _ in brute(b)}


def test_texts_without_blanks(spark):
    rng = random.Random(3)
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(n))
    dense = lambda n: "".join(rng.choice("abcdefgh0123456789+/😀") for _ in range(n))
    shared, code = f"{han(4)}，{han(5)}", dense(65)
    rows = [(1, han(400)), (2, dense(400)), (3, han(30) + shared + han(20)), (4, f"{han(5)} {han(7)}{shared} x"), (5, dense(90) + code), (6, f"a {code}{dense(8)} b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {r.doc_id: [(p.hash, p.pos) for p in r.prints] for r in winnow.fingerprints(df).collect()}
    assert prints[1] == brute(" ".join(rows[0][1])) and prints[2] == brute(" ".join(rows[1][1]))
    assert {x for x, _ in prints[3]} & {x for x, _ in prints[4]} and {x for x, _ in prints[5]} & {x for x, _ in prints[6]}
    got = {r.doc_id: r for r in winnow.compare_edits(df).collect()}
    assert got[1].near_edited > 0.5 > got[1].near_next and got[2].near_edited > 0.5 > got[2].near_next


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "n"), (2, "b c"), (2, "a"), (2, "a"), (5, "z")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_chars) for r in winnow.compare_edits(df).collect())
    assert got == [(0, 1), (2, 1), (2, 1), (2, 3), (5, 1)]
    one = spark.createDataFrame([(9, "w x y z")], "doc_id long, text string")
    assert winnow.compare_edits(one).first().near_next == 1.0
    assert winnow.compare_edits(one.where("false")).collect() == []
