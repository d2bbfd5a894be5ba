"""The registered queries over a whole small data folder, against SQL or brute force."""

import os
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from scriptorium.llm import crf, packing, ppm, queries

sys.path.insert(0, os.path.dirname(__file__))
import test_crf  # noqa: E402
import test_linededup  # noqa: E402
import test_ppm  # noqa: E402
import test_simhash as simhash_rows  # noqa: E402
import test_winnow  # noqa: E402


def docs(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, sf_dir, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, sf_dir).collect()}


@pytest.mark.parametrize("name", queries.ORACLES)
def test_same_rows_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rel = con.sql(queries.ORACLES[name])
    assert sorted(rel.columns) == columns
    want = sorted((tuple(r[rel.columns.index(c)] for c in columns) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want and want


def test_simhash(spark, sf_dir):
    data = docs(sf_dir)
    fps, comp = simhash_rows.brute([t for _, t, _ in data])
    got = rows(spark, sf_dir, "op2_simhash")
    assert len(got) == len(data)
    for k, (d, _, _) in enumerate(data):
        assert (got[d].fingerprint, got[d].component_id) == (f"{fps[k]:016x}", data[comp[k]][0])


def test_sentencepiece(spark, sf_dir):
    import hashlib

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows(spark, sf_dir, "op3_sentencepiece")
    assert len(got) == len(docs(sf_dir))
    for d, t, _ in docs(sf_dir):
        ids = np.array(library.encode(t), dtype="<i4")
        assert (got[d].n_ids, got[d].ids_crc32, got[d].decoded_sha256) == (len(ids), zlib.crc32(ids.tobytes()), hashlib.sha256(t.encode()).hexdigest())


def test_language(spark, sf_dir):
    """Languages and scores of all documents by plain counts, walked symbol by symbol."""
    got = rows(spark, sf_dir, "op4_language_id")
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted, symbols = test_ppm.brute_trees(ppm.sample(frame.where(ppm.fold_of("doc_id") != 0)), 4000)
    held = right = 0
    for d, t, lang in docs(sf_dir):
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= got[d].score <= 1
        if len(t) < 4000:
            bits = {k: test_ppm.brute_bits(counted[k], symbols, t) for k in counted}
            best = min(bits, key=lambda k: (bits[k], k))
            assert got[d].lang_pred == best and got[d].score == pytest.approx(1 / sum(2 ** max(-1000, bits[best] - x) for x in bits.values()), rel=1e-3)
        if got[d].held_out:
            held += 1
            right += got[d].lang_pred == lang
    assert held and right / held > 0.95


def test_tokens(spark, sf_dir):
    tok, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = rows(spark, sf_dir, "op7_wavelet")
    for d, t, _ in docs(sf_dir):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_winnowing(spark, sf_dir):
    data = docs(sf_dir)
    got = rows(spark, sf_dir, "op8_winnowing")
    better = 0
    for (d, t, _), (_, nxt, _) in zip(data, data[1:] + data[:1]):
        cut = len(t) // 4
        own, edited = test_winnow.brute(t), test_winnow.brute(t[: len(t) - cut] + nxt[:cut])
        assert got[d].near_edited == pytest.approx(test_winnow.jaccard(own, edited)) and got[d].near_next == pytest.approx(test_winnow.jaccard(own, test_winnow.brute(nxt)))
        better += got[d].near_edited > got[d].near_next or t == nxt
    assert better / len(data) > 0.95


def test_quality(spark, sf_dir):
    got = rows(spark, sf_dir, "op10_quality_rules")
    field = crf.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert len(got) == len(docs(sf_dir))
    for d, t, _ in docs(sf_dir):
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == test_crf.brute_counts(t)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        share = test_crf.brute_share(t, field)
        assert r.content_share == pytest.approx(share) and r.kept == (not r.base_failed and share >= 0.5)


def shingles(t):
    w = (t or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def joined(texts):
    """The first of each text's group, by the shingle sets of all pairs."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            either = len(sets[i] | sets[j])
            if not either or len(sets[i] & sets[j]) / either >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return find


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = ppm.train(frame.where(ppm.fold_of("doc_id") != 0))
    data = docs(sf_dir)
    langs, scores = trees.predict([t for _, t, _ in data])
    data = [x for x, lang, score in zip(data, langs, scores) if lang != "und" and score >= 0.5]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = crf.train(spark.createDataFrame([(d, t) for d, t, _ in data], "doc_id long, text string"), labels)
    data = [x for x in data if crf.judge(x[1], field, 0.5)[-1]]
    group = joined([t for _, t, _ in data])
    texts = test_linededup.brute([(d, t) for d, t, _ in data], 30, {data[i][0]: data[group(i)][0] for i in range(len(data))})
    left = [i for i, t in enumerate(texts) if t == data[i][1] or len(t.split()) >= 20]
    data, texts = [data[i] for i in left], [texts[i] for i in left]
    find = joined(texts)
    kept = [(data[i][0], len(texts[i].encode()) + 1) for i in range(len(data)) if find(i) == i]
    counts = Counter(n for _, n in kept if n <= packing.BUDGET)
    ends = packing.optimal_lengths(sorted(counts.items()), packing.BUCKETS)
    want, held = set(), {}
    for d, n in kept:
        b = next((k for k, e in enumerate(ends) if n <= e), len(ends))
        end = ends[b] if b < len(ends) else n
        place, room = held.get(b, 0), max(1, packing.BUDGET // end)
        held[b] = place + 1
        want.add((d, n, b, end, place // room, place % room, end - n))
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens", "bucket", "bucket_tokens", "batch", "slot", "padding").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert all(len(texts[i].split()) >= 20 for i in range(len(data)) if find(i) == i)
    docs_now = frame
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_now = stage(spark, docs_now, sf_dir)
        assert docs_now.columns == frame.columns


def test_stages_take_odd_rows(spark, sf_dir):
    import corpus_pipeline

    good = "A plain line of words that is long enough to pass all of the rules, and then some more words to be sure."
    odd = spark.createDataFrame(
        [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (2, good, None, None, None, 3), (2, good, None, None, None, 3), (None, good + " again", "en", "x", 5, 4), (3, "é" * 100_000, "fr", "x", 5, 4)],
        "doc_id long, text string, lang string, source string, n_chars long, kept int",
    )
    # what each stage alone keeps of them, by id (0: null)
    alone = {"quality_rules": [0, 2, 2], "line_dedup": [0, 0, 1, 2, 2, 3], "simhash_near_dedup": [1, 2, 2, 3], "packing": [0, 0, 1, 2, 2, 3]}
    for frame in (odd, odd.where("false")):
        docs_now = frame
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, frame, sf_dir).collect()
            ids = sorted(r.doc_id or 0 for r in got)
            assert not got or name not in alone or ids == alone[name]
            assert bool(got) == (frame is odd) and (name != "language_id" or not any(r.text in (None, "") for r in got))
            docs_now = stage(spark, docs_now, sf_dir)
            assert k == 4 or docs_now.columns == frame.columns
        assert docs_now.count() <= 6


def test_rows_without_ids_are_told_apart(spark, sf_dir):
    """A group with an id keeps that, groups without one keep one text each."""
    import corpus_pipeline

    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, text(1)), (5, text(1)), (None, text(2)), (None, text(2) + " more"), (None, text(3)), (7, text(4)), (6, text(4)), (None, text(4))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted((i or 0, t[:3]) for i, t in kept) == [(0, "w2x"), (0, "w3x"), (5, "w1x"), (6, "w4x")]
