import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scriptorium.llm import lookup, wavelet

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n, top", [(0, 5), (1, 1), (1, 70000), (63, 3), (64, 300), (65, 49407), (1000, 7), (5000, 49407), (513, 2**20)])
def test_queries(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, size=n).astype(np.uint32)
    data = wavelet.dump(ids, pa.array([1, None], pa.int64()), np.array([0, n, n]))
    m, doc_ids, starts = wavelet.load(data)
    assert doc_ids.to_pylist() == [1, None] and starts.tolist() == [0, n, n]
    assert (m.decode() == ids).all()
    for i in range(0, n, max(1, n // 50)):
        assert m.access(i) == ids[i]
    for token in {*ids[:30].tolist(), 0, top, 2**25}:
        where = np.flatnonzero(ids == token).tolist()
        assert m.count(token) == len(where) and m.rank(token, n // 2) == sum(w < n // 2 for w in where)
        assert m.occurrences(token) == where
        with pytest.raises(IndexError):
            m.select(token, len(where))


def texts():
    rng = random.Random(3)
    return [None, "", "it's we'll <|endoftext|> x", "ÀÉ é 漢字 ǅ\xa0a b\x1cc", "é x ́", "A\r\nB\tC\x0bD"] + ["".join(rng.choice(["ab", " ", "J̌", ". ", ",", "It'S", "<|ENDOFTEXT|>", "...", "Ç", "'s", "\n", "12", "<|", "!?", "́", "ΑΣ"]) for _ in range(rng.randint(1, 200))) for _ in range(200)]


@pytest.mark.parametrize("name, words, by_word", [("word_bpe_49k.json", 100_000, True), ("word_bpe_49k.json", 50, True), ("byte_bpe_50k.json", 100_000, False)])
def test_words_encode_like_texts(monkeypatch, name, words, by_word):
    monkeypatch.setattr(lookup, "HOT_WORDS", words)
    monkeypatch.setattr(lookup, "COLD_WORDS", 20 * words)
    path = public_tokenizers.path(name)
    t, e = Tokenizer.from_file(path), wavelet.Encoder(path)
    assert e.by_word == by_word
    rows = duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    every = texts() + [r[0] for r in rows] + ["A. B, c.d e.. f., <|ENDOFTEXT|> <|endoftext|>. J\u030c H\u0331. I\u0307, K\u212a.", "Don't. It'S, we'Re. x"]
    every += ["ΑΣ Σ. ὈΔΥΣΣΕΎΣ ǅ İstanbul ﬁne Å Å straße STRASSE ⅷ x² ª º ʰ ßẞ がか\u3099", "a\u200bb \ufeffc \x00d \x85e\u2028f 가각힣 \u1100\u1161"]
    for x in every:
        assert np.frombuffer(e.encode(x), dtype="<u4").tolist() == t.encode(x or "", add_special_tokens=False).ids


@pytest.mark.parametrize("shard", [1 << 22, 300])
def test_files(spark, shard):
    rows = [(i * 7 % 211, x, 3) for i, x in enumerate(texts())] + [(None, "null id", 3), (5000, "b", 3), (5000, "a", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    files = wavelet.write_shards(df, PATH, end_id=2, shard_tokens=shard)
    got = sorted((tuple(r) for r in wavelet.read_shards(spark, files).collect()), key=lambda r: r[1])
    tok, start, want = Tokenizer.from_file(PATH), 0, []
    hashed = {r.doc_id: r.h for r in df.where("doc_id is null or doc_id < 5000").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    hashed |= {(5000, x): spark.range(1).select(F.xxhash64(F.lit(x))).first()[0] for x in "ab"}
    for d, x, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed[(5000, r[1]) if r[0] == 5000 else r[0]])):
        ids = [*tok.encode(x or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert got == want
    shards = files.orderBy("shard").collect()
    assert sum(r.n_tokens for r in shards) == start and (len(shards) > 10) == (shard == 300)


def test_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert wavelet.read_shards(spark, wavelet.write_shards(df, PATH, 2)).collect() == []


def test_rows_of_one_id_go_to_many_tasks(spark):
    texts = [f"text {k} of many" for k in range(400)]
    df = spark.createDataFrame([(None, x) for x in texts] + [(7, x) for x in texts], "doc_id long, text string").repartition(3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        files = wavelet.write_shards(df, PATH, end_id=2)
        assert max(r.n_docs for r in files.collect()) < 300
        rows = sorted(wavelet.read_shards(spark, files).collect(), key=lambda r: r.start)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [r.doc_id for r in rows] == [None] * 400 + [7] * 400 and all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))
