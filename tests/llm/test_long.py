"""Very long texts, and texts without a blank, beside short ones: every operator gives a row for each."""

import random
import zlib

import public_tokenizers
import pytest

from scriptorium.llm import chat, crf, linededup, packing, ppm, simhash, viterbi, warc, wavelet, winnow


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    long = "\n".join(" ".join(f"w{rng.randrange(50_000)}" for _ in range(12)) for _ in range(15_000))
    return [(1, "short one"), (2, long), (3, long), (4, "x" * 300_000), (5, "漢" * 100_000), (6, "\n" * 50_000), (7, long + " end")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_simhash(docs):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert len(got) == 7 and got[3].component_id == got[7].component_id == 2 and got[6].fingerprint == "0" * 16
    assert {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(docs).collect()} == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5, 6: 6, 7: 2}


def test_language_and_quality(docs):
    trees = ppm.Trees({"a": ["w1 w2 the of"] * 5, "b": ["und der die"] * 5})
    got = {r.doc_id: r.lang_pred for r in ppm.identify(docs, trees).collect()}
    assert len(got) == 7 and got[6] == "und"
    judged = {r.doc_id: r for r in crf.assess(docs, crf.Field()).collect()}
    assert judged[2].n_words == 180_000 and judged[2].n_repeat_words == 0 and judged[4].n_words == 1 and judged[6].n_words == 0


def test_lines(docs, rows):
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert got[2] == rows[1][1] and got[3] == "" and got[6] == rows[5][1]
    # the last piece, which has grown together with another word, stays
    assert rows[6][1].endswith(got[7]) and got[7].endswith(" end") and len(got[7].split()) <= linededup.SPAN


def test_tokens(spark, docs, rows):
    files = wavelet.write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), 2, shard_tokens=100_000)
    got = sorted((r.doc_id, r.start, r.n_tokens) for r in wavelet.read_shards(spark, files).collect())
    assert [d for d, _, _ in got] == [1, 2, 3, 4, 5, 6, 7] and all(s + n == t for (_, s, n), (_, t, _) in zip(got, got[1:])) and got[5][2] == 1
    tripped = {r.doc_id: r for r in viterbi.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    import hashlib

    assert all(tripped[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for d, t in rows)


def test_winnowing_and_packing(docs, rows):
    got = {r.doc_id: r for r in winnow.compare_edits(docs).collect()}
    assert len(got) == 7 and got[2].fingerprint == got[3].fingerprint and got[2].near_next == 1.0 and 0.4 < got[7].near_edited < 0.9
    assert {r.doc_id: r.n_tokens for r in packing.pack(docs).collect()} == {d: len(t.encode()) + 1 for d, t in rows}


def test_archives_and_chats(spark, docs, rows):
    pages = docs.selectExpr("doc_id as page_id", "'http://x/' || doc_id as url", "text as html")
    got = {r.page_id: r for r in warc.captures(spark, warc.write_archives(pages)).collect()}
    assert all(got[d].payload_bytes == len(t.encode()) for d, t in rows) and got[3].refers_to == 2
    turns = docs.selectExpr("0L as conv_id", "doc_id as turn", "'assistant' as role", "text")
    (chatted,) = chat.read_chats(chat.format_chats(turns)).collect()
    assert zlib.crc32(chatted.loss_text.encode()) == zlib.crc32("".join(t for _, t in rows).encode())
