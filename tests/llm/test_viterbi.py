import hashlib
import math
import random

import duckdb
import public_tokenizers
import pytest
import sentencepiece

from scriptorium.llm import viterbi

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return viterbi.Model(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def unigram(model):
    """Pieces of the model with scores as of a unigram model: many sums are equal, as scores are few."""
    return viterbi.Model.of({p: -round(math.log(k + 2), 1) - 2 for k, p in enumerate(model.scores) if k % 3 or len(p) == 1})


def lattice(model, text):
    """The whole lattice at once: best score up to each code point, longer last piece on ties. In whole numbers, as the search adds."""
    marked = viterbi.MARK + text.replace(" ", viterbi.MARK) if text else ""
    floor = round((min(s for s, _ in model.scores.values()) - viterbi.UNKNOWN) / viterbi.UNIT)
    best = [(0, 0, ())]
    for end in range(1, len(marked) + 1):
        options = []
        for size in range(min(end, model.longest), 0, -1):
            piece = marked[end - size : end]
            if piece in model.scores:
                options.append((best[end - size][0] + round(model.scores[piece][0] / viterbi.UNIT), size, (model.scores[piece][1],)))
            elif size == 1:
                options.append((best[end - 1][0] + floor, 1, model.ids_of(piece)))
        best.append(max(options, key=lambda o: (o[0], o[1])))
    out, end = [], len(marked)
    while end:
        out.append(best[end][2])
        end -= best[end][1]
    return [i for ids in reversed(out) for i in ids]


def some():
    rng = random.Random(6)
    texts = ["", "a", " ", "  ", "\n", "Hello  world\n tab\tx é 漢字 ﬁ", "   lead", "trail   ", "x" * 500, "漢字" * 90, "no-space-" * 140, "\x00\x7f😀", "a" + " " * 60 + "b", "=" * 2000, " " * 3000, "a▁b"]
    parts = ["the", " ", "in", "g", "é", "字", "\n", "tion", "  ", "Q", "1", "===", "   ", "😀", "Ж", "\t"]
    return texts + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 400))) for _ in range(200)] + ["".join(rng.choice("abcde nst") for _ in range(900)) for _ in range(60)]


def corpus():
    return [t for t, in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' order by doc_id").fetchall()]


def test_merges_give_the_ids_of_the_library(model, library):
    for t, ids in zip(some() + corpus(), model.encode_all(some() + corpus())):
        assert ids.tolist() == library.encode(t), t[:80]


def test_scores_give_the_path_of_the_whole_lattice(unigram):
    assert not unigram.merges
    texts = some() + corpus()[:60]
    for t, ids in zip(texts, unigram.encode_all(texts)):
        assert ids.tolist() == lattice(unigram, t) and unigram.decode(ids) == t.replace(viterbi.MARK, " "), t[:80]


def test_every_code_point_is_searched_and_little_is_held(library):
    model, texts = viterbi.Model(PATH), corpus()
    model.encode_all(texts)
    assert model.searched == model.steps == sum(len(t) + 1 for t in texts)
    assert model.widest <= 4 * model.longest


def test_long_disagreement_widens_the_window(model):
    """Runs of one letter of odd and even pieces agree on no boundary before the end."""
    m = viterbi.Model.of({"a": -9.0, "aa": -1.0, "aaa": -1.5, "b": -2.0})
    for n in (1, 2, 3, 100, 1001, 5000):
        assert m.encode("a" * n + "b").tolist() == lattice(m, "a" * n + "b")
    assert m.widest > 16


def test_round_trip(model):
    for t in some() + corpus():
        assert model.decode(model.encode(t)) == t.replace(viterbi.MARK, " ")


def test_frames(spark, model):
    df = spark.createDataFrame([(1, "a b", 1), (None, None, 2), (1, "a b", 3), (4, "", 4)], "doc_id long, text string, ids int")
    ids = viterbi.encode(df, PATH)
    assert sorted((r.doc_id or 0, r.ids) for r in ids.collect()) == [(0, []), (1, model.encode("a b").tolist()), (1, model.encode("a b").tolist()), (4, [])]
    assert sorted((r.doc_id or 0, r.text) for r in viterbi.decode(ids, PATH).collect()) == [(0, ""), (1, "a b"), (1, "a b"), (4, "")]
    got = {r.doc_id: r for r in viterbi.round_trip(df, PATH).collect()}
    assert got[1].decoded_sha256 == hashlib.sha256(b"a b").hexdigest() and got[None].n_ids == 0
    assert viterbi.round_trip(df.where("false"), PATH).collect() == []
