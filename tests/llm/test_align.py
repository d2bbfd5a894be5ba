import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scriptorium.llm import align, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def both(libraries, text):
    """Ids and bytes of the tokens of whole texts, from the libraries; None where a text isn't given back."""
    a, b = libraries
    raw = (" " + text).encode()
    ids = a.encode(" " + text, add_special_tokens=False).ids
    # the bytes of an entry are what the library decodes it to; broken characters are told by their part of the text
    shown = {chr(x): x for x in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    rest = iter(range(256, 400))
    shown |= {chr(next(rest)): x for x in range(256) if x not in set(shown.values())}
    xs = [(i, bytes(shown[c] for c in a.id_to_token(i))) for i in ids]
    ys = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    return (xs, ys) if b"".join(x for _, x in xs) == raw == b"".join(y for _, y in ys) else None


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(libraries, texts):
    """The results of all texts: links by looking up which tokens overlap each, groups by the set of common ends."""
    links, parts = [], []
    for t in texts:
        found = both(libraries, t) if t else None
        if found is None:
            links.append([])
            parts.append(None)
            continue
        xs, ys = map(spans, found)
        ends = sorted({e for *_, e in xs} & {e for *_, e in ys})
        upto, begins = [v for *_, v in ys], [u for _, u, _ in ys]
        links.append([(i, j) for i, s, e in xs for j, _, _ in ys[bisect_right(upto, s) : bisect_left(begins, e)]])
        group = lambda tokens, by, lo, hi: ",".join(str(i) for i, *_ in tokens[bisect_right(by, lo) : bisect_right(by, hi)])
        of_a = [e for *_, e in xs]
        parts.append((len(xs), len(ys), len(ends), ";".join(f"{group(xs, of_a, lo, hi)}|{group(ys, upto, lo, hi)}" for lo, hi in zip([0, *ends], ends))))
    counts = Counter(p for x in links for p in set(x))
    top = defaultdict(int)
    for (i, _), n in counts.items():
        top[i] = max(top[i], n)
    for x, p in zip(links, parts):
        if p is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            yield (*p[:3], len(x), sum(counts[q] == top[q[0]] for q in x), sum(counts[q] for q in x), hashlib.sha256(p[3].encode()).hexdigest())


def told(r):
    return tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def test_query_against_brute_force(spark, sf_dir, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: told(r) for r in queries.op11_alignment(spark, sf_dir).collect()}
    assert len(got) == len(docs) and [got[d] for d, _ in docs] == list(brute(libraries, [t for _, t in docs]))


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n  b", "a\t b ", "x  y", "x　 y z", "\x1c a\x1d b", "▁", "a ▁b", "a▁ b", "don't we'll", "<|endoftext|> <s> </s> <unk> <0x41>", "日本語 と English", "😀 😀😀 x", "é́ ﬁ ½",
    "naïve café", "\r\n \r\n", "a" * 3000, "12345 67890", "x\x00 y", "word   next", "﻿bom here", "À b", "the the the", "the the the",
]


def test_odd_rows(spark, libraries, monkeypatch):
    rows = list(enumerate(ODD)) + [(None, "the null"), (5, "the same id")]
    df = spark.createDataFrame([(i, t, "b", 1) for i, t in rows], "doc_id long, text string, block string, part int")
    want = Counter((i, x) for (i, _), x in zip(rows, brute(libraries, [t for _, t in rows])))
    assert sum(bool(x[6]) for _, x in want) > 15
    assert Counter((r.doc_id, told(r)) for r in align.align(df, A, B).collect()) == want
    monkeypatch.setattr(align, "BLOCK", 16)
    assert Counter((r.doc_id, told(r)) for r in align.align(df.coalesce(1), A, B).collect()) == want
    assert align.align(df.where("false"), A, B).collect() == []
    assert [told(r) for r in align.align(df.where("text is null"), A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")]


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab e's.,1\n\t é字▁ 　 \x1c\x01<|>"), min_size=1, max_size=30))
def test_parts_are_encoded_like_whole_texts(text):
    """Joined tokens of the parts are those of the whole text, for every text that is given back; whole columns are cut like single texts."""
    pair = align.pair_of(A, B)
    found = align.parts(" " + text)
    assert "".join(found) == " " + text
    assert align.cut_texts(pa.array(["a b", text, None, "", "c, d.\ne"])).to_pylist() == [[" a", " b"], found, None, None, [" c", ",", " d", ".", "\ne"]]
    a, b = pair.encode(found)
    flat = lambda x: [i for t in x for i in t]
    raw = (" " + text).encode()
    whole_a, whole_b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    back = b"".join(pair.a_bytes[i] for i in whole_a) == raw == b"".join(pair.b_bytes[i] for i in whole_b)
    assert pair.given_back(found, a, b).all() == back
    assert not back or (flat(a), flat(b)) == (whole_a, whole_b)


def test_links_of_a_part(spark):
    tokens = lambda *sides: [int(np.int64(k) << align.SIDE) | n << align.LENGTH | i for k, side in enumerate(sides) for i, n in side]
    df = spark.createDataFrame([("x", tokens([(1, 2), (2, 3), (3, 4)], [(7, 1), (8, 4), (9, 2), (7, 2)])), ("y", tokens([(1, 5)], [(4, 5)])), ("z", [])], "key string, tokens array<long>")
    rows = sorted((r.key, r.end, r.a, r.b, r.a_ends, r.b_ends, r.group) for r in align.linked(df).collect())
    assert rows == [("x", 1, 1, 7, None, 7, 2), ("x", 2, 1, 8, 1, None, 2), ("x", 5, 2, 8, 2, 8, 2), ("x", 7, 3, 9, None, 9, 1), ("x", 9, 3, 7, 3, 7, 1), ("y", 5, 1, 4, 1, 4, 1)]
    links = {r.key: np.array(r.links) for r in align.links_of(df).collect()}
    assert align._texts(np.concatenate((links["x"], links["y"])), np.array([0, 5, 5, 6])) == ["1,2|7,8;3|9,7", "", "1|4"]
