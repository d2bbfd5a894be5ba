import re
import sys
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.functions import text

CASES = [
    ("12\n", ""), ("\n12\n", "12"), ("a \u200b b", "a  b"), ("\u200b12", ""), ("１２ \u3000", ""), ("a\n\n1\n\nb", "a 1 b"), ("", ""), (None, None), ("  \u3000\x85 ", ""), ("\x1c7\x1f", "7"), ("\ufeffx\xad", "x"),
    ("第 一\u3000章\r\n12", "第 一 章 12"), ("\u0378a", "a"),
]


def restated(t):
    t = re.sub(r"\s+", " ", t)
    t = "".join(c for c in t if not unicodedata.category(c).startswith("C"))
    t = re.sub(r"^\d+\s*$", "", t, flags=re.M)
    return t.strip()


def test_clean(spark):
    df = spark.createDataFrame(list(enumerate(c[0] for c in CASES)), "k int, t string")
    got = {r.k: r.c for r in df.select("k", text.clean(F.col("t")).alias("c")).collect()}
    assert got == {k: c[1] for k, c in enumerate(CASES)}
    assert all(restated(a) == b for a, b in CASES if a is not None)


def test_space_class_is_complete():
    own = re.compile("[" + re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", text.SPACE) + "]")
    assert [c for c in map(chr, range(sys.maxunicode + 1)) if own.match(c)] == [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]


def test_clean_like_restated(spark):
    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.text(st.sampled_from("a1２ \n\t\u3000\x1c\u200b\x85。é字😀\u2028"), max_size=12), min_size=30, max_size=60))
    def run(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
        for r in df.select("k", text.clean(F.col("t")).alias("c")).collect():
            assert r.c == restated(texts[r.k])
            assert "  " not in r.c or "\u200b" in texts[r.k] or "\x85" in texts[r.k]

    run()


@pytest.mark.parametrize("t, want", [("\u3000 a b\n", "a b"), ("", ""), ("\x1c", "")])
def test_strip(spark, t, want):
    assert spark.createDataFrame([(t,)], "t string").select(text.strip(F.col("t"))).first()[0] == want


def test_ink_and_lines(spark):
    df = spark.createDataFrame([(None, 0), ("", 0), (" \u3000\n", 0), ("\u200b", 1), ("x", 1)], "t string, w int")
    assert all(bool(r.w) == r.i for r in df.select("w", text.has_ink(F.col("t")).alias("i")).collect())
    assert spark.sql("select 'a\\r\\nb\\rc\\n' as t").select(text.unix_lines(F.col("t"))).first()[0] == "a\nb\nc\n"
