import itertools

import pytest

from scriptorium.sources import charsets

SIMPLIFIED = "第一章 梅花易数，乾卦。今天我们来学习如何计算卦象以及它的含义；请注意这里的每一个步骤。"
TRADITIONAL = "第一章 梅花易數，乾卦。今天我們來學習如何計算卦象以及它的含義；請注意這裡的每一個步驟。"
FRENCH = "Été à Noël, où les élèves français reçoivent un cadeau très apprécié; déjà vu.\n"
GERMAN = "Über die Größe der Häuser schrieb er müßige, schöne Sätze.\n"


@pytest.mark.parametrize("text, name", [(SIMPLIFIED, "gb18030"), (SIMPLIFIED, "gbk"), (SIMPLIFIED, "gb2312"), (TRADITIONAL, "big5"), (SIMPLIFIED, "utf-16"), (TRADITIONAL, "utf-16-be"), (TRADITIONAL, "utf-16-le"), (SIMPLIFIED, "utf-8"), (TRADITIONAL, "utf-8-sig"),
                                        (FRENCH, "cp1252"), (GERMAN, "cp1252"), (FRENCH, "utf-16"), (FRENCH, "utf-16-le"), (GERMAN, "utf-8"), (SIMPLIFIED + "\U00020000", "gb18030"), ("plain text only\n", "utf-16-be")])
@pytest.mark.parametrize("times", [1, 40])
def test_texts_come_back(text, name, times):
    got, told = charsets.detect((text * times).encode(name))
    assert got == text * times and told in (name, {"utf-8-sig": "utf-8", "gbk": "gb18030", "gb2312": "gb18030"}.get(name, name.rsplit("-", 1)[0]))


def test_odd_contents():
    assert charsets.detect(None) == (None, None) and charsets.detect(b"") == ("", "utf-8") and charsets.detect(b"abc") == ("abc", "utf-8")
    assert charsets.detect("短".encode("gb18030"))[0] == "短"
    text, name = charsets.detect(bytes(range(128, 256)) * 3 + b"\x81")
    assert text is None or name


def test_big5_words():
    """Short texts of frequent words, each told on its own."""
    words = "我們的時間 不可以說話 他來到中國 學生的問題 經過很多年 開始工作了 這個地方好 大家都知道".split()
    assert sum(charsets.detect(w.encode("big5")) == (w, "big5") for w in words) >= 7
    words = "我们的时间 不可以说话 他来到中国 学生的问题 经过很多年 开始工作了 这个地方好 大家都知道".split()
    assert sum(charsets.detect(w.encode("gb18030")) == (w, "gb18030") for w in words) >= 7


def test_chinese_that_is_valid_utf_8():
    """Every text of three such characters, told from letters that UTF-8 reads there; texts with these letters among others are UTF-8."""
    texts = ["".join(p) for n in (1, 2, 3) for p in itertools.product("一要也 \n", repeat=n)]
    for t in filter(str.strip, texts):
        assert t.encode("gb18030").decode() and charsets.detect(t.encode("gb18030")) == (t, "gb18030")
    for t in ("Һауа һыуыҡ", "ұлт", "əlaqə", "ɑ", "é", "ж", "ʔ", "Ґ"):
        assert charsets.detect(t.encode()) == (t, "utf-8")
