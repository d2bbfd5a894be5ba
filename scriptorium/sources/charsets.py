"""The encoding of a text of unknown origin, told from all of its bytes.

Every encoding that could be meant reads the bytes strictly, which throws out those in which some sequence is invalid, and what it reads is scored by how likely such characters are. Chinese texts consist almost wholly of a few thousand frequent
characters, which GB 2312 and Big5 both keep in blocks of their own (level 1); read in a wrong encoding, the same bytes are spread over rare ones. Latin letters are likely beside ASCII text; private, unassigned and control
characters aren't. The best score wins, the earlier encoding of equal ones. UTF-8 that reads strictly is taken at once, as other encodings' texts hardly ever do; but short Chinese ones may, and come out as letters that no text consists of alone.
"""

from __future__ import annotations

import codecs
import functools

import numpy as np

# Encodings that are scored, in order of preference; and those tried in turn, where none is likely.
SCORED = ("utf-16", "utf-16-le", "utf-16-be", "gb18030", "big5", "cp1252")
FALLBACK = ("gb18030", "gbk", "gb2312", "utf-8", "utf-16", "big5")
#: Least score of an encoding that is taken.
LIKELY = 0.5
# Lead and trail bytes of the level 1 blocks and of punctuation; the most frequent characters of prose, simplified and traditional.
LEVEL_1 = {"gb2312": (range(0xB0, 0xD8), [*range(0xA1, 0xFF)]), "big5": (range(0xA4, 0xC7), [*range(0x40, 0x7F), *range(0xA1, 0xFF)])}
PUNCTUATION = {"gb2312": (range(0xA1, 0xA4), [*range(0xA1, 0xFF)]), "big5": (range(0xA1, 0xA4), [*range(0x40, 0x7F), *range(0xA1, 0xFF)])}
FREQUENT = "的一是不了在人有我他这這个個们們中来來上大为為和国國地到以说說时時要就出会會可也你对對生能而子那得于於着著下自之年过過发發后後作里裡"
#: Letters that stand between others if at all: phonetic ones, marks, and those that Cyrillic has for some languages beside its plain ones.
BESIDE_OTHERS = frozenset(map(chr, (*range(0x250, 0x370), *range(0x48A, 0x530))))


def _points(name: str, leads, trails) -> list[int]:
    out = []
    for a in leads:
        for b in trails:
            try:
                out += [ord(c) for c in bytes((a, b)).decode(name)]
            except UnicodeError:
                continue
    return out


@functools.cache
def weights(name: str) -> np.ndarray:
    """How likely each 16-bit code unit is in a text of that encoding: 1 for what is frequent, a part of it for what isn't."""
    w = np.zeros(1 << 16, dtype=np.float32)
    for start, end, value in ((0x20, 0x7F, 1), (0xA0, 0x250, 0.9), (0x370, 0x530, 0.8), (0x2010, 0x2030, 0.9), (0x3000, 0x3100, 0.9), (0xFF00, 0xFFF0, 0.8), (0x4E00, 0xA000, 0.15), (0xAC00, 0xD7A4, 0.5), (0xD800, 0xE000, 0.3)):
        w[start:end] = value
    w[[9, 10, 13]] = 1
    families = ("gb2312",) if name == "gb18030" else ("big5",) if name == "big5" else ("gb2312", "big5")
    for family in families:
        w[_points(family, *LEVEL_1[family])] = 0.9
        found = [p for p in _points(family, *PUNCTUATION[family]) if p < 1 << 16]
        w[found] = np.maximum(w[found], 0.9)
    w[[ord(c) for c in FREQUENT]] = 1
    return w


def score(text: str, name: str) -> float:
    """How likely the characters are on average; for encodings that share ASCII those beyond it. 1 where there's none."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), dtype="<u2")
    wide = units >= 0x80
    told = units[wide | (units < 9)]
    if not len(told):
        return 1.0
    if name == "cp1252":
        # a single byte may be anything; in prose, accented letters stand beside plain ones, typographic marks beside plain letters or blanks
        plain = np.concatenate(([True], ~wide, [True, True]))
        beside = plain[:-3] & (plain[2:-1] | plain[3:])
        good = (units >= 0xC0) & (units < 0x100) & (units != 0xD7) & (units != 0xF7) | (units >= 0x2010) & (units < 0x2040) | np.isin(units, (0xA0, 0xAB, 0xBB, 0xBF, 0xA1, 0x152, 0x153))
        return 0.85 * float((wide & good & beside).sum() / len(told))
    if name in ("gb18030", "big5"):
        return float(weights(name)[told].mean())
    # two bytes a character: ASCII counts too, as zeros in wrong places are what a wrong byte order gives
    return float((weights(name)[told].sum() + 0.9 * (len(units) - len(told))) / len(units))


def _read(content: bytes, name: str) -> str | None:
    try:
        return content.decode(name)
    except UnicodeError:
        return None


def _wide(text: str) -> set[str]:
    return {c for c in set(text) if c >= "\x80"}


def _frequent(content: bytes) -> tuple[str, str] | None:
    """Text and encoding, where all characters beyond ASCII that a Chinese encoding reads are among the most frequent ones."""
    read = ((_read(content, name), name) for name in ("gb18030", "big5"))
    return next(((text, name) for text, name in read if text is not None and _wide(text) <= set(FREQUENT)), None)


def detect(content: bytes | None) -> tuple[str | None, str | None]:
    """Text and encoding; (None, None) where none reads all of it."""
    if content is None:
        return None, None
    if (text := _read(content, "utf-8-sig")) is not None and "\0" not in text:
        return _frequent(content) if not text.isascii() and _wide(text) <= BESIDE_OTHERS and _frequent(content) else (text, "utf-8")
    marked = content.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE))
    best, found = 0.0, (None, None)
    for name in SCORED:
        if marked != (name == "utf-16") and name.startswith("utf-16"):
            continue
        if (text := _read(content, name)) is None:
            continue
        likely = 1.0 if marked and name == "utf-16" else score(text, name)
        if likely > best:
            best, found = likely, (text, "utf-16" if name.startswith("utf-16") else name)
    if best >= LIKELY:
        return found
    for name in FALLBACK:
        if (text := _read(content, name)) is not None:
            return text, name
    return found
