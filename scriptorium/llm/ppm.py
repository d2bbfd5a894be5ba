"""Language identification by prediction by partial matching (PPM, escape method C with exclusion).

Each language gets a tree of byte contexts of up to ``order`` bytes with symbol counts from a bounded sample of labelled
texts. A symbol unseen after a context costs an escape to the next shorter one; symbols of the longer contexts are excluded
there, and the last resort is uniform, so code lengths are exact: those of the folded bytes, in which A-Z are in lower case and every run of other ASCII (digits,
punctuation, blanks) is one space. After training the statistics are frozen and the trees of
every four languages are compiled to one automaton: a state is the longest context that any of them knows, and a table holds the code length of
every symbol there for each of them. As a state depends on the last ``order`` bytes only, a text can be cut anywhere
and its pieces scored side by side, each warmed up on the bytes before it; code lengths don't change by it.

Every language is learnt, however many there are. Bounds (documented parameters), shared out evenly between the languages: a sample of 300 texts a language and of
``SAMPLE_CHARS`` code points in all, taken by a hash of the text, of long texts the beginning; 4,000 contexts a language, and ``CELLS`` numbers in all tables together (64 languages: under
100 MB), which is what every executor gets. Prediction reads whole texts, and nothing but texts.

Defined results: ``und`` with score 0 for a null text, one without letters, or when there was nothing to learn from.
The score is the posterior of the best language under equal priors. Equal code lengths: the language first by name. Repeated rows and rows of one id give a row each;
texts that are equal count once in the sample. An empty table gives no rows. Columns other than the id and the text are not read by :func:`identify` and go along in :func:`accepted`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
SPACE = 32
FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else SPACE for b in range(256)], dtype=np.uint8)
#: Symbols scored at a time, and the length of the pieces that are walked side by side.
SLICE, PIECE = 1 << 19, 128
#: Languages with one automaton. A table is states x symbols x languages, so memory grows with the languages and not with their square.
TOGETHER = 4
#: Texts predicted at a time where only a verdict is asked for.
ROWS = 2048
#: Numbers (of 4 bytes) in all tables, and code points of all samples together.
CELLS, SAMPLE_CHARS = 20_000_000, 8_000_000


def folded(text: str) -> np.ndarray:
    """UTF-8 bytes with A-Z in lower case and every run of other ASCII as one space."""
    raw = FOLD[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    blank = raw == SPACE
    blank[1:] &= blank[:-1].copy()
    blank[:1] = False
    return raw[~blank]


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Trees:
    """Frozen statistics of all languages as automata, one for every few languages."""

    def __init__(self, texts: dict[str, list[str]], order: int = 4, contexts: int = 4000, least: int = 4):
        self.langs, self.order = sorted(texts), order
        #: contexts of a language, so that all tables keep their bound: a state has a cost of each symbol for every language of its group, and the next state
        kinds = len(np.unique(np.concatenate([np.unique(folded(t)) for each in texts.values() for t in each] or [FOLD[:0]]))) + 1
        self.contexts = max(1, min(contexts, CELLS // (kinds * (TOGETHER + 1) * max(1, len(texts)))))
        counted = {lang: self._count(texts[lang], self.contexts, least) for lang in self.langs}
        seen = sorted({b for tree in counted.values() for b in tree.get(b"", {})})
        self.symbol = np.zeros(256, dtype=np.int32)  # 0: a byte that no sample has
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        groups = [self.langs[k : k + TOGETHER] for k in range(0, len(self.langs), TOGETHER)]
        #: (next state, cost of every symbol for the group's languages) of each group
        self.tables = [self._compile([counted[lang] for lang in group], seen) for group in groups]

    def _compile(self, trees: list[dict[bytes, dict[int, int]]], seen: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The automaton of some languages; a code length depends on its own tree and on all symbols seen only, not on the group."""
        vectors = [{c: self._vector(n) for c, n in tree.items()} for tree in trees]
        found = sorted({c for tree in trees for c in tree} | {b""}, key=lambda c: (len(c), c))
        states = {c: i for i, c in enumerate(found)}
        cost = np.empty((len(states) * self.width, len(trees)), dtype=np.float32)
        follow = np.zeros((len(states), self.width), dtype=np.int32)
        for c, i in states.items():
            for k, tree in enumerate(vectors):
                chain = [tree[c[j:]] for j in range(len(c) + 1) if c[j:] in tree]
                cost[i * self.width : (i + 1) * self.width, k] = self._lengths(chain)
        # where a context goes: as its longest suffix that's a state goes (shorter contexts come first), but for those that are one byte longer
        for c, i in states.items():
            if c:
                s = c[1:]
                while s not in states:
                    s = s[1:]
                follow[i] = follow[states[s]]
            if len(c) < self.order:
                for b in seen:
                    if (s := c + bytes([b])) in states:
                        follow[i, self.symbol[b]] = states[s]
        return follow.ravel(), cost

    def _count(self, texts: list[str], contexts: int, least: int) -> dict[bytes, dict[int, int]]:
        gap = np.full(self.order, SPACE, dtype=np.uint8)
        stream = np.concatenate([gap] + [x for t in texts for x in (folded(t), gap)])
        tree: dict[bytes, dict[int, int]] = {}
        for k in range(self.order + 1):
            key = np.zeros(max(0, len(stream) - k), dtype=np.uint64)
            for j in range(k + 1):
                key = (key << np.uint64(8)) | stream[j : len(stream) - k + j].astype(np.uint64)
            grams, n = np.unique(key, return_counts=True)
            for gram, m in zip(grams.tolist(), n.tolist()):
                c, b = (gram >> 8).to_bytes(k, "big"), gram & 255
                if b"  " not in c:
                    tree.setdefault(c, {})[b] = m
        totals = sorted((sum(n.values()) for n in tree.values()), reverse=True)
        floor = max(least, totals[contexts] + 1 if len(totals) > contexts else 0)
        # a context occurs no more often than its prefix and its suffix, so what stays has both
        return {c: n for c, n in tree.items() if not c or sum(n.values()) >= floor}

    def _vector(self, counts: dict[int, int]) -> np.ndarray:
        out = np.zeros(self.width)
        out[self.symbol[list(counts)]] = list(counts.values())
        return out

    def _lengths(self, chain: list[np.ndarray]) -> np.ndarray:
        """Bits of every symbol after the contexts of chain, longest first."""
        out, free, spent = np.zeros(self.width), np.ones(self.width, dtype=bool), 0.0
        for counts in chain:
            n = counts * free
            hit = n > 0
            total, kinds = n.sum(), hit.sum()
            if not kinds:
                continue
            out[hit] = spent - np.log2(n[hit] / (total + kinds))
            spent -= np.log2(kinds / (total + kinds))
            free &= ~hit
        if free.any():
            out[free] = spent + np.log2(free.sum())
        return out

    def walk(self, symbols: np.ndarray, follow: np.ndarray) -> np.ndarray:
        """For each position the row of a group's cost table; positions before the first count as spaces."""
        d, n = self.order, len(symbols)
        pieces = -(-n // PIECE)
        padded = np.full(d + pieces * PIECE, self.symbol[SPACE], dtype=np.int32)
        padded[d : d + n] = symbols
        rows = np.lib.stride_tricks.as_strided(padded, (d + PIECE, pieces), (padded.itemsize, PIECE * padded.itemsize))
        state, at = np.zeros(pieces, dtype=np.int32), np.empty((PIECE, pieces), dtype=np.int32)
        for step in range(d + PIECE):
            where = state * np.int32(self.width) + rows[step]
            state = follow[where]
            if step >= d:
                at[step - d] = where
        return at.T.ravel()[:n]

    def bits(self, texts: list[str]) -> np.ndarray:
        """Code length in bits of each text in each language."""
        out, gap = np.zeros((len(texts), len(self.langs))), np.full(self.order, SPACE, dtype=np.uint8)
        parts, spans, at = [], [], 0

        def flush():
            stream = self.symbol[np.concatenate([*parts, gap])]
            for a in range(0, len(stream), SLICE):
                warm = min(a, self.order)
                z = min(a + SLICE, len(stream))
                for_now = [(i, max(s, a) - a, min(e, z) - a) for i, s, e in spans if s < z and e > a]
                if not for_now:
                    continue
                cuts = np.array([x for _, s, e in for_now for x in (s, e)])
                for g, (follow, cost) in enumerate(self.tables):
                    costs = cost[self.walk(stream[a - warm : a + SLICE], follow)[warm:]]
                    sums = np.add.reduceat(np.concatenate([costs, costs[:1]]), cuts, axis=0, dtype=np.float64)[::2]
                    for (i, s, e), total in zip(for_now, sums):
                        out[i, g * TOGETHER : g * TOGETHER + len(total)] += total
            parts.clear()
            spans.clear()

        for i, text in enumerate(texts):
            body = folded(text)
            parts += [gap, body]
            if len(body):
                spans.append((i, at + self.order, at + self.order + len(body)))
            at += self.order + len(body)
            if at >= SLICE:
                flush()
                at = 0
        if parts:
            flush()
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        known = [i for i, t in enumerate(texts) if self.langs and has_letters(t)]
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if known:
            bits = self.bits([texts[i] for i in known])
            best = bits.argmin(axis=1)
            excess = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
            scores[known] = 1 / np.exp2(-excess).sum(axis=1)
            for i, k in zip(known, best):
                langs[i] = self.langs[k]
        return langs, scores


def sample(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 300, longest: int = 20_000) -> dict[str, list[str]]:
    """A bounded sample of the rows of every label: different texts by language, chosen by a hash of the text; of long texts the beginning. No more than SAMPLE_CHARS
    code points come to the driver."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null and lang <> ''").where(F.col("lang") != UNKNOWN)
    h = F.xxhash64("text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    longest = max(1, min(longest, SAMPLE_CHARS // (per_language * len(counts))))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 3 * per_language / n)))])
    few = rows.withColumn("h", h).where(F.pmod("h", F.lit(1 << 20)) < F.try_element_at(share, F.col("lang")) * (1 << 20))
    # copies count once: they'd all be below the bound if one is
    few = few.groupBy("lang", "h").agg(F.min(F.left("text", F.lit(longest))).alias("text"))
    first = few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 20)), "h"))).where(F.col("r") <= per_language)
    out: dict[str, list[str]] = {}
    for r in first.select("lang", "text").orderBy("lang", "r").collect():
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def train(labelled: DataFrame, **bounds) -> Trees:
    return Trees(sample(labelled, **bounds))


def fold_of(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. A null id has no fold: it's neither learnt from nor held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(5))


def identify(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, lang_pred, score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores)], [id_col, "lang_pred", "score"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def accepted(docs: DataFrame, trees: Trees, least_score: float = 0.5, text: str = "text") -> DataFrame:
    """The rows whose language is known with at least that score, all columns as they are; only texts go through Python, and none comes back."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("boolean")
    def known(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                langs, scores = shared.value.predict(part.to_pylist())
                yield pa.array([x != UNKNOWN and s >= least_score for x, s in zip(langs, scores.tolist())], pa.bool_())

    return docs.where(known(F.col(text)))
