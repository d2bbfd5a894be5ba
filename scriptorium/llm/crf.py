"""Quality rules: a linear-chain conditional random field labels each line content or boilerplate.

Viterbi decoding finds the best label sequence of a text's lines; the share of words in content lines decides whether the
text stays. Four counts over the whole text come before (:func:`base`).

Labels are known of texts and not of lines, so the lines' own are latent: of a good text at least ``GOOD`` of the words are taken to be content, of a bad one at most ``BAD``. Fitting
alternates (posterior regularisation): given the weights, each text's line probabilities are moved as little as brings its share within its bound, by one number a text that its
lines' words are weighted with; given these probabilities, the weights climb the conditional likelihood, from zero and with a pull to zero. So a line of
a bad text that looks like those of good ones is content. Bounds of the sample (documented parameters): 300 labelled texts a class, chosen by a hash of the id,
of a long text the first 20,000 characters and 200 lines. Where there are not both labels, ``UNFITTED`` holds.

Defined results: a null text counts as empty, has no words and fails the base rules. Lines without a word have no label.
A text whose content and boilerplate lines hold equally many words stays. Repeated rows are judged alike; of rows with one id in the sample the least text counts.
Very long texts are judged whole. An empty table gives no rows. Columns other than the id and the text are not read by :func:`assess` and go along in :func:`accepted`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = b"0123456789"
BLANKS = b" \t\n\r\x0b\f"
FEATURES = ("bias", "symbols", "capitals", "shouts", "digits", "no letters", "few words", "repeats", "seen before", "repeated words", "no sentence end", "many words")
# Weights of content against boilerplate where nothing is labelled, in the order of FEATURES; then the gain of neighbouring lines having one label.
UNFITTED = np.array([1.0, -9.0, -2.0, -8.0, -2.0, -2.0, -0.2, -6.0, -1.5, -4.0, -0.3, 2.0])
UNFITTED_STAY = 0.8
#: Least share of content in a text labelled good, and greatest in one labelled bad.
GOOD, BAD = 0.9, 0.3
WINDOW = 8
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)


def repeated(words: list[bytes], size: int = WINDOW) -> np.ndarray:
    """Which words stand in a window of so many words that is found twice or more (64-bit window hashes)."""
    n = len(words) - size + 1
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    if n > 1:
        h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * FACTORS[0]
        key = np.zeros(n, dtype=np.uint64)
        for j in range(size):
            key += h[j : n + j] * FACTORS[j]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        if same.any():
            hit = np.zeros(n, dtype=bool)
            hit[order[1:][same]] = True
            hit[order[:-1][same]] = True
            at = np.flatnonzero(hit)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + size, -1)
    return np.cumsum(cover)[:-1] > 0


def without(data: bytes, these: bytes) -> int:
    """How many bytes of data are among these."""
    return len(data) - len(data.translate(None, these))


def lines_of(text: str | None) -> tuple[tuple[int, int, int, int, int], list[int], list[list[float]]]:
    """The counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), and for each line with a word its number
    of words and its features."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words: list[bytes] = []
    sizes, feats, seen, dup = [], [], set(), 0
    for line in data.split(b"\n"):
        own = line.split()
        if not own:
            continue
        words += own
        n, letters = len(own), without(line, LETTERS)
        again = line in seen
        seen.add(line)
        dup += again
        feats.append([1.0, min(1.0, without(line, SYMBOLS) / n), without(line, UPPER) / letters if letters > 3 else 0.0, min(1.0, line.count(b"!") / n), min(1.0, without(line, DIGITS) / n / 4), float(letters == 0), float(n < 5), sum(map(eq, own, own[1:])) / n, float(again), 0.0, float(line.rstrip()[-1:] not in b".!?:;\"')"), min(1.0, n / 40)])
        sizes.append(n)
    rep = repeated(words)
    n_repeat = int(rep.sum())
    if n_repeat:
        ends = np.cumsum(sizes)
        for k, share in enumerate(np.add.reduceat(rep.astype(np.int64), np.concatenate(([0], ends[:-1]))) / np.array(sizes)):
            feats[k][9] = float(share)
    chars = len(text or "") - sum((text or "").count(chr(b)) for b in BLANKS)
    return (len(words), chars, without(data, SYMBOLS), dup, n_repeat), sizes, feats


LEAST_WORDS = 20


def n_words(text: Column) -> Column:
    """Words of a text, as lines_of() counts them."""
    return F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), ""))


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat > 30 * n_words


class Field:
    """Weights of content against boilerplate, and of neighbouring lines having one label."""

    def __init__(self, weights: np.ndarray | None = None, stay: float = UNFITTED_STAY):
        self.weights, self.stay = UNFITTED.copy() if weights is None else weights, stay

    def viterbi(self, gains: list[float]) -> list[bool]:
        """The best labels (true: content) where content on line k gains so much. Ties go to content, and to staying."""
        content, junk, back = 0.0, 0.0, []
        for k, gain in enumerate(gains):
            stay = self.stay if k else 0.0
            from_content = content + stay >= junk
            junk_from_content = content > junk + stay
            content, junk = max(content + stay, junk) + gain, max(content, junk + stay)
            back.append((from_content, junk_from_content))
        label, out = content >= junk, []
        for k in range(len(gains) - 1, -1, -1):
            out.append(label)
            label = back[k][0] if label else back[k][1]
        return out[::-1]

    def share(self, sizes: list[int], feats: list[list[float]]) -> float:
        """The share of words in content lines; 0 where there are none."""
        if not sizes:
            return 0.0
        labels = self.viterbi((np.array(feats) @ self.weights).tolist())
        return sum(n for n, x in zip(sizes, labels) if x) / sum(sizes)

    @classmethod
    def fit(cls, texts: list[str], good: list[bool], rounds: int = 12, steps: int = 15, rate: float = 0.15, pull: float = 0.5, longest: int = 200) -> Field:
        """From texts and whether they're good: rounds of moving line probabilities within the texts' bounds, each with steps of Adam for the weights."""
        if len(set(good)) < 2:
            return cls()
        parts = []
        for text, is_good in zip(texts, good):
            _, words, feats = lines_of(text)
            if words:
                parts.append((np.array(feats[:longest]), np.array(words[:longest], dtype=float), is_good))
        parts.sort(key=lambda x: -len(x[0]))
        chains = Chains([x for x, _, _ in parts], [n for _, n, _ in parts])
        sign = np.array([1.0 if g else -1.0 for _, _, g in parts])
        bound = np.where(sign > 0, GOOD, BAD)
        theta, m, v, t = np.zeros(len(FEATURES) + 1), 0.0, 0.0, 0
        for _ in range(rounds):
            low, high = np.zeros(len(parts)), np.full(len(parts), 64.0)
            for _ in range(16):  # the least move that keeps the bound
                mid = (low + high) / 2 * (high > 1e-3)
                within = (chains.share(*chains.marginals(theta, sign * mid)[:1]) - bound) * sign >= 0
                high, low = np.where(within, mid, high), np.where(within, low, mid)
            q, q_same = chains.marginals(theta, sign * high)
            for _ in range(steps):
                p, p_same = chains.marginals(theta, None)
                grad = np.append(chains.x.T @ (q - p), q_same - p_same) / len(parts) - pull / len(parts) * theta
                t += 1
                m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
                theta = theta + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return cls(theta[:-1], float(theta[-1]))


class Chains:
    """The lines of many texts, longest text first, one after the other by line: first lines of all, then second lines of those that have one, and so on. Nothing is padded."""

    def __init__(self, feats: list[np.ndarray], words: list[np.ndarray]):
        sizes = np.array([len(f) for f in feats])
        live = [int((sizes > k).sum()) for k in range(sizes[0])]
        self.rows = list(zip(np.cumsum([0, *live[:-1]]).tolist(), live))
        self.x = np.concatenate([np.stack([f[k] for f in feats[:n]]) for k, n in enumerate(live)])
        self.text = np.concatenate([np.arange(n) for n in live])
        total = np.array([w.sum() for w in words])
        self.part = np.concatenate([[w[k] for w in words[:n]] for k, n in enumerate(live)]) / total[self.text]

    def share(self, p: np.ndarray) -> np.ndarray:
        """Expected share of words in content lines, of each text."""
        return np.bincount(self.text, weights=p * self.part)

    def marginals(self, theta: np.ndarray, moved: np.ndarray | None) -> tuple[np.ndarray, float]:
        """Probability of content for each line, and expected number of neighbours with one label, by forward and backward sums. moved: of each text, what its lines gain by their share of its
        words."""
        gain, stay = self.x @ theta[:-1], theta[-1]
        if moved is not None:
            gain = gain + moved[self.text] * self.part * np.bincount(self.text)[self.text]
        content, junk = np.empty(len(gain)), np.empty(len(gain))
        for k, (at, n) in enumerate(self.rows):
            here = slice(at, at + n)
            if not k:
                content[here], junk[here] = gain[here], 0.0
            else:
                a, b = content[before : before + n], junk[before : before + n]  # noqa: F821
                content[here], junk[here] = np.logaddexp(a + stay, b) + gain[here], np.logaddexp(a, b + stay)
            before = at
        after_content, after_junk, same, nxt, more = np.zeros(len(gain)), np.zeros(len(gain)), 0.0, 0, 0
        for at, n in reversed(self.rows):
            if more:
                a, b = after_content[nxt : nxt + more] + gain[nxt : nxt + more], after_junk[nxt : nxt + more]
                here = slice(at, at + more)
                after_content[here], after_junk[here] = np.logaddexp(a + stay, b), np.logaddexp(a, b + stay)
                z = np.logaddexp(content[here] + after_content[here], junk[here] + after_junk[here])
                same += float((np.exp(content[here] + stay + a - z) + np.exp(junk[here] + stay + b - z)).sum())
            nxt, more = at, n
        return 1 / (1 + np.exp(np.clip(junk + after_junk - content - after_content, -700, 700))), same


def train(docs: DataFrame, labels: DataFrame, per_class: int = 300, longest: int = 20_000) -> Field:
    """Fits on a bounded sample of the texts that labels (doc_id, quality 0 or 1) names: at most 2 * per_class texts come to the driver."""
    named = labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)))
    counts = {r["quality"]: r["n"] for r in named.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Field()
    # about three times as many ids as are taken, so that no window has more of a class
    few = reduce(Column.__or__, [(F.col("quality") == k) & (F.col("h") < min(1.0, 3 * per_class / n) * (1 << 20)) for k, n in counts.items()])
    chosen = named.where(few).withColumn("r", F.row_number().over(Window.partitionBy("quality").orderBy("h", "doc_id"))).where(F.col("r") <= per_class)
    chosen = chosen.select(F.col("doc_id").alias("chosen"), "quality")
    rows = docs.select("doc_id", F.left("text", F.lit(longest)).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen"))
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    return Field.fit([r["text"] for r in rows], [r["quality"] == 1 for r in rows])


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_share double, base_failed boolean, kept boolean"


def judge(text: str | None, field: Field, least_share: float) -> tuple:
    counts, sizes, feats = lines_of(text)
    failed = base_failed(counts[0], counts[4])
    share = field.share(sizes, feats)
    return (*counts, share, failed, not failed and share >= least_share)


def assess(docs: DataFrame, field: Field, least_share: float = 0.5) -> DataFrame:
    """doc_id and the columns of SCHEMA for each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [judge(x.as_py(), field, least_share) for x in part.column(1)]
                columns = [pa.array(x) for x in zip(*rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *(x.split()[0] for x in SCHEMA.split(", "))])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def accepted(docs: DataFrame, field: Field, least_share: float = 0.5) -> DataFrame:
    """The rows that stay, all columns as they are; only texts go through Python, and none comes back."""

    @F.arrow_udf("boolean")
    def stays(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([judge(x.as_py(), field, least_share)[-1] for x in batch], pa.bool_())

    return docs.where(stays(F.col("text")))
