"""Line dedup by winnowing over hashes of lines.

A text is its sequence of pieces: its lines, where a line of more than ``SPAN`` words is cut at places that its own words choose, as a passage may have been put into
the middle of one. Of every SPAN words in a row in a line the longest is selected (of equally long ones the one whose first ``HEAD`` bytes are
greater, then the rightmost), and the line is cut after each selected word: a cut depends on the words around it only, and no piece has more than SPAN words. Pieces are equal
if their words are. From each piece on, the shortest run with at least ``min_words`` words is a window, and so is the shortest such run up to each piece.

Each window selects the piece of the smallest hash in it, the rightmost of equal ones: texts that share a window select the same piece of it. A selected piece is a row: its
hash, position, and the pieces around it that its windows reach. These rows are joined by hash, those found at one place only end there, and of the others the
windows are compared. Windows from a piece on reach from the first piece of a shared run, windows up to a piece to its last one: so a match is extended both ways to all
whole pieces that are shared. What occurs earlier (smaller doc_id, then earlier in the text) is deleted; the first occurrence stays, and so does a window that
overlaps it in its own text.

A shared passage of ``min_words + 2 * SPAN - 1`` words (51) is always found, wherever it stands; of the words at either end of it SPAN at most may stay, where they have
grown together with others to one piece. Shared runs of fewer than ``min_words`` words stay everywhere, so common short lines do no harm.

Defined results: a null text stays null. A text all of whose words are in later copies becomes empty; its row stays. In a line that
loses words, the words left keep the blanks between them and lose outer ones; a line of which no word is left goes; other lines, and other texts, stay as they are,
byte for byte. Rows with the same doc_id and text count as one text given several times and are treated alike. A null doc_id comes before all others. Very long texts are
read whole. An empty table gives no rows. Columns of any name go along as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.storage import arrow_rows, materialize, reading, tables

MIN_WORDS = 30
#: Words in a row of which one is a cut, and the bytes of a word that are compared.
SPAN, HEAD = 11, 6
#: Bits of a place that count the pieces before the selected one; a piece's words are held in four bits of its mark.
AT = 16
assert SPAN < 16
#: Bytes of texts that are cut at a time, save for a longer single text.
SLAB = 1 << 20
BLANKS = b" \t\n\r\x0b\x0c"
_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)


_KNOWN: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _KNOWN or len(_KNOWN[base]) < n:
        out = np.full(max(n, 2 * SLAB), base, dtype=np.uint64)
        out[0] = 1
        _KNOWN[base] = np.cumprod(out)
    return _KNOWN[base][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def run_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run values[start:stop]: a polynomial by prefix sums, mixed with the length."""
    n = len(values) + 1
    sums = np.zeros(n, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, n)[1:], out=sums[1:])
    return _mixed((sums[stops] - sums[starts]) * _powers(_BACK, n)[starts] + (stops - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


@dataclass
class Pieces:
    """Words and pieces of some texts, one after the other: places in data, and which text, line and piece a word is of."""

    data: bytes
    bounds: np.ndarray  # where each text begins in data; the last is after the end
    start: np.ndarray  # of each word
    stop: np.ndarray
    line: np.ndarray
    first: np.ndarray  # of each piece: its first word; the last is after the end
    text: np.ndarray  # of each piece
    hash: np.ndarray  # of each piece

    @property
    def words(self) -> np.ndarray:
        return np.diff(self.first)

    @classmethod
    def of(cls, texts: list[bytes]) -> Pieces:
        data = b"\n".join(texts)
        bounds = np.concatenate(([0], np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))))
        raw = np.frombuffer(data, dtype=np.uint8)
        blank = np.concatenate(([True], (raw == 32) | ((raw >= 9) & (raw <= 13)), [True]))
        start, stop = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
        n, size = len(start), stop - start
        line = np.searchsorted(np.flatnonzero(raw == 10), start)
        key = np.minimum(size, 0xFFFF).astype(np.uint64) << np.uint64(8 * HEAD)
        for k in range(HEAD):
            at = np.flatnonzero(size > k)
            key[at] |= raw[start[at] + k].astype(np.uint64) << np.uint64(8 * (HEAD - 1 - k))
        begin = np.flatnonzero(line[: max(0, n - SPAN + 1)] == line[SPAN - 1 :])
        best, at = key[begin], begin.copy()
        for k in range(1, SPAN):
            here = key[begin + k]
            later = here >= best
            best[later], at[later] = here[later], begin[later] + k
        fresh = np.zeros(n + 1, dtype=bool)  # words that begin a piece
        fresh[at + 1] = True
        fresh[:1] = True
        fresh[1:n] |= line[1:] != line[:-1]
        fresh[n] = True
        first = np.flatnonzero(fresh)
        of_words = run_hashes(raw, start, stop)
        return cls(data, bounds, start, stop, line, first, np.searchsorted(bounds, start[first[:-1]], side="right") - 1, run_hashes(of_words, first[:-1], first[1:]))


def marks(p: Pieces) -> np.ndarray:
    """What is known of a piece elsewhere, in 32 bits: 28 of its hash, then its number of words."""
    return (p.hash.astype(np.uint32) & np.uint32(0xFFFFFFF0)) | p.words.astype(np.uint32)


def windows(small: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, selected) piece of each window, from the pieces' marks and texts."""
    n, words = len(small), (small & np.uint32(15)).astype(np.int64)
    upto = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    a = np.arange(n)
    b = np.searchsorted(upto, upto[:-1] + least) - 1
    ok = b < n
    ok[ok] = text[b[ok]] == text[a[ok]]
    from_on = np.where(ok, b, -1)
    e = np.arange(n)
    i = np.searchsorted(upto, upto[1:] - least, side="right") - 1
    ok = upto[1:] >= least
    ok[ok] = text[i[ok]] == text[e[ok]]
    ok[ok] = from_on[i[ok]] != e[ok]
    first = np.concatenate((a[from_on >= 0], i[ok]))
    last = np.concatenate((from_on[from_on >= 0], e[ok]))
    if not len(first):
        return first, last, first
    # minima of runs of 1, 2, 4, ... pieces: smallest hash, then rightmost place
    key = (small.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - a.astype(np.uint64))
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    pick, run = np.zeros(len(first), dtype=np.uint64), key
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        pick[at] = np.minimum(run[first[at]], run[last[at] - (1 << k) + 1])
        if len(run) > 1 << k:
            run = np.minimum(run[: -(1 << k)], run[1 << k :])
    return first, last, (np.uint64(0xFFFFFFFF) - (pick & np.uint64(0xFFFFFFFF))).astype(np.int64)


def _spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the spans, one after the other, and where each begins among them."""
    sizes = last - first + 1
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - ends + sizes, sizes), np.concatenate(([0], ends))


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * raw.itemsize).astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])


def _slabs(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The texts some at a time, with the number of the first."""
    begin, held, size = 0, [], 0
    for x in texts:
        held.append(x.as_py().encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= SLAB:
            yield begin, held
            begin, held, size = begin + len(held), [], 0
    if held:
        yield begin, held


def selections(docs: DataFrame, min_words: int) -> DataFrame:
    """id, h (xxhash64 of the text), pick (hash of a selected piece), place (number of the first piece around it, and in the low bits the pieces before the selected one), pieces (marks of
    those around it): a row for each selected piece of each text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in _slabs(batch.column(2)):
                p = Pieces.of(texts)
                small = marks(p)
                first, last, pick = windows(small, p.text, min_words)
                if not len(pick):
                    continue
                order = np.argsort(pick, kind="stable")
                picks, at = np.unique(pick[order], return_index=True)
                low, high = np.minimum.reduceat(first[order], at), np.maximum.reduceat(last[order], at)
                places, edges = _spans(low, high)
                text = p.text[picks]
                row = pa.array(begin + text)
                place = (low - np.searchsorted(p.text, text) << AT) + picks - low
                columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(p.hash[picks].view(np.int64)), pa.array(place), _binary(small[places], edges)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "h", "pick", "place", "pieces"])

    keyed = docs.where("text is not null").select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), "text")
    return keyed.mapInArrow(run, f"id {kind}, h long, pick long, place long, pieces binary")


def selecting_windows(found: DataFrame, min_words: int, certain: bool) -> DataFrame:
    """id, h, first, last (pieces), gram: the windows that each row's piece was selected by. certain: rows that meet an earlier id with the same pieces around the same
    selected one, as copies do, need no comparing: all their pieces are one span, with a null gram."""
    kind = found.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            small = np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype=np.uint32)
            sizes = pc.binary_length(batch.column(4)).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            place = batch.column(3).to_numpy()
            begins, at, begin, known = np.cumsum(sizes) - sizes, place & (1 << AT) - 1, place >> AT, np.zeros(len(sizes), dtype=bool)
            if certain:
                around = run_hashes(small, begins, begins + sizes) ^ _mixed(batch.column(2).to_numpy().view(np.uint64) + at.astype(np.uint64))
                rank = pc.rank(batch.column(0), null_placement="at_start", tiebreaker="min").to_numpy()
                _, group = np.unique(around, return_inverse=True)
                least = np.full(group.max() + 1, len(sizes) + 1, dtype=rank.dtype)
                np.minimum.at(least, group, rank)
                known = rank > least[group]
            row = np.repeat(np.arange(len(sizes)), sizes)
            open_ = ~known[row]
            small, row = small[open_], row[open_]
            begins = np.cumsum(np.where(known, 0, sizes)) - np.where(known, 0, sizes)
            first, last, pick = windows(small, row, min_words)
            own = row[first]
            mine = pick == begins[own] + at[own]
            first, last, own = first[mine], last[mine], own[mine]
            shift, whole = begin[own] - begins[own], np.flatnonzero(known)
            rows = pa.array(np.concatenate((own, whole)))
            grams = pa.array(np.concatenate((run_hashes(small, first, last + 1).view(np.int64), np.zeros(len(whole), dtype=np.int64))), mask=np.concatenate((np.zeros(len(own), dtype=bool), np.ones(len(whole), dtype=bool))))
            spans = [pa.array(np.concatenate(x), pa.int32()) for x in ((first + shift, begin[whole]), (last + shift, begin[whole] + sizes[whole] - 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *spans, grams], ["id", "h", "first", "last", "gram"])

    return found.select("id", "h", "pick", "place", "pieces").mapInArrow(run, f"id {kind}, h long, first int, last int, gram long")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, groups: DataFrame | None = None) -> DataFrame:
    """id, h (xxhash64 of the text), runs: the spans of pieces (first, last) to delete, of each text that has any; a written table."""
    with tables() as keep:
        with arrow_rows(docs.sparkSession, 1000):  # whole texts go to Python: a batch of few is enough
            found = keep(selections(docs, min_words), "lines-found")
        shared = keep(found.groupBy("pick").agg(F.count("*").alias("n")).where("n > 1").select("pick"), "lines-shared")
        # one plan at every size, as what is shared grows with the texts: tables of one row a key, hashed partition by partition, so that only what
        # finds a partner is sorted
        met = found.join(shared.hint("shuffle_hash"), "pick").sortWithinPartitions("pick")
        grown = selecting_windows(met, min_words, groups is None)
        place, other = F.struct("id", "first", "last", "h"), F.lit(True)
        if groups is not None:
            own = groups.groupBy(F.col("doc_id").alias("__id")).agg(F.min("component_id").alias("g"))
            grown = grown.join(own.hint("merge"), F.col("id").eqNullSafe(F.col("__id")), "left").drop("__id")
            place, other = F.when(F.col("id").eqNullSafe(F.col("g")), place), ~F.col("g").eqNullSafe(F.col("least.id"))
        grown = keep(grown, "lines-windows")
        first = grown.where("gram is not null").groupBy("gram").agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1 and least is not null").select("gram", "least")
        first = keep(first, "lines-first")
        both = grown.join(first.hint("shuffle_hash"), "gram")
        same_text = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("h") == F.col("least.h"))
        later = both.where(F.when(same_text, F.col("first") > F.col("least.last")).otherwise(other))
        spans = later.select("id", "h", "first", "last").unionByName(grown.where("gram is null").select("id", "h", "first", "last"))
        return materialize(spans.groupBy("id", "h").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("runs")), "lines-runs")


def without_runs(texts: list[bytes], runs: list[list[tuple[int, int]]]) -> list[bytes]:
    """The texts without the pieces of their runs."""
    p, out = Pieces.of(texts), []
    upto = np.searchsorted(p.text, np.arange(len(texts) + 1))
    zero = np.searchsorted(np.flatnonzero(np.frombuffer(p.data, dtype=np.uint8) == 10), p.bounds)
    for k, text in enumerate(texts):
        begin, end = int(upto[k]), int(upto[k + 1])
        drop = np.zeros(end - begin + 1, dtype=np.int64)
        for a, b in runs[k]:
            drop[a] += 1
            drop[b + 1] -= 1
        gone = np.repeat(np.cumsum(drop)[:-1] > 0, np.diff(p.first[begin : end + 1]))  # word by word
        if gone.all():
            out.append(b"")
            continue
        w = int(p.first[begin])
        start, stop, line = (x[w : w + len(gone)] for x in (p.start, p.stop, p.line))
        lines: list[bytes | None] = list(text.split(b"\n"))
        for number in np.unique(line[gone]).tolist():
            low, high = np.searchsorted(line, [number, number + 1])
            kept = np.flatnonzero(~gone[low:high]) + low
            # words that stay take the blanks along that come after them
            left = b"".join([p.data[start[x] : start[x + 1] if x + 1 < high else stop[x]] for x in kept.tolist()])
            lines[number - int(zero[k])] = left.rstrip(BLANKS) or None
        out.append(b"\n".join([x for x in lines if x is not None]))
    return out


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, groups: DataFrame | None = None) -> DataFrame:
    """The rows of docs with later copies of runs deleted from text; all other columns as they are.

    groups (doc_id, component_id: the smallest id of its group): documents that are copies as a whole and of which one is to be kept. What they share with each other
    doesn't count, and only the document of the smallest id can be the first occurrence of anything."""
    runs = repeated_runs(docs, min_words, groups)
    placed = runs.select(F.struct("id", "h").alias("__place"), F.col("runs").alias("__runs"))
    names = docs.columns
    # positional names, so that no column of docs can clash
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    text, doc_id = f"c{names.index('text')}", f"c{names.index('doc_id')}"
    keyed = plain.withColumn("__k", F.xxhash64(text)).alias("d")
    match = F.col(doc_id).eqNullSafe(F.col("__place.id")) & (F.col("__k") == F.col("__place.h"))
    # one plan at every size: the spans grow with the texts, so they aren't broadcast where they happen to be few
    joined = keyed.join(placed.hint("merge"), match, "left").drop("__k", "__place")

    @F.arrow_udf("string")
    def cut(old: pa.Array, spans: pa.Array) -> pa.Array:
        new, rows = [None] * len(old), np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)).tolist()
        for start in range(0, len(rows), 512):
            some = rows[start : start + 512]
            texts = [old[k].as_py().encode("utf-8", "surrogatepass") for k in some]
            for k, x in zip(some, without_runs(texts, [[(w["first"], w["last"]) for w in spans[k].as_py()] for k in some])):
                new[k] = x.decode("utf-8", "surrogatepass")
        return pa.array(new, pa.string())

    # only texts that lose something go through Python
    changed = F.col("__runs").isNotNull()
    out = joined.withColumn("__new", cut(F.when(changed, F.col(text)), F.col("__runs")))
    out = out.select(*[F.when(changed, F.col("__new")).otherwise(F.col(c)).alias(c) if c == text else F.col(c) for c in plain.columns])
    return reading(out.toDF(*names), runs)
