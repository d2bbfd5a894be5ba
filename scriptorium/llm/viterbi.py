"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is a lattice of pieces; the search keeps one back pointer for each boundary between code points, to the piece that ends there on the
best path. It goes code point by code point and holds a window of boundaries only: a boundary further back than the longest piece can't be
reached any more, and as soon as the surviving paths (from each of the last ``longest`` boundaries) all run through one boundary, the ids before it are
final, are given out and forgotten. (That is looked for at every eighth boundary.) So memory depends on how long paths disagree, not on the text.

What a path is worth depends on the model. Of a **unigram** model it's the sum of its pieces' scores, as fixed-point numbers, so that sums are exact; ties go to the
longer last piece. Scores of a **BPE** model are ranks of merges and no sum of them means anything; there, a step from piece to piece is worth nothing
if merging would leave the two apart, and is forbidden if it would join across them. Exactly one path without a forbidden step leads to each
boundary, and it's the merges' own result: ids are those of the ``sentencepiece`` library.

Many stretches are searched side by side, one code point of each at a step, as arrays. A text is cut into stretches only where no piece holds the two code
points next to each other, which every path has as a boundary (before a mark of white space, for instance), at least ``STRETCH`` code points apart.

Normalisation is the model's own (white space marked by U+2581, one put before the text; nothing else changed). A code point that is no
piece costs ``UNKNOWN`` below the least score and becomes its UTF-8 byte pieces.

Defined results: a null text counts as empty, which has no ids. Decoding gives back every text exactly; a text that holds U+2581 itself gives spaces there.
Repeated rows and equal ids give a row each, all alike. Texts of any length are read whole. An empty table gives no rows. Columns other than
the id and the text are neither read nor returned, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN = 10.0
#: Scores are multiples of this.
UNIT = 2.0**-20
NEVER = -(1 << 60)
#: Least code points in a stretch, and code points searched side by side at most, save for a longer single text.
STRETCH, TOGETHER = 512, 1 << 20
#: Steps between looks for a common boundary.
LOOK = 8
#: Pairs of pieces whose verdict is kept in the table that whole arrays are looked up in (a power of two).
PAIRS = 1 << 20
EMPTY = -1


class Model:
    """Pieces of a sentencepiece model, and what the search needs of them."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        names = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.by_bytes({int(p[3:5], 16): i for i, p in enumerate(names) if sp.is_byte(i)}, names, sp.unk_id())
        self.compile({p: (sp.get_score(i), i) for i, p in enumerate(names) if not special(i)})

    @classmethod
    def of(cls, scores: dict[str, float], merges: bool = False) -> Model:
        """A model from pieces and scores; ids in the order given, byte pieces after them."""
        self = cls.__new__(cls)
        names = [*scores, *(f"<0x{b:02X}>" for b in range(256))]
        self.by_bytes({b: len(scores) + b for b in range(256)}, names, len(names))
        self.compile({p: (s, i) for i, (p, s) in enumerate(scores.items())}, merges)
        return self

    def by_bytes(self, ids: dict[int, int], names: list[str], unk: int) -> None:
        self.bytes, self.names, self.unk = ids, names, unk
        self.byte_of = {i: b for b, i in ids.items()}
        #: byte pieces that are part of a code point only, and the text of all other pieces
        self.high = frozenset(i for b, i in ids.items() if b > 127)
        self.texts = [chr(self.byte_of[i]) if i in self.byte_of else p for i, p in enumerate(names)]

    def compile(self, scores: dict[str, tuple[float, int]], merges: bool | None = None) -> None:
        self.scores = scores
        own = sorted({s for s, _ in scores.values() if s > -1e8})
        #: ranks of merges are whole numbers, one each
        self.merges = all(s == int(s) for s in own) and len(own) > len(scores) / 2 if merges is None else merges
        pieces = self.pieces = list(scores)
        self.index = {p: k for k, p in enumerate(pieces)}
        self.none, self.start = len(pieces), len(pieces) + 1  # a code point that is no piece; the begin of a stretch
        self.ids = np.array([scores[p][1] for p in pieces] + [-2, -3], dtype=np.int32)
        self.sizes = np.array([len(p) for p in pieces] + [1, 0], dtype=np.int64)
        self.longest = int(self.sizes.max())
        floor = min(s for s, _ in scores.values() if s > -1e8) - UNKNOWN
        self.worth = np.array([round(max(s, -1e8) / UNIT) for s, _ in scores.values()] + [round(floor / UNIT), 0], dtype=np.int64)
        if self.merges:
            self._trees()
        self._automaton([p for p in pieces if not self.merges or len(p) == 1 or self.left[self.index[p]] >= 0])
        #: of pairs met so far: twice the pair's number, and 1 if a step may lead through it
        self.pairs = np.full(PAIRS, -1, dtype=np.int64)
        #: code points searched, steps of the search, and boundaries held at most, so far
        self.searched, self.steps, self.widest = 0, 0, 0

    def _trees(self) -> None:
        """Rank of each piece (0 the first merge; code points -1) and the two pieces that it's merged from (-1: code points, and pieces that merging never gives)."""
        order = sorted({s for p, (s, _) in self.scores.items() if len(p) > 1}, reverse=True)
        place = {s: k for k, s in enumerate(order)}
        self.rank = [-1 if len(p) == 1 else place[s] for p, (s, _) in self.scores.items()]
        self.left, self.right = [-1] * len(self.rank), [-1] * len(self.rank)
        for k, p in sorted(enumerate(self.scores), key=lambda x: (self.rank[x[0]], len(x[1]))):
            for at in range(len(p) - 1, 0, -1):
                a, b = self.index.get(p[:at], -1), self.index.get(p[at:], -1)
                if a < 0 or b < 0 or any(len(x) > 1 and self.left[self.index[x]] < 0 for x in (p[:at], p[at:])):
                    continue
                if self.rank[a] <= self.rank[k] and self.rank[b] <= self.rank[k] and self._apart(a, b, True):
                    self.left[k], self.right[k] = a, b
                    break

    def _apart(self, a: int, b: int, joined: bool = False) -> bool:
        """Whether merges of the text of two pieces give these two (joined: give them before a last merge of both). Goes back in time: the last merge
        within either is undone, and each pair that meets at the cut must not have been merged while it stood there."""
        pieces, index, rank, after_a, after_b = self.pieces, self.index, self.rank, 1 << 60, 1 << 60
        while True:
            if not joined:
                both = index.get(pieces[a] + pieces[b])
                # of equal ranks the leftmost is merged first
                if both is not None and rank[both] < after_a and rank[both] <= after_b:
                    return False
            joined = False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                after_a, a = rank[a], self.right[a]
            else:
                after_b, b = rank[b], self.left[b]

    def _automaton(self, pieces: list[str]) -> None:
        """States are beginnings of pieces. After each code point the state is the longest beginning that the text ends with; piece is the longest piece that
        the state ends with, shorter the state of the next shorter one (-1: none). The last state of a chain is one code point, or 0 for one that is no piece."""
        states = {"": 0}
        for p in sorted(pieces, key=len):
            for k in range(1, len(p) + 1):
                states.setdefault(p[:k], len(states))
        joined = sorted({c for p in pieces if len(p) > 1 for c in p})
        self.wide = len(joined) + 1
        classes = {c: k for k, c in enumerate(joined)}
        #: class of each code point: those in longer pieces have their own, all others the last one
        self.class_of = np.full(0x110001, self.wide - 1, dtype=np.uint16)
        self.class_of[[ord(c) for c in joined]] = np.arange(len(joined))
        #: state after a code point of the last class, whatever was before
        self.single = np.zeros(0x110001, dtype=np.int32)
        for p in pieces:
            if len(p) == 1 and p not in classes:
                self.single[ord(p)] = states[p]
        children: dict[int, list[tuple[int, int]]] = {}
        parents = np.zeros(len(states), dtype=np.int64)
        for s, i in states.items():
            if s and s[-1] in classes:
                children.setdefault(states[s[:-1]], []).append((classes[s[-1]], i))
                parents[i] = states[s[:-1]]
        table = np.zeros((len(states), self.wide), dtype=np.int32)
        fail = np.zeros(len(states), dtype=np.int64)
        self.piece, self.shorter = np.full(len(states), self.none, dtype=np.int32), np.full(len(states), -1, dtype=np.int32)
        for s, i in sorted(states.items(), key=lambda x: len(x[0])):
            if i:
                if len(s) > 1:
                    # the parent's row was copied from its own fallback before its children were put in
                    fail[i] = table[fail[parents[i]], classes[s[-1]]]
                table[i] = table[fail[i]]
            for c, child in children.get(i, ()):
                table[i, c] = child
            f = int(fail[i])
            known = s in self.index and (len(s) == 1 or not self.merges or self.left[self.index[s]] >= 0)
            if known:
                self.piece[i] = self.index[s]
                # f ends a chain itself where it's the root: a code point that is a piece ends its chain
                self.shorter[i] = -1 if len(s) == 1 else f
            elif i:
                self.piece[i], self.shorter[i] = self.piece[f], self.shorter[f]
        self.table = (table.astype(np.uint16) if len(states) <= 1 << 16 else table).ravel()
        #: which classes stand next to each other in a piece
        self.meet = np.zeros((self.wide, self.wide), dtype=bool)
        for p in pieces:
            for a, b in zip(p, p[1:]):
                self.meet[classes[a], classes[b]] = True

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of pieces a step may lead through."""
        key = a * np.int64(self.start + 1) + b
        slot = (key * 0x9E3779B1 >> 7) & (PAIRS - 1)
        known = self.pairs[slot]
        new = np.flatnonzero(known >> 1 != key)
        for k in new.tolist():
            x, y = int(a[k]), int(b[k])
            known[k] = 2 * key[k] + (x >= self.none or y >= self.none or self._apart(x, y))
        self.pairs[slot[new]] = known[new]
        return known & 1 == 1

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each whole text."""
        out: list[np.ndarray] = []
        part: list[str] = []
        size = 0
        for t in texts:
            part.append(t or "")
            size += len(part[-1])
            if size >= TOGETHER:
                out += self._encode(part)
                part, size = [], 0
        return out + self._encode(part) if part else out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        codes = np.frombuffer("".join(MARK + t if t else "" for t in texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
        codes[codes == 32] = ord(MARK)
        sizes = np.array([len(t) + bool(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        if not len(codes):
            return [np.array([], dtype="<i4") for _ in texts]
        kinds = self.class_of[codes]
        found = self._search(codes, kinds, self._cuts(kinds, ends[sizes > 0]))
        at = np.flatnonzero(found != EMPTY)
        ids = found[at]
        counts = np.ones(len(ids), dtype=np.int64)
        if (odd := np.flatnonzero(ids == -2)).size:
            given = {c: self.ids_of(chr(c)) for c in np.unique(codes[at[odd]]).tolist()}
            each = [given[c] for c in codes[at[odd]].tolist()]
            counts[odd] = [len(x) for x in each]
            ids = np.repeat(ids, counts)
            ids[ids == -2] = [i for x in each for i in x]
        upto = np.concatenate(([0], np.cumsum(counts)))[np.searchsorted(at, np.concatenate(([0], ends)))]
        ids = ids.astype("<i4")
        return [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def _cuts(self, kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where stretches begin, and the end of the last: at each text's begin, and from STRETCH code points on at the first boundary that every path has."""
        sure = np.flatnonzero(~self.meet[kinds[:-1], kinds[1:]]) + 1
        out, begin = [0], 0
        for end in ends.tolist():
            while end - begin > STRETCH:
                k = int(np.searchsorted(sure, begin + STRETCH))
                if k == len(sure) or sure[k] >= end:
                    break
                begin = int(sure[k])
                out.append(begin)
            out.append(end)
            begin = end
        return np.array(out, dtype=np.int64)

    def _search(self, codes: np.ndarray, kinds: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """For each code point the id of the piece that ends with it on the best path, else EMPTY. Stretches lie side by side, longest first."""
        out = np.full(len(codes), EMPTY, dtype=np.int32)
        size = np.diff(cuts)
        order = np.argsort(-size, kind="stable")
        begin, size = cuts[:-1][order], size[order]
        ring, many = 1 << (4 * self.longest - 1).bit_length(), len(begin)
        token = np.full((ring, many), self.start, dtype=np.int32)  # the piece that ends at a boundary
        anchor = np.full((ring, many), -1, dtype=np.int32)  # the first boundary of its path since the last look that found one
        total = np.zeros((ring, many), dtype=np.int64)
        base, state, lanes = np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int32), np.arange(many)
        anchor[0] = 0
        single = self.single[codes] if (kinds == self.wide - 1).any() else None
        self.searched += len(codes)

        def give_out(who: np.ndarray, end: np.ndarray) -> None:
            """The path from each lane's boundary back to what was given out before."""
            stop = base[who].copy()
            base[who] = end
            while len(who := who[go := end > stop]):
                end, stop = end[go], stop[go]
                last = token[end & (ring - 1), who]
                out[begin[who] + end - 1] = self.ids[last]
                end = end - self.sizes[last]

        now = many
        for e in range(1, int(size[0]) + 1):
            at = begin[:now] + (e - 1)
            kind = kinds[at]
            state = self.table[state[:now] * np.int64(self.wide) + kind]
            if single is not None:
                state = np.where(kind == self.wide - 1, single[at], state)
            row = e & (ring - 1)
            who, here = lanes[:now], state
            best = np.full(now, NEVER, dtype=np.int64)
            pick = np.full(now, self.none, dtype=np.int32)
            while len(who):
                p = self.piece[here]
                back = (e - self.sizes[p]) & (ring - 1)
                if self.merges:
                    ok = self.apart(token[back, who], p)
                    pick[who[ok]] = p[ok]
                    here = self.shorter[here]
                    left = ~ok & (here >= 0)
                else:
                    sums = total[back, who] + self.worth[p]
                    ok = sums > best[who]  # longer pieces come first
                    best[who[ok]], pick[who[ok]] = sums[ok], p[ok]
                    here = self.shorter[here]
                    left = here >= 0
                who, here = who[left], here[left]
            token[row, :now], total[row, :now] = pick, best
            before = anchor[(e - self.sizes[pick]) & (ring - 1), lanes[:now]]
            anchor[row, :now] = np.where(before >= 0, before, e)
            self.steps += now
            if e % LOOK == 0:
                last = anchor[[b & (ring - 1) for b in range(max(0, e - self.longest + 1), e + 1)], :now]
                low = last.min(axis=0)
                who = np.flatnonzero((low >= 0) & (low == last.max(axis=0)))
                give_out(who, low[who].astype(np.int64))
                anchor[:, who] = -1
                anchor[row, who] = e
                held = e - int(base[:now].min())
                self.widest = max(self.widest, held)
                if held + LOOK + 1 >= ring:  # paths that disagree for long: a longer window
                    token, anchor, total = (_longer(x, ring, e) for x in (token, anchor, total))
                    ring *= 2
            if size[now - 1] == e:
                rest = int(np.searchsorted(-size[:now], -e))
                give_out(lanes[rest:now], size[rest:now])
                now = rest
        return out

    def ids_of(self, char: str) -> tuple[int, ...]:
        """The ids of a code point that is no piece."""
        found = tuple(self.bytes.get(b, self.unk) for b in char.encode("utf-8", "surrogatepass"))
        return (self.unk,) if self.unk in found else found

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: byte pieces joined to code points, marks to spaces, without the first."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        if self.high.isdisjoint(ids):
            return "".join(map(self.texts.__getitem__, ids)).replace(MARK, " ")[1:]
        out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            out.append(self.names[i])
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")[1:]


def _longer(rows: np.ndarray, ring: int, e: int) -> np.ndarray:
    """A window of twice the length, with the boundaries up to e where they belong."""
    out = np.full((2 * ring, rows.shape[1]), -1, dtype=rows.dtype)
    for b in range(max(0, e - ring + 1), e + 1):
        out[b & (2 * ring - 1)] = rows[b & (ring - 1)]
    return out


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list]]:
    """Ids and texts of a batch, few enough at a time to lie side by side."""
    for at in range(0, batch.num_rows, 512):
        part = batch.slice(at, 512)
        yield part.column(0), part.column(1).to_pylist()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, ids (array<int>) of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for names, texts in _parts(batch):
                yield pa.RecordBatch.from_arrays([names, pa.array(m.encode_all(texts), pa.list_(pa.int32()))], [id_col, "ids"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, text of each row of ids."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [m.decode(x.values.to_pylist() if x.is_valid else []) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (ids as little-endian 32-bit numbers), decoded_sha256 of each row: encoded, then decoded from the ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import zlib

        m = model(path)
        for batch in batches:
            for names, texts in _parts(batch):
                each = m.encode_all(texts)
                crcs = [zlib.crc32(ids.tobytes()) for ids in each]
                back = [hashlib.sha256(m.decode(ids).encode()).hexdigest() for ids in each]
                yield pa.RecordBatch.from_arrays([names, pa.array([len(ids) for ids in each], pa.int64()), pa.array(crcs, pa.int64()), pa.array(back, pa.string())], ["doc_id", "n_ids", "ids_crc32", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_ids long, ids_crc32 long, decoded_sha256 string")
