"""Token shards as wavelet matrices.

A shard file holds the ids of a range of documents as one bit-plane for each bit of the largest id. Plane by plane, from the
highest bit, ids with a zero bit move stably before those with a one bit; with rank and select on the planes, access to a position,
counting an id up to a position and finding its k-th place each take a step a plane, without decoding the shard.

File: the magic WVM1, the length of a JSON head (little-endian 32 bits), the head (n, width, zeros of each plane, sizes of the
sections), then zstd sections: document ids (Arrow stream), their starts (64 bits), and for each plane its bits (64-bit words, lowest first) and its rank
directory (ones before every 512th bit and of all, 32 bits), which is what rank and select go by: 1/16 of a bit for each bit. A plane stays packed until a query needs it.

Writing: documents are put in ranges of ascending doc_id (null first, equal ids by a hash of the text, so rows of one id may be in many ranges), each task writes its range
as files of about ``shard_tokens`` ids, and the table of files that the tasks return is summed to starts. Reading goes by that
table. A null text counts as empty: the end id alone. No documents: no files, no rows.

Texts are encoded by the tokenizers library. Where a tokenizer never looks across white space, which its settings say, a word has the same ids wherever it
stands, so words are encoded once a worker and looked up from then on (see :class:`Encoder`).

Rows that repeat an id are documents of their own. Very long texts are encoded whole. Columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.llm.lookup import Words
from scriptorium.llm.storage import materialize, scratch, task_fs, task_write

MAGIC = b"WVM1"
BLOCK = 512


def _pack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


class Plane:
    """Bits with rank and select by a directory of the ones before every 512th bit."""

    def __init__(self, words: np.ndarray, n: int, before: np.ndarray):
        self.words, self.n, self.before = words, n, before

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        packed = np.packbits(bits, bitorder="little")
        raw = np.zeros(-(-len(packed) // 8) * 8, dtype=np.uint8)
        raw[: len(packed)] = packed
        words = raw.view(np.uint64)
        starts = np.arange(0, len(words), BLOCK // 64)
        ones = np.add.reduceat(np.bitwise_count(words), starts, dtype=np.int64) if len(words) else starts
        return cls(words, len(bits), np.concatenate(([0], np.cumsum(ones))).astype("<u4"))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(bool)

    def get(self, i: int) -> int:
        return int(self.words[i >> 6] >> np.uint64(i & 63)) & 1

    def rank1(self, i: int) -> int:
        """Ones among the first i bits: those before the block, and those of the block's words."""
        block = i // BLOCK
        found = int(self.before[block])
        for w in range(block * (BLOCK // 64), i >> 6):
            found += int(self.words[w]).bit_count()
        return found + ((int(self.words[i >> 6]) & ((1 << (i & 63)) - 1)).bit_count() if i & 63 else 0)

    def rank(self, bit: int, i: int) -> int:
        return self.rank1(i) if bit else i - self.rank1(i)

    def select(self, bit: int, k: int) -> int:
        """The place of the k-th (from 0) bit of that value: the block by a binary search, then word by word."""
        low, high = 0, len(self.before) - 1
        held = lambda b: int(self.before[b]) if bit else min(b * BLOCK, self.n) - int(self.before[b])
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if held(mid) <= k else (low, mid)
        k -= held(low)
        w = low * (BLOCK // 64)
        while True:
            word = int(self.words[w]) if bit else ~int(self.words[w]) & ((1 << 64) - 1)
            if k < word.bit_count():
                break
            k, w = k - word.bit_count(), w + 1
        for _ in range(k):
            word &= word - 1
        return w * 64 + (word & -word).bit_length() - 1

    def directory(self) -> bytes:
        return self.before.tobytes()


class Planes:
    """The planes of a file, each unpacked when it's first asked for; at() gives one without keeping it."""

    def __init__(self, sections: list[tuple[bytes, bytes]], n: int):
        self.sections, self.n = sections, n
        self.open: dict[int, Plane] = {}

    def __len__(self) -> int:
        return len(self.sections)

    def at(self, k: int) -> Plane:
        bits, directory = self.sections[k]
        return Plane(np.frombuffer(_unpack(bits), dtype="<u8"), self.n, np.frombuffer(_unpack(directory), dtype="<u4"))

    def __getitem__(self, k: int) -> Plane:
        if not 0 <= k < len(self.sections):
            raise IndexError(k)
        if k not in self.open:
            self.open[k] = self.at(k)
        return self.open[k]


def _dealt(bits: np.ndarray, zeros: int, size: int = 1 << 16) -> Iterator[tuple[slice, slice, slice, np.ndarray, np.ndarray]]:
    """A stable deal by bits, in pieces that stay in the processor's cache: a piece, where its zeros and its ones go, and their places in
    the piece. (Going by number is several times faster than by truth value.)"""
    a, b = 0, zeros
    for at in range(0, len(bits), size):
        part = bits[at : at + size]
        i, j = np.flatnonzero(~part), np.flatnonzero(part)
        yield slice(at, at + size), slice(a, a + len(i)), slice(b, b + len(j)), i, j
        a, b = a + len(i), b + len(j)


class Matrix:
    """A wavelet matrix over n ids of width bits."""

    def __init__(self, n: int, width: int, zeros: list[int], planes: list[Plane] | Planes):
        self.n, self.width, self.zeros, self.planes = n, width, zeros, planes

    @classmethod
    def build(cls, ids: np.ndarray) -> Matrix:
        width = max(1, int(ids.max(initial=0)).bit_length())
        now, zeros, planes = ids.astype(np.uint16 if width <= 16 else np.uint32), [], []
        then = np.empty_like(now)
        for level in range(width - 1, -1, -1):
            bits = now & now.dtype.type(1 << level) != 0
            planes.append(Plane.of(bits))
            zeros.append(len(now) - int(np.count_nonzero(bits)))
            for here, low, high, i, j in _dealt(bits, zeros[-1]):
                part = now[here]
                then[low], then[high] = part.take(i), part.take(j)
            now, then = then, now
        return cls(len(ids), width, zeros, planes)

    def access(self, i: int) -> int:
        out = 0
        for zeros, p in zip(self.zeros, self.planes):
            bit = p.get(i)
            out = out << 1 | bit
            i = zeros + p.rank1(i) if bit else i - p.rank1(i)
        return out

    def rank(self, token: int, i: int) -> int:
        """How often token occurs among the first i ids."""
        if token >> self.width or not self.n:
            return 0
        start, end = 0, i
        for k, (zeros, p) in enumerate(zip(self.zeros, self.planes)):
            bit = token >> (self.width - 1 - k) & 1
            start, end = p.rank(bit, start) + zeros * bit, p.rank(bit, end) + zeros * bit
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence of token."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        start = 0
        for j, (zeros, p) in enumerate(zip(self.zeros, self.planes)):
            bit = token >> (self.width - 1 - j) & 1
            start = p.rank(bit, start) + zeros * bit
        at = start + k
        for j in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - j) & 1
            at = self.planes[j].select(bit, at - self.zeros[j] * bit)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids: the planes' moves undone from the lowest bit up."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        now, then = np.zeros(self.n, dtype=kind), np.empty(self.n, dtype=kind)
        once = self.planes.at if isinstance(self.planes, Planes) else self.planes.__getitem__
        for level, zeros in enumerate(reversed(self.zeros)):
            p = once(self.width - 1 - level)
            for here, low, high, i, j in _dealt(p.bits(), zeros):
                part = then[here]
                part[i], part[j] = now[low], now[high] | kind(1 << level)
            now, then = then, now
        return now.astype(np.uint32)


def dump(ids: np.ndarray, doc_ids: pa.Array, starts: np.ndarray) -> bytes:
    """One shard file."""
    matrix = Matrix.build(ids)
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([doc_ids], ["doc_id"])
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    sections = [_pack(sink.getvalue().to_pybytes()), _pack(starts.astype("<i8").tobytes())]
    for p in matrix.planes:
        sections += [_pack(p.words.astype("<u8").tobytes()), _pack(p.directory())]
    head = json.dumps({"n": matrix.n, "width": matrix.width, "zeros": matrix.zeros, "sizes": [len(s) for s in sections]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *sections])


def load(data: bytes) -> tuple[Matrix, pa.Array, np.ndarray]:
    """The matrix, document ids and starts of a shard file. Its planes stay packed until they're asked for."""
    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    size = int.from_bytes(data[4:8], "little")
    head, at, sections = json.loads(data[8 : 8 + size]), 8 + size, []
    for n in head["sizes"]:
        sections.append(memoryview(data)[at : at + n])
        at += n
    doc_ids = pa.ipc.open_stream(_unpack(sections[0])).read_all().column(0).combine_chunks()
    planes = Planes(list(zip(sections[2::2], sections[3::2])), head["n"])
    return Matrix(head["n"], head["width"], head["zeros"], planes), doc_ids, np.frombuffer(_unpack(sections[1]), dtype="<i8")


#: A full stop or comma between an ASCII letter and a blank: a pre-token of its own.
STOP = re.compile(rb"([.,])(?<=[a-z].)(?=[ \n])")
#: Begin combining marks, which the normaliser may join to a letter, and special tokens, whose case counts.
DELICATE = (b"\xcc", b"\xcd", b"<|")
# Settings of a tokenizer for which the short ways hold. White space is composed to blanks and dropped, text put in lower case, and cut at letters, digits and other
# signs, so nothing is looked at across a blank and words of lower-case letters are one piece. They're compared whole with the tokenizer's own.
WORDS_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORDS_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
WORDS_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
WORDS_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}


class Encoder:
    """Ids of whole texts, word by word, where a tokenizer allows it.

    To look up fewer different words, ASCII letters are put in lower case first, as the normaliser does after composing, and stops are set apart,
    unless a text holds something that makes a difference there. A new word of lower-case letters goes straight to the library's model, as its
    normaliser and pre-tokenizer leave it whole; any other word goes through all of the tokenizer. Other tokenizers encode texts as a whole."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        #: byte-level models show other bytes as the code points from 256 on
        self.shown = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.words = Words(self._word)
        with open(path, encoding="utf-8") as f:
            known = json.load(f)
        model = {k: v for k, v in known["model"].items() if k not in ("vocab", "merges")}
        specials = all(t["special"] and not t["normalized"] and t["content"].startswith("<|") for t in known["added_tokens"])
        #: whether words are encoded one by one, and words of letters by the model alone
        self.by_word = specials and known["normalizer"] == WORDS_NORMALIZER and known["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [WORDS_SPLIT, WORDS_BYTES]} and model == WORDS_MODEL

    def _plain(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _straight(self, word: bytes) -> bytes:
        return _packed([t.id for t in self.model.tokenize(word.decode() if word.isascii() else word.decode("latin-1").translate(self.shown))])

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        if text.isalpha() and text == text.lower() and (word.isascii() or unicodedata.is_normalized("NFC", text)):
            return self._straight(word)
        return self._plain(text)

    def _by_word(self, text: str) -> bytes:
        data = text.encode("utf-8")
        if not any(x in data for x in DELICATE):
            data = STOP.sub(rb" \1", data.lower())
        return b"".join(map(self.words.find, data.split()))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian 32-bit numbers."""
        self.words.trim()
        return (self._by_word if self.by_word else self._plain)(text or "")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, shard_tokens: int = 1 << 22, folder: str | None = None) -> DataFrame:
    """Writes the texts' ids; returns the table of files: shard (from 0, in order), path, n_docs, n_tokens, start."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, code = TaskContext.get().partitionId(), encoder(tokenizer)
        ids, names, held, seq, end = [], [], 0, 0, end_id.to_bytes(4, "little")

        def flush():
            starts = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)))
            doc_ids = pa.concat_arrays(names)
            path = task_write(folder, f"{part:06d}-{seq:06d}", dump(np.frombuffer(b"".join(ids), dtype="<u4"), doc_ids, starts))
            row = {"part": [part], "seq": [seq], "path": [path], "n_docs": [len(doc_ids)], "n_tokens": [int(starts[-1])]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            taken = 0
            for k, x in enumerate(batch.column(1)):
                ids.append(code.encode(x.as_py()) + end)
                held += len(ids[-1]) // 4
                if held >= shard_tokens:
                    names.append(batch.column(0).slice(taken, k + 1 - taken))
                    yield flush()
                    ids, names, held, seq, taken = [], [], 0, seq + 1, k + 1
            if taken < batch.num_rows:
                names.append(batch.column(0).slice(taken))
        if ids:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows of one id, or without one, are told apart by their texts, so they aren't all one task's
    order = F.col("doc_id").asc_nulls_first(), F.xxhash64(F.coalesce("text", F.lit("")))
    dealt = docs.select("doc_id", "text").repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    files = materialize(dealt.mapInArrow(run, "part long, seq long, path string, n_docs long, n_tokens long"), "shard-files")
    # a row for each part, at most as many as partitions; files are numbered within their part
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("f"))
    over = Window.orderBy("part")
    before = parts.select("part", (F.sum("t").over(over) - F.col("t")).alias("t0"), (F.sum("f").over(over) - F.col("f")).alias("f0"))
    order = Window.partitionBy("part").orderBy("seq")
    placed = files.join(F.broadcast(before), "part")
    return placed.select((F.col("f0") + F.row_number().over(order) - 1).alias("shard"), "path", "n_docs", "n_tokens", (F.col("t0") + F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("start"))


def read_shards(spark: SparkSession, files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers), from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, name = task_fs(path)
                with system.open_input_stream(name, compression=None) as f:
                    matrix, doc_ids, starts = load(f.read())
                raw = memoryview(matrix.decode().astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(starts[:-1] + start), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = materialize(files.select("path", "start"), "shard-starts").repartition(parts, "path")
    return dealt.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
