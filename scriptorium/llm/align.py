"""Alignment of two tokenizers' tokens, as joins and windows over tokens in rows.

Some places cut a text so that neither tokenizer joins anything across: before a blank or a line end that follows something that is no white space, and between a letter and a full stop or comma at a word's end. So
a text is a row of parts whose tokens depend on the part alone. Each different part is encoded once and aligned once: its tokens are rows (posexplode), running sums of their byte lengths give their ends, equal ends of a part
meet (an outer equi-join on part and end: both sides' tokens in one table, grouped by these), and the running count of ends that both have numbers the groups. Between two neighbouring ends of either kind there's one token
of each side, so each row of that join is one link, of the nearest tokens that end there or later, filled in by a window. That's the range join of the overlapping tokens of a group, without a row for any pair that doesn't overlap.

A text is then what its parts are, in order. A first pass cuts texts into blocks of a few MB, each with its different parts and, for each document, the numbers of its parts: texts are read once and never shuffled. Links
meet the blocks by a join on the part; adding up over a document is NumPy within a block, whose numbers stand in a file of its own, each attempt's under its own name, so they aren't shuffled. Pairs are counted in two steps, in a block and
over blocks, and a pair's count goes back to the blocks that hold it.

Defined results: null and empty texts, and texts of which the joined bytes of either tokenizer's tokens aren't a blank and the text (U+2581 is read back as a blank), have zeros and an empty groups_sha256, and don't count for any pair. Every row is a
document of its own, rows of equal, null or repeated ids included; ids are carried along as they are. Ties for an A id's highest count are all best. A very long text is a block of its own; a very long word is one part, whose tokens are
rows like any other. No rows: no rows. Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.storage import discard, materialize, reading, tables, task_fs, task_write
from scriptorium.sources.shared import scratch

#: Code points of a block, and its documents, about.
BLOCK, BLOCK_DOCS = 1 << 24, 1 << 18
#: Stands between parts while a text is cut.
BAR = "\x01"
SPACES = "".join(rf"\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace())
#: What needs the full pattern: white space before a blank or a line end, also at the beginning, and the bar itself.
ODD = rf"^[ \n]|[{SPACES}][ \n]|{BAR}"
CUT = regex.compile(r"(?<=\S)(?=[ \n])", regex.V1)
MARK = regex.compile(r"(?<=\p{L})(?=[.,]$)")
#: What's said of a link beside its tokens: that its A token, its B token ends with it.
A_ENDS, B_ENDS = 2, 1
#: A token is one number: its side, its length in bytes (31 bits), its id (32 bits).
SIDE, LENGTH, ID = 63, 32, 0xFFFFFFFF


def parts(text: str) -> list[str]:
    """The parts of a text; joined they're the text. An empty text has none."""
    return [x for p in CUT.split(text) for x in MARK.split(p) if x]


def cut_texts(texts: pa.Array) -> pa.ListArray:
    """The parts of a blank and each text; null for null and empty texts."""
    odd = pc.fill_null(pc.or_(pc.equal(pc.binary_length(texts), 0), pc.match_substring_regex(texts, ODD)), False).to_numpy(zero_copy_only=False)
    barred = pc.replace_substring(pc.replace_substring(texts, " ", BAR + " "), "\n", BAR + "\n")
    barred = pc.replace_substring_regex(barred, rf"(\pL)([.,])({BAR}|$)", rf"\1{BAR}\2\3")
    found = pc.split_pattern(pc.binary_join_element_wise(" ", barred, ""), BAR)
    if not odd.any():
        return found
    rows = [pa.array([parts(" " + text) if text else None], pa.list_(pa.string())) for text in (texts[k].as_py() for k in np.flatnonzero(odd).tolist())]
    ends = [-1, *np.flatnonzero(odd).tolist()]
    pieces = []
    for before, k, row in zip(ends, ends[1:], rows):
        pieces += [found.slice(before + 1, k - before - 1), row]
    return pa.concat_arrays([*pieces, found.slice(ends[-1] + 1)])


class Pair:
    """Two tokenizers and the bytes of their entries."""

    def __init__(self, a: str, b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        # Byte-level entries show bytes that can be printed as themselves, the others from U+0100 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        table = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in set(shown))}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(table[c] for c in entry) if all(c in table for c in entry) else entry.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.lengths = [np.array([len(x) for x in side], dtype=np.int32) for side in (self.a_bytes, self.b_bytes)]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, found: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of parts."""
        a = [e.ids for e in self.a.encode_batch_fast(found, add_special_tokens=False)]
        # behind a line end, which nothing is joined with, a part stands as it does within a text; the line end and the blank before it are the first two ids
        return a, [ids[2:] for ids in self.b.encode(["\n" + p for p in found], num_threads=1)]

    def given_back(self, found: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Which parts the bytes of both sides' tokens come to."""
        joined = lambda side, ids: b"".join([side[i] for i in ids])
        every = "".join(found).encode()
        if joined(self.a_bytes, itertools.chain.from_iterable(a)) == every == joined(self.b_bytes, itertools.chain.from_iterable(b)):
            sizes = np.array([len(p.encode()) for p in found])
            own = [np.array([sum(self.lengths[side][ids]) if ids else 0 for ids in x]) for side, x in ((0, a), (1, b))] if any(not p.isascii() for p in found) else None
            if own is None or ((own[0] == sizes) & (own[1] == sizes)).all():
                return np.ones(len(found), dtype=bool)
        return np.array([joined(self.a_bytes, x) == p.encode() == joined(self.b_bytes, y) for p, x, y in zip(found, a, b)], dtype=bool)


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(a: str, b: str) -> Pair:
    if (a, b) not in _PAIRS:
        _PAIRS[a, b] = Pair(a, b)
    return _PAIRS[a, b]


def squeezed(numbers: np.ndarray) -> bytes:
    """Whole numbers, compressed byte plane by byte plane."""
    import zstandard

    wide = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(wide.tobytes())


def opened(data: bytes, kind: str) -> np.ndarray:
    import zstandard

    raw, size = zstandard.ZstdDecompressor().decompress(data), np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _put(folder: str, name: str, columns: dict[str, pa.Array]) -> str:
    """In a task: columns of any lengths as a file in the shared folder; its address."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(v)], v) for v in columns.values()], list(columns))
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return task_write(folder, name, sink.getvalue().to_pybytes())


def _got(path: str) -> dict[str, pa.Array]:
    system, name = task_fs(path)
    with system.open_input_stream(name, compression=None) as f:
        table = pa.ipc.open_stream(f.read()).read_all()
    return {c: table.column(c).combine_chunks().flatten() for c in table.column_names}


def blocks(docs: DataFrame, folder: str) -> DataFrame:
    """block, path, parts (the different ones, by number): a row for each few MB of texts. The file has ids and sizes (parts) of the documents and codes, the numbers of their parts in order."""

    def row(number: int, ids: list[pa.Array], cut: list[pa.ListArray]) -> pa.RecordBatch:
        flat = pa.concat_arrays([x.flatten() for x in cut]).dictionary_encode()
        sizes = pc.fill_null(pc.list_value_length(pa.concat_arrays(cut)), 0)
        found, codes = flat.dictionary, flat.indices.to_numpy()
        # frequent parts have small numbers, which take less room
        order = np.argsort(-np.bincount(codes, minlength=len(found)), kind="stable")
        rank = np.empty(len(found), dtype="<i4")
        rank[order] = np.arange(len(found))
        path = _put(folder, f"codes-{number:x}", {"ids": pa.concat_arrays(ids), "sizes": sizes, "codes": pa.array([squeezed(rank[codes])])})
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([path]), pa.ListArray.from_arrays([0, len(found)], found.take(pa.array(order)))], ["block", "path", "parts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        ids, cut, held, rows = [], [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                ids.append(some.column(0))
                cut.append(cut_texts(some.column(1)))
                held, rows = held + some.column(1).nbytes, rows + some.num_rows
                if held >= BLOCK or rows >= BLOCK_DOCS:
                    yield row(next(numbers), ids, cut)
                    ids, cut, held, rows = [], [], 0, 0
        if ids:
            yield row(next(numbers), ids, cut)

    return docs.select("doc_id", "text").mapInArrow(run, "block long, path string, parts array<string>")


def key_of(part: str) -> Column:
    """A part, or the hash of a long one, so that the rows of its tokens don't carry it."""
    return F.when(F.octet_length(part) <= 64, F.col(part)).otherwise(F.concat(F.lit("\n\n"), F.sha2(F.col(part).cast("binary"), 256)))


def encoded(found: DataFrame, a: str, b: str) -> DataFrame:
    """key, tokens (array<long>, those of A first) of different parts; parts that aren't given back have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        for batch in batches:
            own = batch.column(1).to_pylist()
            x, y = pair.encode(own)
            ok = pair.given_back(own, x, y)
            if not ok.all():
                x, y = ([ids if good else [] for ids, good in zip(side, ok)] for side in (x, y))
            sizes = np.array([[len(i) for i in x], [len(i) for i in y]], dtype=np.int64).reshape(2, -1)
            flat = np.fromiter(itertools.chain.from_iterable(itertools.chain.from_iterable(zip(x, y))), dtype=np.int32, count=sizes.sum())
            side = np.repeat(np.tile(np.array([0, 1]), len(own)), sizes.T.ravel())
            length = np.where(side == 0, pair.lengths[0][np.where(side == 0, flat, 0)], pair.lengths[1][np.where(side == 1, flat, 0)])
            ends = np.concatenate(([0], np.cumsum(sizes.sum(axis=0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(side << SIDE | length.astype(np.int64) << LENGTH | flat))], ["key", "tokens"])

    return found.select("key", "part").mapInArrow(run, "key string, tokens array<long>")


def linked(tokens: DataFrame) -> DataFrame:
    """key, end, a, b (the tokens of a link), a_ends, b_ends (the token that ends here, if any), group (counted backwards from the last one, 1): a row for each link of every key, in one partition a key. tokens: as encoded() gives them."""
    rows = tokens.select("key", F.posexplode("tokens").alias("pos", "t"))
    length = F.shiftright("t", LENGTH).bitwiseAND((1 << SIDE - LENGTH) - 1)
    rows = rows.select("key", "pos", (F.col("t") < 0).alias("of_b"), F.col("t").bitwiseAND(ID).cast("int").alias("id"), length.alias("len"))
    order = Window.partitionBy("key", "of_b").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ended = rows.withColumn("end", F.sum("len").over(order))
    met = ended.groupBy("key", "end").agg(F.max(F.when(~F.col("of_b"), F.col("id"))).alias("a_ends"), F.max(F.when(F.col("of_b"), F.col("id"))).alias("b_ends"))
    back = Window.partitionBy("key").orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    nearest = lambda c: F.last(c, ignorenulls=True).over(back)
    both = F.when(F.col("a_ends").isNotNull() & F.col("b_ends").isNotNull(), 1).otherwise(0)
    return met.select("key", "end", nearest("a_ends").alias("a"), nearest("b_ends").alias("b"), "a_ends", "b_ends", F.sum(both).over(back).alias("group"))


def links_of(tokens: DataFrame) -> DataFrame:
    """key, links (array<long>, in order): a link's tokens and which of them end with it, as one number."""
    number = F.shiftleft(F.col("a").cast("long"), 32) + F.shiftleft(F.col("b").cast("long"), 2) + F.when(F.col("a_ends").isNotNull(), A_ENDS).otherwise(0) + F.when(F.col("b_ends").isNotNull(), B_ENDS).otherwise(0)
    rows = linked(tokens).select("key", F.struct("end", number.alias("link")).alias("s"))
    return rows.groupBy("key").agg(F.sort_array(F.collect_list("s")).alias("s")).select("key", F.col("s.link").alias("links"))


def packed(told: DataFrame, rows: int = 1 << 18) -> DataFrame:
    """of, chunk: the links of a block's parts (of, code, links), many parts to a row. A block without parts is a row whose code is null."""

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        whole = pa.Table.from_batches(held)
        whole = whole.take(np.argsort(whole.column("of").to_numpy(), kind="stable"))
        of, code = whole.column("of").to_numpy(), pc.fill_null(whole.column("code"), -1).to_numpy()
        lists = whole.column("links").combine_chunks()
        sizes, flat = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(), lists.flatten().to_numpy()
        upto = np.concatenate(([0], np.cumsum(sizes)))
        begins = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        for i, j in zip(begins, begins[1:]):
            i = j if code[i] < 0 else i
            chunk = pickle.dumps((squeezed(code[i:j].astype("<i4")), squeezed(sizes[i:j].astype("<i4")), squeezed(flat[upto[i] : upto[j]].astype("<i8"))))
            yield pa.RecordBatch.from_pydict({"of": [int(of[j - 1])], "chunk": [chunk]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return told.select("of", "code", "links").mapInArrow(run, "of long, chunk binary")


def _texts(links: np.ndarray, starts: np.ndarray) -> list[str]:
    """The groups of each part as text: A ids, a bar, B ids; groups in order."""
    a_ends, b_ends = (links & A_ENDS) > 0, (links & B_ENDS) > 0
    cut = a_ends & b_ends
    group = np.cumsum(cut) - cut
    at = np.concatenate((np.flatnonzero(a_ends), np.flatnonzero(b_ends)))
    side = np.repeat([0, 1], [a_ends.sum(), b_ends.sum()])
    order = np.lexsort((at, side, group[at]))
    at, side = at[order], side[order]
    ids = np.where(side == 0, links[at] >> 32, (links[at] & 0xFFFFFFFF) >> 2)
    last = np.concatenate((side[1:] != side[:-1], [True]))
    after = np.where(~last, ",", np.where(side == 0, "|", ";")) if len(at) else np.array([], dtype=str)
    joined = pc.binary_join_element_wise(pa.array(ids).cast(pa.string()), pa.array(after, pa.string()), "")
    # groups end where parts end, so a part's tokens are those of its groups; the last ";" goes
    sizes = np.add.reduceat(np.concatenate((a_ends.astype(np.int64) + b_ends, [0])), starts[:-1]) * (np.diff(starts) > 0) if len(starts) > 1 else np.zeros(0, dtype=np.int64)
    lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), joined)
    return [x[:-1] for x in pc.binary_join(lists, "").to_pylist()]


def _summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring bounds."""
    upto = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return upto[bounds[1:]] - upto[bounds[:-1]]


def _in_documents(codes: np.ndarray, bounds: np.ndarray, whole: np.ndarray, starts: np.ndarray, numbers: np.ndarray, n: int) -> np.ndarray:
    """In how many whole documents of a block each of n pairs is linked. A slice of documents at a time, so that what is held doesn't follow the block's links."""
    seen = np.zeros(n, dtype=np.int64)
    for docs in np.array_split(np.flatnonzero(whole), max(1, len(codes) >> 19)):
        each = [np.unique(codes[bounds[d] : bounds[d + 1]]) for d in docs]
        if each:
            own = np.concatenate(each)
            sizes = starts[own + 1] - starts[own]
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - starts[own], sizes)
            doc = np.repeat(np.repeat(np.arange(len(each)), [len(e) for e in each]), sizes)
            seen += np.bincount(np.unique(doc * n + numbers[at]) % n, minlength=n)
    return seen


def _met(x: pa.Table, y: pa.Table, folder: str) -> pa.Table:
    """A block with its pairs and in how many of its documents they are. Its documents' results as far as they're known, and where pairs are, go to a file beside that of its codes."""
    import pickle

    block, path = x.column("block")[0].as_py(), x.column("path")[0].as_py()
    file = _got(path)
    sizes = file["sizes"].to_numpy()
    bounds, codes = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), opened(file["codes"][0].as_py(), "<i4")
    chunks = [tuple(opened(data, kind) for data, kind in zip(pickle.loads(c), ("<i4", "<i4", "<i8"))) for c in y.column("chunk").to_pylist()]
    code, size, flat = (np.concatenate([c[k] for c in chunks] or [np.zeros(0, dtype=np.int64)]) for k in range(3))
    # links in order of the parts' numbers, of which there's one of each
    order = np.argsort(code)
    begin = (np.cumsum(size) - size)[order]
    size = size[order].astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(size)))
    links = flat[np.arange(starts[-1]) - np.repeat(starts[:-1] - begin, size)].astype(np.int64)
    whole = (sizes > 0) & (_summed(size[codes] == 0, bounds) == 0)
    pairs, numbers = np.unique(links >> 2, return_inverse=True)
    seen = _in_documents(codes, bounds, whole, starts, numbers, len(pairs))
    by_part = {"n_a": (links & A_ENDS) > 0, "n_b": (links & B_ENDS) > 0, "n_groups": (links & 3) == 3, "n_links": np.ones(len(links), dtype=bool)}
    texts = _texts(links, starts)
    told = [hashlib.sha256(";".join([texts[c] for c in codes[a:b].tolist()]).encode()).hexdigest() if ok else "" for a, b, ok in zip(bounds[:-1].tolist(), bounds[1:].tolist(), whole)]
    # the pairs that count in order; the others, of documents that don't, have one number more
    place = np.cumsum(seen > 0) - 1
    place[seen == 0] = (seen > 0).sum()
    numbers, starts_data = squeezed(place[numbers].astype("<i4")), squeezed(starts.astype("<i8"))
    results = {k: pa.array(np.where(whole, _summed(_summed(v, starts)[codes], bounds), 0)) for k, v in by_part.items()}
    own = _put(folder, f"links-{block:x}", {"whole": pa.array(whole), **results, "groups_sha256": pa.array(told, pa.string()), "numbers": pa.array([numbers]), "starts": pa.array([starts_data])})
    row = {"block": pa.array([block]), "path": pa.array([path]), "links_path": pa.array([own])}
    return pa.table(row | {k: pa.ListArray.from_arrays([0, len(v)], pa.array(v)) for k, v in (("pairs", pairs[seen > 0]), ("docs", seen[seen > 0]))})


def _scored(x: pa.Table, y: pa.Table) -> pa.Table:
    """A block's documents, with the counts of its pairs (pos, n, best)."""
    file, links = _got(x.column("path")[0].as_py()), _got(x.column("links_path")[0].as_py())
    whole, codes = links["whole"].to_numpy(zero_copy_only=False), opened(file["codes"][0].as_py(), "<i4")
    bounds = np.concatenate(([0], np.cumsum(file["sizes"].to_numpy(), dtype=np.int64)))
    starts, numbers = opened(links["starts"][0].as_py(), "<i8"), opened(links["numbers"][0].as_py(), "<i4")
    out = {"doc_id": file["ids"], **{k: links[k] for k in ("n_a", "n_b", "n_groups", "n_links")}}
    for name, field in (("n_best", "best"), ("count_sum", "n")):
        value = np.zeros(y.num_rows + 1, dtype=np.int64)
        value[y.column("pos").to_numpy()] = y.column(field).to_numpy()
        out[name] = pa.array(np.where(whole, _summed(_summed(value[numbers], starts)[codes], bounds), 0))
    return pa.table(out | {"groups_sha256": links["groups_sha256"]})


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document; a: a byte-level BPE for the tokenizers library, b: a sentencepiece model."""
    kind, spark = docs.schema["doc_id"].dataType.simpleString(), docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = spark.range(0)
    files._scratch = folder = scratch(spark, "align-files")
    try:
        with tables() as keep:
            cut = keep(blocks(docs, folder), "align-blocks")
            entries = cut.select(F.col("block").alias("of"), F.posexplode_outer("parts").alias("code", "part"))
            tokens = encoded(entries.select("part").where("part is not null").distinct().select(key_of("part").alias("key"), "part"), a, b).repartition(parts, "key")
            told = entries.select("of", "code", key_of("part").alias("key")).join(links_of(tokens).hint("merge"), "key", "left")
            met = cut.select("block", "path").groupBy("block").cogroup(packed(told).groupBy("of")).applyInArrow(lambda x, y: _met(x, y, folder), "block long, path string, links_path string, pairs array<long>, docs array<long>")
            met = materialize(met, "align-met")
        counts = met.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n"))
        # an A id has at most as many pairs as B has entries
        top = F.max("n").over(Window.partitionBy(F.shiftright("pair", 30)))
        counts = materialize(counts.select("pair", "n", F.when(F.col("n") == top, 1).otherwise(0).alias("best")), "align-counts")
    except BaseException:
        discard(files)
        raise
    held = met.select(F.col("block").alias("of"), F.posexplode("pairs").alias("pos", "pair")).join(counts.hint("merge"), "pair").drop("pair")
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    out = met.select("block", "path", "links_path").groupBy("block").cogroup(held.groupBy("of")).applyInArrow(lambda x, y: _scored(x, y), schema)
    return reading(out, met, counts, files)
