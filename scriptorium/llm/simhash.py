"""SimHash near-duplicates with a pigeonring filter.

A text's fingerprint has a bit set where over half of its word shingles' hashes have it set. Two fingerprints of 64 bits
link at ``max_bits`` or fewer differing bits. Candidates come from the strong form of the pigeonring principle: cut the
bits into m segments on a ring; if the total difference is at most t, some segment i exists from which *every* chain of
l consecutive segments differs in at most floor(l * t / m) bits. With t = 4, m = 5 that is 0, 1, 2, 3, 4 bits, so the
index key is segment i exactly together with segment i + 1 up to one bit, about 26 bits, and longer chains prune before
the full Hamming check.

Within a bucket a breadth-first search over the members not yet reached gives a spanning forest, not all pairs: a dense
bucket costs and emits about as many links as it has members, and connectivity is the same. A key that too many fingerprints share is made finer
by further bits (see :func:`hamming_links`); how many rows a fingerprint has in the index doesn't depend on how many fingerprints there are.

For the wider radius that a similarity of 0.8 needs (fingerprints of such texts differ in up to 14 of 64 bits, where an index
over whole segments no longer prunes), :func:`near_duplicate_groups` takes longer fingerprints, whose 64-bit words are the ring. A key is a sample of
one word's bits (see :func:`sampled`); the chain of that word and of it with its neighbour prunes within a bucket. What the chains leave together is compared by whole fingerprints, and links are
confirmed by the shingle sets; what is apart after that is compared by shingle sets alone.

Defined results: a null or blank text has fingerprint zero and is linked like any other; rows with a null doc_id take
part, but a component's id is its smallest non-null doc_id (null if there is none); rows that repeat a doc_id give a row
each; an empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.components import star_components
from scriptorium.llm.storage import arrow_rows, discard, materialize, reading, tables

SEED = 42
#: Shingles hashed at a time, so a very long text needs no more memory than a short one beside its words.
SLAB = 1 << 15
#: Multipliers that derive further 64-bit words and minima from a shingle's hash.
MIX = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of each run of so many words, repeats included, a slab at a time; one hash of all words if fewer."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not found:
        return
    joined = b" ".join(found)
    if len(found) <= words:
        yield np.array([digest(joined, SEED)], dtype=np.uint64)
        return
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    del found
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths)[: len(ends) - words + 1], ends[words - 1 :]
    for at in range(0, len(starts), SLAB):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + SLAB].tolist(), stops[at : at + SLAB].tolist())], dtype=np.uint64)


def mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th further hash of each h; h itself for 0."""
    if not k:
        return h
    x = h * MIX[k]
    x ^= x >> np.uint64(29)
    x *= MIX[k + 100]
    return x ^ (x >> np.uint64(32))


def fingerprint(text: str | None, words: int = 4, lanes: int = 1) -> np.ndarray:
    """The SimHash as so many 64-bit words."""
    ones, total = np.zeros((lanes, 64), dtype=np.int64), 0
    for h in shingle_hashes(text, words):
        total += len(h)
        for k in range(lanes):
            ones[k] += np.unpackbits(mixed(h, k).view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > total, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_py(), words)[0] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def ring(bits: int, segments: int) -> list[tuple[int, int]]:
    """Offset and width of each segment, as even as can be."""
    edges = [round(bits * k / segments) for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segments(fps: np.ndarray, cuts: list[tuple[int, int]]) -> list[np.ndarray]:
    return [(fps >> np.uint64(at)) & np.uint64((1 << width) - 1) for at, width in cuts]


#: A key's top bits name the segment that it starts from.
START = np.uint64(56)


def ring_keys(fps: np.ndarray, cuts: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index rows of 64-bit fingerprints: key, kind (0 as it is, 1 with a zero bit of the second segment set) and the
    fingerprint. Of two fingerprints one bit apart there, exactly one has the zero bit."""
    parts, keys, kinds, who = _segments(fps, cuts), [], [], []
    for i in range(len(cuts)):
        first, second, width = parts[i], parts[(i + 1) % len(cuts)], cuts[(i + 1) % len(cuts)][1]
        bucket = (np.uint64(i) << START) | (first << np.uint64(16))
        for bit in range(-1, width):
            take = np.arange(len(fps)) if bit < 0 else np.flatnonzero((second >> np.uint64(bit)) & np.uint64(1) == 0)
            keys.append(bucket[take] | second[take] | (np.uint64(0) if bit < 0 else np.uint64(1 << bit)))
            kinds.append(np.full(len(take), bit >= 0))
            who.append(fps[take])
    return np.concatenate(keys), np.concatenate(kinds), np.concatenate(who)


def _mask(at: int, width: int) -> int:
    return ((1 << width) - 1) << at


def chain_masks(cuts: list[tuple[int, int]], start: int) -> list[np.uint64]:
    """The bits of each chain from a start segment, shortest first; the last is the whole ring."""
    out, held = [], 0
    for step in range(len(cuts)):
        held |= _mask(*cuts[(start + step) % len(cuts)])
        out.append(np.uint64(held))
    return out


def finer_keys(key: np.ndarray, fps: np.ndarray, used: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, used) of the rows of keys that too many share, so many times each: the bits that no key of theirs holds yet are cut in pieces, one of
    which is equal for two fingerprints that differ in fewer bits than there are pieces."""
    rows, keys, held = [], [], []
    for known in np.unique(used).tolist():
        at = np.flatnonzero(used == known)
        free = [k for k in range(64) if not known >> k & 1]
        for number, bits in enumerate(np.array_split(free, pieces)):
            mask = np.uint64(sum(1 << int(k) for k in bits))
            with np.errstate(over="ignore"):
                h = mixed(mixed(key[at], 11) + mixed((fps[at] & mask) + np.uint64(number), 13), 17)
            rows.append(at)
            keys.append((key[at] >> START << START) | (h >> np.uint64(8)))
            held.append(np.full(len(at), np.uint64(known) | mask))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(held)


def near(one: np.ndarray, many: np.ndarray, max_bits: int) -> np.ndarray:
    """Which rows of many (n x lanes) differ from one in so many bits at most."""
    return np.bitwise_count(many ^ one).sum(axis=1, dtype=np.int64) <= max_bits


def chained(x: np.ndarray, masks: list[np.uint64], max_bits: int) -> np.ndarray:
    """Which differences (64 bits) keep every chain within its share of max_bits: each chain sees those only that the shorter ones have left, and
    the last is the whole fingerprint."""
    alive = np.arange(len(x))
    for step, mask in enumerate(masks, 1):
        alive = alive[np.bitwise_count(x[alive] & mask) <= step * max_bits // len(masks)]
    out = np.zeros(len(x), dtype=bool)
    out[alive] = True
    return out


def forest(ids: np.ndarray, fps: np.ndarray, masks: list[np.uint64], max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph that joins members whose chains pass: breadth first, comparing
    each member only with those not yet reached."""
    ids, at = np.unique(ids, return_index=True)
    fps, left, links = fps[at], np.arange(len(ids)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            hit = chained(fps[left] ^ fps[one], masks, max_bits)
            found, left = left[hit], left[~hit]
            links += [(int(ids[one]), int(ids[j])) for j in found]
            queue += found.tolist()
    return links


def least_forest(ids: np.ndarray, fps: np.ndarray, tight: int, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest, at most max_bits, that joins clusters by their shortest links: clusters at tight bits breadth first, then
    a minimum spanning forest of the clusters. Members of the largest cluster are compared with the members of others only, so a dense
    bucket costs about as much as it has members."""
    ids, at = np.unique(ids, return_index=True)
    fps, n = fps[at], len(ids)
    label, left, links, c = np.zeros(n, dtype=np.int64), np.arange(n), [], 0
    while len(left):
        queue, left = [left[0]], left[1:]
        label[queue[0]] = c
        while queue and len(left):
            one = queue.pop()
            hit = near(fps[one], fps[left], tight)
            found, left = left[hit], left[~hit]
            label[found] = c
            links += [(int(ids[one]), int(ids[j])) for j in found]
            queue += found.tolist()
        c += 1
    if c == 1:
        return links
    least: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i in np.flatnonzero(label != np.bincount(label).argmax()):
        bits = np.bitwise_count(fps ^ fps[i]).sum(axis=1, dtype=np.int64)
        found = np.flatnonzero((bits <= max_bits) & (label != label[i]))
        for j in found[np.argsort(bits[found], kind="stable")[::-1]]:  # the nearest of a cluster comes last
            pair = (min(label[i], label[j]), max(label[i], label[j]))
            if pair not in least or bits[j] <= least[pair][0]:
                least[pair] = (int(bits[j]), int(i), int(j))
    root = list(range(c))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for _, i, j in sorted(least.values()):
        x, y = find(int(label[i])), find(int(label[j]))
        if x != y:
            root[x] = y
            links.append((int(ids[i]), int(ids[j])))
    return links


SMALL = 8


def bucket_links(key: np.ndarray, kind: np.ndarray, ids: np.ndarray, fps: np.ndarray, max_bits: int, cuts=None, tight: int | None = None) -> tuple[list, list]:
    """Links within the buckets of rows sorted by key and then kind. Small buckets are compared all at once, row against
    the row so many places on; large ones by forest(), or by least_forest() where tight is given. Only pairs with a member of kind 0 need comparing."""
    edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    sizes = np.diff(edges)
    size_of = np.repeat(sizes, sizes)
    small = np.flatnonzero((size_of > 1) & (size_of <= SMALL))
    rings = [chain_masks(cuts, i) for i in range(len(cuts))] if cuts else []
    left, right = [], []
    for step in range(1, SMALL):
        a = small[small + step < len(key)]
        b = a + step
        ok = (key[a] == key[b]) & ~kind[a] & (ids[a] != ids[b])
        a, b = a[ok], b[ok]
        if not len(a):
            continue
        if cuts:
            ok, start = np.zeros(len(a), dtype=bool), (key[a] >> START).astype(np.int64)
            for i, masks in enumerate(rings):
                here = np.flatnonzero(start == i)
                ok[here] = chained(fps[a[here], 0] ^ fps[b[here], 0], masks, max_bits)
        else:
            ok = np.bitwise_count(fps[a] ^ fps[b]).sum(axis=1, dtype=np.int64) <= max_bits
        left += ids[a[ok]].tolist()
        right += ids[b[ok]].tolist()
    for g in np.flatnonzero(sizes > SMALL):
        rows = slice(edges[g], edges[g + 1])
        if kind[rows.start]:
            continue  # no member of kind 0
        for a, b in forest(ids[rows], fps[rows, 0], rings[int(key[rows.start] >> START)], max_bits) if tight is None else least_forest(ids[rows], fps[rows], tight, max_bits):
            left.append(a)
            right.append(b)
    return left, right


def sorted_buckets(batches: Iterator[pa.RecordBatch], lanes: int, max_bits: int, cuts=None, tight: int | None = None) -> Iterator[pa.RecordBatch]:
    """Links from rows (key, block, kind, id, fp) sorted by key, block, kind; a bucket may span batches."""
    kept: list[np.ndarray] | None = None

    def columns(batch):
        fps = np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype=np.uint64).reshape(-1, lanes) if lanes > 1 else batch.column(4).to_numpy().view(np.uint64).reshape(-1, 1)
        return [batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(), fps]

    def links(cols):
        key, block, kind, ids, fps = cols
        if not len(key):
            return None
        change = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]) | (block[1:] != block[:-1]))))
        # buckets of one key but other blocks count as buckets of their own; the start segment stays readable in the key
        group = (key >> START << START) | change.astype(np.uint64) if cuts else change.astype(np.uint64)
        a, b = bucket_links(group, kind, ids, fps, max_bits, cuts, tight)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]) if a else None

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = columns(batch)
        if kept:
            cols = [np.concatenate(x) for x in zip(kept, cols)]
        key, block = cols[0], cols[1]
        last = np.flatnonzero((key != key[-1]) | (block != block[-1]))
        cut = last[-1] + 1 if len(last) else 0
        kept = [x[cut:] for x in cols]
        if cut and (out := links([x[:cut] for x in cols])):
            yield out
    if kept and (out := links(kept)):
        yield out


#: Times that keys which too many fingerprints share are made finer.
FINER = 2


def index_rows(unique: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """key, kind, fp, used (the bits that the key holds) of every fingerprint: about 37 rows each, however many there are."""

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 4096):
                key, kind, who = ring_keys(fps[at : at + 4096], cuts)
                used = np.array([_mask(*cuts[i]) | _mask(*cuts[(i + 1) % len(cuts)]) for i in range(len(cuts))], dtype=np.uint64)[(key >> START).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(kind), pa.array(who.view(np.int64)), pa.array(used.view(np.int64))], ["key", "kind", "fp", "used"])

    # dealt out first, as the few bytes of the table would make few tasks
    return unique.select("fp").repartition(_parts(unique)).mapInArrow(run, "key long, kind boolean, fp long, used long")


def finer_rows(rows: DataFrame, crowded: DataFrame, pieces: int) -> DataFrame:
    """The rows, those of crowded keys under finer keys."""

    def run(batches):
        for batch in batches:
            key, kind, fp, used = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            many = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(~many)).select(["key", "kind", "fp", "used"])
            at = np.flatnonzero(many)
            if len(at):
                row, finer, held = finer_keys(key[at].view(np.uint64), fp[at].view(np.uint64), used[at].view(np.uint64), pieces)
                yield pa.RecordBatch.from_arrays([pa.array(finer.view(np.int64)), pa.array(kind[at[row]]), pa.array(fp[at[row]]), pa.array(held.view(np.int64))], ["key", "kind", "fp", "used"])

    return rows.join(crowded.hint("merge"), "key", "left").mapInArrow(run, "key long, kind boolean, fp long, used long")


def hamming_links(unique: DataFrame, max_bits: int = 4, segments: int = 5, block_rows: int = 100_000) -> DataFrame:
    """Links (a, b) between distinct 64-bit fingerprints (column fp), a written table: a spanning forest of each bucket, so the connected
    components are those of all pairs at max_bits or fewer bits. Needs max_bits < segments, so that the first segment of
    a chain is equal and the second at most one bit off.

    A key that more than block_rows fingerprints share is made finer by the bits that it doesn't hold, ``FINER`` times at most; fingerprints so much alike that
    they crowd even those keys are dealt out as pairs of blocks, so that a task holds two blocks of a key."""
    if not max_bits < segments or 2 * max_bits // segments > 1:
        raise ValueError("the index takes a first segment without and a second with at most one difference")
    cuts = ring(64, segments)
    with tables() as keep:
        rows = keep(index_rows(unique, cuts), "simhash-index")
        for level in range(FINER + 1):
            crowded = keep(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block_rows), "simhash-crowded")
            if crowded.isEmpty():
                rows = rows.withColumn("block", F.lit(0).cast("long"))
            elif level < FINER:
                rows = keep(finer_rows(rows, crowded, max_bits + 1), "simhash-index")
                continue
            else:
                rows = rows.withColumnRenamed("fp", "node").join(crowded.hint("merge"), "key", "left").withColumn("n", F.coalesce("n", F.lit(1)))
                rows = in_blocks(rows, block_rows).withColumnRenamed("node", "fp")
            break
        dealt = rows.select("key", "block", "kind", F.col("fp").alias("id"), "fp").repartition(_parts(unique), "key", "block").sortWithinPartitions("key", "block", "kind")
        found = dealt.mapInArrow(lambda it: sorted_buckets(it, 1, max_bits, cuts), "a long, b long")
        return materialize(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "simhash-links")


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, node -> node, component_id: the smallest doc_id of the nodes that links join; a written table."""
    with tables() as keep:
        stars = star_components(links)
        ids = rows.groupBy("node").agg(F.min("doc_id").alias("least"))
        # written before they're joined by root, so that Spark can split the partition of a root with very many nodes
        known = keep(ids.join(stars.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node")), "simhash-roots")
        discard(stars)
        least = keep(known.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
        return materialize(known.join(least.hint("merge"), "root").select("node", "component_id"), "simhash-labels")


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: fingerprints link at max_bits or fewer differing bits."""
    with tables() as keep:
        unique = keep((own := materialize(fingerprints(docs, words), "simhash-own")).select("fp").distinct(), "simhash-unique")
        links = hamming_links(unique, max_bits)
        labels = labelled(own.withColumnRenamed("fp", "node"), links)
        discard(links)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return reading(own.join(labels.hint("merge"), own["fp"] == labels["node"]).select("doc_id", hexed, "component_id"), own, labels)


def band_rows(docs: DataFrame, words: int, lanes: int) -> DataFrame:
    """doc_id, node (a hash of the whole fingerprint and shingles: equal for copies), fp (binary; of the distinct shingles), prints (the text's distinct
    shingles as sorted 32-bit hashes)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import xxhash

        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                out: tuple[list, list, list] = ([], [], [])
                for x in batch.column(1):
                    ones = np.zeros((lanes, 64), dtype=np.int64)
                    # each shingle once, as in the sets that decide: a run of one word repeated doesn't outweigh the rest
                    slabs = [np.unique(h) for h in shingle_hashes(x.as_py(), words)]
                    distinct = np.unique(np.concatenate(slabs)) if len(slabs) > 1 else slabs[0] if slabs else np.array([], dtype=np.uint64)
                    for at in range(0, len(distinct), SLAB):
                        h = distinct[at : at + SLAB]
                        for k in range(lanes):
                            ones[k] += np.unpackbits(mixed(h, k).view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
                    fp = np.packbits(ones * 2 > len(distinct), axis=1, bitorder="little").tobytes()
                    out[0].append(xxhash.xxh64_intdigest(fp + distinct.tobytes(), SEED))
                    out[1].append(fp)
                    out[2].append(np.unique((distinct >> np.uint64(32)).astype("<u4")).tobytes())
                node = pa.array(np.array(out[0], dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), node, pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["doc_id", "node", "fp", "prints"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, node long, fp binary, prints binary")


#: Of 256 bits 68 may differ for two fingerprints to meet: at similarity 0.8 they differ in 39, deviation 6.
RADIUS = 68
#: Bits of a key and keys of a fingerprint, up to 2^19 fingerprints.
BITS, KEYS = 11, 64
#: Buckets of more rows are searched breadth first and not row against row; rows that are worked on at once.
WIDE, HELD = 1024, 1 << 16


def sampled(nodes: int, lanes: int) -> list[tuple[int, np.uint64]]:
    """The keys of a fingerprint: of each the word, and the bits of it that are taken. At similarity 0.8 a bit is equal with probability 0.85, so one of 64 keys of 11 bits is
    with 0.9997 (the chains' loss included, by simulation). Where there are more fingerprints keys have a bit more for each doubling, so a bucket of unlike ones stays at some 256 rows, and there are more of them."""
    more = max(0, (max(nodes, 1) - 1).bit_length() - 19)
    bits, rng = min(BITS + more, 24), np.random.default_rng(SEED)
    return [(k % lanes, np.uint64(sum(1 << int(b) for b in rng.choice(64, bits, replace=False)))) for k in range(min(255, int(np.ceil(KEYS / 0.848 ** (bits - BITS)))))]


def sampled_rows(nodes: DataFrame, keys: list[tuple[int, np.uint64]], lanes: int) -> DataFrame:
    """key, node, one, two (the key's word of the fingerprint and the next one of the ring) for every key of every node."""

    def run(batches):
        for batch in batches:
            fps = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint64).reshape(-1, lanes)
            for number, (lane, mask) in enumerate(keys):
                own = fps[:, lane]
                key = (np.uint64(number) << START) | (mixed(own & mask, 31) >> np.uint64(8))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0), *(pa.array(np.ascontiguousarray(w).view(np.int64)) for w in (own, fps[:, (lane + 1) % lanes]))], ["key", "node", "one", "two"])

    return nodes.select("node", "fp").repartition(_parts(nodes)).mapInArrow(run, "key long, node long, one long, two long")


def together(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of n members the smallest one that the pairs (a, b) join each with."""
    label = np.arange(n)
    while True:
        low, new = np.minimum(label[a], label[b]), label.copy()
        for ends in (a, b):
            np.minimum.at(new, ends, low)
            np.minimum.at(new, label[ends], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_cells(first: np.ndarray, one: np.ndarray, two: np.ndarray, lanes: int) -> np.ndarray:
    """For rows of whole buckets, each bucket's beginning marked in first: the smallest row of those that the chains of one word and of two join in their bucket."""
    near_one, near_two = RADIUS // lanes, 2 * RADIUS // lanes

    def alike(a, b):
        x = np.bitwise_count(one[a] ^ one[b])
        return (x <= near_one) & (x + np.bitwise_count(two[a] ^ two[b]) <= near_two)

    n, begins = len(first), np.flatnonzero(first)
    sizes = np.diff(np.append(begins, n))
    after = np.repeat(begins + sizes, sizes) - np.arange(n) - 1
    left, right, step = [], [], 1
    rows = np.flatnonzero((after > 0) & (np.repeat(sizes, sizes) <= WIDE))
    while len(rows):
        hit = rows[alike(rows, rows + step)]
        left.append(hit)
        right.append(hit + step)
        step += 1
        rows = rows[after[rows] >= step]
    for g in np.flatnonzero(sizes > WIDE):
        others = np.arange(begins[g], begins[g] + sizes[g])
        while len(others):
            queue, others = [others[0]], others[1:]
            while queue and len(others):
                at = queue.pop()
                hit = alike(others, at)
                found, others = others[hit], others[~hit]
                left.append(np.full(len(found), at))
                right.append(found)
                queue += found.tolist()
    return together(n, *(np.concatenate(x) if x else np.array([], dtype=np.int64) for x in (left, right)))


def cells(batches: Iterator[pa.RecordBatch], lanes: int) -> Iterator[pa.RecordBatch]:
    """key, n, node of the groups of two and more that chains join in a bucket, from rows (key, block, node, one, two) sorted by key and block. A group's key is a hash of its nodes, so the same group of several buckets
    has the same rows."""
    import xxhash

    def found(cols):
        key, block, node, one, two = cols
        root = bucket_cells(np.concatenate(([True], (key[1:] != key[:-1]) | (block[1:] != block[:-1]))), one, two, lanes)
        order = np.lexsort((node, root))
        order = order[np.bincount(root, minlength=len(root))[root[order]] > 1]
        if not len(order):
            return None
        begins = np.flatnonzero(np.concatenate(([True], root[order[1:]] != root[order[:-1]])))
        sizes, ids = np.diff(np.append(begins, len(order))), node[order]
        names = np.array([xxhash.xxh64_intdigest(ids[a : a + n].tobytes(), SEED) for a, n in zip(begins.tolist(), sizes.tolist())], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(names, sizes)), pa.array(np.repeat(sizes, sizes)), pa.array(ids)], ["key", "n", "node"])

    def upto(end: bool):
        """What is held, without its last bucket unless it's the end."""
        nonlocal held
        cols = [np.concatenate(x) for x in zip(*held)]
        last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
        cut = len(cols[0]) if end else last[-1] + 1 if len(last) else 0
        held = [[x[cut:] for x in cols]]
        return found([x[:cut] for x in cols]) if cut else None

    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in range(5)]
        held.append(cols[:3] + [x.view(np.uint64) for x in cols[3:]])
        rows += batch.num_rows
        # many buckets at once, as each step over them is one of numpy's; a bucket that isn't at its end waits for as many rows more
        if rows >= HELD:
            if out := upto(False):
                yield out
            rows = 0
    if held and (out := upto(True)):
        yield out


def sharing(nodes: DataFrame, lanes: int, keep, block_rows: int = 20_000) -> DataFrame:
    """key, n, node, written by keep: groups of n > 1 nodes whose fingerprints share a key of sampled bits and are joined there by chains. A key that more than block_rows nodes share is dealt out as pairs of blocks."""
    rows = sampled_rows(nodes, sampled(nodes.count(), lanes), lanes)
    crowded = keep(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block_rows), "simhash-crowded")
    if crowded.isEmpty():
        rows = rows.withColumn("block", F.lit(0).cast("long"))
    else:
        rows = in_blocks(rows.join(crowded.hint("merge"), "key", "left").withColumn("n", F.coalesce("n", F.lit(1))), block_rows)
    dealt = rows.select("key", "block", "node", "one", "two").repartition(_parts(nodes), "key", "block").sortWithinPartitions("key", "block")
    return keep(dealt.mapInArrow(lambda it: cells(it, lanes), "key long, n long, node long").distinct(), "simhash-cells")


def in_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Rows (key, n, node, ...) with a block each; those of a key that more than block_rows nodes share once for every pair of blocks they're in."""
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / block_rows)).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    block = F.shiftleft(F.least("own", "other"), 31).bitwiseOR(F.greatest("own", "other"))
    return rows.withColumn("block", block).drop("n", "blocks", "own", "other")


def similar_links(nodes: DataFrame, members: DataFrame, lanes: int, tight: int, max_bits: int, block_rows: int = 50_000) -> DataFrame:
    """Links between distinct nodes that share a group (members, see sharing) and differ in max_bits or fewer of 64 * lanes bits: of each bucket a spanning
    forest by shortest links. A key that more than block_rows nodes share is dealt out as pairs of blocks."""
    rows = in_blocks(members, block_rows).join(nodes.select("node", "fp").hint("merge"), "node")
    rows = rows.select("key", "block", F.lit(False).alias("kind"), F.col("node").alias("id"), "fp")
    dealt = rows.repartition(_parts(nodes), "key", "block").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(lambda it: sorted_buckets(it, lanes, max_bits, None, tight), "a long, b long")


def similarity(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two sorted sets of 32-bit hashes; 1 for two empty ones."""
    x, y = np.frombuffer(a, dtype="<u4"), np.frombuffer(b, dtype="<u4")
    if not len(x) + len(y):
        return 1.0
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common / (len(x) + len(y) - common)


def confirmed(links: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """The links whose texts have that shingle similarity."""
    one = links.join(prints.select(F.col("node").alias("a"), F.col("prints").alias("pa")).hint("merge"), "a")
    two = one.join(prints.select(F.col("node").alias("b"), F.col("prints").alias("pb")).hint("merge"), "b").select("a", "b", "pa", "pb")

    def run(batches):
        for batch in batches:
            ok = [similarity(x.as_buffer(), y.as_buffer()) >= least for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return two.mapInArrow(run, "a long, b long")


def set_links(ids: list[int], roots: list[int], prints: list[bytes], least: float) -> list[tuple[int, int]]:
    """Links that join the groups (equal roots) of a bucket wherever two members of different ones have that similarity. Members of the
    largest group are compared with those of others only. Two sets so similar share one of the rarest of each: with shingles in order of how many members have them, one among the first size - least * size + 1. So
    only members that meet there are compared, and shingles that all members share, such as those of a template, bring none together."""
    label = np.unique(np.array(roots), return_inverse=True)[1]
    if not label.any():
        return []
    sets = [np.frombuffer(x, dtype="<u4") for x in prints]
    sizes, n = np.array([len(x) for x in sets]), len(sets)
    known, each = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(n), sizes)
    # of each member the rarest shingles first
    order = np.lexsort((each, np.bincount(each, minlength=len(known))[each], holder))
    each = each[order]
    place = np.arange(len(each)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = np.where(sizes > 0, sizes - np.ceil(least * sizes - 1e-9).astype(np.int64) + 1, 0)
    early = place < first[holder]
    each, holder = each[early], holder[early]
    by = np.argsort(each, kind="stable")
    holders, stops = holder[by], np.cumsum(np.bincount(each, minlength=len(known)))
    starts, ends, links = np.concatenate(([0], stops[:-1])), np.cumsum(np.bincount(holder, minlength=n)), []
    begins = np.concatenate(([0], ends[:-1]))
    for i in np.flatnonzero(label != np.bincount(label).argmax()):
        if (label == label[i]).all():
            break
        own = each[begins[i] : ends[i]]
        many = stops[own] - starts[own]
        near = np.zeros(n, dtype=bool)
        for at in range(0, len(own), 1024):
            some = slice(at, at + 1024)
            near[holders[np.arange(many[some].sum()) + np.repeat(starts[own[some]] - np.cumsum(many[some]) + many[some], many[some])]] = True
        near &= (label != label[i]) & (np.minimum(sizes, sizes[i]) >= least * np.maximum(sizes, sizes[i]) - 1e-9)
        for j in np.flatnonzero(near):
            if label[j] != label[i]:
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if common / max(sizes[i] + sizes[j] - common, 1) >= least:
                    links.append((ids[i], ids[j]))
                    label[label == label[j]] = label[i]
    return links


def remaining_links(shared: DataFrame, prints: DataFrame, sure: DataFrame, least: float, block_rows: int = 4_000) -> DataFrame:
    """Links of that similarity between nodes that share a group and that the links found (sure) leave apart. Every such pair is decided
    by its shingle sets, except where other links have joined it. Keys with the same nodes count once."""
    stars = star_components(sure)
    members = shared.select("key", "node").join(stars.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = materialize(members, "simhash-members")
    sums = members.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y"), (F.min("root") != F.max("root")).alias("apart"))
    apart = materialize(sums.where("apart").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n"), "simhash-apart")
    rows = in_blocks(members.join(apart.hint("merge"), "key"), block_rows).join(prints.hint("merge"), "node").select("key", "block", "node", "root", "prints")
    dealt = rows.repartition(_parts(shared), "key", "block").sortWithinPartitions("key", "block")

    def run(batches):
        def links():
            found = set_links(ids, roots, sets, least) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        bucket, ids, roots, sets = None, [], [], []
        for batch in batches:
            for key, block, node, root, own in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if (key, block) != bucket:
                    yield links()
                    bucket, ids, roots, sets = (key, block), [], [], []
                ids.append(node)
                roots.append(root)
                sets.append(own)
        yield links()

    out = materialize(dealt.mapInArrow(run, "a long, b long"), "simhash-rest")
    for df in (stars, members, apart):
        discard(df)
    return out


def near_duplicate_groups(docs: DataFrame, words: int = 5, least: float = 0.8, lanes: int = 4, tight: int = 20, max_bits: int = 56) -> DataFrame:
    """doc_id, component_id: texts link where the Jaccard similarity of their shingle sets is at least 0.8.

    Such texts share 0.89 of their shingles, so at 0.8 exactly 15 % of SimHash bits differ (39 of 256, deviation 6), against half between
    unrelated texts. Keys of sampled bits and chains over the ring of the fingerprint's words make such a pair a candidate with probability 0.9997. The shortest links of a group, of at most 56 bits, are
    confirmed by the sets first, which joins most of a dense group at little cost. As a refused link may have stood for true ones,
    every pair of a group that is still apart then is decided by its sets."""
    with tables() as keep:
        with arrow_rows(docs.sparkSession, 1000):  # whole texts go to Python
            own = keep(band_rows(docs, words, lanes), "simhash-bandrows")
        nodes = keep(own.groupBy("node").agg(F.any_value("fp").alias("fp"), F.any_value("prints").alias("prints")), "simhash-nodes")
        members = sharing(nodes, lanes, keep)
        links = keep(similar_links(nodes, members, lanes, tight, max_bits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "simhash-links")
        prints = keep(nodes.select("node", "prints").join(members.select("node").distinct().hint("merge"), "node", "left_semi"), "simhash-prints")
        sure = keep(confirmed(links, prints, least), "simhash-sure")
        rest = remaining_links(members, prints, sure, least)
        labels = labelled(own.select("doc_id", "node"), sure.unionByName(rest))
        out = materialize(own.select("doc_id", "node").join(labels.hint("merge"), "node").select("doc_id", "component_id"), "simhash-groups")
        for df in (rest, labels):
            discard(df)
        return out
