import random

import numpy as np
import xxhash

from scriptorium.llm import simhash


def brute(texts, words=4, max_bits=4):
    fps = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sh = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
        ones = [0] * 64
        for s in sh:
            h = xxhash.xxh64_intdigest(s, 42)
            for j in range(64):
                ones[j] += h >> j & 1
        fps.append(sum(1 << j for j in range(64) if ones[j] * 2 > len(sh)))
    comp = list(range(len(fps)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    return fps, [find(i) for i in range(len(fps))]


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(120)]
    out = base + base[:10] + [None, "", " \n", "A", "a", "É É É É É", "x " * 50]
    for t in base[:25]:
        for _ in range(4):
            w = t.split()
            w[rng.randrange(len(w))] = "edited"
            out.append(" ".join(w))
    return out


def test_against_brute_force(spark):
    data = texts()
    fps, comp = brute(data)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(data)], "doc_id long, text string, key string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == {i: (f"{fps[i]:016x}", comp[i]) for i in range(len(data))}


def test_dense_ball_and_blocks(spark):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, size=6, dtype=np.int64).view(np.uint64)
    fps = set()
    for c in centre:
        for _ in range(150):
            x = int(c)
            for b in rng.choice(64, size=rng.integers(0, 9), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                parent[find(i)] = find(j)
    want = {}
    for i in range(len(fps)):
        want.setdefault(find(i), set()).add(fps[i])
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    for block_rows in (100_000, 300, 50):
        links = simhash.hamming_links(df, block_rows=block_rows)
        roots = {r.node: r.root for r in simhash.star_components(links).collect()}
        got = {}
        for x in fps:
            s = int(np.uint64(x).view(np.int64))
            got.setdefault(roots.get(s, s), set()).add(x)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_index_rows_for_a_fingerprint_do_not_depend_on_how_many_there_are(spark):
    rng, per, cuts = np.random.default_rng(4), [], simhash.ring(64, 5)
    for n in (500, 50_000):
        df = spark.createDataFrame([(int(x),) for x in rng.integers(-(2**63), 2**63 - 1, size=n)], "fp long")
        rows = simhash.index_rows(df, cuts)
        per.append(rows.count() / n)
        # keys far over the bound here: each level gives so many rows for one, whatever their number
        crowded = rows.groupBy("key").count().where("count > 1").withColumnRenamed("count", "n")
        held = rows.join(crowded, "key", "left_semi").count()
        assert simhash.finer_rows(rows, crowded, 5).count() == rows.count() + 4 * held
    assert abs(per[0] - per[1]) < 1 and 30 < per[1] < 45


def test_chains_prune_before_the_whole_is_compared():
    """Of 4 bits in one place the chain from there has too many, another chain of the ring doesn't."""
    cuts = simhash.ring(64, 5)
    for start in range(5):
        masks = simhash.chain_masks(cuts, start)
        at, _ = cuts[(start + 2) % 5]
        four, one = np.array([15 << at], dtype=np.uint64), np.array([1 << at], dtype=np.uint64)
        assert not simhash.chained(four, masks, 4)[0] and simhash.chained(one, masks, 4)[0]
    rng = np.random.default_rng(2)
    for _ in range(2000):
        x = sum(1 << int(b) for b in rng.choice(64, size=rng.integers(0, 7), replace=False))
        found = any(simhash.chained(np.array([x], dtype=np.uint64), simhash.chain_masks(cuts, s), 4)[0] for s in range(5))
        assert found == (bin(x).count("1") <= 4)


def test_similar_groups(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(2000)]
    rows, group = [], {}
    for g in range(30):
        base = rng.choices(words, k=300)
        for c in range(5):
            w = list(base)
            for _ in range(c):  # c edits of one word: similarity over 0.87
                w[rng.randrange(300)] = "edited%d" % rng.randrange(10**6)
            group[len(rows)] = g
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in simhash.near_duplicate_groups(df).collect():
        assert r.component_id == group[r.doc_id] * 5


def sets_of(text):
    w = text.encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(len(w) - 4)}


def by_sets(rows):
    """The smallest id of each text's group, by the sets of all pairs."""
    sets, root = [sets_of(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_refused_links_hide_no_true_ones(spark):
    rng = random.Random(7)
    rows = []
    for f in range(12):
        base = [f"f{f}w{rng.randrange(2000)}" for _ in range(300)]
        for _ in range(40):
            w = list(base)
            for at in rng.sample(range(300), rng.randint(2, 6)):
                w[at] = f"e{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(df).collect()} == by_sets(rows)


def test_repeated_words_outweigh_nothing(spark):
    rng = random.Random(11)
    rows = []
    for k in range(20):
        w = [f"t{k}w{rng.randrange(5000)}" for _ in range(700)]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(w[:300] + ["again"] * 98 + w[300:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bits = [np.frombuffer(r.fp, dtype=np.uint64) for r in simhash.band_rows(df, 5, 4).orderBy("doc_id").collect()]
    assert all(np.bitwise_count(a ^ b).sum() <= 56 for a, b in zip(bits[::2], bits[1::2]))
    assert {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(df).collect()} == {i: i // 2 * 2 for i, _ in rows}


def test_groups_come_from_fingerprints_by_chains(spark):
    """Candidates of the wide search are pairs that keys of SimHash bits and the ring's chains find: nearly all of those at 0.8, none of unlike fingerprints."""
    from scriptorium.llm.storage import tables

    rng, same = np.random.default_rng(5), 300
    one = rng.integers(0, 1 << 63, (same, 4), dtype=np.uint64)
    flips = np.packbits(rng.random((same, 256)) < 0.152, axis=1).view(np.uint64).reshape(-1, 4)
    far = rng.integers(0, 1 << 63, (2000, 4), dtype=np.uint64)
    fps = np.concatenate([one, one ^ flips, far])
    df = spark.createDataFrame([(k, x.tobytes()) for k, x in enumerate(fps)], "node long, fp binary")
    for block_rows in (20_000, 2):
        with tables() as keep:
            met = {}
            for r in simhash.sharing(df.where("node < 600") if block_rows == 2 else df, 4, keep, block_rows).collect():
                met.setdefault(r.key, set()).add(r.node)
        pairs = {tuple(sorted(x)) for x in met.values()}
        wanted = {(k, k + same) for k in range(same)}
        assert len(wanted & pairs) >= 297 and len(pairs - wanted) <= 3


def test_cells_of_small_and_large_buckets_are_alike(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, (40, 2), dtype=np.uint64)
    words = base[rng.integers(0, 40, 400)] ^ (np.uint64(1) << rng.integers(0, 64, (400, 2)).astype(np.uint64))
    first = np.zeros(400, dtype=bool)
    first[[0, 1, 50, 300]] = True
    small = simhash.bucket_cells(first, words[:, 0], words[:, 1], 4)
    monkeypatch.setattr(simhash, "WIDE", 10)
    assert (small == simhash.bucket_cells(first, words[:, 0], words[:, 1], 4)).all() and len(np.unique(small)) < 130


def test_set_links_against_all_pairs():
    rng = random.Random(2)
    for _ in range(30):
        sets = [sorted(rng.sample(range(40), rng.randint(0, 12))) for _ in range(25)]
        sets += [sorted({*x, 99}) for x in sets[:5]]
        ids, roots = list(range(100, 100 + len(sets))), [rng.randrange(12) for _ in sets]
        prints = [np.array(x, dtype="<u4").tobytes() for x in sets]
        links = simhash.set_links(ids, roots, prints, 0.6)
        assert all(simhash.similarity(prints[a - 100], prints[b - 100]) >= 0.6 for a, b in links)
        group = list(roots)
        for a, b in links:
            x, y = group[a - 100], group[b - 100]
            group = [x if g == y else g for g in group]
        for i in range(len(sets)):
            for j in range(i):
                if sets[i] and sets[j] and simhash.similarity(prints[i], prints[j]) >= 0.6:
                    assert group[i] == group[j]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.near_duplicate_groups(df).collect() == []


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (None, "zz")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, -1), (-1, 3), (3, 3), (3, 3)]


def test_links_of_sets_like_all_pairs_and_templates_cost_little():
    """Groups joined as by all pairs; a thousand sets of which half is common to all have no pair to compare."""
    import random
    import time

    import numpy as np

    rng = random.Random(6)
    for _ in range(60):
        base = [rng.sample(range(300), rng.randrange(1, 40)) for _ in range(4)]
        sets = [set(rng.choice(base)) ^ set(rng.sample(range(300), rng.randrange(0, 6))) for _ in range(rng.randrange(2, 25))]
        roots = [rng.randrange(len(sets)) for _ in sets]
        prints = [np.array(sorted(x), dtype="<u4").tobytes() for x in sets]
        links = simhash.set_links(list(range(len(sets))), roots, prints, 0.8)
        alike = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] | sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]

        def groups(pairs):
            label = list(roots)
            for a, b in pairs:
                label = [label[a] if x == label[b] else x for x in label]
            return {frozenset(k for k, y in enumerate(label) if y == x) for x in label}

        assert groups(links) == groups(alike) and all((a, b) in alike or (b, a) in alike for a, b in links)
    common = np.arange(2500, dtype=np.uint32)
    prints = [np.concatenate((common, np.arange(10_000 + 2500 * k, 12_500 + 2500 * k, dtype=np.uint32))).astype("<u4").tobytes() for k in range(1000)]
    began = time.process_time()
    assert simhash.set_links(list(range(1000)), list(range(1000)), prints, 0.8) == []
    assert time.process_time() - began < 4
