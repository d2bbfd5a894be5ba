import random

from pyspark.sql import functions as F

from scriptorium.operators import components, shapes


def pgm(rows, comment=b""):
    return b"P5\n" + comment + f"{len(rows[0])} {len(rows)}\n255\n".encode() + bytes(v for r in rows for v in r)


def frame(spark, images):
    return spark.createDataFrame([(str(k), pgm(x)) for k, x in enumerate(images)], "path string, content binary")


def flood(cells, around):
    """Groups of cells that touch, by walking from cell to cell."""
    left, out = set(cells), []
    while left:
        todo, seen = [left.pop()], []
        while todo:
            x, y = todo.pop()
            seen.append((x, y))
            near = {(x + i, y + j) for i, j in around} & left
            left -= near
            todo += near
        out.append(seen)
    return out


SIDES = [(1, 0), (-1, 0), (0, 1), (0, -1)]
ALL = SIDES + [(1, 1), (1, -1), (-1, 1), (-1, -1)]


def want_boxes(rows):
    w, h = len(rows[0]), len(rows)
    light = {(x, y) for y in range(h) for x in range(w) if rows[y][x] > 127}
    dark = {(x, y) for y in range(-1, h + 1) for x in range(-1, w + 1)} - light
    (outer,) = [set(g) for g in flood(dark, SIDES) if (-1, -1) in g]
    out = []
    for g in flood(light, ALL):
        if any((x + i, y + j) in outer for x, y in g for i, j in SIDES):
            xs, ys = [x for x, _ in g], [y for _, y in g]
            out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(g)))
    return sorted(out)


def test_boxes_against_walking(spark):
    rng = random.Random(7)
    noise = [[[255 if rng.random() < p else 0 for _ in range(w)] for _ in range(h)] for p, w, h in ((0.3, 20, 15), (0.5, 25, 20), (0.6, 150, 6), (0.8, 9, 9), (0.0, 5, 5), (1.0, 5, 4), (0.5, 1, 1))]
    rings = [[255 if max(abs(x - 8), abs(y - 8)) in (0, 1, 4, 8) else 0 for x in range(17)] for y in range(17)]
    spiral = [[0] * 21 for _ in range(21)]
    x = y = d = 0
    for n in (20, 20, 20, 18, 18, 16, 16, 14, 14, 12, 12, 10, 10, 8, 8, 6, 6, 4, 4, 2):
        for _ in range(n):
            spiral[y][x] = 200
            x, y = x + (1, 0, -1, 0)[d], y + (0, 1, 0, -1)[d]
        d = (d + 1) % 4
    images = [*noise, rings, spiral]
    got = {}
    for r in shapes.boxes(frame(spark, images)).collect():
        got.setdefault(int(r.path), []).append((r.x, r.y, r.w, r.h, r.pixels))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in enumerate(map(want_boxes, images)) if v}


def test_thresholds_and_headers(spark):
    rng = random.Random(3)
    images = [[[rng.choice([10, 12, 200, 210, 90]) for _ in range(9)] for _ in range(7)], [[5] * 4] * 3, [[0, 255]], [[rng.randrange(256) for _ in range(16)] for _ in range(16)]]
    df = frame(spark, images).unionByName(spark.createDataFrame([("cut", pgm([[1, 2], [3, 4]])[:-1]), ("no", b"P6\n1 1\n255\n..."), ("empty", b""), ("said", pgm([[0, 9]], b"# a comment 7 7\n"))], "path string, content binary"))

    def best(rows):
        values = [v for r in rows for v in r]
        found = (0.0, 0)
        for t in sorted(set(values)):
            low, high = [v for v in values if v <= t], [v for v in values if v > t]
            if high:
                between = len(low) * len(high) * (sum(low) / len(low) - sum(high) / len(high)) ** 2
                if between > found[0] * (1 + 1e-12):
                    found = (between, t)
        return found[1]

    rows = shapes.pixel_rows(df)
    got = {r.path: r.threshold for r in shapes.otsu(shapes.histograms(rows)).collect()}
    assert got == {**{str(k): best(x) for k, x in enumerate(images)}, "said": 0}
    back = {r.path: bytes(r.content) for r in shapes.binarised(df).collect()}
    assert back["0"] == pgm([[255 if v > got["0"] else 0 for v in r] for r in images[0]]) and back["said"] == pgm([[0, 255]])


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    names = list(range(0, 900))
    rng.shuffle(names)
    edges = [(a, b) for a, b in zip(names[:400], names[1:401])] + [(a, b) for a, b in zip(names[500:700], names[501:701])] + [(names[800], names[800])]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{n: min(names[:401]) for n in names[:401]}, **{n: min(names[500:701]) for n in names[500:701]}, names[800]: names[800]}
    assert components.connected(spark.createDataFrame([], "a long, b long")).collect() == []
    assert shapes.boxes(spark.createDataFrame([], "path string, content binary")).select(F.count("*")).first()[0] == 0


def test_images_of_a_small_table_are_many_tasks_work(spark, sf_dir):
    """The images that the queries draw, and the rows of pixels that boxes are looked for in: dealt out, however few bytes they are."""
    from scriptorium.plans import catalogue
    from scriptorium.sources.shared import dealt

    drawn = catalogue._drawn(spark, sf_dir)
    assert len(drawn.inputFiles()) == 4 and dealt(drawn.coalesce(1)).rdd.getNumPartitions() == 4


def test_boxes_over_strips_against_walking(spark):
    """Regions, holes and what is around them, across strips of one row and of a few."""
    rng = random.Random(11)
    images = [[[255 if rng.random() < p else 0 for _ in range(w)] for _ in range(h)] for p, w, h in ((0.3, 20, 15), (0.5, 25, 20), (0.6, 150, 6), (0.8, 9, 9), (0.4, 70, 12), (1.0, 5, 4), (0.5, 1, 7), (0.5, 7, 1))]
    images += [[[255 if max(abs(x - 8), abs(y - 8)) in (0, 1, 4, 8) else 0 for x in range(17)] for y in range(17)]]
    for strip in (1, 60):
        got = {}
        for r in shapes.boxes(frame(spark, images), strip=strip).collect():
            got.setdefault(int(r.path), []).append((r.x, r.y, r.w, r.h, r.pixels))
        assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in enumerate(map(want_boxes, images)) if v}


def test_taller_images_have_no_more_rows_to_label(spark, monkeypatch):
    """What is joined and labelled follows the regions of images, not their rows of pixels."""
    counted, write = [], shapes.written

    def counting(df, tag):
        out = write(df, tag)
        counted[-1] += out.count()
        return out

    monkeypatch.setattr(shapes, "written", counting)
    for h in (12, 120):
        counted.append(0)
        found = shapes.boxes(frame(spark, [[[255 if 2 <= y < h - 2 and x % 10 > 5 else 0 for x in range(40)] for y in range(h)]] * 2))
        assert sorted((r.x, r.y, r.w, r.h, r.pixels) for r in found.collect()) == sorted([(x, 2, 4, h - 4, 4 * (h - 4)) for x in (6, 16, 26, 36)] * 2)
    assert counted[0] == counted[1]
