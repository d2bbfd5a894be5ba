import math

from scriptorium.operators import hough

from test_shapes import frame


def drawn(w, h, *cells):
    rows = [[0] * w for _ in range(h)]
    for some in cells:
        for x, y in some:
            rows[y][x] = 255
    return rows


def line(x1, y1, x2, y2):
    n = max(abs(x2 - x1), abs(y2 - y1))
    return {(round(x1 + (x2 - x1) * k / n), round(y1 + (y2 - y1) * k / n)) for k in range(n + 1)}


def disc(cx, cy, r):
    return {(x, y) for x in range(cx - r, cx + r + 1) for y in range(cy - r, cy + r + 1) if (x - cx) ** 2 + (y - cy) ** 2 <= r * r}


def test_segments_found_again(spark):
    ends = [(5, 10, 95, 10), (100, 5, 100, 75), (10, 20, 80, 90), (20, 95, 110, 60)]
    images = [drawn(130, 100, line(*e)) for e in ends] + [drawn(130, 100, line(*ends[0]), line(8, 40, 58, 40), line(75, 40, 128, 40), line(3, 70, 40, 70)), drawn(30, 20)]
    got = {}
    for r in hough.lines(hough.edge_points(frame(spark, images))).collect():
        got.setdefault(int(r.path), []).append((r.x1, r.y1, r.x2, r.y2))
    for k, e in enumerate(ends):
        assert len(got[k]) == 1 and max(abs(a - b) for a, b in zip(got[k][0], e if e[0] < e[2] or e[1] < e[3] else e[2:] + e[:2])) <= 12
    # the second row has a gap of 17, the third segment is too short
    assert sorted(got[4]) == [(5, 10, 95, 10), (8, 40, 58, 40), (75, 40, 128, 40)] and 5 not in got


def test_circles_found_again(spark):
    places = [[(50, 45, 32)], [(40, 40, 30), (120, 60, 36)], []]
    images = [drawn(165, 100, *[disc(*p) for p in some]) for some in places]
    images[2] = drawn(165, 100, {(x, y) for x in range(20, 120) for y in range(20, 80)})
    got = {}
    for r in hough.circles(hough.edge_points(frame(spark, images)), radii=(28, 40)).collect():
        got.setdefault(int(r.path), []).append((r.x, r.y, r.r))
    assert 2 not in got
    for k, some in enumerate(places[:2]):
        assert len(got[k]) == len(some)
        for found, want in zip(sorted(got[k]), some):
            assert math.dist(found[:2], want[:2]) <= 2 and abs(found[2] - want[2]) <= 2


def test_keys_beyond_int_draw_the_same_lines(spark, tmp_path):
    """Keys further on by a multiple of all periods; their sums pass an int."""
    from scriptorium.plans import catalogue

    far, found = 1_890_000_000, []
    for shift in (0, far):
        folder = str(tmp_path / str(shift))
        spark.range(30).selectExpr(f"id + {shift} as s_suppkey").write.parquet(f"{folder}/supplier.parquet")
        found.append(sorted((r.ten - shift // 10, r.x1, r.y1, r.x2, r.y2, r.points) for r in catalogue.line_segments(spark, folder).collect()))
    assert found[0] == found[1] != []
