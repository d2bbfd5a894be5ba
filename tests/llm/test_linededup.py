import random
import re

import numpy as np

from scriptorium.llm import linededup


def pieces(text):
    """Lists of (line, word, word with the blanks after it), a list for each piece of each line."""
    out = []
    for k, line in enumerate(text.encode().split(b"\n")):
        tokens = re.findall(rb"[^ \t-\r]+[ \t-\r]*", line)
        words = [t.split()[0] for t in tokens]
        cuts = {max(range(a, a + 11), key=lambda i: (len(words[i]), words[i][:6], i)) for a in range(len(words) - 10)}
        piece = []
        for i, t in enumerate(tokens):
            piece.append((k, words[i], t))
            if i in cuts or i == len(tokens) - 1:
                out.append(piece)
                piece = []
    return out


def runs_of(sizes, least):
    """From each piece on, and up to each piece, the shortest run of so many words."""
    found = set()
    for a in range(len(sizes)):
        for b in range(a, len(sizes)):
            if sum(sizes[a : b + 1]) >= least:
                found.add((a, b))
                break
    for b in range(len(sizes)):
        for a in range(b, -1, -1):
            if sum(sizes[a : b + 1]) >= least:
                found.add((a, b))
                break
    return sorted(found)


def brute(rows, least, group=None):
    """Every window of every text against all windows before it; no hashes, no selection. group: the smallest id of each id's group."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    first, gone = {}, {}
    cut = {i: pieces(rows[i][1]) for i in order if rows[i][1] is not None}
    grams = {i: [(tuple(tuple(w for _, w, _ in p) for p in cut[i][a : b + 1]), a, b) for a, b in runs_of([len(p) for p in cut[i]], least)] for i in cut}
    for i in cut:
        for gram, _, b in grams[i]:
            if group is None or group[rows[i][0]] == rows[i][0]:
                first.setdefault(gram, (*rows[i], b))
    for i in cut:
        for gram, a, b in grams[i]:
            if one := first.get(gram):
                same = (one[0], one[1]) == rows[i]
                if a > one[2] if same else group is None or group[rows[i][0]] != one[0]:
                    gone.setdefault(i, set()).update(range(a, b + 1))
    out = []
    for i, (_, text) in enumerate(rows):
        if i in gone:
            total, lost = sum(map(len, cut[i])), sum(len(cut[i][k]) for k in gone[i])
            if lost == total:
                text = ""
            else:
                lines = dict(enumerate(text.encode().split(b"\n")))
                for line in {cut[i][k][0][0] for k in gone[i]}:
                    left = b"".join(t for k, p in enumerate(cut[i]) for n, _, t in p if n == line and k not in gone[i])
                    lines[line] = left.rstrip() if left.strip() else None
                text = b"\n".join(x for x in lines.values() if x is not None).decode()
        out.append(text)
    return out


def corpus():
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    line = lambda n: " ".join(word() for _ in range(n))
    passages = [[line(rng.randint(3, 30)) for _ in range(rng.randint(2, 6))] for _ in range(6)] + [[line(60)], [line(26), "", line(26)]]
    common = [line(5) for _ in range(4)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(rng.randint(1, 5)):
            kind = rng.random()
            lines += rng.choice(passages) if kind < 0.4 else [rng.choice(common)] if kind < 0.6 else ["", line(rng.randint(1, 20))]
        rows.append((i, "\n".join(lines)))
    inner = "Here it starts. " + ". ".join(line(rng.randint(3, 9)) for _ in range(9)) + ". The end"
    rows += [(90 + k, f"{line(5)} {inner}{' ' if k % 2 else '. '}{line(7)}. {line(4)}.\n{line(3)}. ") for k in range(6)]
    rows += [(100, rows[0][1]), (101, rows[0][1] + "\nmore"), (102, None), (103, ""), (104, "\n".join(["la la la la"] * 40)), (105, " \n \n")]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    group = {i: 0 if i in (100, 101) else i // 3 * 3 if 30 <= i < 60 else i for i, _ in rows}
    groups = spark.createDataFrame(list(group.items()), "doc_id long, component_id long")
    for least, one in ((50, None), (8, None), (8, group)):
        df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, runs int")
        got = {r.doc_id: r.text for r in linededup.dedup_lines(df, least, groups if one else None).collect()}
        assert got == {i: t for (i, _), t in zip(rows, brute(rows, least, one))}


def test_passages_inside_lines_are_found_wherever_they_stand(spark):
    """51 words in a row, with other words grown to both ends, without a stop or a line's end."""
    rng = random.Random(8)
    word = lambda n=5000: f"w{rng.randrange(n)}" if rng.random() < 0.7 else "the"
    rows, planted = [], []
    for k in range(200):
        passage = [word() for _ in range(51)]
        planted.append(passage)
        for c in range(2):
            own = lambda: [f"own{k}x{c}x{rng.randrange(10**6)}" for _ in range(rng.randint(0, 30))]  # noqa: E731,B023
            rows.append((1000 * c + k, " ".join(own() + passage + own())))
    got = {r.doc_id: r.text.split() for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, passage in enumerate(planted):
        assert got[k] == rows[2 * k][1].split()
        left = [w for w in got[1000 + k] if not w.startswith("own")]
        assert len(left) <= 20 and len(got[1000 + k]) - len(left) >= len(rows[2 * k + 1][1].split()) - 51 - 20


def test_selected_pieces_are_fewer_than_pieces(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(600))) for k in range(50)]
    found = linededup.selections(spark.createDataFrame(rows, "doc_id long, text string"), 30).count()
    cut = sum(len(pieces(t)) for _, t in rows)
    assert 0.15 * cut < found < 0.45 * cut


def test_windows_select_rightmost_minimum():
    small = np.array([5, 3, 3, 9, 1], dtype=np.uint32) * 16 + np.array([2, 2, 2, 2, 3], dtype=np.uint32)
    first, last, pick = linededup.windows(small, np.zeros(5, dtype=np.int64), 6)
    assert sorted(zip(first.tolist(), last.tolist(), pick.tolist())) == [(0, 2, 2), (1, 3, 2), (2, 4, 4)]


def test_null_ids_and_repeated_rows(spark):
    text = "\n".join(f"line number {k} of a passage that is long enough" for k in range(8))
    df = spark.createDataFrame([(None, text), (3, text), (3, text), (4, text + "\nown")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.text) for r in linededup.dedup_lines(df).collect())
    assert got == [(0, text), (3, ""), (3, ""), (4, "own")]
    groups = spark.createDataFrame([(None, 3), (3, 3), (3, 3), (4, 4)], "doc_id long, component_id long")
    assert sorted(((r.doc_id or 0), r.text) for r in linededup.dedup_lines(df, groups=groups).collect()) == [(0, text), (3, text), (3, text), (4, "own")]
    assert linededup.dedup_lines(df.where("false")).collect() == []
