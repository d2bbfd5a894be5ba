import base64
import gzip
import hashlib
import io
import random

import pytest

from scriptorium.llm import warc

PAGES = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://a/4", ""), (0, "http://a/0", "x" * 5000), (9, "u\r\nWARC-Type: evil", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (9, "v", "other"), (8, "v", "other")]


def brute(pages, least=0):
    out = []
    for page, _, html in pages:
        raw = (html or "").encode()
        first = min(p for p, _, h in pages if (h or "").encode() == raw)
        again = page != first and len(raw) >= least
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, least):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, role string")
    got = warc.captures(spark, warc.write_archives(df, min_bytes=least))
    assert sorted((tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr) == brute(PAGES, least)


def test_repeated_null_and_empty(spark):
    df = spark.createDataFrame([(None, "u", "a"), (5, "u", "a"), (5, "u", "a"), (None, "u", "only")], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in warc.captures(spark, warc.write_archives(df)).collect())
    assert got == [(0, "response", 0), (0, "revisit", 5), (5, "response", 0), (5, "response", 0)]
    assert warc.captures(spark, warc.write_archives(df.where("false"))).collect() == []


def test_payloads_come_back(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = warc.read_archives(spark, warc.write_archives(df), with_payload=True).collect()
    assert {bytes(r.payload) for r in rows if r.type == "response"} == {(h or "").encode() for _, _, h in PAGES}
    assert len(rows) - sum(r.type == "warcinfo" for r in rows) == 3 * len(PAGES) and {r.status for r in rows} == {"ok"}


def test_record_format():
    raw = warc.record("response", "<urn:x>", b"HTTP/1.1 200 OK\r\n\r\nab\r\n\r\ncd", Content_Type="application/http; msgtype=response", WARC_Concurrent_To="<urn:y>")
    plain = gzip.decompress(raw)
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and plain.endswith(b"cd\r\n\r\n")
    ((head, block, status),) = list(warc.records(gzip.GzipFile(fileobj=io.BytesIO(raw))))
    assert head["warc-concurrent-to"] == ["<urn:y>"] and status == "ok" and warc.payload_of(head, block) == b"ab\r\n\r\ncd"


def found(spark, rows):
    return spark.createDataFrame([(i, t, c, "t", None, "d", n, "s", {"k": i or ""}, "ok") for i, t, c, n in rows], warc.FIELDS)


def assembled(df):
    named = lambda x: [m.record_id for m in x]
    return sorted(((r.hub, r.type, named(r.requests), named(r.metadata), named(r.others)) for r in warc.assemble(df).collect()), key=repr)


def test_assembly_by_either_side_and_through_members(spark):
    rows = [
        ("a", "response", ["ra"], 10), ("ra", "request", [], 1), ("ma", "metadata", ["ra"], 2),
        ("b", "revisit", [], 0), ("rb", "request", ["b"], 1), ("rb2", "request", ["b"], 1), ("mb", "metadata", ["b"], 2), ("mb2", "metadata", ["rb"], 3), ("mb3", "metadata", ["mb2"], 3), ("mb4", "metadata", ["mb3", "mb4"], 3),
        ("c", "response", [], 5), ("lost", "metadata", ["nowhere"], 1), ("w", "warcinfo", ["c"], 1), ("v", "conversion", [], 1),
        ("m", "metadata", ["told", "d"], 1), ("told", "metadata", [], 1), ("d", "resource", [], 4), ("e", "response", ["gone"], 1), ("f", "request", ["gone"], 1), ("e2", "resource", ["f"], 1),
    ]
    df = found(spark, rows)
    whole = [
        ("a", "response", ["ra"], ["ma"], []), ("b", "revisit", ["rb", "rb2"], ["mb", "mb2", "mb3", "mb4"], []), ("c", "response", [], [], []),
        ("d", "resource", [], ["m", "told"], []), ("e", "response", ["f"], [], ["e2"]), (None, None, [], ["lost"], []), (None, None, [], [], ["v"]),
    ]
    assert assembled(df) == sorted(whole, key=repr)
    cut = df.unionByName(spark.createDataFrame([("z", "response", [], "t", None, "d", None, None, {}, "truncated"), (None, None, [], None, None, None, None, None, {}, "damaged")], warc.FIELDS))
    assert assembled(cut) == assembled(df)
    assert assembled(df.where("false")) == []


@pytest.mark.parametrize("seed", range(3))
def test_assembly_against_brute_force(spark, seed):
    rng = random.Random(seed)
    ids = [f"<{k:03d}>" for k in range(160)]
    rows = [(i, rng.choice(["response", "revisit", "resource", "request", "metadata", "conversion"]), rng.sample(ids, rng.choice([0, 0, 1, 1, 1, 2])) + rng.choice([[], [], ["<gone>"], [i]]) * (k % 9 == 0), k) for k, i in enumerate(ids[:120])]
    # a chain of metadata with the capture at its far end
    rows += [("chain00", "response", [], 1)] + [(f"chain{k:02d}", "metadata", [f"chain{k - 1:02d}"], 1) for k in range(1, 40)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i, _, names, _ in rows:
        for o in names:
            root[top(i)] = top(o)
    groups = {}
    for i, kind, _, _ in rows:
        groups.setdefault(top(i), []).append((i, kind))
    want = []
    for members in groups.values():
        hubs = sorted((warc.HUBS.index(k), i) for i, k in members if k in warc.HUBS)
        of = lambda some, what: sorted(i for i, k in some if what(k))
        for hub, some in [(hubs[0][1], members)] if hubs else [(None, [m]) for m in members]:
            want.append((hub, dict(some).get(hub), of(some, lambda k: k == "request"), of(some, lambda k: k == "metadata"), sorted(i for i, k in some if k not in ("request", "metadata") and i != hub)))
    assert assembled(found(spark, rows).repartition(3)) == sorted(want, key=repr)


def test_records_of_one_id_or_none(spark):
    rows = [("a", "response", [], 7), ("a", "response", ["r"], 5), ("r", "request", [], 1), ("x", "metadata", ["r"], 1), ("x", "metadata", ["b"], 2), ("b", "revisit", [], 1), (None, "response", ["a"], 1), (None, "request", ["a"], 1)]
    got = assembled(found(spark, rows))
    assert got == sorted([("a", "response", ["r"], ["x", "x"], ["b"]), (None, None, [None], [], []), (None, None, [], [], [None])], key=repr)
    assert [r.payload_bytes for r in warc.assemble(found(spark, rows)).collect() if r.hub] == [5]


def test_many_that_name_a_missing_record_do_not_meet(spark):
    rows = [(f"m{k}", "metadata", ["nowhere"], 1) for k in range(500)]
    assert [len(m) for _, _, _, m, _ in assembled(found(spark, rows))] == [1] * 500


def test_files_close(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    files = warc.write_archives(df, file_bytes=1)
    assert files.count() == len(PAGES) and {r.n_records for r in files.collect()} == {4}
    got = warc.captures(spark, files)
    assert sorted((tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr) == brute(PAGES)


def test_revisits_name_what_they_refer_to(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    heads = []
    for r in warc.write_archives(df.where("page_id in (1, 2)")).collect():
        with open(r.path.removeprefix("file://"), "rb") as f, warc.unpacked(f) as stream:
            heads += [h for h, _, _ in warc.records(stream)]
    (revisit,) = [h for h in heads if h["warc-type"] == ["revisit"]]
    assert revisit["warc-refers-to-target-uri"] == ["http://a/1"] and revisit["warc-refers-to-date"] == [warc.DATE]
    assert heads[0]["warc-type"] == ["warcinfo"]


def test_plain_and_damaged_archives(spark, tmp_path):
    one = lambda k, n: (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <{k}>\r\nContent-Length: {n}\r\n\r\n" + "x" * n + "\r\n\r\n").encode()
    packed = warc.record("resource", "<g>", b"y" * 1019)
    noise = bytes(range(256)) * 40
    files = {
        "plain": one("a", 5) + one("b", 7),
        "packed": gzip.compress(one("c", 5)) + packed,
        "cut plain": one("d", 5) + one("e", 50)[:-30],
        "cut packed": packed + warc.record("resource", "<h>", noise)[:-200],
        "cut head": one("f", 5) + b"WARC/1.1\r\nWARC-Type: resource\r\n",
        "no length": one("i", 3) + b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <j>\r\n\r\nlost\r\n\r\n" + one("k", 4),
        "garbage": b"<html>\nnot an archive\n" + one("l", 4),
        "bad member": packed + b"\x1f\x8b\x08" + noise[:300],
        "bad bits": packed[:60] + bytes([packed[60] ^ 255]) + packed[61:],
        "empty": b"",
    }
    for name, data in files.items():
        (tmp_path / name.replace(" ", "_")).write_bytes(data)
    df = spark.createDataFrame([(f"file://{tmp_path}/{name.replace(chr(32), chr(95))}", name) for name in files], "path string, status string")
    rows = warc.read_archives(spark, df, with_payload=True).collect()
    good = sorted((r.record_id, r.payload_bytes) for r in rows if r.status == "ok")
    assert good[:7] == [("<a>", 5), ("<b>", 7), ("<c>", 5), ("<d>", 5), ("<f>", 5), ("<g>", 1019), ("<g>", 1019)]
    assert [x for x, _ in good if x > "<g>"] == ["<i>", "<k>", "<l>"]
    bad = sorted((r.status, r.record_id or "") for r in rows if r.status != "ok")
    assert ("truncated", "<e>") in bad and ("truncated", "<h>") in bad and ("truncated", "") in bad and ("damaged", "<j>") in bad
    assert all(r.payload is None and r.payload_bytes is None for r in rows if r.status != "ok") and sum(s == "damaged" for s, _ in bad) >= 3
