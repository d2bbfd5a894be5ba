import json

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import flatten
from scriptorium.operators.images import Found
from scriptorium.plans import pipelines
from scriptorium.sources import config, files, sinks
from scriptorium.streaming import incoming


def test_encodings(spark, tmp_path):
    text = "第一章 梅花易数\r\n乾卦。\r"
    for name, raw in (("a.txt", text.encode()), ("b.txt", text.encode("gb18030")), ("c.txt", b"\xef\xbb\xbfx"), ("d.txt", b"\xff\xfe\x00\xd8\x01"), ("e.txt", b"")):
        (tmp_path / name).write_bytes(raw)
    got = {r.doc_id: (r.text, r.encoding) for r in files.read_any_texts(spark, str(tmp_path)).collect()}
    want = text.replace("\r\n", "\n").replace("\r", "\n")
    assert got["a.txt"] == (want, "utf-8") and got["b.txt"] == (want, "gb18030") and got["c.txt"] == ("x", "utf-8")
    assert "e.txt" not in got and files.decode(b"") == ("", "utf-8") and files.decode(None) == (None, None)  # Spark lists no empty files
    assert got["d.txt"][0] is None or got["d.txt"][1] != "utf-8"
    assert {r.doc_id: r.text for r in files.read_texts(spark, f"{tmp_path}/a.txt").collect()} == {"a.txt": want}


def test_numbered_files_and_export(spark, tmp_path):
    for name, value in (("success10.json", [{"input": "x", "output": "y"}]), ("success2.json", [{"input": "é", "output": "字"}]), ("success_x.json", []), ("other.json", [])):
        (tmp_path / name).write_text(json.dumps(value))
    good, bad = files.read_numbered(spark, str(tmp_path))
    assert [(r.name, r.file_no) for r in good.orderBy("file_no").collect()] == [("success2.json", 2), ("success10.json", 10)]
    assert [r.name for r in bad.collect()] == ["success_x.json"]
    from scriptorium.operators import qa

    rows = qa.records(qa.parse_answers(good.drop("name")), "s")
    assert sinks.export_array(rows, str(tmp_path / "all.json"), ["file_no", "pair_no"], ["file_no", "pair_no"]) == 2
    text = (tmp_path / "all.json").read_text()
    assert json.loads(text) == [{"instruction": "é", "output": "字", "system": "s"}, {"instruction": "x", "output": "y", "system": "s"}]
    assert text == json.dumps(json.loads(text), ensure_ascii=False, indent=4)
    assert sinks.export_array(rows.where("false"), str(tmp_path / "none.json"), ["file_no"]) == 0 and (tmp_path / "none.json").read_text() == "[]"


def test_training_row_files(spark, tmp_path):
    rows = [{"type": "text", "content": "a", "page": 1}, {"type": "image", "content": "b", "page": 1, "image_path": "p"}]
    (tmp_path / "t.json").write_text(json.dumps(rows))
    assert files.read_training_rows(spark, str(tmp_path / "t.json")).where("type = 'text'").first().content == "a"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "c")], "seg_no int, t string, u string")
    sinks.write_lines(df, f"{tmp_path}/lines")
    assert '"u":null' in "".join(p.read_text() for p in (tmp_path / "lines").glob("*.json"))
    sinks.write_parts(df, f"{tmp_path}/parts")
    assert sorted(p.name for p in (tmp_path / "parts").glob("seg_no=*")) == ["seg_no=1", "seg_no=2"]
    sinks.write_with_quarantine(df, df.where("u is null"), f"{tmp_path}/both")
    assert spark.read.parquet(f"{tmp_path}/both/quarantine").count() == 1
    assert df.select(sinks.part_name(F.col("seg_no"))).first()[0] == "part_001.json"


def test_documents_to_training_rows_with_fakes(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one|two")
    documents = spark.read.format("binaryFile").load(f"{tmp_path}/*.pdf")
    pages = files.read_pages(files.render_pages(documents, lambda raw: raw.split(b"|")), lambda png: f" page {png.decode()}\n", lambda png: [(0, 0, 50, 50), (1, 2, 150, 150), (5, 6, 200, 180)] if png == b"two" else [])
    rows = pages.orderBy("page_number").collect()
    assert [(r.text, [(i.path, i.position.width) for i in r.images]) for r in rows] == [("page one", []), ("page two", [("figures/a.pdf/page_00002_figure_000.png", 150), ("figures/a.pdf/page_00002_figure_001.png", 200)])]
    crops = files.cut_figures(pages, lambda png, box: png + str(box).encode()).orderBy("path").collect()
    assert [bytes(c.png) for c in crops] == [b"two(1, 2, 150, 150)", b"two(5, 6, 200, 180)"]
    told = spark.createDataFrame([(c.doc_id, c.path, "a", "caption") for c in crops], "doc_id string, path string, analysis string, caption string")
    out = pipelines.pages_to_training_rows(pages.drop("png"), told).orderBy("page", "seq").collect()
    assert [(r.type, r.content, r.page) for r in out] == [("text", "page one", 1), ("text", "page two", 2), ("image", "caption", 2), ("image", "caption", 2)]
    assert "position" in flatten.IMAGES


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "c.yaml").write_text("pdf_processing: {dpi: 150, preprocessing: {enable: true}}\nqa_generation: {max_segment_length: 2000, overlap_length: 200, api_key: secret}\n")
    got = config.load(str(tmp_path / "c.yaml"))
    assert got.pdf_processing.dpi == 150 and got.qa_generation.max_segment_length == 2000 and got.text_correction.batch_size == 1000
    assert "secret" not in repr(got)
    monkeypatch.delenv("NOT_THERE", raising=False)
    with pytest.raises(KeyError):
        config.secret("NOT_THERE")


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    folder.mkdir()
    (folder / "a.txt").write_text("x" * 2500)
    incoming.run_available(incoming.chunks(spark, str(folder)), out, mark).awaitTermination()
    (folder / "b.txt").write_text("y\r\nz")
    incoming.run_available(incoming.chunks(spark, str(folder)), out, mark).awaitTermination()
    got = sorted((r.doc_id, r.chunk_no, len(r.chunk)) for r in spark.read.parquet(out).collect())
    assert got == [("a.txt", 1, 2000), ("a.txt", 2, 500), ("b.txt", 1, 3)]


def test_resume(spark):
    texts = spark.createDataFrame([("d", "x" * 5000)], "doc_id string, text string")
    done = pipelines.texts_to_chunks(texts, start_index=2).select("doc_id", "chunk_no")
    assert [r.chunk_no for r in done.collect()] == [3]
    assert sorted(r.chunk_no for r in pipelines.texts_to_chunks(texts, done=done).collect()) == [1, 2]
    with pytest.raises(ValueError):
        pipelines.texts_to_chunks(texts, start_index=-1)


def test_documents_in_one_go_and_image_files(spark, tmp_path):
    documents = spark.createDataFrame([("x/a.pdf", b"one|two|bad")], "path string, content binary")

    def read(png):
        if png == b"BAD":
            raise ValueError
        return png.decode()

    def find(png):
        return [(0, 0, 150, 150)] if png == b"TWO" else 1 // 0 if png == b"BAD" else []

    rows = pipelines.documents_to_training_rows(documents, lambda raw: raw.split(b"|"), read, find, lambda png, box: png + b"!", lambda png: Found(None, [], None, png.decode()), lambda pngs: ["seen"] * len(pngs), prepare=lambda png: png.upper())
    got = [(r.type, r.content, r.page) for r in rows.orderBy("page", "seq").collect()]
    assert got == [("text", "ONE", 1), ("text", "TWO", 2), ("image", "图中不完全符合卦象特征。\n图中包含文字信息：TWO!\n基础图像描述：seen", 2)]
    pictures = spark.createDataFrame([("p", b"6")], "path string, content binary")
    (one,) = pipelines.regions_to_analysis(pictures, lambda png: [(0, 0, 60, 60), (0, 0, 50, 60)], lambda png, b: png + b"x", lambda png: Found([(1, 1, 1)], [], None, png.decode())).collect()
    assert (one.path, one.region, one.status) == ("p", 0, "ok") and "6x" in one.analysis
    pngs = spark.createDataFrame([("d/1.png", b"abc"), ("d/2.png", b"")], "path string, png binary")
    assert sorted((r.path, r.bytes) for r in sinks.write_images(pngs, f"file://{tmp_path}/figures").collect()) == [("d/1.png", 3), ("d/2.png", 0)]
    assert (tmp_path / "figures/d/1.png").read_bytes() == b"abc"


def test_failures_are_rows(spark):
    """A renderer, a reader, a finder, a cutter and a detector that fail take nothing else with them."""
    documents = spark.createDataFrame([("x/a.pdf", b"one|two"), ("x/bad.pdf", b"first|!"), ("x/c.pdf", b"three|unread|unfound|uncut")], "path string, content binary")

    def render(raw):
        for page in raw.split(b"|"):
            if page == b"!":
                raise OSError("broken")
            yield page

    def fails_on(word, otherwise):
        def run(png, *more):
            if bytes(png) == word:
                raise ValueError
            return otherwise(png, *more)

        return run

    read, find = fails_on(b"unread", lambda png: png.decode()), fails_on(b"unfound", lambda png: [(0, 0, 150, 150)])
    cut = fails_on(b"uncut", lambda png, box: png)
    pages = files.read_pages(files.render_pages(documents, render), read, find)
    got = sorted((r.doc_id, r.page_number, r.text, len(r.images), r.status) for r in pages.collect())
    assert got == [("a.pdf", 1, "one", 1, "ok"), ("a.pdf", 2, "two", 1, "ok"), ("bad.pdf", 1, "first", 1, "ok"), ("bad.pdf", 2, "", 0, "not rendered: OSError"), ("c.pdf", 1, "three", 1, "ok"), ("c.pdf", 2, "", 1, "not read: ValueError"), ("c.pdf", 3, "unfound", 0, "no figures: ValueError"), ("c.pdf", 4, "uncut", 1, "ok")]
    crops = {r.path: r.png and bytes(r.png) for r in files.cut_figures(pages, cut).collect()}
    assert len(crops) == 6 and [v for v in crops.values()].count(None) == 1
    rows = pipelines.documents_to_training_rows(documents, render, read, find, cut, lambda png: Found(None, [], None, png.decode()), lambda pngs: ["seen"] * len(pngs))
    texts = sorted((r.doc_id, r.page, r.type) for r in rows.collect())
    assert texts == [("a.pdf", 1, "image"), ("a.pdf", 1, "text"), ("a.pdf", 2, "image"), ("a.pdf", 2, "text"), ("bad.pdf", 1, "image"), ("bad.pdf", 1, "text"), ("c.pdf", 1, "image"), ("c.pdf", 1, "text"), ("c.pdf", 2, "image"), ("c.pdf", 3, "text"), ("c.pdf", 4, "image"), ("c.pdf", 4, "text")]
    pictures = spark.createDataFrame([("p", b"good"), ("q", b"unfound"), ("r", b"uncut")], "path string, content binary")
    regions = sorted((r.path, r.region, r.status) for r in pipelines.regions_to_analysis(pictures, find, cut, lambda png: Found(None, [], None, png.decode())).collect())
    assert regions == [("p", 0, "ok"), ("q", None, "failed"), ("r", 0, "failed")]
    assert files.render_pages(documents.where("false"), render).collect() == []
