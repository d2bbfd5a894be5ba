import json

import pytest

from scriptorium import __main__ as cli
from scriptorium.operators import models, prompts
from scriptorium.operators.images import Found, describe_images, split_regions


def go(spark, *argv, backend=None):
    return cli.run(spark, cli._parser().parse_args(list(map(str, argv))), backend)


def test_book_and_its_answers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x" * 50 + "\r\n" + "y" * 30)
    (tmp_path / "c.yaml").write_text("qa_generation: {max_segment_length: 40, overlap_length: 10}\n")
    said = lambda s: s.removeprefix(prompts.PAIRS_BEFORE).removesuffix(prompts.PAIRS_AFTER)
    rule = models.RuleBackend(lambda s: json.dumps([{"input": said(s)[:3], "output": "o"}, {"x": 1}]) if "y" not in said(s) and said(s) != s else "no json")
    for k in range(2):
        got = go(spark, "--config", tmp_path / "c.yaml", "book", tmp_path / "a.txt", tmp_path / f"out{k}", "--answers", f"file://{tmp_path}/answers", backend=rule)
        assert got == {"written": 1, "set aside": 3}
    assert spark.read.parquet(f"{tmp_path}/out0/good").first().instruction == "xxx"


def test_chunks(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x" * 4500)
    assert go(spark, "chunks", tmp_path / "a.txt", tmp_path / "out", 1, backend=models.RuleBackend(lambda s: "{}" if len(s) == 2000 else "{")) == {"written": 1, "set aside": 1}
    with pytest.raises(SystemExit):
        cli._parser().parse_args(["chunks", "only"])


def test_merge_convert_reshape_clean(spark, tmp_path):
    for folder in ("m", "c", "r", "t"):
        (tmp_path / folder).mkdir()
    (tmp_path / "m/success10.json").write_text(json.dumps([{"instruction": "q", "output": "a", "system": "s", "more": [1, None]}, 5]))
    (tmp_path / "m/success2.json").write_text('[{"z": "é", "a": 1.0}]')
    (tmp_path / "m/success3.json").write_text("{}")
    (tmp_path / "m/success_x.json").write_text("[]")
    (tmp_path / "c/qa_pairs_1.json").write_text(json.dumps([json.dumps([{"question": "q", "answer": "a"}])]))
    (tmp_path / "r/any.json").write_text(json.dumps([{"input": "q", "output": "a"}, {"input": "q"}]))
    (tmp_path / "t/x.txt").write_bytes("一\r\n二".encode("gb18030"))
    assert go(spark, "merge", tmp_path / "m", tmp_path / "om") == {"written": 3, "set aside": 2}
    merged = spark.read.parquet(f"{tmp_path}/om/good").orderBy("file_no", "item_no").collect()
    assert [json.loads(r["item"]) for r in merged] == [{"z": "é", "a": 1.0}, {"instruction": "q", "output": "a", "system": "s", "more": [1, None]}, 5] and merged[0]["item"].startswith('{"z"')
    assert go(spark, "convert", tmp_path / "c", tmp_path / "oc") == {"written": 1, "set aside": 0}
    assert go(spark, "reshape", tmp_path / "r", tmp_path / "or", "--system", "s") == {"written": 1, "set aside": 1}
    assert go(spark, "clean", tmp_path / "t", tmp_path / "ot") == {"written": 1, "set aside": 0}
    assert spark.read.parquet(f"{tmp_path}/ot/good").first().text == "一 二"
    spark.createDataFrame([("d", 1, "t", None)], "doc_id string, page_number int, text string, images array<struct<path:string,position:struct<x:int,y:int,width:int,height:int>,analysis:string,caption:string>>").write.parquet(f"{tmp_path}/pages")
    assert go(spark, "rows", tmp_path / "pages", tmp_path / "orows") == {"written": 1, "set aside": 0}
    (tmp_path / "fix.yaml").write_text("text_correction: {enable: true, max_retries: 1, retry_delay: 0}\n")
    rule = models.RuleBackend(lambda s: "fixed" if s == prompts.CORRECT_BEFORE + "t" else None)
    assert go(spark, "--config", tmp_path / "fix.yaml", "rows", tmp_path / "pages", tmp_path / "ofix", backend=rule) == {"written": 1, "set aside": 0}
    assert spark.read.parquet(f"{tmp_path}/ofix/good").first().content == "fixed"


def test_images(spark):
    df = spark.createDataFrame([("a", b"6"), ("b", b"broken"), ("c", b"0")], "path string, content binary")

    def detect(png):
        n = int(png)
        return Found([(1, 1, 40)] if n else None, [(0, 0, 31, 31)] if n else [], [(0, k, 100, k) for k in range(n)] or None, " 字 " if n else "")

    got = {r.path: r for r in describe_images(df, detect, lambda pngs: [None if p == b"0" else "model" for p in pngs]).collect()}
    assert got["a"].analysis == "图中包含圆形和方形卦象结构，检测到6条线条，符合卦象基本特征。\n图中包含文字信息：字"
    assert got["a"].caption == got["a"].analysis + "\n基础图像描述：model"
    assert (got["b"].status, got["b"].analysis) == ("failed", "图片分析失败")
    assert got["c"].analysis == "图中不完全符合卦象特征。" and got["c"].caption == "图片描述生成失败"
    regions = split_regions(df, lambda png: [(0, 0, 50, 60), (1, 1, 51, 51)] if png == b"6" else [], lambda png, b: png + bytes([b[2]])).collect()
    assert [(r.path, r.region, bytes(r.png)) for r in regions] == [("a", 0, b"6\x33")]
