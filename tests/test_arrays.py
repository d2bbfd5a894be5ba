import json
import random

import pytest

from scriptorium.sources import arrays, sinks


def test_same_bytes_as_the_plain_writer(spark, tmp_path):
    rows = [(k, "é\n\"q\" " + "字" * (k % 5), None if k % 3 else [k, None], {"a": k} if k % 2 else None) for k in range(200)]
    df = spark.createDataFrame(rows, "n long, t string, l array<int>, m map<string,int>").repartition(7)
    for name, some in (("all", df), ("one", df.where("n = 5")), ("none", df.where("false"))):
        n = sinks.export_array(some, str(tmp_path / f"{name}-1.json"), ["n"], ["l"])
        assert arrays.write_array(some, f"file://{tmp_path}/{name}-2.json", ["n"], ["l"]) == n == some.count()
        assert (tmp_path / f"{name}-1.json").read_bytes() == (tmp_path / f"{name}-2.json").read_bytes()
    placed = spark.createDataFrame([(0, "a", 3, 0), (1, "b", 2, 5)], "part long, name string, size long, at long")
    (tmp_path / "p").mkdir()
    (tmp_path / "p/a").write_bytes(b"1,2")
    (tmp_path / "p/b").write_bytes(b"33")
    arrays._one_by_one(placed, f"file://{tmp_path}/p", f"file://{tmp_path}/c.json")
    assert (tmp_path / "c.json").read_bytes() == b"[\n1,2,\n33\n]"


@pytest.mark.parametrize("indent", [None, 4])
def test_elements_by_any_ranges(spark, tmp_path, indent):
    rng = random.Random(2)
    odd = ['"', "\\", "\\\\", "[", "]", "{", "}", ",", "\\\"", "é", "字", " ", "\n", "x"]
    text = lambda: "".join(rng.choice(odd) for _ in range(rng.randrange(12)))
    items = [rng.choice([text(), 5, None, [text(), [1, []]], {text(): [text()], "b": {"c": text()}}, {}]) for _ in range(120)]
    (tmp_path / "a.json").write_text(json.dumps(items, ensure_ascii=rng.random() < 0.5, indent=indent))
    for size in (61, 1000, 1 << 20):
        got = sorted((r["at"], r["item"]) for r in arrays.read_array(spark, f"file://{tmp_path}/a.json", size).collect())
        assert [json.loads(x) for _, x in got] == items
    for bad in ("[1, 2", '["a]'):
        (tmp_path / "b.json").write_text(bad)
        with pytest.raises(ValueError):
            arrays.read_array(spark, f"file://{tmp_path}/b.json")
    (tmp_path / "e.json").write_text(" [ ] ")
    assert arrays.read_array(spark, f"file://{tmp_path}/e.json").collect() == []


def test_many_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"n": k, "t": "x" * 50} for k in range(2000)]))
    df = arrays.read_large_rows(spark, f"file://{tmp_path}/a.json", "n long, t string", 1 << 13)
    held = df.selectExpr("spark_partition_id() p", "n").groupBy("p").count().collect()
    assert len(held) > 5 and sorted(r.n for r in df.collect()) == list(range(2000))


def test_ranges_share_tasks(spark, tmp_path):
    """A file of many ranges is read by four times as many tasks as shuffles have at most, not by one for each range."""
    path = tmp_path / "many.json"
    path.write_text("[" + ",".join(f'"{k}"' for k in range(500)) + "]")
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = arrays.read_array(spark, f"file://{path}", 10)
    assert arrays.ranges(spark, f"file://{path}", 10).rdd.getNumPartitions() <= parts and df.rdd.getNumPartitions() <= parts
    assert sorted(int(r["item"].strip('"')) for r in df.collect()) == list(range(500))
