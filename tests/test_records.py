import json

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import figures, strictjson
from scriptorium.operators import assemble, flatten, models, qa
from scriptorium.plans import pipelines

GOOD = '[{"input": "q", "output": "a"}]'


@pytest.mark.parametrize(
    "text, status, n, bad",
    [
        (GOOD, "ok", 1, 0), (f"  {GOOD}\n", "ok", 1, 0), (None, "empty", 0, 0), ("", "empty", 0, 0), (" ", "bad_json", 0, 0), (f"```json\n{GOOD}\n```", "bad_json", 0, 0), (GOOD.replace('"', "'"), "bad_json", 0, 0),
        (GOOD + " done", "bad_json", 0, 0), ('{"input": 1}', "not_list", 0, 0), ('"x"', "not_list", 0, 0), ('[{"a": 1}, 3, null, [1]]', "ok", 1, 3), ("[]", "ok", 0, 0), ("[" * 100_000, "bad_json", 0, 0),
    ],
)
def test_strict_json(text, status, n, bad):
    got = strictjson.parse(text)
    assert (got["status"], len(got["items"]), len(got["bad_items"])) == (status, n, bad)


def test_values_and_keys():
    (item,) = strictjson.parse('[{"a": 1.50, "b": null, "c": "x", "c": "y", "d": ["é"]}]')["items"]
    assert item["fields"] == {"a": "1.5", "b": None, "c": "y", "d": '["é"]'}
    assert [strictjson.json_kind(x) for x in ("{}", "[]", '"s"', "1", "true", "null", "x", None)] == ["object", "array", "string", "number", "boolean", "null", None, None]


def test_missing_and_null_keys(spark):
    raw = '[{"input": null, "output": "a"}, {"output": "b"}, 7, {"input": "q", "output": 2}]'
    found = qa.parse_answers(spark.createDataFrame([(1, raw), (2, "nope")], "id int, raw string"))
    assert sorted((r.pair_no, r.instruction, r.output) for r in qa.records(found, "s").collect()) == [(1, None, "a"), (4, "q", "2")]
    assert sorted((r.id, r.reason, r.item_no) for r in qa.quarantine(found).collect()) == [(1, "missing_key", 2), (1, "not_object", 3), (2, "bad_json", None)]


def test_legacy(spark):
    inner = [{"question": "q", "answer": "a"}]
    rows = [(1, json.dumps([json.dumps(inner)])), (2, json.dumps([inner, "ignored"])), (3, "[]"), (4, "broken")]
    out = qa.convert_legacy(spark.createDataFrame(rows, "id int, raw string"))
    assert sorted((r.id, r.instruction, r.output) for r in out.collect()) == [(1, "q", "a"), (2, "q", "a")]


def test_ordered_text_skips_nulls(spark):
    df = spark.createDataFrame([(1, 10, "c"), (1, 2, "b"), (1, 1, None), (2, 1, None)], "k int, n int, t string")
    assert {r.k: r.o for r in assemble.ordered_concat(df, ["k"], ["n"], "t", "o", between="|").collect()} == {1: "b|c", 2: ""}


def test_numbered(spark):
    df = spark.createDataFrame([("success10.json",), ("success2.json",), ("success_x.json",), ("success99999999999.json",)], "name string")
    good, bad = assemble.merge_numbered(df, r"success(\d+)\.json$")
    assert [r.file_no for r in good.orderBy("file_no").collect()] == [2, 10] and bad.count() == 2


def test_training_rows(spark):
    pages = spark.createDataFrame(
        [("d", 1, "text", [("p", None, "an", "cap"), (None, None, None, "cap2"), ("q", None, None, ""), ("r", None, None, None)]), ("d", 2, " \u3000", None), ("e", 1, None, [])],
        f"doc_id string, page_number int, text string, images {flatten.IMAGES}",
    )
    got = [tuple(r) for r in flatten.training_rows(pages).orderBy("doc_id", "page", "seq").collect()]
    assert got == [("d", 0, "text", "text", 1, None), ("d", 1, "image", "cap", 1, "p"), ("d", 2, "image", "cap2", 1, "")]
    told = spark.createDataFrame([("d", "q", "seen", "now")], "doc_id string, path string, analysis string, caption string")
    rows = pipelines.pages_to_training_rows(pages, told, models.calls(models.RuleBackend(str.upper))).orderBy("page", "seq").collect()
    assert [(r.type, r.content) for r in rows] == [("text", "TEXT"), ("image", "cap"), ("image", "cap2"), ("image", "now")]


def test_figures(spark):
    boxes = [(0, 0, 100, 101), (0, 0, 101, 101), (0, 0, 160, 200), (0, 0, 240, 200), (0, 0, 200, 180)]
    df = spark.createDataFrame([(boxes,)], f"b array<{figures.BOX}>")
    assert [(b.w, b.h) for b in df.select(figures.kept_boxes(F.col("b"))).first()[0]] == [(101, 101), (200, 180)]
    flat = lambda n: [(0, 0, 100, k % 10) for k in range(n)]
    lines = [flat(5), flat(6), flat(8), flat(9), None, [*flat(5), (0, 0, 1000, 176)], [*flat(5), (0, 0, 1000, 177)], [*flat(5), (100, 0, 0, 0)]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lines)], f"k int, l array<{figures.LINE}>")
    got = [r[0] for r in df.orderBy("k").select(figures.looks_like_hexagram(F.col("l"))).collect()]
    assert got == [False, True, True, False, False, True, False, False]


def test_correction_keeps_failed_segments(spark):
    df = spark.createDataFrame([(1, "ab\ncd"), (2, " "), (3, None), (4, "x\ny")], "doc_id int, text string")
    out = models.correct(df, models.calls(models.RuleBackend(lambda s: 1 / 0 if "x" in s else s.upper())), limit=2)
    assert {r.doc_id: (r.text, r.n_failed) for r in out.collect()} == {1: ("AB\nCD", 0), 2: (" ", 0), 3: (None, 0), 4: ("x\ny", 1)}


def test_answers_are_asked_once(spark, tmp_path):
    class Counting:  # here, so that it's pickled with its code
        def __init__(self, path):
            self.path = path

        def complete(self, prompts):
            with open(self.path, "a") as f:
                f.write("x")
            return [None if "fail" in p else p + "!" for p in prompts]

    log, table = str(tmp_path / "calls"), f"file://{tmp_path}/answers"
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "fail")], "id int, prompt string")
    first = models.answer(df, Counting(log), table, attempts=2)
    assert {r.id: r.raw for r in first.collect()} == {1: "a!", 2: "a!", 3: "b!", 4: None, 5: None}
    assert len(open(log).read()) == 4  # a, b, and twice the failing one
    again = models.answer(df.unionByName(spark.createDataFrame([(6, "c")], "id int, prompt string")), Counting(log), table, attempts=1)
    assert again.where("id = 6").first().raw == "c!" and len(open(log).read()) == 6


def test_one_answer_for_a_prompt_and_one_row_for_a_row(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "p"), (2, "q"), (1, "p")], "doc_id long, prompt string").withColumn("raw", F.lit("old"))
    key = models.prompt_key(F.col("prompt"))
    recorded = spark.createDataFrame([("p", "b"), ("p", "a")], "prompt string, response string").select(key.alias("prompt_hash"), "response")
    assert sorted((r.doc_id, r.prompt, r.raw) for r in models.replay(df, recorded).collect() if r.raw) == [(1, "p", "a"), (1, "p", "a")] and models.replay(df, recorded).count() == 3
    texts = spark.createDataFrame([(1, "ab"), (1, "cd"), (None, " \n"), (2, None), (3, "")], "doc_id long, text string")
    got = models.correct(texts, models.calls(models.RuleBackend(lambda s: None if s == "cd" else s.upper()), attempts=1)).collect()
    assert sorted((r.doc_id or 0, r.text or "", r.n_failed) for r in got) == [(0, " \n", 0), (1, "AB", 0), (1, "cd", 1), (2, "", 0), (3, "", 0)]


def test_calls_say_what_they_should():
    from scriptorium.operators import prompts

    body = prompts.CORRECT.backend("u", "m").body("x")
    assert body["temperature"] == 0.3 and body["top_p"] == 0.8 and body["max_tokens"] == 2048 and [m["role"] for m in body["messages"]] == ["system", "user"] and "stream" not in body
    assert prompts.PAIRS.backend("u", "m").body("x")["max_tokens"] == 4096
    assert set(prompts.CHUNK.backend("u", "m").body("x")) == {"model", "messages", "stream"}
    events = [b"data: " + x for x in (b'{"choices": [{"delta": {"content": "a"}}]}', b'{"choices": []}', b'{"choices": [{"delta": {"content": null}}]}', b'{"choices": [{"delta": {"content": "b "}}]}', b"[DONE]", b'{"choices": [{"delta": {"content": "no"}}]}')]
    assert models.streamed([b"", b": ping", *events]) == "ab "


@pytest.mark.parametrize("text, status", [('[3, {"a": ",]"}, ]', "ok"), ('[{"a": 1 ,\n}\t,\n]', "ok"), ("[,]", "bad_json"), ("[1,,]", "bad_json"), ('{"a":,}', "bad_json"), ('["a,]', "bad_json"), ('{"a": "\\\\",}', "not_list")])
def test_last_commas_are_taken_where_asked_for(text, status):
    assert strictjson.parse(text)["status"] == "bad_json" and strictjson.parse(text, True)["status"] == status


def test_texts_are_parsed_in_small_pieces():
    """What is made of the texts of a batch isn't held all at once."""
    import pandas as pd

    from scriptorium.functions.pieces import in_pieces

    batches = [pd.Series(["a" * 400, None, "b" * 700, "", "c" * 3000, "d" * 10]), pd.Series([], dtype=object), pd.Series(["e" * 600, "f" * 600])]
    pieces = [p.tolist() for p in in_pieces(iter(batches), 1000)]
    assert [t for p in pieces for t in p] == [t for b in batches for t in b]
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 1000 for p in pieces) and len(pieces) == 6
    got = list(strictjson.parsed.__globals__["in_pieces"](iter([pd.Series(["[{}]" * 100_000] * 20)])))
    assert len(got) == 10
