import hashlib
import json

from pyspark.sql import functions as F

from scriptorium.llm import chat

NASTY = ["\\### Assistant: </turn> ok", "\n</turn>\n", "</turn", "<turn assistant>\nx\n</turn>\n", "\\", "\\\\</turn>\\", "", None, "a\n", "\n", "<", "<t", "é😀<turn", "%3E", "\\<turn"]


def rows():
    out = []
    for c in range(5):
        for k in range(len(NASTY)):
            out.append((c, k, ["user", "assistant", "system", "odd>%0A\n%25role", None][(c + k) % 5], NASTY[(c * 3 + k) % len(NASTY)]))
    return out


def test_reversible_and_masked(spark):
    data = rows()
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3)
    whole = chat.format_chats(chat.from_frame(df))
    texts = {r.conv_id: (r.formatted, r.loss) for r in whole.collect()}
    for r in chat.read_chats(whole).collect():
        own = [(role or "", text or "") for c, _, role, text in data if c == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own
        assert r.loss_text == "".join(text for role, text in own if role == "assistant")
        formatted, loss = texts[r.conv_id]
        assert len(formatted) == r.formatted_chars and formatted.count("\n</turn>\n") == len(own)
        raw = [formatted[m.at : m.at + m.n] for m in loss]
        assert len(raw) == sum(role == "assistant" for role, _ in own)
        assert all(formatted[m.at - m.skip :].startswith("<turn assistant>\n") and formatted[m.at + m.n :].startswith("\n</turn>\n") for m in loss)


def test_layouts_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "human", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "q", "input": " ", "output": "a"},
        {"instruction": "q", "input": "more", "output": "a"},
        {"prompt": "q", "response": "a"},
        {"completion": "a", "prompt": "q"},
        {"question": "q", "answer": None},
        {"system": "s", "instruction": "q", "output": "a"},
        {"what": 1},
        [1, 2],
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(99, "{broken"), (100, None)], "conv_id long, record string")
    mapped = chat.from_json(df)
    got = {r.conv_id: (r.layout, r.status, r.turns and [(t.role, t.text) for t in r.turns]) for r in mapped.collect()}
    plain = [("user", "q"), ("assistant", "a")]
    assert got[0] == ("messages", "mapped", plain) and got[1] == ("from_value", "mapped", plain)
    assert got[2] == ("instruction_input", "mapped", plain) and got[3][2][0] == ("user", "q\n\nmore")
    assert got[4] == ("prompt_response", "mapped", plain) and got[5] == ("prompt_completion", "mapped", plain)
    assert got[6] == ("question_answer", "mapped", [("user", "q"), ("assistant", None)])
    assert got[7][2] == [("system", "s"), *plain]
    assert all(got[k] == (None, "unmapped", None) for k in (8, 9, 99, 100))
    assert chat.explode_turns(mapped).count() == 17


def test_extra_fields_do_no_harm(spark):
    plain = [("user", "q"), ("assistant", "a")]
    records = [
        {"id": 7, "messages": [{"role": "user", "content": "q", "name": "n"}, {"role": "assistant", "content": "a", "tool": {"role": 1, "x": [{"y": 2}]}}], "meta": {"role": "x", "deep": [{"messages": [1]}]}},
        {"instruction": "q", "output": "a"},
        {"instruction": "q", "output": "a", "prompt": 3, "source": {"input": [[1]]}},
        {"zz": None, "question": "q", "answer": "a", "aa": []},
        {"prompt": "q", "response": "a", "system": "s"},
        {"conversations": [{"from": "human", "value": "q", "weight": 0.5}, {"from": "gpt", "value": "a"}], "system": "s"},
        {"messages": [{"role": "user", "content": [{"type": "text"}]}]},
        {"messages": []},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "conv_id long, record string")
    got = {r.conv_id: (r.layout, r.turns and [(t.role, t.text) for t in r.turns]) for r in chat.from_json(df).collect()}
    assert got[0] == ("messages", plain) and got[1] == ("instruction", plain) and got[2] == ("instruction", plain) and got[3] == ("question_answer", plain)
    assert got[4] == ("prompt_response_system", [("system", "s"), *plain]) and got[5] == ("from_value_system", [("system", "s"), *plain])
    assert got[6] == got[7] == (None, None)
    turns = spark.createDataFrame([(1, 0, "user", "q", "x", "y", "z")], "conv_id long, turn long, role string, text string, input string, messages string, t string")
    assert [tuple(r) for r in chat.from_frame(turns).collect()] == [(1, 0, "user", "q")]
    listed = spark.createDataFrame([(1, [("user", "q", "n")], "i", 5)], "conv_id long, messages array<struct<role:string,content:string,name:string>>, input string, turn int")
    assert [tuple(r) for r in chat.from_frame(listed).collect()] == [(1, 0, "user", "q")]


def test_frames_of_other_layouts(spark):
    df = spark.createDataFrame([(1, "q", "a", 5, "x")], "conv_id long, prompt string, completion string, score int, formatted string")
    assert [(r.turn, r.role, r.text) for r in chat.from_frame(df).orderBy("turn").collect()] == [(0, "user", "q"), (1, "assistant", "a")]
    try:
        chat.from_frame(df.select("conv_id", "prompt"))
    except ValueError as e:
        assert "prompt: _" in str(e)
    else:
        raise AssertionError


def test_ties_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, 1, "user", "b"), (None, None, "user", "a"), (None, 1, "assistant", "c"), (None, 1, "user", "b")], "conv_id long, turn long, role string, text string")
    (r,) = chat.read_chats(chat.format_chats(df)).collect()
    assert [(t.role, t.text) for t in r.turns] == [("user", "a"), ("assistant", "c"), ("user", "b"), ("user", "b")] and r.loss_text == "c"
    assert chat.read_chats(chat.format_chats(df.where("false"))).collect() == []


def test_native_plan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    out = chat.read_chats(chat.format_chats(chat.from_frame(df)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert hashlib.sha256(b"").hexdigest() == out.select(F.sha2(F.lit(""), 256)).first()[0]


def test_wrong_kinds_are_unmapped_and_names_do_no_harm(spark):
    """Nothing is taken for a text that is none, nothing is lost without a word, and extra fields of any name and depth are passed over."""
    import json

    deep = {}
    for _ in range(12):
        deep = {"a": deep, "b: _": [deep]}
    one = {"role": "user", "content": "q"}
    records = {
        1: {"messages": [one, {"role": "assistant", "content": [{"type": "text", "text": "a"}]}]}, 2: {"instruction": "i", "input": ["x"], "output": "o"}, 3: {"messages": [one], "role": "x", "content": [1]},
        4: {"messages": [{**one, "a<b>: c": 1}], "x: y": {"<": 2}}, 5: {"messages": [one], "meta": deep}, 6: {"prompt": "p", "response": "r", "system": None}, 7: {"messages": [one], "system": {"text": "s"}},
        8: {"messages": [one, "text"]}, 9: {"messages": {"role": "user", "content": "q"}}, 10: {"prompt": {"a": 1}, "response": "r"}, 11: {"messages": [one, {"role": "assistant"}]}, 12: {"prompt": "p", "completion": 5, "system": "s"},
        13: [], 14: "text", 15: {"messages": []}, 16: {"instruction": "i", "input": "", "output": "o", "system": "s"},
    }
    df = spark.createDataFrame([*((k, json.dumps(v)) for k, v in records.items()), (17, "{broken"), (18, None)], "conv_id long, record string")
    got = {r.conv_id: (r.layout, [tuple(t) for t in r.turns] if r.turns is not None else None) for r in chat.from_json(df).collect()}
    user = [("user", "q")]
    want = {3: ("messages", user), 4: ("messages", user), 5: ("messages", user), 6: ("prompt_response_system", [("user", "p"), ("assistant", "r")]), 11: ("messages", [*user, ("assistant", None)]),
            12: ("prompt_completion_system", [("system", "s"), ("user", "p"), ("assistant", "5")]), 16: ("instruction_input_system", [("system", "s"), ("user", "i"), ("assistant", "o")])}
    assert got == {k: want.get(k, (None, None)) for k in range(1, 19)}
