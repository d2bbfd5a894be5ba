import json
import time

import pytest

from scriptorium import __main__ as cli
from scriptorium.operators import ledger, models


def backend(log, rule):
    """A backend that notes each call in a file."""

    def one(prompt):
        with open(log, "a") as f:
            f.write(json.dumps(prompt) + "\n")
        return rule(prompt)

    return models.RuleBackend(one)


def calls(log):
    return [json.loads(x) for x in open(log)] if log.exists() else []


def prompts(spark, n):
    return spark.range(n).selectExpr("id", "concat('p', cast(id % 10 as string), '-', cast(id as string)) as prompt")


@pytest.mark.parametrize("command, more", [("book", []), ("chunks", [])])
def test_commands_ask_once(spark, tmp_path, command, more):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / f"in/{k}.txt").write_text(f"text {k}. " * 20)
    (tmp_path / "c.yaml").write_text("qa_generation: {pause: 0, retry_delay: 0}\n")
    answer = json.dumps([{"input": "q", "output": "a"}, {"bad": 1}])
    said = lambda p: answer if "text 1" not in p else "{broken"
    args = cli._parser().parse_args(["--config", f"{tmp_path}/c.yaml", command, f"{tmp_path}/in", f"{tmp_path}/out", *more])
    got = cli.run(spark, args, backend(tmp_path / "log", said))
    assert got == ({"written": 2, "set aside": 3} if command == "book" else {"written": 2, "set aside": 1})
    assert len(calls(tmp_path / "log")) == 3 == len(set(calls(tmp_path / "log")))


def test_a_stopped_run_goes_on(spark, tmp_path):
    """The service breaks down in the middle and takes the job with it: what was answered isn't asked again."""
    df, folder, stop = prompts(spark, 40), f"file://{tmp_path}/ledger", tmp_path / "stop"
    stop.write_text("")

    class Broken(BaseException):
        pass

    def rule(p):
        if stop.exists() and p.endswith("7"):
            raise Broken
        return p.upper()

    policy = ledger.Policy(lanes=4, every=3)
    with pytest.raises(Exception, match="Broken"):
        ledger.answered(df, backend(tmp_path / "log1", rule), folder, policy=policy)
    known = {r.prompt_hash for r in ledger.answers(ledger.read(spark, folder)).collect()}
    stop.unlink()
    out = ledger.answered(df, backend(tmp_path / "log2", rule), folder, policy=policy)
    assert {r.prompt: r.raw for r in out.collect()} == {r.prompt: r.prompt.upper() for r in df.collect()}
    assert 0 < len(known) < 40 and len(calls(tmp_path / "log2")) == 40 - len(known)
    ledger.answered(df, backend(tmp_path / "log3", rule), folder, policy=policy).collect()
    assert calls(tmp_path / "log3") == []


def test_attempts_and_causes(spark, tmp_path):
    df = spark.createDataFrame([(1, "good"), (2, "good"), (3, "bad"), (4, None), (5, "")], "id int, prompt string")

    def rule(p):
        if p == "bad":
            raise ValueError("no such thing")
        return "ok" if p else None

    folder = f"file://{tmp_path}/ledger"
    out = ledger.answered(df, backend(tmp_path / "log", rule), folder, policy=ledger.Policy(attempts=2, lanes=3))
    assert {r.id: r.raw for r in out.collect()} == {1: "ok", 2: "ok", 3: None, 4: None, 5: None}
    rows = sorted((r.cause or "", r.attempt, r.response) for r in ledger.read(spark, folder).collect())
    assert rows == [("", 1, "ok"), ("ValueError: no such thing", 1, None), ("ValueError: no such thing", 2, None), ("no answer", 1, None), ("no answer", 2, None)]
    assert ledger.answered(df.where("false"), backend(tmp_path / "log4", rule), f"file://{tmp_path}/none").collect() == []


@pytest.mark.parametrize("lanes", [1, 4])
def test_one_rate_for_all_lanes(spark, tmp_path, lanes):
    """Calls of all tasks together come at the rate asked for, within 10 %, also where answers take longer than a pause."""
    pause, n = 0.08, 75
    slow = 0.0 if lanes == 1 else 2 * pause
    ledger.answered(prompts(spark, n), models.RuleBackend(lambda p: time.sleep(slow) or p), f"file://{tmp_path}/{lanes}", policy=ledger.Policy(pause=pause, lanes=lanes))
    times = sorted(r.asked_at for r in ledger.read(spark, f"file://{tmp_path}/{lanes}").collect())
    assert len(times) == n and (times[-1] - times[0]).total_seconds() / (n - 1) == pytest.approx(pause, rel=0.1)


def test_texts_move_to_their_lanes_once(spark, tmp_path, monkeypatch):
    """Calls are numbered as slots() does, without texts in a window."""
    counts = [3, 0, 5, 1]
    every = [ledger.slot(counts, lane, place) for lane, n in enumerate(counts) for place in range(n)]
    assert sorted(every) == list(range(9))
    rows = ledger.slots(spark.range(40).selectExpr("sha2(cast(id as string), 256) as prompt_hash"), 4).collect()
    held = [sum(r.lane == k for r in rows) for k in range(4)]
    assert all(ledger.slot(held, r.lane, r.place) == r.slot for r in rows)
    monkeypatch.setattr(ledger, "slots", None)
    out = ledger.answered(prompts(spark, 9), models.RuleBackend(str.upper), f"file://{tmp_path}/ledger", policy=ledger.Policy(lanes=3))
    assert {r.raw for r in out.collect()} == {r.prompt.upper() for r in prompts(spark, 9).collect()}
