import random
from datetime import datetime, timedelta

import pytest

from scriptorium.plans import catalogue
from scriptorium.streaming import calls

START = datetime(2024, 1, 1)
DELTAS = "call_id long, seq long, has_choice boolean, content string, last boolean, at timestamp"
TURNS = "conv_id long, turn long, text string, at timestamp"


@pytest.fixture
def stream(spark, tmp_path):
    """Works off files that are added, one batch each, and gives all rows so far."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    calls.state_in_rocksdb(spark)
    source = tmp_path / "in"
    source.mkdir()

    def run(make, schema, *batches):
        for k, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{source}/{len(list(source.iterdir())):04d}")
        frame = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"file://{source}")
        query = make(frame).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").collect()

    yield run
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def dealt(rows, n, seed):
    random.Random(seed).shuffle(rows)
    return [rows[k::n] for k in range(n)]


def test_answers_like_the_batch_form(spark, sf_dir, stream):
    """The deltas of stream_accumulate in any order, some twice, over batches of two runs."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    final = {}
    for r in table:
        final[r.conv_id] = max(final.get(r.conv_id, 0), r.turn)
    rows = [(r.conv_id, r.turn, (r.conv_id + r.turn) % 5 != 0, r.text if (r.conv_id + r.turn) % 7 else None, r.turn == final[r.conv_id], START + timedelta(seconds=k)) for k, r in enumerate(table)]
    one, two, three, four = dealt(rows + rows[::9], 4, 3)
    stream(calls.accumulated, DELTAS, one, two)
    got = stream(calls.accumulated, DELTAS, three, four)
    want = {r.call_id: r.full_text for r in catalogue.stream_accumulate(spark, sf_dir).collect()}
    best = {}
    for r in sorted(got, key=lambda r: r.version):
        best[r.call_id] = r
    assert {k: r.full_text for k, r in best.items()} == want and all(r.complete and not r.missing for r in best.values())


def test_missing_and_late_pieces(stream):
    piece = lambda call, seq, text, last=False, minutes=0: (call, seq, True, text, last, START + timedelta(minutes=minutes))
    make = lambda df: calls.accumulated(df, idle=30, delay="1 minute")
    # call 1 lacks a piece, call 2 its end; call 3 is there only to move the time on
    got = stream(make, DELTAS, [piece(1, 0, "a"), piece(1, 2, "c", True), piece(2, 0, "x")], [piece(3, 0, "z", True, 10)])
    assert sorted((r.call_id, r.full_text, r.missing, r.complete, r.version) for r in got) == [(1, "ac", 1, False, 1), (2, "x", 0, False, 1), (3, "z", 0, True, 1)]
    got = stream(make, DELTAS, [piece(1, 1, "b", minutes=11), piece(2, 0, "x", minutes=11)])
    assert sorted((r.call_id, r.full_text, r.complete, r.version) for r in got) == [(1, "abc", True, 2), (1, "ac", False, 1), (2, "x", False, 1), (3, "z", True, 1)]


def test_conversations_like_the_batch_form(spark, sf_dir, stream):
    """The turns of chat_until_exit in any order over batches of two runs; turns after the exit word come before and after it."""
    said = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("conv_id", "turn", "CASE WHEN conv_id % 3 = 0 AND turn = conv_id % 4 + 1 THEN CASE WHEN conv_id % 2 = 0 THEN 'EXIT' ELSE 'Quit' END ELSE text END AS text").collect()
    first = min(r.turn for r in said)
    rows = [(r.conv_id, r.turn, r.text, START + timedelta(seconds=k)) for k, r in enumerate(said)]
    one, two, three = dealt(rows, 3, 5)
    make = lambda df: calls.until_exit(df, first)
    stream(make, TURNS, one)
    got = stream(make, TURNS, two, three)
    assert sorted(map(tuple, got)) == sorted(map(tuple, catalogue.chat_until_exit(spark, sf_dir).collect())) and len(got) < len(rows)


def test_gaps_and_exits(stream):
    turn = lambda conv, k, text, minutes=0: (conv, k, text, START + timedelta(minutes=minutes))
    make = lambda df: calls.until_exit(df, 0, idle=30, delay="1 minute")
    got = stream(make, TURNS, [turn(1, 0, "a"), turn(1, 2, "c"), turn(2, 0, "Exit"), turn(3, 1, None), turn(3, 3, "quit"), turn(3, 4, "x")])
    assert sorted(map(tuple, got)) == [(1, 0, "a")]
    # conversation 3 waits for turn 0 until its timer expires; 1 goes on as soon as its gap is filled
    got = stream(make, TURNS, [turn(4, 0, "later", 10)], [turn(1, 1, "late", 10), turn(2, 1, "after", 10), turn(1, 3, "d", 11)])
    assert sorted((r.conv_id, r.turn, r.text) for r in got) == [(1, 0, "a"), (1, 1, "late"), (1, 2, "c"), (1, 3, "d"), (3, 1, None), (4, 0, "later")]
    got = stream(make, TURNS, [turn(3, 2, "too late", 12), turn(3, 9, "after", 12)])
    assert len(got) == 6


def test_pieces_go_to_the_state_together():
    """A key's pieces of a batch are one access, however many they are."""
    import pandas as pd

    asked = []

    class Store:
        def __init__(self, name, held):
            self.name, self.held = name, held

        def __getattr__(self, what):
            def run(*args):
                asked.append((self.name, what))
                return self.held

            return run

    class Handle:
        def __getattr__(self, what):
            return lambda name=None, *args: Store(name, iter(()) if name == "pieces" else None)

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    work = calls.Accumulate(60)
    work.init(Handle())
    rows = pd.DataFrame({"seq": range(200), "content": ["x"] * 200, "has_choice": [True] * 200, "last": [k == 199 for k in range(200)], "at": [pd.Timestamp(START)] * 200})
    out = list(work.handleInputRows((1,), iter([rows]), Times()))
    assert out[0]["full_text"][0] == "x" * 200 and sum(name == "pieces" for name, _ in asked) == 1
