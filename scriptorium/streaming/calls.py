"""Streamed answers and conversations with state: what operators.assemble does with whole tables, done while rows arrive, in any order and over any number of batches.

Both keep state by key (transformWithStateInPandas, state in RocksDB), and give rows out once: append mode. Timers follow event time, so what never ends is given out once the watermark has passed its last row by ``idle`` seconds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from scriptorium.operators.assemble import EXIT_WORDS

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_in_rocksdb(spark: SparkSession) -> None:
    """What these streams need of a session; to be called before they're started."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


class Accumulate(StatefulProcessor):
    """Pieces of a call by number. A call is given out when its last piece and all before it are there, or when its timer expires; pieces that come later give it out again, one version up."""

    def __init__(self, idle: float):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # pieces are read and added as a whole, as each access goes to the executor and back
        self.pieces = handle.getListState("pieces", "seq long, content string")
        # the last piece's number (null: not yet there), versions given out, the timer that is set
        self.meta = handle.getValueState("meta", "last long, versions int, timer long")

    def told(self, key, held, last, versions) -> pd.DataFrame:
        first = min(held)
        # pieces are numbered one by one from the first that is there
        missing = (last if last is not None else max(held)) - first + 1 - len(held)
        text = "".join(c for _, c in sorted(held.items()) if c is not None)
        return pd.DataFrame({"call_id": [key[0]], "full_text": [text], "n_pieces": [len(held)], "missing": [missing], "complete": [last is not None and missing == 0], "version": [versions]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.meta.get()
        last, versions, timer = known or (None, 0, None)
        held = dict(self.pieces.get()) if known else {}
        new, at = {}, 0
        for batch in rows:
            for seq, content, has_choice, end, when in zip(batch["seq"], batch["content"], batch["has_choice"], batch["last"], batch["at"]):
                at = max(at, int(when.timestamp() * 1000))
                # the same piece twice is one piece
                if (seq := int(seq)) not in held:
                    held[seq] = new[seq] = content if has_choice and not pd.isna(content) else None
                if end:
                    last = seq
        if new:
            self.pieces.appendList(list(new.items()))
        out = self.told(key, held, last, versions + 1)
        if timer is not None:
            self.handle.deleteTimer(timer)
            timer = None
        if new and (versions or out["complete"][0]):
            versions += 1
            yield out
        elif not versions:
            timer = max(at + int(self.idle * 1000), timerValues.getCurrentWatermarkInMs() + 1)
            self.handle.registerTimer(timer)
        self.meta.update((last, versions, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, versions, _ = self.meta.get()
        self.meta.update((last, versions + 1, None))
        yield self.told(key, dict(self.pieces.get()), last, versions + 1)


ACCUMULATED = "call_id {kind}, full_text string, n_pieces long, missing long, complete boolean, version int"


def accumulated(deltas: DataFrame, idle: float = 60, delay: str = "10 minutes") -> DataFrame:
    """call_id, full_text, n_pieces, missing, complete, version of streamed deltas (call_id, seq, has_choice, content, last: is it the call's last piece, at: timestamp). Pieces without a choice or content count as there and
    add nothing. idle: seconds without a piece after which a call is given out as it is. Of several versions of a call the highest counts."""
    kind = deltas.schema["call_id"].dataType.simpleString()
    marked = deltas.select("call_id", "seq", "has_choice", "content", "last", "at").withWatermark("at", delay)
    return marked.groupBy("call_id").transformWithStateInPandas(Accumulate(idle), outputStructType=ACCUMULATED.format(kind=kind), outputMode="Append", timeMode="EventTime")


class UntilExit(StatefulProcessor):
    """Turns in order, each once those before it are there; nothing from the first exit word on, whatever comes after. When the timer expires, what has been waiting is given out over the gaps."""

    def __init__(self, first: int, words: tuple[str, ...], idle: float):
        self.first, self.words, self.idle = first, words, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "turn long", "text string")
        self.meta = handle.getValueState("meta", "next long, ended boolean, timer long")

    def given(self, key, upto: int, gaps: bool) -> tuple[int, bool, pd.DataFrame]:
        rows, ended = [], False
        for turn, text in sorted((k[0], v[0]) for k, v in self.waiting.iterator()):
            if turn > upto and not gaps:
                break
            self.waiting.removeKey((turn,))
            if text is not None and text.lower() in self.words:
                ended = True
                break
            rows.append((key[0], turn, text))
            upto = turn + 1
        if ended:
            self.waiting.clear()
        return upto, ended, pd.DataFrame(rows, columns=["conv_id", "turn", "text"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        upto, ended, timer = self.meta.get() if self.meta.exists() else (self.first, False, None)
        at = 0
        for batch in rows:
            for turn, text, when in zip(batch["turn"], batch["text"], batch["at"]):
                at = max(at, int(when.timestamp() * 1000))
                if not ended and turn >= upto:
                    self.waiting.updateValue((int(turn),), (None if pd.isna(text) else text,))
        if ended:
            return
        upto, ended, out = self.given(key, upto, False)
        if timer is not None:
            self.handle.deleteTimer(timer)
            timer = None
        if not ended and next(iter(self.waiting.keys()), None) is not None:
            timer = max(at + int(self.idle * 1000), timerValues.getCurrentWatermarkInMs() + 1)
            self.handle.registerTimer(timer)
        self.meta.update((upto, ended, timer))
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto, ended, _ = self.meta.get()
        upto, ended, out = self.given(key, upto, True)
        self.meta.update((upto, ended, None))
        if len(out):
            yield out


def until_exit(turns: DataFrame, first: int = 0, words: tuple[str, ...] = EXIT_WORDS, idle: float = 60, delay: str = "10 minutes") -> DataFrame:
    """conv_id, turn, text of streamed turns (conv_id, turn, numbered one by one from first, text, at: timestamp) before a conversation's first exit word, whatever its case. A turn waits for those before it, at most idle
    seconds of event time; one that comes after a later one was given out is dropped."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    marked = turns.select("conv_id", "turn", "text", "at").withWatermark("at", delay)
    return marked.groupBy("conv_id").transformWithStateInPandas(UntilExit(first, words, idle), outputStructType=f"conv_id {kind}, turn long, text string", outputMode="Append", timeMode="EventTime")
