"""The queue of offers as a stream with state: an offer waits once, is tried again after a failure, and is given up in time.

Events (offer_id, kind, ts) go in: `new` when an offer is asked for, `failed` and `done` when it has been tried. Actions
(offer_id, action, tries, at) come out: `process` and `retry` are to be worked on, `done` and `dropped` end an offer. An offer
that waits already is not taken again. After a failure it is tried again, up to a number of tries and a time since it came; a
timer at the end of that time drops offers that nothing is heard of, and their state with them. An offer that has ended may come
anew.

What happens to an offer follows from its events in the order of time alone, so it is the same however the events fall into
micro-batches, and a run that goes on from its checkpoint continues where the last one ended.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from offerloom.streaming.decisions import MINUTES, TRIES

#: The order of events at one time: what ends a try stands before what asks for a new one.
KINDS = ("done", "failed", "new")
ACTIONS = "action string, tries int, at timestamp"
State = tuple[int, int]  # tries, milliseconds at which the offer came


def step(state: State | None, kind: str, ms: int, tries: int = TRIES, minutes: int = MINUTES) -> tuple[State | None, list[tuple[str, int, int]]]:
    """The state after an event, and the actions (action, tries, milliseconds)."""
    out = []
    if state and ms >= (end := state[1] + minutes * 60_000):
        out.append(("dropped", state[0], end))
        state = None
    if kind == "new" and not state:
        return (1, ms), [*out, ("process", 1, ms)]
    if kind == "done" and state:
        return None, [*out, ("done", state[0], ms)]
    if kind == "failed" and state:
        if state[0] < tries:
            return (state[0] + 1, state[1]), [*out, ("retry", state[0] + 1, ms)]
        return None, [*out, ("dropped", state[0], ms)]
    return state, out


class Waiting(StatefulProcessor):
    """step() on the state that Spark holds for an offer, with a timer at the end of its time."""

    def __init__(self, key: str, tries: int, minutes: int):
        self.key, self.tries, self.minutes = key, tries, minutes

    def init(self, handle) -> None:
        self.handle = handle
        self.item = handle.getValueState("item", "tries int, came long")

    def _rows(self, key: tuple, actions: list[tuple[str, int, int]]) -> Iterator[Row]:
        for action, tries, ms in actions:
            yield Row(**{self.key: key[0], "action": action, "tries": tries, "at": datetime.fromtimestamp(ms / 1000, timezone.utc)})

    def _hold(self, before: State | None, after: State | None) -> None:
        ends = lambda s: s[1] + self.minutes * 60_000
        if before and (not after or after[1] != before[1]):
            self.handle.deleteTimer(ends(before))
        if not after:
            self.item.clear()
        elif after != before:
            self.item.update(after)
            if not before or after[1] != before[1]:
                self.handle.registerTimer(ends(after))

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        held = self.item.get() if self.item.exists() else None
        before = state = tuple(held) if held else None
        for ms, order in sorted((r.ms, KINDS.index(r.kind)) for r in rows):
            state, actions = step(state, KINDS[order], ms, self.tries, self.minutes)
            yield from self._rows(key, actions)
        self._hold(before, state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.item.exists():
            tries, _ = self.item.get()
            self.item.clear()
            yield from self._rows(key, [("dropped", tries, expiredTimerInfo.getExpiryTimeInMs())])

    def close(self) -> None:
        pass


def actions(events: DataFrame, tries: int = TRIES, minutes: int = MINUTES, key: str = "offer_id", late: str = "0 seconds") -> DataFrame:
    """A stream of actions from a stream of events (key, kind, ts). Events of unknown kinds and null ids are left out, and those
    that come later than `late` after a later one. The session needs the RocksDB state store, see run()."""
    rows = events.withWatermark("ts", late).filter(F.col("kind").isin(*KINDS) & F.col(key).isNotNull())
    rows = rows.select(key, "kind", F.unix_millis("ts").alias("ms"), "ts")
    kind = events.schema[key].dataType.simpleString()
    return rows.groupBy(key).transformWithState(Waiting(key, tries, minutes), f"`{key}` {kind}, {ACTIONS}", "Append", "EventTime")


def run(events: DataFrame, out: str, checkpoint: str, tries: int = TRIES, minutes: int = MINUTES, key: str = "offer_id") -> StreamingQuery:
    """Takes the events that are there, and goes on from the checkpoint; actions go to Parquet files in `out`, each once."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = actions(events, tries, minutes, key).writeStream.format("parquet").outputMode("append")
    return stream.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def outcomes(decided: DataFrame, time: str = "ts", key: str = "offer_id") -> DataFrame:
    """Events of what the decision flow says about offers (key, topic, time): an offer that is to be queued again has failed."""
    return decided.select(key, F.when(F.col("topic") == "retry", "failed").otherwise("done").alias("kind"), F.col(time).alias("ts"))
