"""The queue of offers: actions of random events, restarts, and the loop with the decision flow."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from offerloom.streaming import decisions, queue

SCHEMA = "offer_id long, kind string, ts timestamp"
MINUTE = 60_000
START = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp() * 1000)


def add(spark, rows, folder):
    """rows: (offer, kind, minutes after the start)."""
    at = [(i, kind, START + m * MINUTE) for i, kind, m in rows]
    spark.createDataFrame(at, "offer_id long, kind string, ms long").select("offer_id", "kind", F.timestamp_millis("ms").alias("ts")).write.mode("append").parquet(folder)


def drain(spark, folder, out, checkpoint, **options):
    queue.run(spark.readStream.schema(SCHEMA).parquet(folder), out, checkpoint, **options).awaitTermination()
    rows = spark.read.parquet(out).withColumn("ms", F.unix_millis("at")).collect()
    return sorted((r.offer_id, (r.ms - START) // MINUTE, r.action, r.tries) for r in rows)


def by_hand(rows, tries, minutes):
    """Actions of events in the order of time, and drops up to the last event's time."""
    out, waiting = [], {}
    for m, kind, i in sorted((m, ("done", "failed", "new").index(k), i) for i, k, m in rows):
        if i in waiting and m >= waiting[i][1] + minutes:
            n, came = waiting.pop(i)
            out.append((i, came + minutes, "dropped", n))
        if kind == 2 and i not in waiting:
            waiting[i] = [1, m]
            out.append((i, m, "process", 1))
        elif kind == 0 and i in waiting:
            out.append((i, m, "done", waiting.pop(i)[0]))
        elif kind == 1 and i in waiting:
            if waiting[i][0] < tries:
                waiting[i][0] += 1
                out.append((i, m, "retry", waiting[i][0]))
            else:
                out.append((i, m, "dropped", waiting.pop(i)[0]))
    now = max(m for *_, m in rows)
    out += [(i, came + minutes, "dropped", n) for i, (n, came) in waiting.items() if came + minutes <= now]
    return sorted(out)


def test_random_events_and_restarts(spark, tmp_path):
    rng = random.Random(11)
    rows = sorted(((rng.randint(1, 12), rng.choice(["new", "failed", "failed", "done"]), rng.randint(0, 3000)) for _ in range(600)), key=lambda r: r[2])
    rows = list({(i, m): (i, k, m) for i, k, m in rows}.values())
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for part in (rows[:200], rows[200:210], rows[210:]):
        add(spark, part, folder)
        got = drain(spark, folder, out, checkpoint, tries=3, minutes=190)
    assert got == by_hand(rows, 3, 190)
    assert {a for _, _, a, _ in got} == {"process", "retry", "done", "dropped"}
    assert drain(spark, folder, out, checkpoint, tries=3, minutes=190) == got  # nothing new


def test_limits():
    held, said = queue.step(None, "new", 0)
    for n in range(2, 6):
        held, said = queue.step(held, "failed", n)
        assert said == [("retry", n, n)]
    assert queue.step(held, "failed", 9) == (None, [("dropped", 5, 9)])
    assert queue.step((2, 0), "new", 190 * MINUTE - 1) == ((2, 0), [])
    assert queue.step((2, 0), "new", 190 * MINUTE) == ((1, 190 * MINUTE), [("dropped", 2, 190 * MINUTE), ("process", 1, 190 * MINUTE)])
    assert queue.step(None, "failed", 5) == queue.step(None, "done", 5) == (None, [])


def test_unknown_kinds_and_nulls(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    add(spark, [(1, "new", 0), (None, "new", 0), (2, "other", 0), (3, None, 1), (1, "new", 0)], folder)
    assert drain(spark, folder, out, checkpoint) == [(1, 0, "process", 1)]


def test_loop_with_the_decision_flow(spark, tmp_path):
    """Offers that fail come back until their tries are used up; others are done at the first."""
    folder, out, checkpoint, work, progress = (str(tmp_path / x) for x in ("in", "out", "cp", "work", "progress"))
    routes = spark.createDataFrame([("c", "m")], "category string, model string")
    catalogue = spark.createDataFrame([(i,) for i in (1, 2, 3)], "offer_id long")
    decide = lambda batch: batch.filter("offer_id != 2").select("offer_id", F.lit("matched").alias("topic"))
    add(spark, [(i, "new", 0) for i in (1, 2, 3, 4)], folder)
    seen = 0
    for at in range(1, 5):
        got = drain(spark, folder, out, checkpoint, tries=3)
        actions = spark.readStream.schema(f"offer_id long, {queue.ACTIONS}").parquet(out).filter("action IN ('process', 'retry')")
        decisions.run_routed(actions.withColumn("category", F.lit("c")), lambda: routes, decide, catalogue, work, progress).awaitTermination()
        said = spark.read.option("basePath", work).parquet(f"{work}/batch=*").select("offer_id", "topic", "batch")
        new = said.filter(F.col("batch") >= seen).withColumn("ts", F.timestamp_millis(F.lit(START + at * MINUTE)))
        seen = said.agg(F.max("batch")).first()[0] + 1
        queue.outcomes(new).write.mode("append").parquet(folder)
    got = drain(spark, folder, out, checkpoint, tries=3)
    assert got == sorted([(i, 0, "process", 1) for i in (1, 2, 3, 4)] + [(i, 1, "done", 1) for i in (1, 3, 4)] + [(2, 1, "retry", 2), (2, 2, "retry", 3), (2, 3, "dropped", 3)])


@pytest.mark.parametrize("sent", [100_000, 0])
def test_split_batch(spark, monkeypatch, sent):
    monkeypatch.setattr(decisions, "MOST_SENT", sent)
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "offer_id long, x string")
    known, unknown = decisions.split_batch(batch, spark.createDataFrame([(1,), (1,), (None,), (7,)], "offer_id long"))
    assert sorted(map(tuple, known.collect())) == [(1, "a"), (1, "b")] and {r[0] for r in unknown.collect()} == {2, None}
