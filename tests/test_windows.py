"""Closed windows with late rows kept, and the offset ledger, against loop models over several batches."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from postroad import schema
from postroad.operators import delivery
from postroad.sources import kafka
from postroad.streaming import story, windows

WIDTH, LATE = 60, 90


def drawn(seed, batches=5, rows=30):
    draw, out = random.Random(seed), []
    for b in range(batches):
        base = b * 100
        out.append([(draw.choice(["a", "b", None]), base + draw.randrange(120) - (draw.random() < 0.2) * draw.randrange(400)) for _ in range(rows if b != 2 else 0)])
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "topic string, s long").select("topic", F.timestamp_seconds(F.col("s") + 10_000).alias("ts"))


def model(batches):
    """(closed with the batch that closed it, late rows, open windows) by a loop."""
    mark, held, closed, late = None, collections.Counter(), [], collections.Counter()
    for b, rows in enumerate(batches):
        for topic, s in rows:
            start = (s + 10_000) // WIDTH * WIDTH
            key = (start, topic or "unknown")
            if mark is not None and start + WIDTH <= mark:
                late[key] += 1
            else:
                held[key] += 1
        if rows:
            mark = max(x for x in (mark, max(s for _, s in rows) + 10_000 - LATE) if x is not None)
        for key in [k for k in held if mark is not None and k[0] + WIDTH <= mark]:
            closed.append((b, *key, held.pop(key)))
    return sorted(closed), late, held


@pytest.mark.parametrize("seed", range(2))
def test_windows_equal_a_loop(spark, tmp_path, seed):
    batches = drawn(seed)
    kept = windows.ClosedWindows(str(tmp_path / "out"), f"{WIDTH} seconds", "topic", LATE)
    for b, rows in enumerate(batches):
        for _ in range(2 if b % 2 else 1):  # some batches are run again, by a new object
            windows.ClosedWindows(str(tmp_path / "out"), f"{WIDTH} seconds", "topic", LATE).process(frame(spark, rows), b)
    closed, late, held = model(batches)
    assert closed and late and held
    start = F.unix_seconds("window_start").alias("start")
    found = spark.read.parquet(str(tmp_path / "out/closed")).select("batch_id", start, "topic", "n").collect()
    assert sorted(map(tuple, found)) == closed
    assert collections.Counter((r.start, r.topic) for r in kept.late(spark).select(start, "topic").collect()) == late
    assert {(r.start, r.topic): r.n for r in kept.open(spark, 4).select(start, "topic", "n").collect()} == held
    whole = collections.Counter(((s + 10_000) // WIDTH * WIDTH, t or "unknown") for rows in batches for t, s in rows)
    assert {(r.start, r.topic): r.n for r in kept.totals(spark, 4).select(start, "topic", "n").collect()} == whole


def test_windows_of_a_stream(spark, tmp_path):
    batches, path, out = drawn(7, batches=3), str(tmp_path / "in"), str(tmp_path / "out")
    kept = windows.ClosedWindows(out, f"{WIDTH} seconds", "topic", LATE)
    batches[2] = [("a", 900)]
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema("topic string, ts timestamp").parquet(path)
        windows.run_windows(stream, kept, f"{out}/checkpoint", {"availableNow": True}).awaitTermination()
    closed, late, held = model(batches)
    found = kept.closed(spark).select(F.unix_seconds("window_start").alias("start"), "topic", "n").collect()
    assert sorted(map(tuple, found)) == sorted(c[1:] for c in closed)
    assert kept.late(spark).count() == sum(late.values())


def ledger_model(batches, c):
    """By a loop over batches: in each, rounds of up to c sends per partition; a round counts once some partition sends in it or in a later one."""
    ledger, seen = {}, {}
    for records in batches:
        rounds, sends = {}, collections.defaultdict(int)
        for part, offset, passes in records:
            seen[part] = offset + 1
            rounds[part, offset] = sends[part] // c + 1
            sends[part] += passes
        last = max((rounds[p, o] for p, o, passes in records if passes), default=0)
        for part, offset, _ in records:
            if rounds[part, offset] <= last:
                ledger[part] = max(ledger.get(part, 0), offset + 1)
    return {p: (ledger.get(p), seen[p]) for p in seen}


@pytest.mark.parametrize("c", [1, 2])
def test_ledger_over_batches_and_restarts(spark, tmp_path, c):
    """Trailing filtered records of a batch are settled by the next one that sends, also after each restart."""
    draw, out, offsets, batches = random.Random(c), str(tmp_path / "out"), collections.Counter(), []
    path = str(tmp_path / "log")
    for b in range(4):
        records = []
        for _ in range(14):
            part = draw.randrange(3)
            offsets[part] += draw.randint(1, 2)
            records.append((part, offsets[part], draw.random() < (0.5 if b != 1 else 0.0)))
        batches.append(records)
        rows = [(b"k", b'{"id":"i","title":"%s","published":""}' % (b"yes" if passes else b"no"), "t", part, offset, None, 0) for part, offset, passes in records]
        kafka.land_log(spark.createDataFrame(rows, schema.KAFKA_SOURCE).coalesce(1), path)
        params = {"story_id": "s", "sink": {"url": "http://example.invalid/"}, "include": ["yes"], "concurrent": c}
        story.run_story(kafka.landed_log(spark, path, ["t"]), params, out, f"{out}/checkpoint", lambda *a: (200, "ok"), {"availableNow": True}).awaitTermination()
        found = {r.partition: (r.next_offset, r.seen) for r in spark.read.parquet(f"{out}/ledger/batch_id={b}").collect()}
        assert found == ledger_model(batches, c)
    assert any(r.next_offset < r.seen for r in spark.read.parquet(f"{out}/ledger/batch_id=1").where("next_offset is not null").collect())
    assert delivery.offset_ledger(spark.read.parquet(f"{out}/results/batch_id=1")).where("next_offset is not null").count() == 0
