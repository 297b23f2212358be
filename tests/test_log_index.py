"""The time index of a landed log: the same rows as a whole scan, from few files."""

import random

import pytest
from pyspark.sql import functions as F

from postroad import schema
from postroad.operators import replay
from postroad.sources import kafka, log_index
from postroad.streaming import story


def at(seconds):
    return F.timestamp_seconds(F.lit(seconds))


def landed(spark, path, seed, runs=6, index=True):
    """Runs of records of three partitions, times mostly in order; the last run is landed but perhaps not indexed."""
    draw, offsets = random.Random(seed), {}
    rows = []
    for run in range(runs):
        batch = []
        for _ in range(40):
            place = (f"t{draw.randrange(2)}", draw.randrange(2))
            offsets[place] = offsets.get(place, 0) + draw.randint(1, 3)
            time = 1000 * run + draw.randrange(1000) - (draw.random() < 0.1) * draw.randrange(1500)
            batch.append((b"k", b"v", *place, offsets[place], time))
        rows += batch
        df = spark.createDataFrame(batch, "key binary, value binary, topic string, partition int, offset long, s long")
        df = df.withColumn("timestamp", F.timestamp_seconds("s")).withColumn("timestampType", F.lit(0)).drop("s").select(*schema.KAFKA_SOURCE.fieldNames())
        (log_index.land_indexed if index else kafka.land_log)(df.coalesce(1), path)
    return rows


def bounds_of(rows, start, end):
    out = {}
    for place in {r[2:4] for r in rows}:
        mine = [r for r in rows if r[2:4] == place]
        lo = min((r[4] for r in mine if r[5] >= start), default=None)
        hi = None if end is None else min((r[4] for r in mine if r[5] >= start and r[5] > end), default=None)
        if lo is not None:
            out[place] = lo, hi
    return out


@pytest.mark.parametrize("seed", range(2))
def test_index_gives_what_a_scan_gives(spark, tmp_path, seed):
    path = str(tmp_path / "log")
    rows = landed(spark, path, seed)
    draw = random.Random(seed + 50)
    for start, end in [(2500, 3500), (0, None), (5200, 9000), (9000, None), (3000, 2000), *((draw.randrange(6000), draw.randrange(6000)) for _ in range(3))]:
        found = log_index.seek_landed(spark, path, at(start), None if end is None else at(end))
        expected = bounds_of(rows, start, end)
        assert {(r.topic, r.partition): (r.lo, r.hi) for r in found.bounds.collect()} == expected
        kept = log_index.replay_landed(spark, path, at(start), None if end is None else at(end))
        places = sorted((r.topic, r.partition, r.offset) for r in kept.collect())
        assert places == sorted(r[2:5] for r in rows if r[2:4] in expected and expected[r[2:4]][0] <= r[4] and (expected[r[2:4]][1] is None or r[4] < expected[r[2:4]][1]))
        whole = replay.replay_window(kafka.landed_log(spark, path, topic_pattern="t", streaming=False), at(start), None if end is None else at(end))
        assert places == sorted((r.topic, r.partition, r.offset) for r in whole.collect())


def test_a_seek_opens_only_files_across_a_bound(spark, tmp_path):
    """Twenty runs in order of time: of 20 files a topic, those that the bounds fall into are opened, and those of the range are read."""
    path = str(tmp_path / "log")
    for run in range(20):
        df = spark.range(run * 100, run * 100 + 100).select(
            F.lit(b"k").alias("key"), F.lit(b"v").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
            F.timestamp_seconds(F.col("id") * 10).alias("timestamp"), F.lit(0).alias("timestampType"),
        )
        log_index.land_indexed(df.coalesce(1), path)
    assert log_index.read_index(spark, path).count() == 20 and log_index.index_log(spark, path) == 0
    inside = log_index.seek_landed(spark, path, at(5050), at(8040))
    assert len(inside.opened) == 2 and len(inside.files) == 4
    assert [tuple(r) for r in inside.bounds.collect()] == [("t", 0, 505, 805)]
    on_the_edge = log_index.seek_landed(spark, path, at(5000), at(7990))
    assert len(on_the_edge.opened) == 0 and len(on_the_edge.files) == 3
    assert log_index.replay_landed(spark, path, at(5000), at(7990), ["t"]).count() == 300
    assert log_index.seek_landed(spark, path, at(50_000)).files == []


def test_files_that_were_not_indexed_are_added(spark, tmp_path):
    path = str(tmp_path / "log")
    landed(spark, path, 3, runs=2, index=False)
    assert log_index.read_index(spark, path).count() == 0
    assert log_index.index_log(spark, path) > 0
    before = log_index.read_index(spark, path).agg(F.sum("n")).first()[0]
    assert before == 80 and log_index.index_log(spark, path) == 0


def test_a_replay_by_the_index(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    value = F.concat(F.lit('{"id":"'), F.col("id"), F.lit('","title":"t","published":""}'))
    log = spark.range(50).select(F.lit(b"k").alias("key"), value.cast("binary").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.timestamp_seconds("id").alias("timestamp"), F.lit(0).alias("timestampType"))
    log_index.land_indexed(log, path)
    start, end = at(10), at(19)
    whole = kafka.landed_log(spark, path, ["t"], streaming=False)
    window = lambda: log_index.replay_landed(spark, path, start, end, ["t"])
    sent = story.replay(whole, "http://example.invalid/", start, end, out, lambda *a: (200, "ok"), window=window)
    assert sorted(int(r.id) for r in sent.where("status = 'DONE'").collect()) == list(range(10, 20))
