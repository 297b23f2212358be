"""Many stories on one read: outcomes, backlogs and lifecycle rows against loop models."""

import collections
import json
import os
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from postroad import schema
from postroad.operators import report
from postroad.sources import kafka
from postroad.streaming import fanout
from postroad.streaming.deliver import ConnectionFailed

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def no_sleep(seconds):
    pass


def land(spark, path, low, high, title="user.a", partitions=2):
    rows = [(b"k", json.dumps({"id": f"e{k}", "title": title if k % 4 else "other", "published": ""}).encode(), "t", k % partitions, k, None, 0) for k in range(low, high)]
    kafka.land_log(spark.createDataFrame(rows, schema.KAFKA_SOURCE).coalesce(1), path)


def story_rows(spark, n, include=None):
    rows = [(f"s{k}", ["t"], None, include, None, f"http://s{k}.invalid/", 1) for k in range(n)]
    return spark.createDataFrame(rows, "story_id string, topics array<string>, topic_pattern string, include array<string>, exclude array<string>, url string, max_retry_times int")


class Sinks:
    """Writes what each sink got, in order; a sink whose file `down-<name>` is there is down; ids that end in 7 go to dead letters."""

    def __init__(self, folder):
        self.folder = str(folder)

    def send(self, method, url, headers, body, timeout):
        name, event = url.split("/")[2].split(".")[0], json.loads(body)["id"]
        if os.path.exists(f"{self.folder}/down-{name}"):
            raise ConnectionFailed("down")
        with open(f"{self.folder}/got-{name}", "a") as f:
            f.write(event + "\n")
        if event.endswith("5") and open(f"{self.folder}/got-{name}").read().split().count(event) < 2:
            return 200, "retry"
        return (200, "no") if event.endswith("7") else (200, "ok")

    def got(self, name):
        path = f"{self.folder}/got-{name}"
        return open(path).read().split() if os.path.exists(path) else []


def serve(spark, path, out, stories, sinks, **more):
    stream = kafka.landed_log(spark, path, ["t"])
    running = fanout.run_shared(stream, lambda s, k: stories, out, f"{out}/checkpoint", sinks, {"availableNow": True}, sleep=no_sleep, **more)
    running.awaitTermination()
    return running


def test_fifty_stories_read_the_topic_once(spark, tmp_path):
    path, out, sinks = str(tmp_path / "log"), str(tmp_path / "out"), Sinks(tmp_path)
    land(spark, path, 0, 40)
    stories = story_rows(spark, 50, ["user"])
    running = serve(spark, path, out, stories, sinks)
    assert sum(p["numInputRows"] for p in running.recentProgress) == 40
    passing = [k for k in range(40) if k % 4]
    found = fanout.SharedStories(spark, out).results().collect()
    assert len(found) == 50 * len(passing)
    assert {(r.story_id, r.id) for r in found if r.status == "DEAD_LETTER"} == {(f"s{n}", f"e{k}") for n in range(50) for k in passing if k % 10 == 7}
    counts = spark.read.parquet(f"{out}/outcomes").collect()
    assert {(r.story_id, r.new, r.done, r.dead_letter, r.unknown) for r in counts} == {(f"s{n}", 30, 30 - 4, 4, 0) for n in range(50)}
    for n in range(0, 50, 7):
        order = [int(e[1:]) for e in dict.fromkeys(sinks.got(f"s{n}"))]
        for partition in (0, 1):
            assert [k for k in order if k % 2 == partition] == [k for k in passing if k % 2 == partition]


def test_a_sink_that_is_down_holds_up_its_own_story_alone(spark, tmp_path):
    path, out, sinks = str(tmp_path / "log"), str(tmp_path / "out"), Sinks(tmp_path)
    stories, handed = story_rows(spark, 3), []
    down = tmp_path / "down-s1"
    down.touch()
    hand = lambda df, k: handed.extend((r.topic, r.key.decode()) for r in df.collect())
    for low in (0, 20):
        land(spark, path, low, low + 20)
        serve(spark, path, out, stories, sinks, patience_s=0.3, write_dead_letters=hand)
    tables = fanout.SharedStories(spark, out)
    assert len(sinks.got("s0")) >= 40 and sinks.got("s1") == [] and len(sinks.got("s2")) >= 40
    waiting = tables.backlog(1).collect()
    assert sorted((r.story_id, r.offset) for r in waiting) == [("s1", k) for k in range(40)]
    assert not fanout.settle_backlog(spark, 1, stories, out, sinks, hand, sleep=no_sleep, patience_s=0.2)
    # A story that is gone keeps its backlog.
    assert not fanout.settle_backlog(spark, 1, stories.where("story_id <> 's1'"), out, sinks, hand, sleep=no_sleep)
    down.unlink()
    land(spark, path, 40, 50)
    serve(spark, path, out, stories, sinks, write_dead_letters=hand)
    order = [int(e[1:]) for e in dict.fromkeys(sinks.got("s1"))]
    assert [k for k in order if k % 2 == 0] == list(range(0, 50, 2)) and [k for k in order if k % 2] == list(range(1, 50, 2))
    assert tables.backlog(2).isEmpty() and fanout.settle_backlog(spark, 2, stories, out, sinks)
    settled = collections.Counter((r.story_id, r.id) for r in tables.results().where("status <> 'UNKNOWN'").collect())
    assert settled == collections.Counter((f"s{n}", f"e{k}") for n in range(3) for k in range(50))
    assert collections.Counter(handed) == collections.Counter(("dead-letter-t", f"e{k}") for k in range(50) if k % 10 == 7 for _ in range(3))


def test_a_batch_that_is_run_again_sends_nothing_twice(spark, tmp_path):
    path, out, sinks = str(tmp_path / "log"), str(tmp_path / "out"), Sinks(tmp_path)
    land(spark, path, 0, 12)
    records, stories = kafka.landed_log(spark, path, ["t"], streaming=False), story_rows(spark, 2)
    first = fanout.process_shared(records, 0, stories, out, sinks, sleep=no_sleep).collect()
    sent = sinks.got("s0")
    again = fanout.process_shared(records, 0, stories, out, sinks, sleep=no_sleep).collect()
    assert sinks.got("s0") == sent and sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_lifecycle_rows_follow_from_the_results(spark, tmp_path):
    """Latest stage and all stages of each story's events, from a loop over what the sinks answer."""
    path, out, sinks = str(tmp_path / "log"), str(tmp_path / "out"), Sinks(tmp_path)
    (tmp_path / "down-s1").touch()
    land(spark, path, 0, 20, partitions=1)
    serve(spark, path, out, story_rows(spark, 2), sinks, patience_s=0.2)
    rows = spark.read.parquet(f"{out}/lifecycle")
    stages = collections.defaultdict(list)
    for r in rows.orderBy("story_id", "id", "step").collect():
        stages[r.story_id, r.id].append(r.status)

    def expected(story, k):
        if story == "s1":
            return ["FROM_KAFKA"]
        retries = ["RETRY_TO_SINK"] if k % 10 == 5 else []
        return ["FROM_KAFKA", "TO_SINK", *retries, "TO_DEAD_LETTER" if k % 10 == 7 else "IN_SINK"]

    first = stages.pop(("s1", "e0"))  # the one that was tried
    stages.pop(("s0", "e0"))
    assert first[:3] == ["FROM_KAFKA", "TO_SINK", "RETRY_TO_SINK"] and set(first[3:]) <= {"RETRY_TO_SINK"}
    assert stages == {(s, f"e{k}"): expected(s, k) for s in ("s0", "s1") for k in range(1, 20)}
    latest = {r.id: r.status for r in report.lifecycle_latest(rows.where("story_id = 's0'")).collect()}
    assert latest == {f"e{k}": expected("s0", k)[-1] for k in range(20)}
    counts = {r.status: r.n for r in report.lifecycle_counts(rows.where("story_id = 's0'")).collect()}
    assert counts == {"FROM_KAFKA": 20, "TO_SINK": 20, "RETRY_TO_SINK": 2, "IN_SINK": 18, "TO_DEAD_LETTER": 2}
