"""Delivery to the sink of each row, and the producer's two paths."""

import collections
import json
import sys

import pytest
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from postroad.operators import routing
from postroad.streaming import producer, sinks
from postroad.streaming.deliver import ConnectionFailed
from postroad.streaming.story import DeliveryIncomplete

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def no_sleep(seconds):
    pass


class Busy:
    """Answers with how many sends were under way at this sink in the task, and in which task."""

    def open(self):
        import threading

        self.lock, self.now = threading.Lock(), collections.Counter()

    def send(self, method, url, headers, body, timeout):
        import time

        with self.lock:
            self.now[url] += 1
            n = self.now[url]
        time.sleep(0.002)
        with self.lock:
            self.now[url] -= 1
        return 200, f"{n} in {TaskContext.get().partitionId()}"


def asked(spark, n, hot=0.5):
    """Events of which a share goes to one sink and the others to five more."""
    sink = F.when(F.col("id") < n * hot, "s0").otherwise(F.concat(F.lit("s"), (F.col("id") % 5 + 1).cast("string")))
    rows = spark.range(n).select(F.col("id").cast("string").alias("request_id"), F.lit(0).alias("pos"), F.concat(F.lit("e"), "id").alias("id"), F.concat(F.lit('{"id":"e'), "id", F.lit('"}')).alias("payload"), sink.alias("sink_id"))
    known = spark.createDataFrame([(f"s{k}", f"http://s{k}.invalid/") for k in range(5)], "sink_id string, url string")
    return routing.dispatch_to_sink(rows, known)


def test_lanes_stay_within_the_limit(spark):
    limit = F.when(F.col("sink_id") == "s0", 8).when(F.col("sink_id") == "s1", 1).otherwise(5)
    laned = sinks.sink_lanes(asked(spark, 3000), limit, lane_rows=100)
    found = {r.sink_id: (r.lanes, r.each) for r in laned.groupBy("sink_id").agg(F.countDistinct("lane").alias("lanes"), F.max("at_once").alias("each")).collect()}
    assert found["s0"] == (8, 1) and found["s1"] == (1, 1) and found["s2"] == (3, 1)
    wide = sinks.sink_lanes(asked(spark, 3000), 32, lane_rows=1000)
    found = {r.sink_id: (r.lanes, r.each) for r in wide.groupBy("sink_id").agg(F.countDistinct("lane").alias("lanes"), F.max("at_once").alias("each")).collect()}
    assert found["s0"] == (2, 16) and found["s2"] == (1, 32)


def test_a_sink_with_half_of_all_rows_is_spread(spark):
    sent = sinks.deliver_each(asked(spark, 2000), Busy(), limit=12, lane_rows=100, sleep=no_sleep)
    out = sent.select("sink_id", "error_kind", "error").collect()
    assert len(out) == 2000
    tasks, most = collections.defaultdict(set), collections.Counter()
    for r in out:
        if r.sink_id == "s5":
            assert (r.error_kind, r.error) == ("InvalidArgumentError", "Sink 's5' not found.")
            continue
        n, task = map(int, r.error.removeprefix("Unexpected Response: ").split(" in "))
        tasks[r.sink_id].add(task)
        most[r.sink_id] = max(most[r.sink_id], n)
    assert len(tasks["s0"]) >= 4 and len(tasks["s1"]) <= 2
    assert all(n <= 12 for n in most.values()) and most["s1"] > 1


class Picky:
    """Answers by the sink's own parameters, which must reach it; one sink is down until a file says that it is up."""

    def __init__(self, up):
        self.up = up

    def send(self, method, url, headers, body, timeout):
        import os

        name = url.split("/")[2].split(".")[0]
        if name == "s2" and not os.path.exists(self.up):
            raise ConnectionFailed("down")
        if name == "s3":
            return 200, "retry"
        return 200, "ok" if (headers or {}).get("key") == name and timeout == len(name) and method == ("PUT" if name == "s1" else "POST") else "wrong"


def test_parameters_come_from_the_row_and_a_second_run_sends_the_rest(spark, tmp_path):
    known = [(f"s{k}", f"http://s{k}.invalid/", "PUT" if k == 1 else None, {"key": f"s{k}"}, 2.0, k) for k in range(5)]
    table = spark.createDataFrame(known, "sink_id string, url string, method string, headers map<string,string>, timeout double, max_retry_times int")
    rows = [(f"r{k}", pos, f"e{k}-{pos}", json.dumps({"n": k}), f"s{k % 6}") for k in range(60) for pos in range(2)]
    events = spark.createDataFrame(rows, "request_id string, pos int, id string, payload string, sink_id string")
    dispatched, out, up = routing.dispatch_to_sink(events, table), str(tmp_path / "out"), tmp_path / "up"
    assert not sinks.send_requests(dispatched, out, Picky(str(up)), sleep=no_sleep, deadline_s=0.5)
    first = {(r.request_id, r.pos): r for r in spark.read.parquet(f"{out}/results").collect()}
    up.touch()
    assert sinks.send_requests(dispatched, out, Picky(str(up)), sleep=no_sleep)
    again = spark.read.parquet(f"{out}/tries/try=1").select("sink_id").distinct().collect()
    assert [r.sink_id for r in again] == ["s2"]
    found = {(r.request_id, r.pos): r for r in spark.read.parquet(f"{out}/results").collect()}
    assert len(found) == len(first) == 110
    for (request, pos), r in found.items():
        sink = int(request[1:]) % 6
        if sink == 5:
            assert (r.id, r.status, r.error_kind) == ("root", None, "InvalidArgumentError") and pos == 0
        elif sink == 3:
            assert (r.status, r.error_kind, r.error, r.attempts) == ("DEAD_LETTER", "Exception", "Maximum Retries", 4)
        else:
            assert (r.status, r.error_kind) == ("DONE", None)
        if sink == 2:
            assert first[request, pos].status == "UNKNOWN" and first[request, pos].error_kind == "Exception"


def test_requests_are_handled_once(spark, tmp_path):
    """Topics, sinks, faults and events without a topic in one batch; a second run goes on where the first one stopped."""
    event = lambda i, title: {"id": i, "title": title, "published": "p"}
    bodies = [
        ("r0", json.dumps([event("a", "user.x"), event("b", "none")]), None), ("r1", json.dumps(event("c", "user.y")), "s0"), ("r2", "no json", "s0"),
        ("r3", json.dumps([event("d", "user.z")]), "nope"), ("r4", "[]", None), ("r5", json.dumps(event("e", "user.y")), "s2"),
    ]
    df = spark.createDataFrame(bodies, "request_id string, body string, sink_id string")
    rules = spark.createDataFrame([(0, "t", r"user\.")], "rank int, topic string, pattern string")
    known = spark.createDataFrame([(f"s{k}", f"http://s{k}.invalid/", {"key": f"s{k}"}, 2.0) for k in (0, 2)], "sink_id string, url string, headers map<string,string>, timeout double")
    published, out, up = [], str(tmp_path / "out"), tmp_path / "up"

    def publish(routed):
        published.extend((r.topic, r.id) for r in routed.collect())

    with pytest.raises(DeliveryIncomplete):
        producer.handle_requests(df, rules, known, out, publish, Picky(str(up)), sleep=no_sleep, deadline_s=0.3)
    up.touch()
    for _ in range(2):
        answers = {r.request_id: r for r in producer.handle_requests(df, rules, known, out, publish, Picky(str(up)), sleep=no_sleep).collect()}
    assert published == [("t", "a")]
    assert {k: r.status for k, r in answers.items()} == {"r0": "part_succ", "r1": "all_succ", "r2": "all_fail", "r3": "all_fail", "r4": "all_fail", "r5": "all_succ"}
    assert answers["r0"].details == {"b": "<NoMatchedKafkaTopicError> "} and answers["r3"].details == {"root": "<InvalidArgumentError> Sink 'nope' not found."}
    assert answers["r2"].plain == "fail\nroot: <EventValidationError> Request body must not an non-empty Json."


def test_a_stream_of_requests(spark, tmp_path):
    bodies = [(f"r{k}", json.dumps({"id": f"e{k}", "title": "user.a", "published": ""}), "s0" if k % 2 else None) for k in range(6)]
    spark.createDataFrame(bodies, "request_id string, body string, sink_id string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("request_id string, body string, sink_id string").parquet(str(tmp_path / "in"))
    rules = lambda s: s.createDataFrame([(0, "t", "user")], "rank int, topic string, pattern string")
    known = lambda s: s.createDataFrame([("s0", "http://s0.invalid/", {"key": "s0"}, 2.0)], "sink_id string, url string, headers map<string,string>, timeout double")
    (tmp_path / "up").touch()
    running = producer.run_producer(stream, rules, known, str(tmp_path / "out"), str(tmp_path / "checkpoint"), lambda df: df.write.mode("append").parquet(str(tmp_path / "records")), Picky(str(tmp_path / "up")), {"availableNow": True}, sleep=no_sleep)
    running.awaitTermination()
    answers = spark.read.parquet(str(tmp_path / "out/*/answers")).collect()
    assert {r.request_id: r.status for r in answers} == {f"r{k}": "all_succ" for k in range(6)}
    assert spark.read.parquet(str(tmp_path / "records")).count() == 3
