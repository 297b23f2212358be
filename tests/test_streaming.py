"""Sources, delivery and stories, with scripted sinks and landed logs."""

import json
import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from postroad import schema
from postroad.operators import delivery, report
from postroad.plans.catalog import ScriptedSink, _no_sleep
from postroad.sources import control, kafka, requests
from postroad.streaming import deliver as delivering
from postroad.streaming import hooks, route, story
from postroad.streaming.deliver import ConnectionFailed, PayloadFailed, deliver, http_transport

# Workers do not have the tests on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SINK = {"url": "http://example.invalid/"}


def record(topic, part, off, title="user.a", **more):
    body = {"id": str(off), "title": title, "published": "p", **more}
    return (str(off).encode(), json.dumps(body).encode(), topic, part, off, None, 0)


def log(spark, rows):
    return spark.createDataFrame(rows, schema.KAFKA_SOURCE)


def events(spark, payloads):
    rows = [(str(i), p, "t", i % 2, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "id string, payload string, topic string, partition int, offset bigint")


REPLIES = [(200, "Ok"), (200, "RETRY"), (200, "Exponential_Backoff_Retry"), (200, "later"), (404, ""), "connection", "timeout", "response", "payload", "other"]
RAISED = {"connection": ConnectionFailed, "timeout": TimeoutError, "response": delivering.ResponseFailed, "payload": PayloadFailed, "other": KeyError}


class Script:
    """Answers each attempt by the next line of a script drawn from the payload; in the end with ok."""

    def open(self):
        self.tries = {}

    def send(self, method, url, headers, body, timeout):
        name = body.decode()
        n = self.tries[name] = self.tries.get(name, 0) + 1
        script = random.Random(name).choices(REPLIES, k=5)
        reply = script[n - 1] if n <= len(script) else (200, "ok")
        if isinstance(reply, str):
            raise RAISED[reply]("said so")
        return reply


def test_outcomes(spark):
    """What delivery does with any script of replies is what the classifying operators say of its attempts."""
    names = [f"script {k}" for k in range(60)]
    for ordered in (True, False):
        sent = deliver(events(spark, names), SINK, Script(), ordered=ordered, sleep=_no_sleep).cache()
        attempts = sent.select("payload", F.explode("log").alias("a")).select("payload", "a.*")
        outcomes = delivery.delivery_outcome(delivery.classify_attempt(attempts), key=["payload"])
        expected = {r.payload: (r.status, r.error, r.attempts, pytest.approx(r.total_delay)) for r in outcomes.collect()}
        found = {r.payload: (r.status, r.error, r.attempts, r.total_delay) for r in sent.collect()}
        assert set(found) == set(names) and found == expected
        assert {s for s, *_ in found.values()} == {"DONE", "DEAD_LETTER"}
    for r in sent.collect():
        script = random.Random(r.payload).choices(REPLIES, k=5) + [(200, "ok")]
        for attempt, reply in zip(r.log, script, strict=False):
            assert (attempt.error_kind if isinstance(reply, str) else (attempt.http_status, attempt.body)) == reply


def test_no_end_is_unknown(spark):
    def refuse(*_):
        raise ConnectionFailed("refused")

    row = deliver(events(spark, ["x"]), SINK, refuse, sleep=_no_sleep, deadline_s=0.05).first()
    assert row.status == "UNKNOWN" and row.attempts >= 1
    assert row.log[0].error_kind == "connection"


def test_a_partition_stops_at_an_unknown_event(spark):
    def send(method, url, headers, body, timeout):
        if body == b"4":
            raise ConnectionFailed("refused")
        return 200, "ok"

    rows = deliver(events(spark, [str(k) for k in range(10)]), SINK, send, sleep=_no_sleep, deadline_s=3).collect()
    found = {int(r.payload): (r.status, r.attempts > 0) for r in rows}
    assert found == {k: ("DONE", True) if k % 2 or k < 4 else ("UNKNOWN", k == 4) for k in range(10)}


def test_order_and_rounds(spark, tmp_path):
    rows = [("%d" % i, f"{p}:{i}", "t", p, i, i // 2 + 1, i % 5 != 0) for i in range(40) for p in range(3)]
    df = spark.createDataFrame(rows, "id string, payload string, topic string, partition int, offset bigint, round bigint, passes boolean")
    path = str(tmp_path / "sent")

    def write(method, url, headers, body, timeout):
        with open(path, "a") as f:
            f.write(body.decode() + "\n")
        return 200, "ok"

    results = deliver(df, SINK, write, max_parallel=1).collect()
    assert {r.status for r in results if r.passes} == {"DONE"} and {r.status for r in results if not r.passes} == {None}
    sent = [tuple(map(int, line.split(":"))) for line in open(path)]
    for p in range(3):
        assert [i for q, i in sent if q == p] == [i for i in range(40) if i % 5]


def test_http_failures():
    for url, error in [("no-url", delivering.InvalidUrl), ("http://127.0.0.1:1/", ConnectionFailed), ("http://[x/", delivering.InvalidUrl)]:
        with pytest.raises(error):
            http_transport("POST", url, None, b"{}", 2.0)
    with pytest.raises(ValueError):
        deliver(None, {"method": "POST"})


def stream(spark, path, rows):
    log(spark, rows).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema.KAFKA_SOURCE).parquet(path)


def run(query):
    query.awaitTermination()
    return query


def test_story_tables(spark, tmp_path):
    rows = [record(f"event-v2-t{i % 2}", i % 3, i, "user.a" if i % 4 else "msg.x") for i in range(60)]
    rows.append((b"bad", b"abc", "event-v2-t0", 0, 99, None, 0))
    source = stream(spark, str(tmp_path / "log"), rows)
    out = str(tmp_path / "out")
    params = {"story_id": "s", "sink": SINK, "include": [r"user\."], "concurrent": 2}
    run(story.run_story(source, params, out, f"{out}/checkpoint", ScriptedSink(), {"availableNow": True}, sleep=_no_sleep))
    results = spark.read.parquet(f"{out}/results")
    sent = results.where("passes")
    assert {int(r.id) for r in sent.collect()} == {i for i in range(60) if i % 4}
    assert results.count() == 60 and spark.read.parquet(f"{out}/quarantine").count() == 1
    dead = {int(r.id): r.topic for r in sent.where("status = 'DEAD_LETTER'").collect()}
    letters = spark.read.parquet(f"{out}/dead_letters").collect()
    assert {(int(bytes(r.key)), r.topic) for r in letters} == {(i, t.replace("v2-", "v2-dead-letter-")) for i, t in dead.items()}
    counts = report.story_outcome_counts(sent).first()
    assert counts.new == 45 and counts.dead_letter == len(dead) and counts.done == 45 - len(dead)
    last = {(r.topic, r.partition): r.next_offset for r in spark.read.parquet(f"{out}/offsets").collect()}
    assert max(last.values()) <= 60 and len(last) == 6


def test_incomplete_batch_is_delivered_again(spark, tmp_path):
    source = stream(spark, str(tmp_path / "log"), [record("t", 0, i) for i in range(4)])
    out, flag, count = str(tmp_path / "out"), str(tmp_path / "up"), str(tmp_path / "count")
    params = {"story_id": "s", "sink": SINK}

    def send(method, url, headers, body, timeout):
        with open(count, "a") as f:
            f.write("x")
        if not os.path.exists(flag):
            raise ConnectionFailed("down")
        return 200, "ok"

    def start():
        return story.run_story(source, params, out, f"{out}/checkpoint", send, {"availableNow": True}, sleep=_no_sleep, deadline_s=0.0)

    with pytest.raises(Exception, match="DeliveryIncomplete"):
        run(start())
    assert {r.status for r in spark.read.parquet(f"{out}/results").collect()} == {"UNKNOWN"}
    assert spark.read.parquet(f"{out}/offsets").count() == 0
    open(flag, "w").close()
    run(start())
    assert {r.status for r in spark.read.parquet(f"{out}/results").collect()} == {"DONE"}
    sends = os.path.getsize(count)
    # A settled batch is not sent again.
    story.process_batch(spark.read.parquet(str(tmp_path / "log")), 0, params, out, send)
    assert os.path.getsize(count) == sends


def test_a_rerun_sends_only_what_is_open(spark, tmp_path):
    batch = log(spark, [record("t", k % 2, k) for k in range(10)])
    out, flag, sent = str(tmp_path / "out"), str(tmp_path / "up"), str(tmp_path / "sent")
    handed = []

    def send(method, url, headers, body, timeout):
        n = json.loads(body)["id"]
        if n == "4" and not os.path.exists(flag):
            raise ConnectionFailed("down")
        with open(sent, "a") as f:
            f.write(f"{n}\n")
        return (500, "") if n == "3" else (200, "ok")

    def process():
        story.process_batch(batch, 0, {"story_id": "s", "sink": SINK}, out, send, write_dead_letters=lambda df, k: handed.append(df.count()), sleep=_no_sleep, deadline_s=3)

    with pytest.raises(story.DeliveryIncomplete):
        process()
    assert handed == [] and spark.read.parquet(f"{out}/results").where("status = 'UNKNOWN'").count() == 3
    open(flag, "w").close()
    process()
    process()
    assert sorted(int(n) for n in open(sent)) == list(range(10))
    assert handed == [1] and spark.read.parquet(f"{out}/results").count() == 10
    assert {r.next_offset for r in spark.read.parquet(f"{out}/offsets").collect()} == {9, 10}


class Halve:
    def init(self):
        pass

    def run(self, event):
        return {**event, "title": event["title"] + "!"} if int(event["id"]) % 2 else None

    def close(self):
        pass


class Counted(Halve):
    def __init__(self, path):
        self.path = path

    def run(self, event):
        with open(self.path, "a") as f:
            f.write("x")
        return super().run(event)


def test_transforms_run_once(spark, tmp_path):
    batch = log(spark, [record("t", 0, i) for i in range(20)])
    calls = str(tmp_path / "calls")
    for _ in range(2):
        story.process_batch(batch, 0, {"story_id": "s", "sink": SINK}, str(tmp_path / "out"), lambda *_: (200, "ok"), transforms=[hooks.row_transform(lambda: Counted(calls))])
    assert os.path.getsize(calls) == 20


def test_row_transform_in_a_story(spark, tmp_path):
    batch = log(spark, [record("t", 0, i) for i in range(10)])
    out = str(tmp_path / "out")
    params = {"story_id": "s", "sink": SINK}
    story.process_batch(batch, 0, params, out, lambda *_: (200, "ok"), transforms=[hooks.row_transform(Halve)])
    results = spark.read.parquet(f"{out}/results").orderBy("offset").collect()
    assert [r.status for r in results] == [None, "DONE"] * 5
    assert results[1].title == "user.a!"
    assert spark.read.parquet(f"{out}/offsets").first().next_offset == 10


def test_replay(spark, tmp_path):
    rows = [(*record("t", i % 2, i)[:5], None, 0) for i in range(20)] + [(b"k", b"abc", "t", 0, 30, None, 0)]
    df = log(spark, rows).withColumn("timestamp", F.timestamp_seconds(F.col("offset")))
    out = str(tmp_path / "out")
    seen = str(tmp_path / "headers")

    def send(method, url, headers, body, timeout):
        with open(seen, "w") as f:
            json.dump(headers, f)
        return 200, "ok"

    begin = F.timestamp_seconds(F.lit(5))
    sent = story.replay(df, SINK["url"], begin, None, out, send, headers=["Accept=a=b"], step=6)
    assert report.replay_count(sent).first().total == 15
    assert sorted(int(r.id) for r in sent.collect()) == list(range(5, 20))
    assert json.load(open(seen)) == {"Accept": "a=b"}
    late = F.timestamp_seconds(F.lit(1000))
    assert story.replay(df, SINK["url"], late, None, f"{out}-late", send).count() == 0
    assert spark.read.parquet(f"{out}/quarantine").count() == 1


def test_replay_goes_on_after_a_failure(spark, tmp_path):
    df = log(spark, [record("t", 0, i) for i in range(12)]).withColumn("timestamp", F.timestamp_seconds(F.col("offset")))
    out, flag, sent = str(tmp_path / "out"), str(tmp_path / "up"), str(tmp_path / "sent")

    class Fragile:
        def send(self, method, url, headers, body, timeout):
            n = json.loads(body)["id"]
            if n == "7" and not os.path.exists(flag):
                sys.exit("task lost")
            with open(sent, "a") as f:
                f.write(f"{n}\n")
            return 200, "ok"

    def start():
        return story.replay(df, SINK["url"], F.timestamp_seconds(F.lit(0)), None, out, Fragile(), step=4)

    with pytest.raises(Exception):
        start()
    open(flag, "w").close()
    assert start().where("status = 'DONE'").count() == 12
    assert [int(n) for n in open(sent)] == [0, 1, 2, 3, 4, 5, 6, 4, 5, 6, 7, 8, 9, 10, 11]
    with pytest.raises(ValueError, match="other arguments"):
        story.replay(df, SINK["url"], F.timestamp_seconds(F.lit(5)), None, out, Fragile(), step=4)


def test_replay_tries_unknown_events_again(spark, tmp_path):
    rows = [record("t", 0, i) for i in range(8)] + [record("t", 1, 1000 + i) for i in range(8)]
    df = log(spark, rows).withColumn("timestamp", F.timestamp_seconds(F.col("offset") % 100))
    out, flag, sent = str(tmp_path / "out"), str(tmp_path / "up"), str(tmp_path / "sent")

    def send(method, url, headers, body, timeout):
        n = json.loads(body)["id"]
        if n == "2" and not os.path.exists(flag):
            raise ConnectionFailed("down")
        with open(sent, "a") as f:
            f.write(f"{n}\n")
        return 200, "ok"

    def start():
        return story.replay(df, SINK["url"], F.timestamp_seconds(F.lit(0)), None, out, send, step=4, sleep=_no_sleep, deadline_s=3)

    assert start().where("status = 'UNKNOWN'").count() == 2
    assert spark.read.parquet(f"{out}/chosen").select("step").distinct().count() == 2
    open(flag, "w").close()
    assert start().where("status = 'DONE'").count() == 16
    order = [int(n) for n in open(sent)]
    assert sorted(order) == [*range(8), *range(1000, 1008)] and [n for n in order if n < 8] == list(range(8))


def test_few_lanes_are_dealt_out_evenly(spark):
    rows = [(f"t{i % 4}", i % 2, i) for i in range(64)] + [("big", None, i) for i in range(40)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = delivering.by_lane(df, ["topic", "partition"])
    found = dealt.withColumn("task", F.spark_partition_id()).groupBy("topic", "partition").agg(F.collect_set("task").alias("tasks"), F.count("*").alias("n")).collect()
    assert dealt.columns == df.columns and sum(r.n for r in found) == len(rows)
    assert all(len(r.tasks) == 1 for r in found)
    lanes = [r.tasks[0] for r in found if r.topic != "big"]
    assert len(set(lanes)) == len(lanes) == 4 <= tasks


def test_a_batch_is_parsed_once(spark, tmp_path):
    """What a story sends, counts and files comes from events that were written, and not from its records once more."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = log(spark, [record("t", i % 2, i) for i in range(20)]).mapInArrow(counted, schema.KAFKA_SOURCE)
    out = str(tmp_path / "out")
    story.process_batch(df, 0, {"story_id": "s", "sink": SINK}, out, lambda *a: (200, "ok"))
    assert spark.read.parquet(f"{out}/results").where("status = 'DONE'").count() == 20
    assert seen.value == 40  # the events, and the quarantine


def test_many_short_steps_are_few_jobs(spark, tmp_path):
    """200 steps of two offsets: sent in order, in waves; a down sink stops its partition within a wave."""
    rows = [record("t", p, 1000 * p + i) for i in range(400) for p in range(2)]
    df = log(spark, rows).withColumn("timestamp", F.timestamp_seconds(F.col("offset") % 1000))
    out, flag, sent = str(tmp_path / "out"), str(tmp_path / "up"), str(tmp_path / "sent")

    def send(method, url, headers, body, timeout):
        n = json.loads(body)["id"]
        if n == "100" and not os.path.exists(flag):
            raise ConnectionFailed("down")
        with open(sent, "a") as f:
            f.write(f"{n}\n")
        return 200, "ok"

    def start():
        return story.replay(df, SINK["url"], F.timestamp_seconds(F.lit(0)), None, out, send, step=2, sleep=_no_sleep, deadline_s=0.5)

    first = start()
    assert sorted(int(r.id) for r in first.where("status = 'UNKNOWN'").collect()) == [100, 101]
    assert first.where("step > 50 and partition = 0").isEmpty()
    open(flag, "w").close()
    done = start()
    assert sorted((r.partition, r.step, int(r.id)) for r in done.where("status = 'DONE'").collect()) == sorted((p, i // 2, 1000 * p + i) for i in range(400) for p in range(2))
    order = [int(n) for n in open(sent)]
    assert len(order) == 800 and [n for n in order if n < 1000] == list(range(400)) and [n for n in order if n >= 1000] == list(range(1000, 1400))
    assert len([d for d in os.listdir(f"{out}/results") if "=" in d]) == 9


def test_waves_of_steps(spark):
    found = spark.range(3000).select(story.wave_of(F.col("id"), 100, 6400).alias("w")).groupBy("w").count().collect()
    assert sorted((r.w, r["count"]) for r in found)[:9] == [(0, 1), (1, 1), (2, 2), (3, 4), (4, 8), (5, 16), (6, 32), (7, 64), (8, 64)]
    assert max(r["count"] for r in found) == 64
    assert [r.w for r in spark.range(4).select(story.wave_of(F.col("id"), 100_000).alias("w")).collect()] == [0, 1, 2, 3]


def test_all_stories(spark, tmp_path):
    rows = [record(f"t{i % 2}", 0, i, "user.a" if i % 3 else "msg.x") for i in range(24)]
    path = str(tmp_path / "log")
    kafka.land_log(log(spark, rows), path)
    sink = 'http#{"uri":"http://example.invalid/","method":"post"}'
    nodes = [
        ("a", 'kafka#{"topics":["t0"]}', 'filter#{"event-name-white-list":["user"]}'),
        ("b", 'kafka#{"topic-pattern":"t"}', None),
        ("c", "file#{}", None),
        ("d", 'kafka#{"topics":["t0"]}', None),
    ]
    table = [(f"stories/{s}/{n}", d) for s, source, op in nodes for n, d in [("source", source), ("sink", sink), ("status", "DISABLED" if s == "d" else ""), ("operators", op)] if d is not None]
    stories = control.load_stories(spark.createDataFrame(table, "path string, data string"), "relay", "p", "test")

    def open_stream(row):
        return kafka.landed_log(spark, path, row.topics, row.topic_pattern)

    out = str(tmp_path / "out")
    running = story.run_stories(stories, open_stream, out, f"{out}/checkpoints", lambda *_: (200, "ok"), {"availableNow": True})
    assert len(running) == 2
    for query in running:
        query.awaitTermination()
    results = spark.read.parquet(f"{out}/a/results").union(spark.read.parquet(f"{out}/b/results")).where("passes")
    counts = {r.story_id: r.new for r in report.story_outcome_counts(results).collect()}
    assert counts == {"a": 8, "b": 24}


def test_rules_change_while_running(spark, tmp_path):
    snapshots = []

    def read():
        return spark.createDataFrame(list(enumerate(snapshots)), "version int, data string")

    def write(batch, batch_id):
        batch.select("id", "topic").write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={batch_id}")

    path = str(tmp_path / "in")
    found = []
    for i, doc in enumerate(['[{"topic":"a","patterns":["user"]}]', "broken", '[{"topic":"b","patterns":["USER"]}]']):
        snapshots.append(doc)
        spark.createDataFrame([(str(i), "user.x")], "id string, title string").write.mode("append").parquet(path)
        source = spark.readStream.schema("id string, title string").parquet(path)
        run(route.route_stream(source, read, write, f"{tmp_path}/checkpoint", availableNow=True))
        found.append({r.id: r.topic for r in spark.read.parquet(f"{tmp_path}/out").collect()})
    assert found[-1] == {"0": "a", "1": "a", "2": "b"}


def test_no_rules_keep_the_offsets(spark, tmp_path):
    """A batch without any valid rules document fails; with an empty one it passes without topics."""
    path, written = str(tmp_path / "in"), []
    spark.createDataFrame([("1", "user.x")], "id string, title string").write.parquet(path)
    source = spark.readStream.schema("id string, title string").parquet(path)
    for doc, topics in (("broken", None), ("[]", [None]), (None, None)):
        def read(doc=doc):
            return spark.createDataFrame([(0, doc)] if doc else [], "version int, data string")

        def write(batch, batch_id):
            written.append([r.topic for r in batch.collect()])

        def start(doc=doc):
            run(route.route_stream(source, read, write, f"{tmp_path}/checkpoint-{doc}", availableNow=True))

        if topics is None:
            with pytest.raises(Exception, match="Topic mappings is empty"):
                start()
        else:
            start()
    assert written == [[None]]


def test_kafka_options():
    options = kafka.reader_options(["a", "b"], None, {"kafka.bootstrap.servers": "example.invalid:9092"})
    assert options == {
        "subscribe": "a,b", "startingOffsets": "latest", "maxOffsetsPerTrigger": 100_000, "kafka.bootstrap.servers": "example.invalid:9092",
    }
    assert kafka.reader_options(None, "event-(a|b)", {"maxOffsetsPerTrigger": 5})["subscribePattern"] == "(?:event-(a|b)).*"
    with pytest.raises(ValueError):
        kafka.reader_options()
    assert kafka.replay_options(["t"], 1000, 2000) == {
        "subscribe": "t", "startingTimestamp": 1000, "startingOffsetsByTimestampStrategy": "latest", "endingTimestamp": 2001,
    }
    assert kafka.writer_options({"kafka.acks": "1"})["kafka.acks"] == "1"
    assert kafka.writer_options({})["kafka.enable.idempotence"] == "true"


@pytest.mark.parametrize("call", [
    lambda s: kafka.kafka_topics_source(s, ["t"], {"kafka.bootstrap.servers": "example.invalid:1"}),
    lambda s: kafka.kafka_pattern_source(s, "t", {"kafka.bootstrap.servers": "example.invalid:1"}),
    lambda s: kafka.publish(s.sql("select 't' topic, '1' id, '{}' payload"), {"kafka.bootstrap.servers": "example.invalid:1"}),
])
def test_kafka_needs_its_connector(spark, call):
    """Without the connector on the class path the calls get as far as looking it up."""
    with pytest.raises(Exception, match="(?i)kafka"):
        call(spark)


def test_request_folder(spark, tmp_path):
    body = '{"id":"1",\n"title":"t","published":"p"}'
    os.makedirs(tmp_path / "text")
    (tmp_path / "text" / "one").write_text(body)
    found = requests.request_bodies_source(spark, str(tmp_path / "text"), "text", streaming=False).first()
    assert found.body == body and found.request_id.endswith("/one") and found.sink_id is None
    for kind in ("json", "parquet"):
        path = str(tmp_path / kind)
        spark.createDataFrame([("r", body, "s")], schema.REQUEST).write.format(kind).save(path)
        assert requests.request_bodies_source(spark, path, kind, streaming=False).first().sink_id == "s"
    with pytest.raises(ValueError):
        requests.request_bodies_source(spark, "x", "csv")


def test_sink_table_row_as_parameters(spark):
    text = 'http#{"method":"put","uri":"http://example.invalid/","max_retry_times":1}'
    row = control.load_sinks(spark.createDataFrame([(text,)], "data string")).first()
    sink = {k: v for k, v in row.asDict().items() if k != "error"}
    seen = deliver(events(spark, ["retry"]), sink, lambda m, *_: (200, "retry" if m == "PUT" else "no")).first()
    assert (seen.error, seen.attempts) == ("Maximum Retries", 2)
