"""Rules and sinks as versioned state."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from postroad import schema
from postroad.sources import kafka
from postroad.streaming import control_state, route, story

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Documents:
    """A control log: one file for each version; counts what each batch was given."""

    def __init__(self, path):
        self.path, self.given = str(path), []

    def add(self, spark, version, data):
        spark.createDataFrame([(version, data)], "version long, data string").coalesce(1).write.mode("append").parquet(self.path)

    def since(self, spark, version):
        newer = control_state.newer_than(spark.read.schema("version long, data string").parquet(self.path), version)
        self.given.append(newer.count())
        return newer


def rules(*entries):
    return json.dumps([{"topic": t, "patterns": [p]} for t, p in entries])


def current(state, spark, batch):
    table = state.at(spark, batch)
    return None if table is None else [(r.topic, r.pattern) for r in table.orderBy("rank").collect()]


def test_rules_follow_the_documents_and_read_each_once(spark, tmp_path):
    log = Documents(tmp_path / "documents")
    state = control_state.rules_state(str(tmp_path / "state"), log.since)
    log.add(spark, 1, "no json")
    assert current(state, spark, 0) is None
    log.add(spark, 2, rules(("a", "x")))
    log.add(spark, 3, rules(("b", "(")))
    assert current(state, spark, 1) == [("a", "x")]
    assert current(state, spark, 2) == [("a", "x")]
    for version in range(4, 9):
        log.add(spark, version, rules((f"v{version}", "y"), ("c", "z")))
    assert current(state, spark, 3) == [("v8", "y"), ("c", "z")]
    log.add(spark, 9, "[]")
    assert current(state, spark, 4) == []
    assert log.given == [1, 3, 0, 5, 1]
    # A restart, and a batch that is run again, get what they had; a gap in the numbers is bridged.
    again = control_state.rules_state(str(tmp_path / "state"), log.since)
    log.add(spark, 10, rules(("late", "x")))
    assert [current(again, spark, k) for k in range(1, 5)] == [[("a", "x")], [("a", "x")], [("v8", "y"), ("c", "z")], []]
    assert len(log.given) == 5
    assert current(again, spark, 7) == [("late", "x")] and log.given[-1] == 1


def test_newer_documents_are_a_pushed_filter(spark, tmp_path):
    log = Documents(tmp_path / "documents")
    log.add(spark, 1, "x")
    newer = control_state.newer_than(spark.read.schema("version long, data string").parquet(log.path), 7)
    assert "GreaterThan(version,7)" in newer._jdf.queryExecution().executedPlan().toString()


def test_sinks_are_updated_one_by_one(spark, tmp_path):
    log = Documents(tmp_path / "documents")
    state = control_state.sinks_state(str(tmp_path / "state"), log.since)
    text = lambda url, **more: "http#" + json.dumps({"uri": url, "method": "post", **more})
    log.add(spark, 1, json.dumps({"a": text("a1"), "b": text("b1")}))
    of = lambda batch: {r.sink_id: (r.url, r.timeout) for r in state.at(spark, batch).collect()}
    assert of(0) == {"a": ("a1", 300.0), "b": ("b1", 300.0)}
    log.add(spark, 2, json.dumps({"a": text("a2", timeout=5), "c": text("c1")}))
    assert of(1) == {"a": ("a2", 5.0), "b": ("b1", 300.0), "c": ("c1", 300.0)}
    log.add(spark, 3, json.dumps({"a": "ftp#{}", "b": text("b2")}))
    assert of(2) == {"a": ("a2", 5.0), "b": ("b2", 300.0), "c": ("c1", 300.0)}
    params = control_state.sink_at(state, "a")
    assert params(spark, 0)["url"] == "a1" and params(spark, 2)["timeout"] == 5.0
    with pytest.raises(ValueError):
        control_state.sink_at(state, "nope")(spark, 2)


def log_rows(spark, path, low, high):
    value = F.concat(F.lit('{"id":"'), F.col("id"), F.lit('","title":"t'), F.col("id") % 3, F.lit('","published":""}'))
    rows = spark.range(low, high).select(F.lit(b"k").alias("key"), value.cast("binary").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))
    kafka.land_log(rows.select(*schema.KAFKA_SOURCE.fieldNames()), path)


class Told:
    """Answers with the URL that ``update_params`` and the call name."""

    def update_params(self, params):
        self.params = params

    def send(self, method, url, headers, body, timeout):
        return 200, f"{self.params['url']} {url} {timeout}"


def test_a_change_of_a_sink_takes_effect_at_the_next_batch(spark, tmp_path):
    log, path, out = Documents(tmp_path / "documents"), str(tmp_path / "log"), str(tmp_path / "out")
    state = control_state.sinks_state(str(tmp_path / "state"), log.since)
    for run, (url, timeout) in enumerate([("u1", 1), ("u2", 2), (None, 0)]):
        text = "http#" + json.dumps({"uri": url, "method": "post", "timeout": timeout})
        log.add(spark, run, json.dumps({"s": text}))
        log_rows(spark, path, run * 4, run * 4 + 4)
        running = story.run_story(kafka.landed_log(spark, path, ["t"]), {"story_id": "x"}, out, f"{out}/checkpoint", Told(), {"availableNow": True}, control_state.sink_at(state, "s"))
        running.awaitTermination()
    found = {r.offset: r.error for r in spark.read.parquet(f"{out}/results").collect()}
    said = ["u1 u1 1.0", "u2 u2 2.0", "u2 u2 2.0"]  # the last document is faulty
    assert found == {k: f"Unexpected Response: {said[k // 4]}" for k in range(12)}


def test_a_stream_by_state_fails_without_rules_and_goes_on_with_them(spark, tmp_path):
    log, path, out = Documents(tmp_path / "documents"), str(tmp_path / "log"), str(tmp_path / "out")
    log.add(spark, 1, "[{}]")
    log_rows(spark, path, 0, 6)
    schema_ = "title string, topic string"
    write = lambda df, k: df.select("title", "topic").write.mode("overwrite").parquet(f"{out}/{k}")

    def run(state_path):
        stream = spark.readStream.schema(schema.KAFKA_SOURCE).parquet(path).select(F.concat(F.lit("t"), (F.col("offset") % 3).cast("string")).alias("title"))
        route.route_by_state(stream, control_state.rules_state(state_path, log.since), write, f"{out}-checkpoint", availableNow=True).awaitTermination()

    with pytest.raises(Exception, match="Topic mappings is empty"):
        run(str(tmp_path / "state"))
    log.add(spark, 2, rules(("zero", "t0"), ("rest", "t")))
    run(str(tmp_path / "state"))
    assert {(r.title, r.topic) for r in spark.read.schema(schema_).parquet(f"{out}/0").collect()} == {("t0", "zero"), ("t1", "rest"), ("t2", "rest")}
