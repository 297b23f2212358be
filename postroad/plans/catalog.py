"""Registered queries: each operator applied to whole tables.

A query takes ``(spark, sf_dir)`` and gives a DataFrame of plain columns. Queries that
run a stream or deliver events write a table in the shared folder and read it back.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroad.functions.match import is_valid_pattern
from postroad.functions.strict_json import with_variant
from postroad.functions.text import backoff_delay, dead_letter_topic, header_map, merge_maps, parse_zoned_time
from postroad.operators import delivery, filters, parse, replay, report, routing
from postroad.plans import views
from postroad.session import prepare, shared_dir
from postroad.sources import control, kafka, log_index, requests
from postroad.streaming import control_state, fanout, hooks, producer, route, sinks, story, windows
from postroad.streaming.deliver import ConnectionFailed, PayloadFailed, deliver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(*tables: str):
    """Register a function of tables; ``spark`` is passed first."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return build(spark, *[views.table(spark, sf_dir, t) for t in tables])

        QUERIES[build.__name__] = run
        return build

    return register


def _log(events: DataFrame) -> DataFrame:
    return views.kv_events(events)


def _kafka_log(events: DataFrame) -> DataFrame:
    """The log with the columns of the Kafka source."""
    value = F.to_json(F.struct("id", "title", "published", F.col("user_id").alias("user")))
    return _log(events).select(
        F.col("id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.lit(0).alias("timestampType"),
    )


def _drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there now, into a table."""
    spark, out = stream.sparkSession, shared_dir(stream.sparkSession, name)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint")
    writer.trigger(availableNow=True).start(f"{out}/data").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


# --- sources and control tables -------------------------------------------------


def _landed(spark: SparkSession, events: DataFrame, **which) -> DataFrame:
    path = shared_dir(spark, "log")
    kafka.land_log(_kafka_log(events), path)
    parsed = parse.parse_kafka_messages(kafka.landed_log(spark, path, **which))
    return _drain(parsed.select("id", "title", "topic", "partition", "offset", "key"), "consumed")


@query("events")
def kafka_topics_source(spark, events):
    return _landed(spark, events, topics=["event-v2-t1", "event-v2-t7"])


@query("events")
def kafka_pattern_source(spark, events):
    return _landed(spark, events, topic_pattern="event-v[0-9]-(t0|x)")


@query("events")
def request_bodies_source(spark, events):
    path = shared_dir(spark, "requests")
    bodies = views.request_bodies(events).select("request_id", "body", "sink_id")
    bodies.write.json(path)
    parsed = parse.parse_request_bodies(requests.request_bodies_source(spark, path, "json"))
    return _drain(parsed.select("request_id", "pos", "id", "title", "sink_id"), "received")


@query("events")
def replay_window(spark, events):
    start, end = [F.lit(t).cast("timestamp") for t in (views.REPLAY_START, views.REPLAY_END)]
    return replay.replay_window(_log(events), start, end).select("topic", "partition", "offset", "id")


@query("events")
def seek_offsets(spark, events):
    start, end = [F.lit(t).cast("timestamp") for t in (views.REPLAY_START, views.REPLAY_END)]
    return replay.seek_offsets(_log(events), start, end)


def _landed_in_parts(spark: SparkSession, events: DataFrame) -> str:
    """The log landed in four runs by record time, each indexed as it lands."""
    path = shared_dir(spark, "log")
    log = _kafka_log(events).withColumn("run", F.pmod(F.dayofyear("timestamp"), F.lit(4)))
    for run in range(4):
        log_index.land_indexed(log.where(F.col("run") == run).drop("run"), path)
    return path


@query("events")
def replay_landed(spark, events):
    """`replay_window` over a landed log, by the time index of its files."""
    start, end = [F.lit(t).cast("timestamp") for t in (views.REPLAY_START, views.REPLAY_END)]
    found = log_index.replay_landed(spark, _landed_in_parts(spark, events), start, end)
    return found.select("topic", "partition", "offset", F.col("key").cast("string").alias("id"))


@query("events")
def seek_landed(spark, events):
    start, end = [F.lit(t).cast("timestamp") for t in (views.REPLAY_START, views.REPLAY_END)]
    return log_index.seek_landed(spark, _landed_in_parts(spark, events), start, end).bounds


@query("orders")
def load_topic_rules(spark, orders):
    return control.load_topic_rules(views.rule_snapshots(orders))


@query("orders")
def rejected_rules(spark, orders):
    return control.rejected_rules(views.rule_snapshots(orders)).select("owner", "version")


@query("orders")
def current_rules(spark, orders):
    return control.current_rules(views.rule_snapshots(orders), by=["owner"])


@query("customer")
def load_sinks(spark, customer):
    sinks = control.load_sinks(views.sink_texts(customer))
    return sinks.withColumn("accept", F.col("headers")["accept"]).drop("headers")


@query("orders")
def current_sinks(spark, orders):
    sinks = control.current_sinks(views.sink_snapshots(orders))
    return sinks.select("sink_id", "version", "url", "method", "timeout", "max_retry_times")


def _stories(customer: DataFrame) -> DataFrame:
    return control.load_stories(views.story_nodes(customer), "relay", "proj", "test")


@query("customer")
def load_stories(spark, customer):
    lists = {n: F.array_join(n, "|") for n in ("topics", "include", "exclude")}
    return _stories(customer).withColumns(lists).select(
        "story_id", "topics", "topic_pattern", "group_id", "url", "method", "include", "exclude",
        "status", "error",
    )


def _runners(nation: DataFrame, region: DataFrame) -> tuple[DataFrame, DataFrame]:
    placed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    of_region = placed.groupBy(F.col("r_name").alias("project_id")).agg(
        F.collect_list("n_name").alias("runners")
    )
    shared = nation.where("n_nationkey % 4 = 1").agg(F.collect_list("n_name").alias("runners"))
    return of_region.unionByName(shared.withColumn("project_id", F.lit("all")))


def _active(customer, nation, region, project):
    homes = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("s"), "c_custkey").alias("story_id"), F.col("n_name").alias("runner")
    )
    stories = _stories(customer).where("error is null").join(homes, "story_id")
    active = control.active_stories(stories, _runners(nation, region), project)
    return active.select("story_id", "runner")


@query("customer", "nation", "region")
def active_stories(spark, customer, nation, region):
    return _active(customer, nation, region, "ASIA")


@query("customer", "nation", "region")
def active_stories_shared(spark, customer, nation, region):
    return _active(customer, nation, region, "elsewhere")


# --- parsing ---------------------------------------------------------------------


@query("events")
def parse_request_bodies(spark, events):
    parsed = parse.flatten_extra(parse.parse_request_bodies(views.request_bodies(events)))
    return parsed.select(
        "request_id", "pos", "id", "title", "published", "actor_id", "object_id", "target_id"
    )


@query("events")
def quarantine_bodies(spark, events):
    rejected = parse.quarantine_bodies(views.request_bodies(events))
    return rejected.select("request_id", "error_kind", "error")


@query("documents")
def parse_kafka_messages(spark, documents):
    parsed = parse.flatten_extra(parse.parse_kafka_messages(views.kafka_messages(documents)))
    content = F.get_json_object("payload", "$.content")
    return parsed.select(
        "id", "title", "published", "actor_id", "object_id", "topic", "partition", "offset", "key",
        F.md5(content).alias("content_md5"),
    )


@query("documents")
def quarantine_messages(spark, documents):
    rejected = parse.quarantine_messages(views.kafka_messages(documents))
    return rejected.select("offset", "error_kind", "error")


@query("events")
def validate_envelope(spark, events):
    typed = events.selectExpr(
        "event_id",
        """concat('{"id":', case event_id % 3 when 0 then '"a"' when 1 then cast(event_id as string) else 'null' end,
           if(event_id % 4 = 0, '', concat(',"title":"', event_type, '"')),
           ',"published":', if(event_id % 5 = 0, props, '""'), '}') as body""",
    )
    checked = parse.validate_envelope(with_variant(typed, F.col("body"), "v"), "v")
    return checked.select("event_id", "bad_fields")


@query("events")
def extract_extra(spark, events):
    typed = events.selectExpr(
        "event_id",
        """concat('{"actor":', case event_id % 3 when 0 then concat('{"id":"u', user_id, '"}')
           when 1 then '"plain"' else concat('{"id":', user_id, '}') end,
           ',"object":', if(event_id % 4 = 0, '{"id":{"x":1}}', '[{"id":"no"}]'),
           if(event_id % 5 = 0, '', concat(',"target":{"name":1', if(event_id % 2 = 0, ',"id":null', ''), '}')),
           '}') as body""",
    )
    extra = parse.extract_extra(with_variant(typed, F.col("body"), "v"), "v")
    names = F.array_join(F.array_sort(F.map_keys("extra")), ",").alias("present")
    return parse.flatten_extra(extra.select("event_id", "extra", names))


@query("events")
def payload_text_exact(spark, events):
    parsed = parse.parse_request_bodies(views.request_bodies(events), exact_payload=True)
    return parsed.select("request_id", "pos", "payload")


@query("events")
def payload_text(spark, events):
    """The received text of each event, alone or as a part of a list."""
    return parse.parse_request_bodies(views.request_bodies(events)).select("request_id", "pos", "payload")


@query("events")
def examine_bodies(spark, events):
    """Events and rejected bodies by one parse."""
    examined = parse.examine_bodies(views.request_bodies(events))
    return examined.select("request_id", "pos", "id", "title", "error_kind", "error")


@query("events")
def event_summary(spark, events):
    log = parse.event_summary(_log(events).withColumn("key", F.lit(None).cast("string")))
    return log.select("offset", "summary")


@query("events")
def to_kafka_records(spark, events):
    records = parse.to_kafka_records(_log(events))
    return records.select("topic", *[F.col(c).cast("string").alias(c) for c in ("key", "value")])


# --- filters ---------------------------------------------------------------------


@query("events")
def include_events(spark, events):
    return filters.include_events(_log(events), views.INCLUDE).select("id", "title")


@query("events")
def exclude_events(spark, events):
    return filters.exclude_events(_log(events), views.EXCLUDE).select("id", "title")


@query("events")
def filter_events(spark, events):
    return filters.filter_events(_log(events), views.INCLUDE, views.EXCLUDE).select("id", "title")


@query("events")
def transform_chain(spark, events):
    steps = [
        lambda df: filters.filter_events(df, include=[r"user\.|my\.profile"]),
        lambda df: filters.filter_events(df, exclude=[r"my\.profile\.(view|click)"]),
        lambda df: df.withColumn("title", F.upper("title")),
    ]
    return filters.transform_chain(_log(events), steps).select("id", "title")


@query("documents")
def filter_documents(spark, documents):
    """Titles that are whole texts: Unicode, line breaks and long input."""
    titled = documents.select("doc_id", F.col("text").alias("title"))
    kept = filters.filter_events(titled, [r"[a-m]", r"é"], [r"(is|un|la) "])
    return kept.select("doc_id")


@query("events")
def story_filter(spark, events):
    chosen = routing.story_events(_log(events), views.stories_table(spark))
    return chosen.select("story_id", "id", "title")


@query("events")
def story_filter_large(spark, events):
    """Pattern lists of more than one index: two patterns in each."""
    chosen = routing.story_events(_log(events), views.stories_table(spark), block=2)
    return chosen.select("story_id", "id", "title")


# --- routing ---------------------------------------------------------------------


@query("events")
def resolve_topic(spark, events):
    return routing.resolve_topic(_log(events), views.RULES).select("id", "title", "topic")


@query("events")
def resolve_topic_table(spark, events):
    routed = routing.resolve_topic_table(_log(events), views.rules_table(spark))
    return routed.select("id", "title", "topic")


@query("events")
def resolve_distinct_titles(spark, events):
    log = _log(events).drop("topic")
    routed = routing.resolve_distinct_titles(log, views.rules_table(spark), spread_by=["id"])
    return routed.select("id", "title", "topic")


@query("events")
def resolve_distinct_titles_large(spark, events):
    """Rules of more than one index, and titles looked up by shuffle."""
    log = _log(events).drop("topic")
    routed = routing.resolve_distinct_titles(
        log, views.rules_table(spark), block=2, spread_by=["id"], max_titles=2
    )
    return routed.select("id", "title", "topic")


@query("orders")
def dedupe_patterns(spark, orders):
    rules = control.load_topic_rules(views.rule_snapshots(orders)).withColumn(
        "rank", F.col("version") * 4 + F.col("rank")
    )
    return routing.dedupe_patterns(rules.drop("version"), by=["owner"])


@query("events")
def unrouted_events(spark, events):
    missing = routing.unrouted_events(routing.resolve_topic(_log(events), views.RULES))
    return missing.select("id", "title", "error_kind")


@query("events")
def story_fanout(spark, events):
    fanned = routing.story_fanout(_log(events), views.stories_table(spark))
    return fanned.select("story_id", "topic", "id")


@query("events")
def dispatch_to_sink(spark, events):
    parsed = parse.parse_request_bodies(views.request_bodies(events))
    sent = routing.dispatch_to_sink(parsed, views.sinks_table(spark))
    return sent.select("request_id", "sink_id", "id", "title", "url", "error_kind", "error")


# --- delivery --------------------------------------------------------------------


def _rounds(events: DataFrame, c: int, chunk: int = delivery.CHUNK) -> DataFrame:
    passes = filters.title_passes(F.col("title"), views.INCLUDE, views.EXCLUDE)
    return delivery.delivery_rounds(_log(events), passes, c, chunk=chunk)


@query("events")
def delivery_rounds(spark, events):
    return _rounds(events, 1).select("topic", "partition", "offset", "round")


@query("events")
def delivery_rounds_concurrent(spark, events):
    """Three sends at once, and chunks small enough to carry totals over at this scale."""
    return _rounds(events, 3, chunk=512).select("topic", "partition", "offset", "round")


@query("events")
def classify_attempt(spark, events):
    classified = delivery.classify_attempt(views.attempts(events))
    return classified.select("event_id", "attempt", "action", "status", "error", "delay")


@query("events")
def backoff_delays(spark, events):
    return events.select(
        "event_id",
        backoff_delay(F.col("event_id") % 12 + 1, 0.5, 60.0).alias("delay"),
        backoff_delay(F.col("event_id") % 12 + 1, F.col("event_id") % 3 + 0.25, 9.0).alias("capped"),
    )


@query("events")
def delivery_outcome(spark, events):
    outcome = delivery.delivery_outcome(delivery.classify_attempt(views.attempts(events)))
    return outcome.withColumn("total_delay", F.round("total_delay", 6))


@query("events")
def delivery_outcome_spans(spark, events):
    """Outcomes reduced in spans of two attempts, with parameters taken from columns."""
    tried = views.attempts(events).withColumn("max_retry", (F.col("event_id") % 3).cast("int"))
    classified = delivery.classify_attempt(tried, F.col("max_retry"), 1.0, 3.0)
    return delivery.delivery_outcome(classified, width=2)


def _results(events: DataFrame) -> DataFrame:
    """Rounds with outcomes: late events of one partition have none."""
    status = (
        F.when(~F.col("passes"), None)
        .when((F.col("partition") == 2) & (F.col("offset") >= F.col("limit")), "UNKNOWN")
        .when(F.col("offset") % 10 == 3, "DEAD_LETTER")
        .otherwise("DONE")
    )
    limit = events.agg(F.floor(F.max("event_id") * 0.7).alias("limit")).scalar()
    rounds = _rounds(events, 2, chunk=512)
    return rounds.withColumn("limit", limit).withColumn("status", status)


@query("events")
def committable_offsets(spark, events):
    return delivery.committable_offsets(_results(events))


@query("events")
def committable_offsets_filtered(spark, events):
    settled = _results(events).withColumn("status", F.lit("DONE"))
    return delivery.committable_offsets(settled, commit_filtered=True)


@query("events")
def offset_ledger(spark, events):
    """Three batches by record number, carried from one to the next."""
    results, ledger = _results(events), None
    for batch in range(3):
        ledger = delivery.offset_ledger(results.where(F.pmod(F.col("offset"), F.lit(3)) == batch), ledger)
    return ledger


@query("events")
def dead_letter_topics(spark, events):
    named = _log(events).withColumn(
        "topic",
        F.concat(F.element_at(F.array(*map(F.lit, ["", "event-v2-", "event-v12-", "x-event-v1-", "event-v3-dead-letter-"])),
                              (F.col("offset") % 5 + 1).cast("int")), "topic"),
    )
    return named.select("offset", dead_letter_topic(F.col("topic")).alias("topic"))


@query("events")
def dead_letter_records(spark, events):
    dead = delivery.dead_letter_records(_results(events))
    return dead.select("topic", *[F.col(c).cast("string").alias(c) for c in ("key", "value")])


# --- reports ---------------------------------------------------------------------


def _publish_results(events: DataFrame) -> DataFrame:
    """Results of publishing parsed requests: unrouted events and some refusals fail."""
    parsed = parse.parse_request_bodies(views.request_bodies(events))
    routed = routing.resolve_topic(parsed, views.RULES)
    refused = F.col("pos").isin(1, 3) & (F.col("event_id") % 6 == 1)
    kind = F.when(F.col("topic").isNull(), "NoMatchedKafkaTopicError").when(refused, "KafkaError")
    # Some ids repeat inside a request.
    shared_id = F.when(F.col("event_id") % 10 == 1, F.col("request_id")).otherwise(F.col("id"))
    return routed.withColumns({
        "id": shared_id,
        "error_kind": kind,
        "error": F.when(kind == "KafkaError", F.concat(F.lit("refused "), F.col("pos").cast("string"))),
    })


@query("events")
def batch_ack(spark, events):
    rejected = report.rejected_results(parse.quarantine_bodies(views.request_bodies(events)))
    columns = ["request_id", "pos", "id", "error_kind", "error"]
    results = _publish_results(events).select(*columns).unionByName(rejected.select(*columns))
    acks = report.batch_ack(results)
    pairs = F.transform(F.map_entries("details"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return acks.withColumn("details", F.array_join(pairs, ";"))


@query("events")
def ack_status(spark, events):
    return report.ack_status(_publish_results(events))


@query("events")
def ack_details(spark, events):
    return report.ack_details(_publish_results(events))


@query("events")
def topic_counts(spark, events):
    return report.topic_counts(routing.resolve_topic(_log(events), views.RULES))


@query("events")
def sink_counts(spark, events):
    return report.sink_counts(_publish_results(events))


@query("events")
def path_counts(spark, events):
    return report.path_counts(_publish_results(events))


@query("events")
def story_outcome_counts(spark, events):
    fanned = routing.story_fanout(_results(events).where("passes"), views.stories_table(spark))
    return report.story_outcome_counts(fanned)


@query("events")
def send_time_stats(spark, events):
    return report.send_time_stats(views.attempts(events)).withColumn("avg_ms", F.round("avg_ms", 6))


@query("events")
def latency_summary(spark, events):
    times = events.select(
        F.col("value").alias("request_time"),
        F.when(F.col("event_id") % 3 != 0, F.col("value") * 2 + F.col("user_id")).alias("receive_time"),
    )
    return report.latency_summary(times).withColumn("mean", F.round("mean", 6))


@query("events")
def poll_counts(spark, events):
    return report.poll_counts(_log(events))


@query("events")
def replay_count(spark, events):
    return report.replay_count(_results(events).where("passes"))


@query("events")
def lifecycle_counts(spark, events):
    return report.lifecycle_counts(views.lifecycle_log(events))


@query("events")
def lifecycle_latest(spark, events):
    return report.lifecycle_latest(views.lifecycle_log(events)).select("id", "status")


@query("events")
def windowed_counts(spark, events):
    routed = routing.resolve_topic(_log(events), views.RULES)
    counts = report.windowed_counts(routed, "6 hours", "topic")
    return counts.select(F.col("window_start").cast("string"), "topic", "n")


# --- scalar functions ------------------------------------------------------------


@query("events")
def valid_patterns(spark, events):
    patterns = events.select(
        "event_id",
        F.concat(
            F.element_at(F.array(*map(F.lit, ["(", "", "[", "(?:", "a|"])), (F.col("event_id") % 5 + 1).cast("int")),
            "event_type",
            F.when(F.col("event_id") % 2 == 0, ")").otherwise(""),
        ).alias("pattern"),
    )
    return patterns.select("event_id", "pattern", is_valid_pattern(F.col("pattern")).alias("valid"))


@query("events")
def zoned_times(spark, events):
    zones = F.array(*map(F.lit, ["+0200", "-05:30", "Z", "", "+2"]))
    text = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.element_at(zones, (F.col("event_id") % 5 + 1).cast("int")),
    )
    return events.select("event_id", F.unix_millis(parse_zoned_time(text)).alias("ms"))


@query("events")
def header_maps(spark, events):
    headers = F.array(
        F.concat(F.lit("a="), "event_type"), F.concat(F.lit("b=x="), F.col("user_id")), F.lit("a=last")
    )
    defaults = F.create_map(F.lit("b"), F.lit("default"), F.lit("c"), F.lit("kept"))
    merged = merge_maps(defaults, header_map(headers))
    return events.select(
        "event_id", *[merged[k].alias(k) for k in ("a", "b", "c")], F.size(merged).alias("n")
    )


# --- streams and delivery --------------------------------------------------------


@query("events")
def route_stream(spark, events):
    """Rules change between batches by document; the current document is the rules list."""
    path = shared_dir(spark, "log")
    kafka.land_log(_kafka_log(events), path)
    stream = parse.parse_kafka_messages(
        kafka.landed_log(spark, path, topic_pattern="event")
    ).drop("topic")
    out = shared_dir(spark, "routed")

    def snapshots() -> DataFrame:
        # One document from the rules table, then one with a faulty pattern.
        entries = F.array_sort(F.collect_list(F.struct("rank", "topic", "pattern")))
        entry = F.transform(
            entries, lambda e: F.struct(e["topic"].alias("topic"), F.array(e["pattern"]).alias("patterns"))
        )
        good = views.rules_table(spark).agg(F.to_json(entry).alias("data"))
        bad = F.lit('[{"topic":"t","patterns":["("]}]')
        return good.withColumn("version", F.lit(1)).unionByName(
            good.select(bad.alias("data"), F.lit(2).alias("version"))
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.select("id", "title", "topic")
        kept.write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    routed = route.route_stream(stream, snapshots, write, f"{out}/checkpoint", availableNow=True)
    routed.awaitTermination()
    return spark.read.parquet(f"{out}/data").select("id", "title", "topic")


@query("events")
def route_by_state(spark, events):
    """Three batches; between them come a document with other rules, a faulty one and the rules again."""
    path, documents, out = (shared_dir(spark, name) for name in ("log", "documents", "routed"))

    def tell(version: int, patterns: list[tuple[str, str]]) -> None:
        data = json.dumps([{"topic": t, "patterns": [p]} for t, p in patterns])
        spark.createDataFrame([(version, data)], "version long, data string").write.mode("append").parquet(documents)

    def newer(session: SparkSession, version: int | None) -> DataFrame:
        return control_state.newer_than(session.read.schema("version long, data string").parquet(documents), version)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("id", "title", "topic").write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    state = control_state.rules_state(f"{out}/rules", newer)
    for run, rules in enumerate([views.RULES, views.RULES[::-1], [("t", "(")]]):
        tell(run, rules)
        kafka.land_log(_kafka_log(events).where(F.col("offset") % 3 == run), path)
        stream = parse.parse_kafka_messages(kafka.landed_log(spark, path, topic_pattern="event")).drop("topic")
        route.route_by_state(stream, state, write, f"{out}/checkpoint", availableNow=True).awaitTermination()
    return spark.read.parquet(f"{out}/data").select("id", "title", "topic")


@query("events")
def publish(spark, events):
    path, out = shared_dir(spark, "log"), shared_dir(spark, "published")
    kafka.land_log(_kafka_log(events), path)
    stream = parse.parse_kafka_messages(kafka.landed_log(spark, path, topic_pattern="event"))
    routed = routing.resolve_topic(stream, views.RULES)
    kafka.publish(
        routed, {"path": f"{out}/data"}, f"{out}/checkpoint", "parquet", {"availableNow": True}
    ).awaitTermination()
    return spark.read.parquet(f"{out}/data").select(
        "topic", *[F.col(c).cast("string").alias(c) for c in ("key", "value")]
    )


@query("events")
def windowed_counts_stream(spark, events):
    path = shared_dir(spark, "log")
    kafka.land_log(_kafka_log(events), path)
    stream = parse.parse_kafka_messages(kafka.landed_log(spark, path, topic_pattern="event"))
    stamped = stream.withColumn("ts", F.col("published").cast("timestamp"))
    counts = report.windowed_counts(stamped, "6 hours", "topic", late="60 days")
    out = shared_dir(spark, "windows")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data")

    writer = counts.writeStream.outputMode("complete").foreachBatch(write)
    writer = writer.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()
    return spark.read.parquet(f"{out}/data").select(F.col("window_start").cast("string"), "topic", "n")


@query("events")
def closed_windows(spark, events):
    """Windows that closed, late rows and open windows of four batches add up to the counts of all events."""
    out = shared_dir(spark, "windows")
    kept = windows.ClosedWindows(out, "6 hours", "topic", 24 * 3600.0)
    stamped = _log(events).select("topic", "ts", F.expr("offset * 7 % 4").alias("run"))
    for run in range(4):
        kept.process(stamped.where(F.col("run") == run).drop("run"), run)
    totals = kept.totals(spark, 3)
    return totals.select(F.col("window_start").cast("string"), "topic", "n")


class ScriptedSink:
    """A sink that answers by event id and attempt, as the ``attempts`` view does.

    The event's id is the JSON payload's ``id``; attempts are counted inside the task,
    which holds all attempts of its events.
    """

    def open(self) -> None:
        self.tries: dict[int, int] = {}

    def send(self, method, url, headers, body, timeout):
        import json

        event_id = int(json.loads(body)["id"])
        n = self.tries[event_id] = self.tries.get(event_id, 0) + 1
        k = (event_id * 7 + n * 3) % 10
        if k == 0:
            raise ConnectionFailed("connection")
        if k == 1:
            raise TimeoutError("timeout")
        if k == 2:
            raise PayloadFailed("payload")
        if k == 3:
            return 500, "err"
        replies = {4: "OK", 5: "retry", 6: "retry", 7: "exponential_backoff_retry", 8: "exponential_backoff_retry"}
        return 200, replies.get(k, "something else")

    def close(self) -> None:
        self.tries = {}


def _no_sleep(seconds: float) -> None:
    pass


@query("events")
def deliver_events(spark, events):
    log = parse.parse_kafka_messages(_kafka_log(events))
    passes = filters.title_passes(F.col("title"), views.INCLUDE, views.EXCLUDE)
    rounds = delivery.delivery_rounds(log, passes, 2)
    out = shared_dir(spark, "delivered")
    sink = {"url": "http://example.invalid/"}
    deliver(rounds, sink, ScriptedSink(), sleep=_no_sleep).where("passes").write.parquet(out)
    return spark.read.parquet(out).select(
        "id", "status", "error", "attempts", F.round("total_delay", 6).alias("total_delay")
    )


@query("events")
def run_story(spark, events):
    path, out = shared_dir(spark, "log"), shared_dir(spark, "story")
    kafka.land_log(_kafka_log(events), path)
    stream = kafka.landed_log(spark, path, topics=["event-v2-t0", "event-v2-t1"])
    params = {
        "story_id": "s1",
        "sink": {"url": "http://example.invalid/"},
        "include": views.INCLUDE,
        "exclude": views.EXCLUDE,
    }
    running = story.run_story(
        stream, params, out, f"{out}/checkpoint", ScriptedSink(), {"availableNow": True}, sleep=_no_sleep
    )
    running.awaitTermination()
    dead = spark.read.parquet(f"{out}/dead_letters")
    return dead.select("topic", F.col("key").cast("string").alias("key"))


class RequestSink(ScriptedSink):
    """The same script for events of requests, whose ids are ``<event>-<place>``."""

    def send(self, method, url, headers, body, timeout):
        import json

        event, place = json.loads(body)["id"].split("-")
        return super().send(method, url, headers, json.dumps({"id": int(event) + int(place)}).encode(), timeout)


def _dispatched(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Events for the sinks that their requests name; a sink's number is its retry limit."""
    limit = F.substring("sink_id", 5, 1).cast("int")
    known = views.sinks_table(spark).withColumn("max_retry_times", limit)
    return routing.dispatch_to_sink(parse.parse_request_bodies(views.request_bodies(events)), known)


@query("events")
def sink_lanes(spark, events):
    """Rows and lanes of each sink: as many lanes as its rows ask for, within its limit."""
    laned = sinks.sink_lanes(_dispatched(spark, events), limit=F.substring("sink_id", 5, 1).cast("int") * 3, lane_rows=50)
    return laned.groupBy("sink_id").agg(
        F.count("*").alias("n"), F.countDistinct("lane").alias("lanes"), F.max("at_once").alias("at_once")
    )


@query("events")
def deliver_requests(spark, events):
    out = shared_dir(spark, "requests")
    sinks.send_requests(_dispatched(spark, events), out, RequestSink(), sleep=_no_sleep, lane_rows=200)
    return spark.read.parquet(f"{out}/results").select(
        "request_id", "pos", "id", "sink_id", "url", "status", "error_kind", "error", "attempts",
        F.round("total_delay", 6).alias("total_delay"),
    )


@query("events")
def handle_requests(spark, events):
    """The whole producer: answers to all requests."""
    out = shared_dir(spark, "producer")
    bodies = views.request_bodies(events).select("request_id", "body", "sink_id")

    def publish_records(routed: DataFrame) -> None:
        kafka.publish(routed, {"path": f"{out}/records"}, format="parquet")

    answers = producer.handle_requests(
        bodies, views.rules_table(spark), views.sinks_table(spark), out, publish_records, RequestSink(), sleep=_no_sleep
    )
    pairs = F.transform(F.map_entries("details"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return answers.withColumn("details", F.array_join(pairs, ";"))


class StorySink(ScriptedSink):
    """The same script for each sink on its own."""

    def send(self, method, url, headers, body, timeout):
        import json

        event_id = int(json.loads(body)["id"])
        n = self.tries[url, event_id] = self.tries.get((url, event_id), 0) + 1
        # The script counts by itself; it is told which attempt this is.
        self.tries[event_id] = n - 1
        return super().send(method, url, headers, body, timeout)


def _shared_stories(spark: SparkSession, events: DataFrame) -> fanout.SharedStories:
    """All stories on one read of the landed log."""
    path, out = shared_dir(spark, "log"), shared_dir(spark, "shared")
    kafka.land_log(_kafka_log(events), path)
    stories = views.stories_table(spark).withColumn("url", F.concat(F.lit("http://example.invalid/"), "story_id"))
    running = fanout.run_shared(
        kafka.landed_log(spark, path, topic_pattern="event"), lambda s, k: stories, out, f"{out}/checkpoint", StorySink(),
        {"availableNow": True}, sleep=_no_sleep, max_parallel=1,
    )
    running.awaitTermination()
    return fanout.SharedStories(spark, out)


@query("events")
def run_shared(spark, events):
    """Outcomes of all stories from one query."""
    results = _shared_stories(spark, events).results()
    return results.select("story_id", "id", "status", "error", "attempts")


@query("events")
def lifecycle_log(spark, events):
    """Stages of all stories' events, counted, as their results give them."""
    results = _shared_stories(spark, events).results()
    return report.lifecycle_log(results).groupBy("story_id", "status").agg(F.count("*").alias("n"))


@query("events")
def replay_events(spark, events):
    out = shared_dir(spark, "replayed")
    start, end = [F.lit(t).cast("timestamp") for t in (views.REPLAY_START, views.REPLAY_END)]
    sent = story.replay(
        _kafka_log(events), "http://example.invalid/", start, end, out, ScriptedSink(),
        headers=["Accept=application/json;version=1"], step=500, sleep=_no_sleep,
    )
    return report.replay_count(sent)


class _Shout:
    """Drops odd ids and upper-cases titles."""

    def init(self) -> None:
        self.seen = 0

    def run(self, event):
        self.seen += 1
        return {**event, "title": event["title"].upper()} if int(event["id"]) % 2 == 0 else None

    def close(self) -> None:
        self.seen = 0


@query("events")
def row_transform(spark, events):
    step = hooks.row_transform(_Shout)
    return filters.transform_chain(_log(events).select("id", "title"), [step])
