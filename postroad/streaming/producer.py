"""The producer's side in one function: requests come in, events go to topics or to the sinks they name, answers go out."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postroad.operators import report
from postroad.operators.parse import examine_bodies
from postroad.operators.routing import dispatch_to_sink, resolve_topic_table, unrouted_events
from postroad.streaming.deliver import http_transport
from postroad.streaming.sinks import send_requests
from postroad.streaming.story import DeliveryIncomplete, _is_written

ACK = ["request_id", "sink_id", "pos", "id", "error_kind", "error"]


def split_paths(events: DataFrame, rules: DataFrame, sinks: DataFrame, allow_empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parsed events by the path they take: with their topics, and with their sinks' parameters.

    A request that names a sink bypasses the topics, whether the sink is known or not.
    """
    to_topics = resolve_topic_table(events.where(F.col("sink_id").isNull()), rules, allow_empty=allow_empty)
    return to_topics, dispatch_to_sink(events, sinks)


def handle_requests(
    bodies: DataFrame,
    rules: DataFrame,
    sinks: DataFrame,
    out: str,
    publish_records: Callable[[DataFrame], None],
    transport: Any = http_transport,
    allow_empty: bool = False,
    **delivery: Any,
) -> DataFrame:
    """One batch of request bodies ``(request_id, body, sink_id)``: parse, route or send, answer. Returns the answers.

    Bodies are parsed once, into ``out/events``. Routed events are handed to ``publish_records`` once; events for sinks are
    sent as in `send_requests`, and only what is not settled is sent again when the batch is handled again. The results
    of both paths and the rejected bodies, one row an event, are in ``out/handled``, and `batch_ack` of them in
    ``out/answers``. Raises `DeliveryIncomplete` while a send has no outcome.
    """
    spark = bodies.sparkSession

    def once(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{out}/{name}"
        if not _is_written(spark, path):
            build().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    examined = once("events", lambda: examine_bodies(bodies))
    rejected = examined.where(F.col("error_kind").isNotNull())
    events = examined.where(F.col("error_kind").isNull()).drop("error_kind", "error")
    to_topics, to_sinks = split_paths(events, rules, sinks, allow_empty)
    routed = once("routed", lambda: to_topics)
    if not _is_written(spark, f"{out}/published"):
        publish_records(routed.where(F.col("topic").isNotNull()))
        spark.range(0).write.mode("overwrite").parquet(f"{out}/published")
    dispatched = once("dispatched", lambda: to_sinks)
    if not send_requests(dispatched, f"{out}/sinks", transport, **delivery):
        raise DeliveryIncomplete(f"requests in {out}")
    none = F.lit(None).cast("string")
    published = routed.where(F.col("topic").isNotNull()).withColumns({"error_kind": none, "error": none})
    results = published.select(*ACK).unionByName(unrouted_events(routed).select(*ACK))
    results = results.unionByName(spark.read.parquet(f"{out}/sinks/results").select(*ACK))
    refused = report.rejected_results(rejected).join(rejected.select("request_id", "sink_id"), "request_id")
    handled = once("handled", lambda: results.unionByName(refused.select(*ACK)))
    return once("answers", lambda: report.batch_ack(handled))


def run_producer(
    stream: DataFrame,
    read_rules: Callable[[SparkSession], DataFrame],
    read_sinks: Callable[[SparkSession], DataFrame],
    out: str,
    checkpoint: str,
    publish_records: Callable[[DataFrame], None],
    transport: Any = http_transport,
    trigger: dict[str, Any] | None = None,
    **delivery: Any,
) -> StreamingQuery:
    """`handle_requests` for each micro-batch, by the rules and sinks that are current when it starts.

    The tables of a batch are under ``out/batch_id=N``. A batch that is run again goes on where it stopped.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        handle_requests(batch, read_rules(spark), read_sinks(spark), f"{out}/batch_id={batch_id}", publish_records, transport, **delivery)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
