"""Kafka readers and writers, and the same log landed as files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroad import schema
from postroad.functions.match import topic_matches
from postroad.functions.text import merge_options
from postroad.operators.parse import to_kafka_records


def reader_options(
    topics: Sequence[str] | None = None,
    topic_pattern: str | None = None,
    options: Mapping[str, Any] | None = None,
) -> dict[str, Any]:
    """Options of Spark's Kafka source for a topic list or a topic pattern.

    A subscription pattern matches names from their start; Java matches whole names,
    so the pattern is widened.
    """
    if not topics and not topic_pattern:
        raise ValueError("topics or topic_pattern must be set")
    subscribe = (
        {"subscribe": ",".join(topics)} if topics else {"subscribePattern": f"(?:{topic_pattern}).*"}
    )
    defaults = {"startingOffsets": "latest", "maxOffsetsPerTrigger": schema.BATCH_MAX_RECORDS}
    return {**merge_options(defaults, options or {}), **subscribe}


def kafka_topics_source(
    spark: SparkSession, topics: Sequence[str], options: Mapping[str, Any]
) -> DataFrame:
    """Stream of a topic list. Offsets live in the query's checkpoint."""
    return spark.readStream.format("kafka").options(**reader_options(topics, None, options)).load()


def kafka_pattern_source(
    spark: SparkSession, topic_pattern: str, options: Mapping[str, Any]
) -> DataFrame:
    """Stream of all topics whose name matches a pattern."""
    given = reader_options(None, topic_pattern, options)
    return spark.readStream.format("kafka").options(**given).load()


def replay_options(topics: Sequence[str], start_ms: int, end_ms: int | None = None) -> dict[str, Any]:
    """Options of a bounded Kafka read by record time; both times are inclusive."""
    options = {
        "subscribe": ",".join(topics),
        "startingTimestamp": start_ms,
        "startingOffsetsByTimestampStrategy": "latest",
    }
    return options if end_ms is None else {**options, "endingTimestamp": end_ms + 1}


def landed_log(
    spark: SparkSession,
    path: str,
    topics: Sequence[str] | None = None,
    topic_pattern: str | None = None,
    streaming: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """A Kafka log landed as parquet with the Kafka source columns, by topics or pattern.

    The topic test reaches the scan; landing files partitioned by topic prunes folders.
    """
    if not topics and not topic_pattern:
        raise ValueError("topics or topic_pattern must be set")
    reader = (spark.readStream if streaming else spark.read).schema(schema.KAFKA_SOURCE)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    log = reader.parquet(path)
    if topics:
        return log.where(F.col("topic").isin(list(topics)))
    return log.where(topic_matches(F.col("topic"), topic_pattern))


def land_log(records: DataFrame, path: str) -> None:
    """Append records with the Kafka source columns to a landed log, by topic."""
    records.write.partitionBy("topic").mode("append").parquet(path)


def writer_options(options: Mapping[str, Any]) -> dict[str, Any]:
    """Options of Spark's Kafka sink: acknowledged by all replicas, idempotent."""
    defaults = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}
    return merge_options(defaults, options)


def publish(
    events: DataFrame,
    options: Mapping[str, Any],
    checkpoint: str | None = None,
    format: str = "kafka",
    trigger: Mapping[str, Any] | None = None,
):
    """Send routed events to their topics, at least once; events without a topic stay out.

    A stream gives its running query; a table is written at once. ``format`` may name a
    file format, with its ``path`` among the options, to land the records instead.
    """
    records = to_kafka_records(events.where(F.col("topic").isNotNull()))
    given = writer_options(options) if format == "kafka" else dict(options)
    if not events.isStreaming:
        return records.write.format(format).mode("append").options(**given).save()
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    writer = records.writeStream.format(format).options(**given)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
