"""A story: one subscription, filtered, delivered, accounted for; and its replay."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postroad import schema
from postroad.functions.text import parse_headers
from postroad.operators.delivery import PARTITION, committable_offsets, dead_letter_records, delivery_rounds, offset_ledger
from postroad.operators.filters import Transform, indexed_passes, transform_chain
from postroad.operators.lookup import lookup_join
from postroad.operators.parse import parse_kafka_messages, quarantine_messages
from postroad.operators.replay import replay_window
from postroad.streaming.deliver import RESULT_FIELDS, deliver, http_transport


#: Offsets of each partition that the longest wave of a replay has, if its steps are shorter.
WAVE = 100_000


class DeliveryIncomplete(RuntimeError):
    """Some events have no outcome; the batch is to be run again."""


def _is_written(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def process_batch(
    records: DataFrame,
    batch_id: int,
    story: dict[str, Any],
    out: str,
    transport: Any = http_transport,
    transforms: Sequence[Transform] = (),
    write_dead_letters: Callable[[DataFrame, int], None] | None = None,
    **delivery: Any,
) -> None:
    """Deliver one batch of Kafka-shaped records and write its tables under ``out``.

    What transforms give is written before anything is sent, and every try writes its
    results, so that user code runs once and nothing is sent twice by a recomputation. A
    batch that is run again sends only the events without a final outcome. Everything else
    is derived from the results; dead letters are handed on once the whole batch is settled.
    ``story`` has ``story_id``, ``sink`` and perhaps ``include``, ``exclude``, ``concurrent``.
    """
    spark = records.sparkSession
    key = [*PARTITION, "offset"]
    results_path = f"{out}/results/batch_id={batch_id}"
    tries = f"{out}/tries/batch_id={batch_id}"

    include, exclude = story.get("include"), story.get("exclude")
    passes = indexed_passes(spark, F.col("title"), include, exclude) if include or exclude else F.lit(True)
    # Parsed and tested once; rounds, lanes and results read what was written.
    events_path = f"{out}/events/batch_id={batch_id}"
    tested = parse_kafka_messages(records).withColumn("_passes", passes)
    tested.write.mode("overwrite").parquet(events_path)
    events = spark.read.schema(tested.schema).parquet(events_path)
    passes = F.col("_passes")
    if transforms:
        kept_path = f"{out}/transformed/batch_id={batch_id}"
        if not _is_written(spark, kept_path):
            transform_chain(events.where(passes).drop("_passes"), transforms).write.mode("overwrite").parquet(kept_path)
        kept = spark.read.parquet(kept_path)
        dropped = events.drop("_passes").join(kept, key, "left_anti")
        passes = F.col("_kept")
        events = kept.withColumn("_kept", F.lit(True)).unionByName(
            dropped.withColumn("_kept", F.lit(False)), allowMissingColumns=True
        )
    # Filtered events take part in offset accounting; they are not sent.
    rounds = delivery_rounds(events, passes, story.get("concurrent", 1)).drop("_passes")
    finished = deliver_unsettled(
        rounds, story["sink"], transport, tries, results_path, {"story_id": story["story_id"]}, **delivery
    )
    results = spark.read.parquet(results_path)

    def save(table: DataFrame, name: str) -> None:
        table.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")

    save(quarantine_messages(records), "quarantine")
    save(committable_offsets(results), "offsets")
    earlier = f"{out}/ledger/batch_id={batch_id - 1}"
    save(offset_ledger(results, spark.read.parquet(earlier) if _is_written(spark, earlier) else None), "ledger")
    if not finished:
        raise DeliveryIncomplete(f"story {story['story_id']}, batch {batch_id}")
    dead_path = f"{out}/dead_letters/batch_id={batch_id}"
    if not _is_written(spark, dead_path):
        save(dead_letter_records(results), "dead_letters")
    if write_dead_letters is not None and not _is_written(spark, f"{tries}/handed"):
        write_dead_letters(spark.read.parquet(dead_path), batch_id)
        spark.range(0).write.mode("overwrite").parquet(f"{tries}/handed")


def deliver_unsettled(
    events: DataFrame,
    sink: dict[str, Any],
    transport: Any,
    tries: str,
    results_path: str,
    more: dict[str, str] | None = None,
    **delivery: Any,
) -> bool:
    """`settle` for the events of one sink, with the columns ``more`` in the results."""

    def send(todo: DataFrame) -> DataFrame:
        return deliver(todo, sink, transport, **delivery).withColumns({k: F.lit(v) for k, v in (more or {}).items()})

    return settle(events, [*PARTITION, "offset"], send, tries, results_path)


def settle(
    events: DataFrame,
    key: Sequence[str],
    send: Callable[[DataFrame], DataFrame],
    tries: str,
    results_path: str,
) -> bool:
    """Send the events that no earlier try has settled, and write one result for each event.

    Each try is a table under ``tries``; ``results_path`` is written from them all. Returns
    whether every event is settled now.
    """
    spark = events.sparkSession
    key = list(key)
    number = 0
    settled: DataFrame | None = None
    while _is_written(spark, f"{tries}/try={number}"):
        done = spark.read.parquet(f"{tries}/try={number}")
        done = done.where(F.coalesce("status", F.lit("DONE")) != "UNKNOWN")
        settled = done if settled is None else settled.unionByName(done)
        number += 1
    todo = events if settled is None else events.join(settled.select(*key), key, "left_anti")
    if settled is None or not todo.isEmpty():
        send(todo).write.mode("overwrite").parquet(f"{tries}/try={number}")
        sent = spark.read.parquet(f"{tries}/try={number}")
        whole = sent if settled is None else settled.unionByName(sent)
        whole.write.mode("overwrite").parquet(results_path)
    elif not _is_written(spark, results_path):
        settled.write.mode("overwrite").parquet(results_path)
    return spark.read.parquet(results_path).where(F.col("status") == "UNKNOWN").isEmpty()


def run_story(
    stream: DataFrame,
    story: dict[str, Any],
    out: str,
    checkpoint: str,
    transport: Any = http_transport,
    trigger: dict[str, Any] | None = None,
    sink_of: Callable[[SparkSession, int], dict[str, Any]] | None = None,
    **options: Any,
) -> StreamingQuery:
    """Start a story on a stream with the Kafka source columns; see `process_batch`.

    An incomplete batch fails the query before its offsets are committed; the next start
    delivers the batch again. ``sink_of`` gives the sink's parameters for each batch (`sink_at`), in place of the story's own:
    a change takes effect at the next batch, and a batch that is run again has the parameters that it had. A transport
    with ``update_params`` is told of them in each task before it sends.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # several tables are written from one read of the source
        try:
            fixed = {**story, "sink": sink_of(batch.sparkSession, batch_id)} if sink_of else story
            process_batch(batch, batch_id, fixed, out, transport, **options)
        finally:
            batch.unpersist()

    writer = (
        stream.writeStream.queryName(f"story-{story['story_id']}")
        .foreachBatch(process)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def story_params(row: Row) -> dict[str, Any]:
    """Parameters of `run_story` from a row of `load_stories`."""
    sink = {k: row[k] for k in ("url", "method", "headers", *schema.SINK_DEFAULTS)}
    return {"story_id": row.story_id, "sink": sink, "include": row.include, "exclude": row.exclude}


def run_stories(
    stories: DataFrame,
    open_stream: Callable[[Row], DataFrame],
    out: str,
    checkpoint: str,
    transport: Any = http_transport,
    trigger: dict[str, Any] | None = None,
    **options: Any,
) -> list[StreamingQuery]:
    """Start one query per usable story that is not disabled, each with its own tables, checkpoint and pool.

    ``open_stream`` gives the stream of a story's row: by its topics or its pattern.
    """
    context = stories.sparkSession.sparkContext
    running = []
    usable = F.col("error").isNull() & (F.col("status") == "NORMAL")
    for row in stories.where(usable).toLocalIterator():
        context.setLocalProperty("spark.scheduler.pool", f"story-{row.story_id}")
        running.append(run_story(
            open_stream(row), story_params(row), f"{out}/{row.story_id}",
            f"{checkpoint}/{row.story_id}", transport, trigger, **options,
        ))
    context.setLocalProperty("spark.scheduler.pool", None)
    return running


def wave_of(number: Column, step: int, longest: int = WAVE) -> Column:
    """The wave of a step: steps 0, 1, 2 to 3, 4 to 7 and so on, then runs of at most ``longest`` offsets."""
    doublings = max(1, longest // step).bit_length() - 1
    run = 1 << doublings
    growing = F.when(number == 0, 0).otherwise(F.length(F.bin(number)))
    return F.when(number < run, growing).otherwise(F.floor((number - run) / run) + (doublings + 1)).cast("long")


def replay(
    log: DataFrame,
    url: str,
    start: Column,
    end: Column | None,
    out: str,
    transport: Any = http_transport,
    headers: Sequence[str] | None = None,
    step: int = 100_000,
    window: Callable[[], DataFrame] | None = None,
    **delivery: Any,
) -> DataFrame:
    """Send a time range of a log to a sink; returns the written results.

    The range is first written under ``out`` in steps of ``step`` offsets of each partition,
    counted from the first one chosen there, and the steps are sent one after the other. They
    are sent in waves, a job for each: the first step, then waves as long as all before them, up
    to `WAVE` offsets, so short steps of a long range do not take a job each. Within a wave a
    partition's task goes through its steps in order, and stops after one with an event that has no outcome.
    A replay that is started again goes on after the last full wave and
    sends only what has no final outcome; with other arguments on the same folder it is
    refused. Failures stay in the results and are not dead-lettered. Unparsable records go to a
    quarantine table and the replay goes on. ``headers`` are ``k=v`` texts. ``window`` gives the range's records
    by a shorter way than `replay_window`, such as `replay_landed`.
    """
    spark = log.sparkSession
    by_step, by_wave = T.StructField("step", T.LongType()), T.StructField("wave", T.LongType())
    chosen_schema = T.StructType([*log.schema.fields, by_step, by_wave])
    sent_schema = T.StructType([*parse_kafka_messages(log).schema.fields, *RESULT_FIELDS, by_step])
    sink: dict[str, Any] = {"url": url}
    if headers:
        sink["headers"] = parse_headers(headers)
    asked = json.dumps([url, str(start), None if end is None else str(end), list(headers or []), step, WAVE])
    if _is_written(spark, f"{out}/asked"):
        before = spark.read.parquet(f"{out}/asked").first().asked
        if before != asked:
            raise ValueError(f"{out} holds a replay of other arguments: {before}")
    else:
        spark.createDataFrame([(asked,)], "asked string").write.mode("overwrite").parquet(f"{out}/asked")
    chosen_path = f"{out}/chosen"
    if not _is_written(spark, chosen_path):
        chosen_records = window() if window else replay_window(log, start, end)
        first = chosen_records.groupBy(*PARTITION).agg(F.min("offset").alias("_first"))
        numbered = lookup_join(chosen_records, first, PARTITION, "inner", ["offset"])
        numbered = numbered.withColumn("step", F.expr(f"(`offset` - _first) div {step}")).withColumn("wave", wave_of(F.col("step"), step))
        chosen = numbered.select(*chosen_schema.fieldNames()).repartition("wave", *PARTITION)
        chosen.write.partitionBy("wave").mode("overwrite").parquet(chosen_path)
    chosen = spark.read.schema(chosen_schema).parquet(chosen_path)
    quarantine_messages(chosen.drop("wave")).write.mode("overwrite").parquet(f"{out}/quarantine")
    any_sent = False
    for (number,) in chosen.select("wave").distinct().orderBy("wave").toLocalIterator():
        events = parse_kafka_messages(chosen.where(F.col("wave") == number).drop("wave"))
        paths = f"{out}/tries/wave={number}", f"{out}/results/wave={number}"
        any_sent = True
        if not deliver_unsettled(events, sink, transport, *paths, step="step", **delivery):
            break  # later records of a partition must not pass earlier ones
    if not any_sent:
        return spark.createDataFrame([], sent_schema)
    return spark.read.schema(sent_schema).parquet(f"{out}/results").select(*sent_schema.fieldNames())
