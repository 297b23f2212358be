"""Many stories on one read of the log: a batch is read and parsed once, fanned out, and each story has its own outcome.

`run_stories` starts a query for each story, which reads the topic once for each. Here one query serves them all. A story whose sink
fails does not fail the batch: what it could not deliver stays in its backlog, in order, and goes out before its newer events in the
next batch. The other stories go on.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postroad import schema
from postroad.operators.delivery import dead_letter_records
from postroad.operators.lookup import lookup_join
from postroad.operators.parse import parse_kafka_messages, quarantine_messages
from postroad.operators.report import lifecycle_log, story_outcome_counts
from postroad.operators.routing import story_events
from postroad.streaming.deliver import RESULT_FIELDS, by_lane, http_transport, result_columns, send_until_settled, with_columns
from postroad.streaming.sinks import PARAMETERS, batch_parameters
from postroad.streaming.story import _is_written

LANE = ("story_id", "topic", "partition")
SENT_AT = T.StructField("sent_at", T.TimestampType())


def deliver_fanned(
    events: DataFrame,
    transport: Any = http_transport,
    lane: Sequence[str] = LANE,
    patience_s: float = 600.0,
    sleep: Callable[[float], None] = time.sleep,
    max_parallel: int = 64,
) -> DataFrame:
    """Send each row to its own sink, in offset order within a lane, and add the result columns and ``sent_at``.

    The lanes of a task are sent side by side. A lane has ``patience_s`` of sending; what is not settled by then is UNKNOWN,
    and so is all that follows in the lane, which is not sent. So a sink that is down costs the others at most that time.
    """
    # By offset and not by lane, so that a batch of rows holds all lanes of its task.
    dealt = by_lane(events, lane).sortWithinPartitions("offset", *lane)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        if hasattr(transport, "open"):
            transport.open()
        send = getattr(transport, "send", transport)
        spent: dict[tuple, float] = {}
        unsent = {"status": "UNKNOWN", "error": schema.SINK_CLOSED, "attempts": 0, "total_delay": 0.0, "log": []}

        def serve(name: tuple, places: list[int], sinks: list[dict], payloads: list[str], results: list[dict]) -> None:
            for place in places:
                left = patience_s - spent.get(name, 0.0)
                if left <= 0:
                    results[place] = {**unsent, "sent_at": datetime.now(timezone.utc)}
                    continue
                clock = time.monotonic()
                result = send_until_settled(send, sinks[place], payloads[place], clock + left, sleep)
                spent[name] = spent.get(name, 0.0) + time.monotonic() - clock
                if result["status"] == "UNKNOWN":
                    spent[name] = patience_s
                result["sent_at"] = datetime.now(timezone.utc)
                results[place] = result

        try:
            with ThreadPoolExecutor(max_parallel) as pool:
                for batch in batches:
                    lanes: dict[tuple, list[int]] = {}
                    for place, name in enumerate(zip(*(batch.column(c).to_pylist() for c in lane))):
                        lanes.setdefault(name, []).append(place)
                    sinks, payloads = batch_parameters(batch), batch.column("payload").to_pylist()
                    results: list[dict] = [{}] * batch.num_rows
                    jobs = [pool.submit(serve, name, places, sinks, payloads, results) for name, places in lanes.items()]
                    for job in jobs:
                        job.result()
                    sent_at = pa.array([r["sent_at"] for r in results], pa.timestamp("us", "UTC"))
                    yield with_columns(batch, {**result_columns(results), "sent_at": sent_at})
        finally:
            if hasattr(transport, "close"):
                transport.close()

    return dealt.mapInArrow(run, T.StructType([*events.schema.fields, *RESULT_FIELDS, SENT_AT]))


class SharedStories:
    """The tables of one shared query under ``out``. Tries of a batch are numbered; the first one is the batch itself."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out

    def path(self, table: str, batch_id: int, number: int = 0) -> str:
        return f"{self.out}/{table}/batch_id={batch_id}/try={number}"

    def once(self, path: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not _is_written(self.spark, path):
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def last_try(self, batch_id: int) -> int | None:
        number = None
        while _is_written(self.spark, self.path("backlog", batch_id, 0 if number is None else number + 1)):
            number = 0 if number is None else number + 1
        return number

    def backlog(self, batch_id: int) -> DataFrame | None:
        """What the stories still have to send after a batch."""
        number = self.last_try(batch_id) if batch_id >= 0 else None
        return None if number is None else self.spark.read.parquet(self.path("backlog", batch_id, number))

    def results(self) -> DataFrame:
        """All tries of all batches; an event has one settled row for each story, and perhaps UNKNOWN ones before."""
        return self.spark.read.parquet(f"{self.out}/results")


def _send(
    tables: SharedStories,
    fresh: DataFrame,
    before: DataFrame | None,
    stories: DataFrame,
    batch_id: int,
    number: int,
    transport: Any,
    write_dead_letters: Callable[[DataFrame, int], None] | None,
    **delivery: Any,
) -> DataFrame:
    """One try: the backlog before and fresh events, by the sinks that the stories have now. Returns the outcome counts."""
    params = stories.select("story_id", *(c for c in PARAMETERS if c in stories.columns))
    todo = fresh if before is None else before.unionByName(fresh)
    path = tables.path
    results = tables.once(
        path("results", batch_id, number), lambda: deliver_fanned(lookup_join(todo, params, ["story_id"], "inner"), transport, **delivery)
    )
    waiting = results.where("status = 'UNKNOWN'").select(*todo.columns)
    # A story that is not there now keeps what it has to send.
    absent = todo.join(params.select("story_id"), "story_id", "left_anti").select(*todo.columns)
    dead = tables.once(path("dead_letters", batch_id, number), lambda: dead_letter_records(results))
    tables.once(path("lifecycle", batch_id, number), lambda: lifecycle_log(results))
    if write_dead_letters is not None and not _is_written(tables.spark, path("handed", batch_id, number)):
        write_dead_letters(dead, batch_id)
        tables.spark.range(0).write.mode("overwrite").parquet(path("handed", batch_id, number))
    counts = tables.once(path("outcomes", batch_id, number), lambda: story_outcome_counts(results))
    tables.once(path("backlog", batch_id, number), lambda: waiting.unionByName(absent))
    return counts


def process_shared(
    records: DataFrame,
    batch_id: int,
    stories: DataFrame,
    out: str,
    transport: Any = http_transport,
    write_dead_letters: Callable[[DataFrame, int], None] | None = None,
    **delivery: Any,
) -> DataFrame:
    """One batch of Kafka-shaped records for all stories; see `run_shared`. Returns each story's outcome counts.

    Everything is written once and derived from what was written, so a batch that is run again goes on where it stopped.
    """
    tables = SharedStories(records.sparkSession, out)
    events = tables.once(tables.path("events", batch_id), lambda: parse_kafka_messages(records))
    tables.once(tables.path("quarantine", batch_id), lambda: quarantine_messages(records))

    def fanned() -> DataFrame:
        chosen = stories.select("story_id", "topics", "topic_pattern", "include", "exclude")
        return story_events(events, chosen).select("story_id", *events.columns)

    fresh = tables.once(tables.path("fanned", batch_id), fanned)
    return _send(tables, fresh, tables.backlog(batch_id - 1), stories, batch_id, 0, transport, write_dead_letters, **delivery)


def settle_backlog(
    spark: SparkSession,
    batch_id: int,
    stories: DataFrame,
    out: str,
    transport: Any = http_transport,
    write_dead_letters: Callable[[DataFrame, int], None] | None = None,
    **delivery: Any,
) -> bool:
    """Another try for what is left after the last batch; returns whether the backlog is empty then. Not while the query runs."""
    tables = SharedStories(spark, out)
    before = tables.backlog(batch_id)
    if before is None or before.isEmpty():
        return True
    number = tables.last_try(batch_id) + 1
    _send(tables, before.limit(0), before, stories, batch_id, number, transport, write_dead_letters, **delivery)
    return tables.backlog(batch_id).isEmpty()


def run_shared(
    stream: DataFrame,
    stories: Callable[[SparkSession, int], DataFrame],
    out: str,
    checkpoint: str,
    transport: Any = http_transport,
    trigger: dict[str, Any] | None = None,
    **options: Any,
) -> StreamingQuery:
    """Serve all stories from one stream with the Kafka source columns.

    ``stories`` gives the usable rows of `load_stories` for a batch. Under ``out`` each batch has its events, results,
    dead letters, lifecycle rows, outcome counts and the stories' backlog.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # parsed events and the quarantine come from one read of the source
        try:
            process_shared(batch, batch_id, stories(batch.sparkSession, batch_id), out, transport, **options)
        finally:
            batch.unpersist()

    writer = stream.writeStream.queryName("shared-stories").foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
