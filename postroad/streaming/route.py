"""Routing of a stream by rules that change while it runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from postroad.operators.routing import resolve_topic_table
from postroad.sources.control import current_rules, has_valid_rules
from postroad.streaming.control_state import ControlState


def route_stream(
    events: DataFrame,
    read_snapshots: Callable[[], DataFrame],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Resolve each micro-batch by the rules that are current when it starts.

    ``read_snapshots`` gives the rule documents ``(version, data)``; ``write`` takes the
    resolved batch and its id, and must be idempotent by id. Without any valid document
    the batch fails and keeps its offsets; a valid document without rules gives no topics.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        snapshots = read_snapshots()
        rules = current_rules(snapshots)
        empty = rules.isEmpty()
        if empty and not has_valid_rules(snapshots):
            raise ValueError("Topic mappings is empty")
        write(resolve_topic_table(batch, rules, allow_empty=empty), batch_id)

    writer = events.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def route_by_state(
    events: DataFrame,
    rules: ControlState,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """`route_stream` with rules kept as state (`rules_state`): a batch reads only documents that no batch has read before.

    A batch that is run again gets the rules that it had.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        current = rules.at(batch.sparkSession, batch_id)
        if current is None:
            raise ValueError("Topic mappings is empty")
        write(resolve_topic_table(batch, current, allow_empty=True), batch_id)

    writer = events.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
