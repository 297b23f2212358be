"""Delivery of events to the sinks that their own rows name.

Where `deliver` sends one topic's events to one sink in order, here every row carries its sink's parameters
(`dispatch_to_sink`), order does not matter, and what counts is that no sink gets more sends at once than
it allows while a sink with most of the rows still uses many tasks.
"""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad import schema
from postroad.operators.lookup import lookup_join
from postroad.streaming.deliver import RESULT_FIELDS, http_transport, result_columns, send_until_settled, with_columns

PER_SINK = 32  # sends at once to one sink
LANE_ROWS = 10_000
# The error kinds of a failed send, by how its last attempt went.
ERROR_KINDS = {"response": "ResponseFailed", "payload": "PayloadFailed"}
PARAMETERS = ("method", "url", "headers", *schema.SINK_DEFAULTS)
KEY = ("request_id", "pos")


def sink_lanes(
    events: DataFrame, limit: Column | int = PER_SINK, lane_rows: int = LANE_ROWS, key: Sequence[str] = KEY
) -> DataFrame:
    """Add ``lane`` and ``at_once``: the part of its sink's traffic a row belongs to, and sends at once there.

    A sink gets a lane for every ``lane_rows`` rows, and never more lanes than ``limit``, the sends at once that it
    allows: an integer or a column that is the same in all rows of a sink. Each lane is sent by one task, so lanes
    times ``at_once`` stays within the limit, however many tasks run.
    """
    most = F.greatest(limit if isinstance(limit, Column) else F.lit(limit), F.lit(1))
    sizes = events.groupBy("sink_id").agg(F.count(F.lit(1)).alias("_n"), F.min(most).alias("_most"))
    lanes = F.least(F.ceil(F.col("_n") / lane_rows).cast("int"), F.col("_most").cast("int"))
    sizes = sizes.select("sink_id", lanes.alias("_lanes"), F.expr("cast(_most as int)").alias("_most"))
    placed = lookup_join(events, sizes, ["sink_id"], "inner", list(key))
    return placed.withColumns({
        "lane": F.pmod(F.xxhash64(*key), F.col("_lanes")).cast("int"),
        "at_once": F.expr("_most div _lanes").cast("int"),
    }).drop("_lanes", "_most")


def _parameters(row: dict[str, Any]) -> dict[str, Any]:
    """A sink's parameters from a row; what it lacks has the default."""
    out = {"method": "POST", "headers": None, **schema.SINK_DEFAULTS}
    for name in PARAMETERS:
        value = row.get(name)
        if value is None or (isinstance(value, float) and value != value):
            continue
        out[name] = dict(value) if name == "headers" else value
    out["max_retry_times"] = int(out["max_retry_times"])
    return out


def batch_parameters(batch: pa.RecordBatch) -> list[dict[str, Any]]:
    """The sink's parameters of each row; equal ones are one and the same."""
    names = [c for c in PARAMETERS if c in batch.schema.names]
    known: dict[tuple, dict[str, Any]] = {}
    out = []
    for row in zip(*(batch.column(c).to_pylist() for c in names)) if names else [()] * batch.num_rows:
        key = tuple(tuple(v) if isinstance(v, list) else v for v in row)
        if key not in known:
            known[key] = _parameters(dict(zip(names, row)))
        out.append(known[key])
    return out


def deliver_each(
    events: DataFrame,
    transport: Any = http_transport,
    limit: Column | int = PER_SINK,
    lane_rows: int = LANE_ROWS,
    key: Sequence[str] = KEY,
    deadline_s: float = 3600.0,
    sleep: Callable[[float], None] = time.sleep,
    max_parallel: int = 64,
) -> DataFrame:
    """Send each row's payload to its own sink and add ``status, error_kind, error, attempts, total_delay, log``.

    Takes the output of `dispatch_to_sink`: rows with an ``error_kind`` are carried along and not sent. One exchange,
    by sink and lane (`sink_lanes`). A task serves the lanes it holds side by side, so a slow sink holds up its own rows;
    each lane gets a thread before any gets a second one. ``deadline_s`` and UNKNOWN are as in `deliver`.

    The plan has side effects: write the result once and read it back (`send_requests`).
    """
    columns = [c for c in events.columns if c not in ("error_kind", "error")]
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laned = sink_lanes(events.withColumnsRenamed({"error_kind": "_kind", "error": "_error"}), limit, lane_rows, key)
    # With a number, since adaptive execution would merge partitions that wait on a sink.
    laned = laned.repartition(tasks, "sink_id", "lane")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        if hasattr(transport, "open"):
            transport.open()
        send = getattr(transport, "send", transport)
        deadline = time.monotonic() + deadline_s
        unsent = {"status": "UNKNOWN", "error": schema.SINK_CLOSED, "attempts": 0, "total_delay": 0.0, "log": []}

        def serve(queue: list[int], params: list[dict], payloads: list[str], results: dict[int, dict]) -> None:
            while queue:
                try:
                    place = queue.pop()
                except IndexError:  # another thread of the lane took the last one
                    return
                late = time.monotonic() > deadline
                results[place] = unsent if late else send_until_settled(send, params[place], payloads[place], deadline, sleep)

        try:
            with ThreadPoolExecutor(max_parallel) as pool:
                for batch in batches:
                    own, ids, lanes, at_once, payloads = (batch.column(c).to_pylist() for c in ("_kind", "sink_id", "lane", "at_once", "payload"))
                    params = batch_parameters(batch)
                    queues: dict[tuple, list[int]] = defaultdict(list)
                    for place in reversed(range(batch.num_rows)):
                        if own[place] is None:
                            queues[ids[place], lanes[place]].append(place)
                    results: dict[int, dict] = {}
                    threads = [(min(at_once[q[0]], len(q), max_parallel), q) for q in queues.values()]
                    jobs = [
                        pool.submit(serve, queue, params, payloads, results)
                        for n in range(max((most for most, _ in threads), default=0))
                        for most, queue in threads
                        if n < most
                    ]
                    for job in jobs:
                        job.result()
                    yield _with_results(batch, results, columns)
        finally:
            if hasattr(transport, "close"):
                transport.close()

    kept = [f for f in events.schema.fields if f.name in columns]
    kind = T.StructField("error_kind", T.StringType())
    return laned.mapInArrow(run, T.StructType([*kept, kind, *RESULT_FIELDS]))


def _with_results(batch: pa.RecordBatch, results: dict[int, dict], columns: list[str]) -> pa.RecordBatch:
    """The rows with their results; rows that were refused keep their own error."""
    found = [results.get(place, {}) for place in range(batch.num_rows)]

    def kind(result: dict, own: str | None) -> str | None:
        if not result:
            return own
        if result["status"] == "DONE":
            return None
        last = result["log"][-1]["error_kind"] if result["log"] else None
        return ERROR_KINDS.get(last, "Exception")

    kinds = [kind(r, own) for r, own in zip(found, batch.column("_kind").to_pylist())]
    errors = [r.get("error") if r else own for r, own in zip(found, batch.column("_error").to_pylist())]
    more = {"error_kind": pa.array(kinds, pa.string()), **result_columns(found), "error": pa.array(errors, pa.string())}
    return with_columns(batch.select(columns), more)


def send_requests(
    dispatched: DataFrame, out: str, transport: Any = http_transport, key: Sequence[str] = KEY, **delivery: Any
) -> bool:
    """`deliver_each` with the results written under ``out``: each try sends only what no earlier one settled.

    Returns whether every row is settled; the results are in ``out/results``.
    """
    from postroad.streaming.story import settle

    def send(todo: DataFrame) -> DataFrame:
        return deliver_each(todo, transport, key=key, **delivery)

    return settle(dispatched, key, send, f"{out}/tries", f"{out}/results")
