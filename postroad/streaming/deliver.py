"""Delivery of events to a sink through an injected transport.

A transport is a callable ``(method, url, headers, body, timeout) -> (status, text)``,
or an object with that method as ``send`` and optional ``open`` and ``close``, which
run once per task, and ``update_params``, which is given the sink's parameters after ``open``. It reports failures by the exceptions below.
"""

from __future__ import annotations

import heapq
import time
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad import schema
from postroad.operators.lookup import rows_within

#: Lanes that are dealt out by their sizes; more of them even out by hash.
MAX_LANES = 10_000


class ConnectionFailed(Exception):
    """No connection. Tried again without limit."""


class InvalidUrl(Exception):
    """Not a usable URL. Tried again without limit, as the sink may be corrected."""


class ResponseFailed(Exception):
    """The reply broke the protocol. Not tried again."""


class PayloadFailed(Exception):
    """The reply's data could not be read. Not tried again."""


# By class name: a worker may hold its own copy of these classes.
KINDS = {
    "ConnectionFailed": "connection",
    "InvalidUrl": "invalid_url",
    "TimeoutError": "timeout",
    "ResponseFailed": "response",
    "PayloadFailed": "payload",
}

RESULT_FIELDS = [
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempts", T.LongType()),
    T.StructField("total_delay", T.DoubleType()),
    T.StructField("log", T.ArrayType(schema.ATTEMPT)),
]

#: The same fields in Arrow.
RESULT_TYPES = {
    "status": pa.string(),
    "error": pa.string(),
    "attempts": pa.int64(),
    "total_delay": pa.float64(),
    "log": pa.list_(pa.struct([
        ("attempt", pa.int32()),
        ("http_status", pa.int32()),
        ("body", pa.string()),
        ("error_kind", pa.string()),
        ("error", pa.string()),
        ("duration_ms", pa.int64()),
    ])),
}


def with_columns(batch: pa.RecordBatch, more: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch with columns added; its own stay as they came."""
    fields = [*batch.schema, *(pa.field(name, column.type) for name, column in more.items())]
    return pa.RecordBatch.from_arrays([*batch.columns, *more.values()], schema=pa.schema(fields))


def result_columns(results: list[dict[str, Any]]) -> dict[str, pa.Array]:
    return {name: pa.array([r.get(name) for r in results], kind) for name, kind in RESULT_TYPES.items()}


def http_transport(
    method: str, url: str, headers: dict[str, str] | None, body: bytes, timeout: float
) -> tuple[int, str]:
    """Send over HTTP with the standard library."""
    import http.client
    import socket
    import urllib.error
    import urllib.request

    headers = dict(headers or {})
    if "content-type" not in map(str.lower, headers):
        headers["Content-Type"] = "application/json; charset=utf-8"
    try:
        request = urllib.request.Request(url, data=body, headers=headers, method=method)
    except ValueError as ex:
        raise InvalidUrl(str(ex)) from ex
    try:
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            charset = reply.headers.get_content_charset() or "utf-8"
            return reply.status, reply.read().decode(charset, "replace")
    except urllib.error.HTTPError as ex:
        with ex:
            return ex.code, ""
    except urllib.error.URLError as ex:
        if isinstance(ex.reason, (TimeoutError, socket.timeout)):
            raise TimeoutError(str(ex)) from ex
        raise ConnectionFailed(str(ex)) from ex
    except http.client.IncompleteRead as ex:
        raise PayloadFailed(str(ex)) from ex
    except http.client.InvalidURL as ex:
        raise InvalidUrl(str(ex)) from ex
    except http.client.RemoteDisconnected as ex:
        raise ConnectionFailed(str(ex)) from ex
    except http.client.HTTPException as ex:
        raise ResponseFailed(str(ex)) from ex
    except ConnectionError as ex:
        raise ConnectionFailed(str(ex)) from ex


def send_until_settled(
    send: Callable[..., tuple[int, str]],
    sink: dict[str, Any],
    payload: str,
    deadline: float,
    sleep: Callable[[float], None],
) -> dict[str, Any]:
    """Send one event until an attempt ends its delivery or the deadline (on the monotonic clock) passes.

    The rules are those of `classify_attempt`.
    """
    log: list[dict[str, Any]] = []
    waited = 0.0

    def settled(status: str, error: str | None) -> dict[str, Any]:
        return {
            "status": status,
            "error": error,
            "attempts": len(log),
            "total_delay": waited,
            "log": log,
        }

    while True:
        n = len(log) + 1
        record = dict(attempt=n, http_status=None, body=None, error_kind=None, error=None)
        clock = time.monotonic()
        try:
            record["http_status"], record["body"] = send(
                sink["method"], sink["url"], sink["headers"], payload.encode("utf-8"), sink["timeout"]
            )
        except Exception as ex:
            kinds = (KINDS.get(c.__name__) for c in type(ex).__mro__)
            record["error_kind"] = next((k for k in kinds if k), "other")
            record["error"] = str(ex) or record["error_kind"]
        record["duration_ms"] = int((time.monotonic() - clock) * 1000)
        log.append(record)

        wait = min(2.0 ** min(n - 1, 1000) * sink["exp_backoff_factor"], sink["exp_backoff_max_delay"])
        reply = (record["body"] or "").lower()
        if record["error_kind"] in ("response", "payload"):
            return settled("DEAD_LETTER", record["error"])
        if record["error_kind"] is None:
            if record["http_status"] != 200:
                return settled("DEAD_LETTER", f"Non-200 Status Code: {record['http_status']}")
            if reply == "ok":
                return settled("DONE", None)
            if reply not in ("retry", "exponential_backoff_retry"):
                return settled("DEAD_LETTER", f"Unexpected Response: {record['body']}")
            if n > sink["max_retry_times"]:
                return settled("DEAD_LETTER", schema.MAX_RETRIES)
            if reply == "retry":
                wait = 0.0
        if time.monotonic() + wait > deadline:
            return settled("UNKNOWN", schema.SINK_CLOSED)
        waited += wait
        sleep(wait)


def by_lane(events: DataFrame, lane: Sequence[str]) -> DataFrame:
    """The rows of each lane in one task, few lanes dealt out by size: the largest first, each to the task with the fewest rows.

    A hash alone puts two of a few large lanes into one task, which then takes twice as long as any other. The lanes are counted first.
    The number of tasks is fixed, since adaptive execution would merge partitions that wait on a sink.
    """
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows_within(events.groupBy(*lane).agg(F.count(F.lit(1)).alias("_n")), MAX_LANES)
    if not sizes:
        return events.repartition(tasks, *lane)
    load = [(0, task) for task in range(tasks)]
    placed = []
    for row in sorted(sizes, key=lambda r: -r["_n"]):
        n, task = heapq.heappop(load)
        placed.append((*(row[c] for c in lane), task))
        heapq.heappush(load, (n + row["_n"], task))
    fields = [*(events.schema[c] for c in lane), T.StructField("_task", T.IntegerType())]
    table = F.broadcast(events.sparkSession.createDataFrame(placed, T.StructType(fields)))
    # Lanes with a null key meet nothing, and share a task.
    return events.join(table, list(lane), "left").repartitionById(tasks, F.coalesce("_task", F.lit(0))).select(*events.columns)


def _rounds(sent: list[bool], values: list[Any] | None) -> Iterator[list[int]]:
    """Positions of the rows to send, in runs of one round; without rounds one by one."""
    places = [i for i, passes in enumerate(sent) if passes]
    if values is None:
        yield from ([i] for i in places)
        return
    yield from (list(run) for _, run in groupby(places, key=lambda i: values[i]))


def _by_step(batch: pa.RecordBatch, step: str | None) -> Iterator[tuple[Any, pa.RecordBatch]]:
    """The runs of rows of one step, with its number."""
    if step is None:
        yield None, batch
        return
    first = 0
    for number, run in groupby(batch.column(step).to_pylist()):
        n = sum(1 for _ in run)
        yield number, batch.slice(first, n)
        first += n


def deliver(
    events: DataFrame,
    sink: dict[str, Any],
    transport: Any = http_transport,
    ordered: bool = True,
    deadline_s: float = 3600.0,
    sleep: Callable[[float], None] = time.sleep,
    max_parallel: int = 32,
    step: str | None = None,
) -> DataFrame:
    """Send each event's payload and add ``status, error, attempts, total_delay, log``.

    ``ordered``: a (topic, partition) stays in one task and keeps its offset order,
    which the log's own ordering demands; with a ``round`` column (`delivery_rounds`)
    the events of a round go out together, so partitions that share a task do not wait
    for one another. Otherwise events are sent where they are, without a shuffle.
    ``deadline_s`` holds for a task as a whole. What is not settled by then is UNKNOWN, and
    so is all that follows in a partition with an UNKNOWN event: it is not sent, as order
    demands. Rows whose ``passes`` is false are carried along and not sent.
    ``step`` names a column of steps that a task sends one after the other, with ``deadline_s`` for each; after a step with
    an UNKNOWN event it sends no further one, and those events have no row in the result.

    The plan has side effects: write the result once and read it back.
    """
    params = {"method": "POST", "headers": None, **schema.SINK_DEFAULTS, **sink}
    if not params.get("url"):
        raise ValueError("sink needs a url")
    rounds = "round" if ordered and "round" in events.columns else None
    if ordered:
        lead = [c for c in (step, rounds) if c]
        events = by_lane(events, ["topic", "partition"]).sortWithinPartitions(*lead, "topic", "partition", "offset")
    elif step:
        events = events.sortWithinPartitions(step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        if hasattr(transport, "open"):
            transport.open()
        if hasattr(transport, "update_params"):
            transport.update_params(params)
        send = getattr(transport, "send", transport)

        deadline = time.monotonic() + deadline_s
        stopped: set[tuple[Any, Any]] = set()
        unsent = {"status": "UNKNOWN", "error": schema.SINK_CLOSED, "attempts": 0, "total_delay": 0.0, "log": []}

        def settle(payload: str) -> dict[str, Any]:
            return send_until_settled(send, params, payload, deadline, sleep)

        def sent(batch: pa.RecordBatch, pool: ThreadPoolExecutor) -> list[dict[str, Any]]:
            results: list[dict[str, Any]] = [{}] * batch.num_rows
            column = {c: batch.column(c).to_pylist() for c in ("payload", "topic", "partition", "passes", rounds) if c in batch.schema.names}
            payloads = column["payload"]
            lines = list(zip(column["topic"], column["partition"])) if ordered else [None] * len(results)
            for places in _rounds(column.get("passes", [True] * len(results)), column.get(rounds)):
                late = not ordered and time.monotonic() > deadline
                for i in places:
                    if late or lines[i] in stopped:
                        results[i] = unsent
                places = [i for i in places if results[i] is not unsent]
                todo = [payloads[i] for i in places]
                settle_all = map if len(todo) == 1 else pool.map
                for i, result in zip(places, settle_all(settle, todo)):
                    results[i] = result
                    if ordered and result["status"] == "UNKNOWN":
                        stopped.add(lines[i])
            return results

        at, unsettled = None, False
        try:
            with ThreadPoolExecutor(max_parallel) as pool:
                for batch in batches:
                    for number, part in _by_step(batch, step):
                        if number != at:
                            if unsettled:
                                continue
                            at, deadline = number, time.monotonic() + deadline_s
                        results = sent(part, pool)
                        unsettled = unsettled or any(r.get("status") == "UNKNOWN" for r in results)
                        yield with_columns(part, result_columns(results))
        finally:
            if hasattr(transport, "close"):
                transport.close()

    return events.mapInArrow(run, T.StructType(events.schema.fields + RESULT_FIELDS))
