"""Schemas of the tables that flow between operators."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

EVENT = T.StructType([
    T.StructField("id", _S),
    T.StructField("title", _S),
    T.StructField("published", _S),
    T.StructField("payload", _S),
    T.StructField("extra", T.MapType(_S, _S)),
])

KAFKA_EVENT = T.StructType(EVENT.fields + [
    T.StructField("topic", _S),
    T.StructField("partition", _I),
    T.StructField("offset", _L),
    T.StructField("key", _S),
])

# The columns of Spark's Kafka source.
KAFKA_SOURCE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", _S),
    T.StructField("partition", _I),
    T.StructField("offset", _L),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", _I),
])

REQUEST = T.StructType([
    T.StructField("request_id", _S),
    T.StructField("body", _S),
    T.StructField("sink_id", _S),
])

RULE = T.StructType([
    T.StructField("rank", _I),
    T.StructField("topic", _S),
    T.StructField("pattern", _S),
])

ATTEMPT = T.StructType([
    T.StructField("attempt", _I),
    T.StructField("http_status", _I),
    T.StructField("body", _S),
    T.StructField("error_kind", _S),
    T.StructField("error", _S),
    T.StructField("duration_ms", _L),
])

# Delivery statuses and lifecycle statuses, in the order of the flow.
EVENT_STATUSES = ["DONE", "DEAD_LETTER", "UNKNOWN"]
LIFECYCLE = [
    "RECEIVED",
    "TO_KAFKA",
    "IN_KAFKA",
    "FROM_KAFKA",
    "TO_SINK",
    "RETRY_TO_SINK",
    "IN_SINK",
    "TO_DEAD_LETTER",
]
STORY_STATUSES = ["NORMAL", "DISABLED"]
HTTP_METHODS = ["POST", "PUT", "PATCH"]

# Sink and polling defaults.
SINK_DEFAULTS = {
    "timeout": 300.0,
    "max_retry_times": 3,
    "exp_backoff_factor": 0.1,
    "exp_backoff_max_delay": 60.0,
}
POLL_MAX_RECORDS = 100
POLL_TIMEOUT_MS = 1000

# Records per micro-batch, which takes the place of many polls.
BATCH_MAX_RECORDS = 100_000

# Messages of rejected records and requests.
EMPTY_VALUE = "Message value must not be empty."
NOT_JSON = "Request body must not an non-empty Json."
NOT_AN_EVENT = "Invalid format of the event"
EMPTY_BODY = "Invalid format of request body."
MAX_RETRIES = "Maximum Retries"
SINK_CLOSED = "HttpSink is closed"
