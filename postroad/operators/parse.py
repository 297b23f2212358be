"""Parsing of request bodies and log records into events, with a quarantine."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain, combinations
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad import schema
from postroad.functions import json_scan
from postroad.functions.strict_json import (
    evaluate_once,
    field,
    is_json_string,
    root_kind,
    utf8_text,
    with_wrapped,
)

REQUIRED = ["id", "title", "published"]
RELATED = ["actor", "object", "target"]


def bad_fields(value: Column) -> Column:
    """Names of required fields that are absent or not JSON strings; ``""`` without any."""
    return F.concat_ws(
        ", ", *[F.when(~is_json_string(field(value, f"$.{f}")), F.lit(f)) for f in REQUIRED]
    )


def is_event(value: Column) -> Column:
    """True if all required fields are JSON strings."""
    return reduce(and_, [is_json_string(field(value, f"$.{f}")) for f in REQUIRED])


def validate_envelope(df: DataFrame, value: str, out: str = "bad_fields") -> DataFrame:
    """Add the names of the required fields that are missing or of a wrong type."""
    return df.withColumn(out, bad_fields(F.col(value)))


def extra_map(value: Column) -> Column:
    """``actor_id``, ``object_id``, ``target_id`` of nested objects that carry an ``id``.

    Null without any. An ``id`` that is not a string is kept as JSON text.
    """
    ids = {name: field(value, f"$.{name}.id") for name in RELATED}
    extra = F
    # One map per set of ids that may be there: no intermediate arrays.
    for size in range(len(RELATED), 0, -1):
        for names in combinations(RELATED, size):
            entries = [(F.lit(f"{name}_id"), field(ids[name], "$", "string")) for name in names]
            found = reduce(and_, [ids[name].isNotNull() for name in names])
            extra = extra.when(found, F.create_map(*chain.from_iterable(entries)))
    return extra


def extract_extra(df: DataFrame, value: str, out: str = "extra") -> DataFrame:
    return df.withColumn(out, extra_map(F.col(value)))


def flatten_extra(df: DataFrame) -> DataFrame:
    """Replace the ``extra`` map by three plain columns."""
    ids = {f"{name}_id": F.col("extra")[f"{name}_id"] for name in RELATED}
    return df.withColumns(ids).drop("extra")


@F.pandas_udf(T.StringType())
def _python_dumps(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import json

    def rewritten(text):
        try:
            return None if text is None else json.dumps(json.loads(text))
        except ValueError:  # a rejected text, if the plan gets here before the filter
            return None

    for batch in texts:
        yield batch.map(rewritten)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _python_dumps_each(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import json

    def texts(body):
        try:
            value = json.loads(body)
        except ValueError:  # a rejected body, if the plan gets here before the filter
            return None
        return [json.dumps(e) for e in (value if isinstance(value, list) else [value])]

    for batch in bodies:
        yield batch.map(texts)


def payload_text(text: Column, exact: bool = False) -> Column:
    """JSON text of an event.

    By default the received text as it stands: the same JSON value, with its own number
    formats and key order. ``exact`` writes it anew, with ``", "`` and ``": "`` as
    separators, ASCII escapes and no repeated keys, by an Arrow batch function.
    """
    return _python_dumps(text) if exact else text


def _envelope(value: Column, payload: Column) -> dict[str, Column]:
    return {
        **{f: field(value, f"$.{f}", "string") for f in REQUIRED},
        "payload": payload,
        "extra": extra_map(value),
    }


def _with_parsed(df: DataFrame, text: str, slices: bool = False) -> DataFrame:
    """Add ``_wrapped`` (`with_wrapped`), for texts of any depth and numbers of any length.

    The native parser refuses outsize texts; of these a scanner makes a small text with the same envelope. Only texts
    that were refused and are long enough reach it. ``slices`` adds ``_texts``, the received text of each element of a list.
    """
    outsize = F.col("_wrapped").isNull() & (F.octet_length(text) > json_scan.NATIVE_LIMIT)
    scanned = {"_small": json_scan.envelope_of(F.when(outsize, F.col(text)), tuple(REQUIRED), tuple(RELATED))}
    if slices:
        scanned["_texts"] = json_scan.elements_of(F.when(root_kind(F.col(text)) == "[", F.col(text)))
    staged = with_wrapped(df, F.col(text)).withColumns(scanned)
    both = with_wrapped(staged, F.col("_small"), "_wrapped_small")
    return both.withColumn("_wrapped", F.coalesce("_wrapped", "_wrapped_small")).drop("_small", "_wrapped_small")


def _examined_bodies(df: DataFrame, body: str) -> DataFrame:
    """Add ``_elements``, ``_texts``, ``_kind`` and ``error_kind`` of each body, without a shuffle."""
    wrapped = F.col("_wrapped")
    kind = root_kind(F.col(body))
    elements = F.when(kind == "[", field(wrapped, "$[0]", "array<variant>")).when(
        kind == "{", F.array(field(wrapped, "$[0]"))
    )
    staged = evaluate_once(
        _with_parsed(df, body, slices=True), _elements=F.when(wrapped.isNotNull(), elements), _kind=kind
    )
    error_kind = (
        F.when(wrapped.isNull(), "NOT_JSON")
        .when(F.col("_elements").isNull(), "NOT_AN_EVENT")
        .when(F.size("_elements") == 0, "EMPTY_BODY")
        .when(~F.forall("_elements", is_event), "BAD_ELEMENT")
    )
    return evaluate_once(staged, error_kind=error_kind).drop("_wrapped")


def parse_request_bodies(
    df: DataFrame, body: str = "body", exact_payload: bool = False
) -> DataFrame:
    """One row per event, with its place ``pos`` in the body.

    An object is one event, a list is its elements in order. Any fault rejects the
    whole body (see `quarantine_bodies`). The payload is the received text: the body of
    an object, an element's part of a list. ``exact_payload``: see `payload_text`.
    """
    keep = [c for c in df.columns if c != body]
    good = _examined_bodies(df, body).where(F.col("error_kind").isNull())
    received = F.when(F.col("_kind") == "{", F.array(F.col(body))).otherwise(F.col("_texts"))
    texts = good.withColumn("_texts", _python_dumps_each(F.col(body)) if exact_payload else received)
    pairs = texts.select(*keep, F.posexplode(F.arrays_zip("_elements", "_texts")).alias("pos", "_pair"))
    events = pairs.select("*", F.col("_pair._elements").alias("_event"))
    columns = _envelope(F.col("_event"), F.col("_pair._texts"))
    return events.select(*keep, "pos", *[c.alias(n) for n, c in columns.items()])


def examine_bodies(df: DataFrame, body: str = "body") -> DataFrame:
    """`parse_request_bodies` and `quarantine_bodies` in one table and one parse: one row per event, or per rejected body.

    A rejected body has ``error_kind`` and ``error``, and null in the event's columns. Write it once and take both sides from it.
    """
    keep = [c for c in df.columns if c != body]
    examined = evaluate_once(_examined_bodies(df, body), error=F.when(F.col("error_kind").isNotNull(), _body_error()))
    received = F.when(F.col("_kind") == "{", F.array(F.col(body))).otherwise(F.col("_texts"))
    good = F.when(F.col("error_kind").isNull(), F.arrays_zip("_elements", received.alias("_texts")))
    rows = examined.select(*keep, "error_kind", "error", good.alias("_pairs"))
    rows = rows.select(*keep, "error_kind", "error", F.posexplode_outer("_pairs").alias("pos", "_pair"))
    columns = _envelope(F.col("_pair._elements"), F.col("_pair._texts"))
    return rows.select(*keep, "pos", *[c.alias(n) for n, c in columns.items()], "error_kind", "error")


def _body_error() -> Column:
    """The text of a rejected body's error."""
    faults = F.filter(
        F.transform("_elements", lambda v, i: F.struct(i.alias("pos"), bad_fields(v).alias("bad"))),
        lambda e: e["bad"] != "",
    )
    first = F.get(faults, F.lit(0))
    kind = F.col("error_kind")
    return (
        F.when(kind == "NOT_JSON", schema.NOT_JSON)
        .when(kind == "NOT_AN_EVENT", schema.NOT_AN_EVENT)
        .when(kind == "EMPTY_BODY", schema.EMPTY_BODY)
        .otherwise(F.format_string("element %d: not a string: %s", first["pos"], first["bad"]))
    )


def quarantine_bodies(df: DataFrame, body: str = "body") -> DataFrame:
    """The bodies that `parse_request_bodies` rejects, with ``error_kind, error``."""
    return (
        _examined_bodies(df, body)
        .where(F.col("error_kind").isNotNull())
        .select(*df.columns, "error_kind", _body_error().alias("error"))
    )


def _examined_messages(df: DataFrame) -> DataFrame:
    """Add ``_text``, ``_key``, ``_value`` and ``error_kind`` of each record."""
    staged = evaluate_once(
        df, _text=utf8_text(F.col("value")), _key=utf8_text(F.col("key"))
    )
    parsed = _with_parsed(staged, "_text").withColumn("_value", field(F.col("_wrapped"), "$[0]")).drop("_wrapped")
    error_kind = (
        F.when(F.coalesce(F.octet_length("value"), F.lit(0)) == 0, "EMPTY_VALUE")
        .when(F.col("_value").isNull(), "NOT_JSON")
        .when(root_kind(F.col("_text")) != "{", "NOT_AN_EVENT")
        .when(~is_event(F.col("_value")), "BAD_EVENT")
        .when(F.col("key").isNotNull() & F.col("_key").isNull(), "BAD_KEY")
    )
    return evaluate_once(parsed, error_kind=error_kind)


def parse_kafka_messages(df: DataFrame, exact_payload: bool = False) -> DataFrame:
    """Records of a Kafka-shaped source as events; bad records are dropped.

    Columns other than key and value are carried along. ``exact_payload``: see
    `payload_text`.
    """
    keep = [c for c in df.columns if c not in ("key", "value")]
    columns = _envelope(F.col("_value"), payload_text(F.col("_text"), exact_payload))
    return (
        _examined_messages(df)
        .where(F.col("error_kind").isNull())
        .select(*[c.alias(n) for n, c in columns.items()], *keep, F.col("_key").alias("key"))
    )


def quarantine_messages(df: DataFrame) -> DataFrame:
    """The records that `parse_kafka_messages` drops, with ``error_kind, error``."""
    kind = F.col("error_kind")
    error = (
        F.when(kind == "EMPTY_VALUE", schema.EMPTY_VALUE)
        .when(kind == "NOT_JSON", schema.NOT_JSON)
        .when(kind == "NOT_AN_EVENT", schema.NOT_AN_EVENT)
        .when(kind == "BAD_KEY", "not a string: key")
        .otherwise(F.concat(F.lit("not a string: "), bad_fields(F.col("_value"))))
    )
    return (
        _examined_messages(df)
        .where(kind.isNotNull())
        .select(*df.columns, "error_kind", error.alias("error"))
    )


def event_summary(df: DataFrame, out: str = "summary") -> DataFrame:
    """Add the JSON of an event without its payload and without nulls."""
    names = ["id", "title", "published", "extra", "topic", "partition", "offset", "key"]
    return df.withColumn(out, F.to_json(F.struct(*[n for n in names if n in df.columns])))


def to_kafka_records(df: DataFrame) -> DataFrame:
    """``(topic, key, value)``: the event id and its payload as bytes."""
    return df.select(
        "topic", F.col("id").cast("binary").alias("key"), F.col("payload").cast("binary").alias("value")
    )
