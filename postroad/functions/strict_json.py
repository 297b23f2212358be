"""Strict JSON parsing with native expressions.

``try_parse_json`` ignores text after the first value. Parsing ``[<text>,"<hash of the
text>"]`` instead makes one parse enough: the array is the value and the hash, and nothing
else, only if the text is one complete JSON value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator.

    A plain projection lets the optimizer copy the expressions into later filters,
    which would parse each text twice; a generator output is not copied.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def with_wrapped(df: DataFrame, text: Column, out: str = "_wrapped") -> DataFrame:
    """Add ``out``, the parsed pair of a text and its mark; null if it is not one
    complete JSON value. The value itself is at ``$[0]``.
    """
    mark = F.hex(F.xxhash64(text))
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    parsed = evaluate_once(df, _parsed=pair, _mark=mark)
    complete = (field(F.col("_parsed"), "$[1]", "string") == F.col("_mark")) & field(
        F.col("_parsed"), "$[2]"
    ).isNull()
    return parsed.withColumn(out, F.when(complete, F.col("_parsed"))).drop("_parsed", "_mark")


def with_variant(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Add ``out``: the VARIANT of a strict JSON text, null if it is not one."""
    return with_wrapped(df, text).withColumn(out, field(F.col("_wrapped"), "$[0]")).drop("_wrapped")


def json_type(value: Column) -> Column:
    """Type name of a VARIANT: STRING, BIGINT, VOID (JSON null), OBJECT<..>, ..."""
    return F.schema_of_variant(value)


def is_json_string(value: Column) -> Column:
    """False for other types and for an absent value."""
    return F.coalesce(json_type(value) == "STRING", F.lit(False))


def field(value: Column, path: str, type_: str = "variant") -> Column:
    return F.try_variant_get(value, path, type_)


def root_kind(text: Column) -> Column:
    """First significant character of a JSON text: ``{`` object, ``[`` array."""
    return F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1)


def utf8_text(data: Column) -> Column:
    """Bytes as text; null if they are not valid UTF-8."""
    return F.try_validate_utf8(data.cast("string"))
