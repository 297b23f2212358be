"""Joins of large event tables with smaller tables, by checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def rows_within(df: DataFrame, max_rows: int) -> list[Row] | None:
    """All rows of a control table, or None if there are more than ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Measure at most ``max_rows + 1`` rows of a table: few enough, and small enough?"""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    size = (
        df.limit(max_rows + 1)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes"))
        .first()
    )
    return size.n <= max_rows and size.bytes <= max_bytes


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] = (),
    salts: int = 64,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join a large table with a lookup table on ``on``.

    A table measured small is broadcast, so the facts do not move. A larger one is
    joined by shuffle on the key and a salt taken from ``spread_by``, so that a key
    with a large share of the facts is split over ``salts`` tasks.
    """
    if fits_broadcast(table, max_rows):
        return facts.join(F.broadcast(table), list(on), how)
    unhashable = (T.MapType, T.VariantType)
    plain = [f.name for f in facts.schema if not isinstance(f.dataType, unhashable)]
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*(spread_by or plain)), F.lit(salts)))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
