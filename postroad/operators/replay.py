"""Time-range replay of a partitioned log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postroad.operators.lookup import lookup_join, rows_within

PARTITION = ("topic", "partition")
MAX_SEEK_ROWS = 50_000  # partitions, not records


def seek_offsets(
    df: DataFrame, start: Column, end: Column | None = None, by: Sequence[str] = PARTITION
) -> DataFrame:
    """Per partition: ``lo``, the first offset at or after ``start``, and ``hi``, the
    first offset after ``end`` (null if none). Reads only rows from ``start`` on.
    """
    late = F.min(F.when(F.col("timestamp") > end, F.col("offset"))) if end is not None else F.lit(None)
    return (
        df.where(F.col("timestamp") >= start)
        .groupBy(*by)
        .agg(F.min("offset").alias("lo"), late.cast("long").alias("hi"))
    )


def replay_window(
    df: DataFrame, start: Column, end: Column | None = None, by: Sequence[str] = PARTITION
) -> DataFrame:
    """Records of each partition from ``lo`` up to, not including, ``hi``.

    Both times are inclusive. Selection is by offset: a record inside the range is kept
    even if its own time is out of order. A partition without a start gives nothing. The
    offsets are looked up first, by a job over topic, partition, offset and time alone.
    """
    bounds = seek_offsets(df, start, end, by)
    found = rows_within(bounds, MAX_SEEK_ROWS)
    in_reach = F.lit(True)
    if found is not None:
        if not found:
            return df.where(F.lit(False))
        bounds = df.sparkSession.createDataFrame(found, bounds.schema)
        # Literal limits reach the scan and prune files and row groups.
        in_reach = F.col("offset") >= min(r.lo for r in found)
        if all(r.hi is not None for r in found):
            in_reach &= F.col("offset") < max(r.hi for r in found)
    return (
        lookup_join(df.where(in_reach), bounds, by, "inner", spread_by=[*by, "offset"])
        .where((F.col("offset") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("offset") < F.col("hi"))))
        .select(*df.columns)
    )
