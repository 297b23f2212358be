"""Counts per time window of a stream: each window is given once, when it closes, and rows that come later are kept.

A watermark makes Spark drop what comes after it. Here the open windows are a table that each batch carries on, and a row of a
window that is closed goes to a side table; so closed windows, late rows and open windows together are the counts of all rows.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postroad.streaming.story import _is_written

BY = ("window_start", "window_end")


class ClosedWindows:
    """Tables under ``out``, one part for each batch: ``closed`` and ``late`` add up, ``open`` is replaced, ``mark`` holds the watermark.

    The watermark is the latest event time of all batches so far less ``late_s``. A window closes with the batch that moves the
    watermark to its end or beyond; a row is late if its window was closed before its batch.
    """

    def __init__(self, out: str, width: str, key: str, late_s: float, ts: str = "ts"):
        self.out, self.width, self.key, self.late_s, self.ts = out, width, key, late_s, ts

    def path(self, table: str, batch_id: int) -> str:
        return f"{self.out}/{table}/batch_id={batch_id}"

    def _mark(self, spark: SparkSession, batch_id: int) -> int | None:
        """The watermark after a batch, in microseconds; None before any event time."""
        if batch_id < 0 or not _is_written(spark, self.path("mark", batch_id)):
            return None
        return spark.read.schema("watermark long").parquet(self.path("mark", batch_id)).first().watermark

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Take one batch in. Run again, it writes the same tables: all follow from the batch and the one before."""
        spark, key = batch.sparkSession, self.key
        if _is_written(spark, self.path("mark", batch_id)):
            return
        before = self._mark(spark, batch_id - 1)
        window = F.window(self.ts, self.width)
        timed = batch.withColumns({"window_start": window["start"], "window_end": window["end"], key: F.coalesce(F.col(key), F.lit("unknown"))})
        reached = lambda micros: F.unix_micros("window_end") <= F.lit(micros)
        late = timed.where(F.lit(False) if before is None else reached(before))
        late.write.mode("overwrite").parquet(self.path("late", batch_id))
        fresh = timed if before is None else timed.where(~reached(before))
        counts = fresh.groupBy(*BY, key).agg(F.count("*").alias("n"))
        if batch_id > 0 and _is_written(spark, self.path("open", batch_id - 1)):
            carried = spark.read.schema(counts.schema).parquet(self.path("open", batch_id - 1))
            counts = counts.unionByName(carried).groupBy(*BY, key).agg(F.sum("n").alias("n"))
        latest = batch.agg(F.max(F.unix_micros(self.ts)).alias("at")).first().at
        now = before if latest is None else max(x for x in (before, latest - int(self.late_s * 1e6)) if x is not None)
        is_closed = F.lit(False) if now is None else reached(now)
        counts.where(is_closed).write.mode("overwrite").parquet(self.path("closed", batch_id))
        counts.where(~is_closed).write.mode("overwrite").parquet(self.path("open", batch_id))
        spark.createDataFrame([(now,)], "watermark long").coalesce(1).write.mode("overwrite").parquet(self.path("mark", batch_id))

    def closed(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.out}/closed").drop("batch_id")

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.out}/late").drop("batch_id")

    def open(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.parquet(self.path("open", batch_id))

    def totals(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Counts of all rows up to a batch: closed windows, late rows and open windows."""
        late = self.late(spark).groupBy(*BY, self.key).agg(F.count("*").alias("n"))
        parts = self.closed(spark).unionByName(late).unionByName(self.open(spark, batch_id))
        return parts.groupBy(*BY, self.key).agg(F.sum("n").alias("n"))


def run_windows(stream: DataFrame, windows: ClosedWindows, checkpoint: str, trigger: dict[str, Any] | None = None) -> StreamingQuery:
    """Keep the windows of a stream; ``ts`` is a timestamp column."""
    writer = stream.writeStream.foreachBatch(windows.process).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
