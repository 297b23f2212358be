"""Control tables as versioned state: what is current, and up to which document it was read.

Each micro-batch reads the documents that are newer than the last one it has seen, and folds them into the table it had.
So the read of a batch does not grow with the history. A batch keeps what it was run with: run again, also after a
restart, it gets the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroad import schema
from postroad.sources.control import current_rules, current_sinks, has_valid_rules

# Documents of a later version than the given one; all documents for None.
ReadSince = Callable[[SparkSession, int | None], DataFrame]
# The table before (None at first) and newer documents give the table now, or None if nothing changed.
Fold = Callable[[DataFrame | None, DataFrame], DataFrame | None]


class ControlState:
    """A table under ``path`` for each batch that changed it, and a mark for each batch.

    A mark is one row: the last version that was read, and the batch whose table is current. There is none before the first table.
    The folder belongs to one query, as its checkpoint does.
    """

    def __init__(self, path: str, read_since: ReadSince, fold: Fold):
        self.path, self.read_since, self.fold = path, read_since, fold

    def _exists(self, spark: SparkSession, path: str) -> bool:
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)

    def _mark(self, spark: SparkSession, batch_id: int) -> tuple[int | None, int | None] | None:
        path = f"{self.path}/marks/batch={batch_id}"
        if not self._exists(spark, path):
            return None
        row = spark.read.schema("upto long, held long").parquet(path).first()
        return row.upto, row.held

    def _before(self, spark: SparkSession, batch_id: int) -> tuple[int | None, int | None]:
        """The mark of the batch before, which nearly always is the one of the number before."""
        if batch_id == 0:
            return None, None
        mark = self._mark(spark, batch_id - 1)
        if mark is not None:
            return mark
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/marks")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
        earlier = sorted((int(n.split("=")[1]) for n in names if n.startswith("batch=")), reverse=True)
        found = (self._mark(spark, n) for n in earlier if n < batch_id)
        return next((m for m in found if m is not None), (None, None))

    def table(self, spark: SparkSession, held: int | None) -> DataFrame | None:
        return None if held is None else spark.read.parquet(f"{self.path}/tables/at={held}")

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The table that the batch is to be run with; None as long as no usable document was seen."""
        mark = self._mark(spark, batch_id)
        if mark is None:
            upto, held = self._before(spark, batch_id)
            newer = self.read_since(spark, upto)
            last = newer.agg(F.max("version").alias("v")).first().v
            if last is not None:
                now = self.fold(self.table(spark, held), newer.where(F.col("version") <= last))
                if now is not None:
                    now.write.mode("overwrite").parquet(f"{self.path}/tables/at={batch_id}")
                    held = batch_id
                upto = last
            if held is None:  # nothing to run with; the batch looks again when it is run again
                return None
            mark = upto, held
            row = spark.createDataFrame([mark], "upto long, held long").coalesce(1)
            row.write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}")
        return self.table(spark, mark[1])


def newer_than(snapshots: DataFrame, version: int | None) -> DataFrame:
    """Documents after a version; the limit is a literal, so it reaches a columnar scan and its statistics."""
    return snapshots if version is None else snapshots.where(F.col("version") > F.lit(version))


def rules_state(path: str, read_since: ReadSince) -> ControlState:
    """Rules (rank, topic, pattern): a newer valid document takes the place of them all, other documents change nothing."""

    def fold(before: DataFrame | None, newer: DataFrame) -> DataFrame | None:
        rules = current_rules(newer).select("rank", "topic", "pattern")
        if not rules.isEmpty():
            return rules
        return rules if has_valid_rules(newer) else None

    return ControlState(path, read_since, fold)


def sinks_state(path: str, read_since: ReadSince) -> ControlState:
    """Sinks by id: a newer usable entry takes the place of the sink's older one, a faulty one leaves it."""

    def fold(before: DataFrame | None, newer: DataFrame) -> DataFrame | None:
        entries = current_sinks(newer)
        if entries.isEmpty():
            return None
        if before is None:
            return entries
        return before.join(entries.select("sink_id"), "sink_id", "left_anti").unionByName(entries)

    return ControlState(path, read_since, fold)


def sink_at(state: ControlState, sink_id: str) -> Callable[[SparkSession, int], dict[str, Any]]:
    """The parameters of one sink for each batch, as `run_story` takes them."""

    def params(spark: SparkSession, batch_id: int) -> dict[str, Any]:
        table = state.at(spark, batch_id)
        row = None if table is None else table.where(F.col("sink_id") == sink_id).first()
        if row is None:
            raise ValueError(f"Sink '{sink_id}' not found.")
        return {k: row[k] for k in ("url", "method", "headers", *schema.SINK_DEFAULTS)}

    return params
