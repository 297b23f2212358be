"""A time index of a landed log: what each file holds of each partition, so that a replay opens few files.

The index is a table in ``<log>/_index``, which readers of the log pass over. It has a row for each file and (topic, partition):
the number of records, their least and greatest offset and time. It is kept as files land (`land_indexed`), and `index_log` adds
whatever files it lacks, so a job that died between landing and indexing does no harm.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postroad import schema
from postroad.functions.match import topic_matches
from postroad.operators.lookup import lookup_join
from postroad.operators.replay import PARTITION
from postroad.sources.kafka import land_log

INDEX = "file string, topic string, partition int, n long, first long, last long, since timestamp, until timestamp"


def _files_of(spark: SparkSession, path: str) -> list[str]:
    """Names of the log's files, as the reader lists them."""
    return spark.read.schema(schema.KAFKA_SOURCE).parquet(path).inputFiles()


def _read(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame:
    """Some files of a log; topics come from their folders."""
    if not files:
        return spark.createDataFrame([], schema.KAFKA_SOURCE)
    return spark.read.schema(schema.KAFKA_SOURCE).option("basePath", path).parquet(*files)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index as it is; empty for a log that was never indexed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_index")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], INDEX)
    # A file that two jobs indexed at once has two equal rows.
    return spark.read.schema(INDEX).parquet(f"{path}/_index").distinct()


def index_log(spark: SparkSession, path: str) -> int:
    """Index the files that are not in the index yet; returns how many. Reads three columns of those files alone."""
    known = {r.file for r in read_index(spark, path).select("file").distinct().toLocalIterator()}
    new = [f for f in _files_of(spark, path) if f not in known]
    if new:
        rows = _read(spark, path, new).withColumn("file", F.input_file_name())
        entries = rows.groupBy("file", *PARTITION).agg(
            F.count("*").alias("n"), F.min("offset").alias("first"), F.max("offset").alias("last"),
            F.min("timestamp").alias("since"), F.max("timestamp").alias("until"),
        )
        entries.write.mode("append").parquet(f"{path}/_index")
    return len(new)


def land_indexed(records: DataFrame, path: str) -> int:
    """`land_log`, and the new files' rows in the index."""
    land_log(records, path)
    return index_log(records.sparkSession, path)


@dataclass
class Seek:
    """Where a replay begins and ends: `bounds` as of `seek_offsets`, the files opened to find them, and the files to read."""

    bounds: DataFrame
    opened: list[str]
    files: list[str]


def _names(df: DataFrame) -> list[str]:
    return sorted(r.file for r in df.select("file").distinct().toLocalIterator())


def seek_landed(
    spark: SparkSession, path: str, start: Column, end: Column | None = None, chosen: Column | None = None
) -> Seek:
    """`seek_offsets` by the index. ``chosen`` is a test on the topic.

    A file that begins at or after ``start`` gives its least offset without being opened, and one that ends before gives nothing.
    A file across the bound is opened only if it begins below what the whole files give for that partition. The end is sought
    in the same way and in the same read.
    """
    index = read_index(spark, path)
    index = index if chosen is None else index.where(chosen)
    since, until = F.col("since"), F.col("until")

    def sought(whole: Column, part: Column, name: str) -> tuple[DataFrame, DataFrame]:
        """The least offset of whole files by partition, and the rows of files that may have a lesser one."""
        least = index.where(whole).groupBy(*PARTITION).agg(F.min("first").alias(name))
        across = lookup_join(index.where(part), least, PARTITION)
        return least, across.where(F.col(name).isNull() | (F.col("first") < F.col(name)))

    least_lo, across = sought(since >= start, (since < start) & (until >= start), "whole_lo")
    late = F.lit(False) if end is None else (F.col("timestamp") >= start) & (F.col("timestamp") > end)
    least_hi = None
    if end is not None:
        beyond = F.greatest(start, end)
        after = (since > end) & (since >= start)
        least_hi, across_hi = sought(after, ~after & (until > end) & (until >= start) & (since <= beyond), "whole_hi")
        across = across.select("file", *PARTITION).union(across_hi.select("file", *PARTITION))
    opened = _names(across)
    rows = _read(spark, path, opened)
    rows = rows if chosen is None else rows.where(chosen)
    inside = rows.groupBy(*PARTITION).agg(
        F.min(F.when(F.col("timestamp") >= start, F.col("offset"))).alias("lo"), F.min(F.when(late, F.col("offset"))).alias("hi")
    )
    none = F.lit(None).cast("long")
    parts = inside.union(least_lo.select(*PARTITION, F.col("whole_lo"), none))
    if least_hi is not None:
        parts = parts.union(least_hi.select(*PARTITION, none, F.col("whole_hi")))
    bounds = parts.groupBy(*PARTITION).agg(F.min("lo").alias("lo"), F.min("hi").alias("hi")).where("lo is not null")
    bounds = spark.createDataFrame(bounds.collect(), bounds.schema)  # a row for each partition
    reached = lookup_join(index, bounds, PARTITION, "inner").where((F.col("last") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("first") < F.col("hi"))))
    return Seek(bounds, opened, _names(reached))


def replay_landed(
    spark: SparkSession,
    path: str,
    start: Column,
    end: Column | None = None,
    topics: Sequence[str] | None = None,
    topic_pattern: str | None = None,
) -> DataFrame:
    """The records of `replay_window` over a landed log, from the files that hold any of them."""
    chosen = None
    if topics:
        chosen = F.col("topic").isin(list(topics))
    elif topic_pattern:
        chosen = topic_matches(F.col("topic"), topic_pattern)
    found = seek_landed(spark, path, start, end, chosen)
    rows = _read(spark, path, found.files)
    joined = lookup_join(rows, found.bounds, PARTITION, "inner", spread_by=[*PARTITION, "offset"])
    kept = (F.col("offset") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("offset") < F.col("hi")))
    return joined.where(kept).select(*rows.columns)
