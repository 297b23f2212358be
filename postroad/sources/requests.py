"""Requests from a landing folder: a JSON body and perhaps the id of a sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroad import schema


def request_bodies_source(
    spark: SparkSession, path: str, format: str = "json", streaming: bool = True
) -> DataFrame:
    """``(request_id, body, sink_id)`` from parquet, JSON lines or text.

    As text, a file is one body and its path the request id.
    """
    reader = spark.readStream if streaming else spark.read
    if format == "text":
        files = reader.text(path, wholetext=True)
        return files.select(
            F.col("_metadata.file_path").alias("request_id"),
            F.col("value").alias("body"),
            F.lit(None).cast("string").alias("sink_id"),
        )
    if format not in ("json", "parquet"):
        raise ValueError(f"unsupported format: {format}")
    return reader.schema(schema.REQUEST).format(format).load(path)
