"""Tables written to the folder that the cluster shares, and joins with small tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of fewer bytes goes to every task; a larger one is joined by shuffling.
SMALL_BYTES = 32_000_000


def folder(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``. Only a local session may go without that setting."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        root = tempfile.mkdtemp(prefix="llm-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a table that lost executors do not take with them."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder."""
    folder(df.sparkSession, "checkpoint")  # sees to it that there is one
    return df.checkpoint()


def is_small(table: DataFrame, limit: int = SMALL_BYTES) -> bool:
    """Whether the rows, strings at full length, hold fewer bytes than `limit`. One aggregate."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in table.dtypes if kind in ("string", "binary")]
    size = F.lit(16 + 8 * len(table.columns))
    for t in texts:
        size = size + t
    return (table.agg(F.sum(size.cast("long"))).first()[0] or 0) < limit


def lookup(df: DataFrame, table: DataFrame, keys: list[str], salts: int = 32, limit: int = SMALL_BYTES) -> DataFrame:
    """Left join with a table of one row for each key; keys are not null.

    A small table is broadcast. A larger one is joined on the keys and a salt, so that the rows of a hot key are dealt to many tasks.
    """
    if is_small(table, limit):
        return df.join(F.broadcast(table), keys, "left")
    wide = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")).join(wide, [*keys, "_salt"], "left").drop("_salt")
