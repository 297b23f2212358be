"""Byte n-grams of a corpus: counts in Spark, and scoring of every text by a table of n-gram values.

An n-gram is a byte and the n - 1 bytes before it, in one long (n is at most 8): the byte lowest, nearer bytes
below farther ones. Before a text stand bytes 255, and a byte 255 closes it; UTF-8 has no such byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad.llm.arrays import Table, chunks, counted, distinct, framed, gram_keys

#: Distinct n-grams that a task gathers before it hands them on.
GATHER = 2_000_000
#: A table of more n-grams than this (16 bytes each, 20 in memory) is joined and not sent to the tasks: the driver holds it some four times.
SENT = 1_000_000
#: Bytes of text that a task works on at once; counts and lookups hold some 100 bytes for each of them.
CHUNK = 250_000
#: Bytes of text in a part of the texts whose n-grams are looked up together, and that a task holds to deal them out to parts.
PART, PACK = 32_000_000, 16_000_000


def counts(df: DataFrame, n: int, text: str = "text", weight: str = "weight", ids: np.ndarray | None = None) -> DataFrame:
    """(gram, n): every n-gram of the texts, and how often it occurs in rows of weight 1; weight 0 rows add n-grams without counts.

    With `ids` (sorted numbers, sent to the tasks at 8 bytes each), rows of which the column `weight` is one of them are of weight 1. Each task adds up as it goes, so about as many rows are shuffled as there are distinct n-grams in a task.
    """

    shared = None if ids is None else df.sparkSession.sparkContext.broadcast(ids)

    def chosen(column: pa.Array) -> np.ndarray:
        if shared is None:
            return column.to_numpy(zero_copy_only=False) > 0
        asked, known = pc.fill_null(column, 0).to_numpy(), shared.value
        if not len(known):
            return np.zeros(len(asked), bool)
        return (known[np.minimum(np.searchsorted(known, asked), len(known) - 1)] == asked) & column.is_valid().to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = merged = 0

        def handed() -> pa.RecordBatch:
            keys, (sums,) = counted(np.concatenate([k for k, _ in held]), [np.concatenate([c for _, c in held])])
            held[:] = [(keys, sums)]
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sums)], names=["gram", "n"])

        for batch in batches:
            for rows, data, offsets in chunks(batch, 0, CHUNK):
                data, offsets = framed(data, offsets)
                keys = gram_keys(data, offsets, n)
                learned = np.repeat(chosen(rows.column(1)), np.diff(offsets))
                others, _ = distinct(keys[~learned])
                held += [distinct(keys[learned]), (others, np.zeros(len(others), np.int64))]
                size += len(held[-1][0]) + len(held[-2][0])
                # Added up whenever what came since is as much as what was there, or a quarter of GATHER.
                if size - merged >= max(merged, GATHER // 4):
                    batch_out = handed()
                    if batch_out.num_rows >= GATHER // 2:
                        yield batch_out
                        held.clear()
                    size = merged = sum(len(k) for k, _ in held)
        if held:
            yield handed()

    parts = df.select(text, F.col(weight).cast("int" if ids is None else "long")).mapInArrow(run, "gram long, n long")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def scored(df: DataFrame, table: DataFrame, n: int, text: str = "text", keep: tuple[str, ...] = ("doc_id",), sent: int = SENT, value: str = "value") -> DataFrame:
    """The kept columns, `n_bytes` (with the closing one) and `total`, the sum of the n-grams' values.

    `table` (gram, value) has a value for every n-gram of the texts. Up to `sent` n-grams go to the tasks as an array
    table; more are joined by shuffling with the n-grams of each part of the texts.
    """
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_bytes", T.LongType()), T.StructField("total", T.DoubleType())])
    if table.count() > sent:
        return joined(df, table, n, text, keep, value)
    columns = keep if text in keep else (*keep, text)
    rows = table.select("gram", F.col(value).cast("double").alias("value")).toArrow()
    shared = df.sparkSession.sparkContext.broadcast((rows.column("gram").to_numpy().view(np.uint64), rows.column("value").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = Table(*shared.value)
        for batch in batches:
            for rows, data, offsets in chunks(batch, columns.index(text), CHUNK):
                data, offsets = framed(data, offsets)
                found = values.find(gram_keys(data, offsets, n))
                total = np.add.reduceat(values.values[found], offsets[:-1])
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(keep)], pa.array(np.diff(offsets)), pa.array(total)], names=[*keep, "n_bytes", "total"])

    return df.select(*columns).mapInArrow(run, schema)


def joined(df: DataFrame, table: DataFrame, n: int, text: str, keep: tuple[str, ...], value: str = "value", part: int = PART, then: Callable | None = None, schema: T.StructType | None = None) -> DataFrame:
    """As `scored`, for a table of any size: the distinct n-grams of each part of the texts meet their values, and these the part.

    Rows are dealt to parts by a hash of all their columns, so a part holds the same rows whenever it is computed. The texts
    move once, compressed, and of the n-grams a row for each part that has them; nothing goes through the driver.

    `then` makes rows of `schema` of a batch in the same task: it gets a number for each row (the same in no other batch), the
    kept columns, n_bytes and total as a batch, and the bytes and offsets of the texts.
    """
    ways = max(1, -(-(df.agg(F.sum(F.octet_length(text))).first()[0] or 0) // part))
    labels = _labels(df.sparkSession, ways)
    hashed = F.xxhash64(*(F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind))
    columns = keep if text in keep else (*keep, text)
    place = columns.index(text)
    fields = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_bytes", T.LongType()), T.StructField("total", T.DoubleType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def handed() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            held.clear()
            rows = rows.take(np.argsort(rows.column(0).to_numpy(), kind="stable")).combine_chunks()
            own = labels[rows.column(0).to_numpy()]
            heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])).tolist()
            packed = [_packed(rows.slice(a, b - a).remove_column(0)) for a, b in zip(heads, [*heads[1:], len(own)], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(own[heads]), pa.array(packed, pa.binary())], names=["part", "texts"])

        for batch in batches:
            for rows, data, _ in chunks(batch, place + 1, PACK):
                held.append(rows)
                size += len(data)
                if size >= PACK:
                    yield handed()
                    size = 0
        if held:
            yield handed()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        merged: dict[int, int] = {}
        for batch in batches:
            for own, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys = held.setdefault(own, [])
                keys += [distinct(gram_keys(*framed(data, offsets), n))[0] for _, data, offsets in _unpacked(packed.as_buffer(), place)]
                if sum(map(len, keys)) - merged.get(own, 0) >= max(merged.get(own, 0), GATHER // 4):
                    keys[:] = [distinct(np.concatenate(keys))[0]]
                    merged[own] = len(keys[0])
        for own, keys in held.items():
            grams = distinct(np.concatenate(keys))[0]
            for first in range(0, len(grams), GATHER // 4):
                some = grams[first : first + GATHER // 4]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), own, np.int32)), pa.array(some.view(np.int64))], names=["part", "gram"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, packed = [], [], []
        row = 0
        for batch in batches:
            row = batch.column(0)[0].as_py() << 33
            texts = batch.column(3).is_valid()
            packed += batch.column(3).filter(texts).to_pylist()
            known = batch.filter(pc.invert(texts))
            keys.append(known.column(1).to_numpy())
            values.append(known.column(2).to_numpy())
        found_ = Table(np.concatenate(keys).view(np.uint64), np.concatenate(values))
        keys.clear()
        values.clear()
        for texts in sorted(packed):
            for rows, data, offsets in _unpacked(texts, place):
                whole, at = framed(data, offsets)
                found = found_.find(gram_keys(whole, at, n))
                if (found < 0).any():
                    raise ValueError("the table has no value for an n-gram of the texts")
                scored_ = pa.RecordBatch.from_arrays([*rows.columns[: len(keep)], pa.array(np.diff(at)), pa.array(np.add.reduceat(found_.values[found], at[:-1]))], names=fields.names)
                if then:
                    yield from then(np.arange(row, row + rows.num_rows), scored_, data, offsets)
                else:
                    yield scored_
                row += rows.num_rows
        pa.default_memory_pool().release_unused()

    parts = df.select(F.pmod(hashed, F.lit(ways)).cast("int").alias("_part"), *columns).mapInArrow(pack, "part int, texts binary").repartition(ways, "part")
    asked = parts.mapInArrow(ask, "part int, gram long")
    told = asked.join(table.select("gram", F.col(value).cast("double").alias("value")), "gram").repartition(ways, "part")
    # Both sides lie by part already, so Spark puts them together without a further exchange.
    met = told.select("part", "gram", "value", F.lit(None).cast("binary").alias("texts")).union(parts.select("part", F.lit(None).cast("long"), F.lit(None).cast("double"), "texts"))
    return met.groupBy("part").applyInArrow(add, schema or fields)


def _labels(spark: SparkSession, ways: int) -> np.ndarray:
    """Numbers for so many parts, of which each, where possible, goes to a partition of its own."""
    ids = spark.range(32 * ways).select(F.col("id").cast("int").alias("id"))
    found = ids.groupBy(F.pmod(F.hash("id"), F.lit(ways)).alias("at")).agg(F.min("id").alias("id")).toArrow()  # a row for each part
    labels = np.arange(32 * ways, 33 * ways, dtype=np.int32)
    labels[found.column("at").to_numpy()] = found.column("id").to_numpy()
    return labels


def _packed(rows: pa.Table) -> bytes:
    """Rows as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes | pa.Buffer, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """As `chunks` gives them."""
    for batch in pa.ipc.open_stream(packed):
        yield from chunks(batch, column, CHUNK)
