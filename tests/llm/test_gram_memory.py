"""What a task holds while it counts or looks up n-grams."""

import tracemalloc

import numpy as np
import pyarrow as pa
from odd_rows import prose

from postroad.llm import grams
from postroad.llm.arrays import chunks, distinct, framed, gram_keys


def most(function, batch):
    """Results, and the most bytes that were held at once."""
    list(function(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    found = list(function(iter([batch])))
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return pa.Table.from_batches(found), held


def test_a_task_holds_few_bytes_for_a_large_batch(spark, monkeypatch):
    texts = [prose(k, 400) for k in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([k % 2 for k in range(len(texts))], pa.int32())], names=["text", "weight"])
    assert batch.column(0).nbytes > 3_000_000
    keys = gram_keys(*framed(*next(chunks(batch, 0, 1 << 30))[1:]), 5)
    every, times = distinct(keys)
    table = spark.createDataFrame(pa.table({"gram": every.view(np.int64), "value": np.arange(len(every), dtype=float)}))
    df = spark.createDataFrame(pa.table({"text": texts[:2], "weight": pa.array([1, 0], pa.int32())}))
    caught = []
    kept = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, function, schema, *more: caught.append(function) or kept(self, function, schema, *more))
    grams.counts(df, 5)
    grams.scored(df, table, 5, keep=("weight",))
    counted, held = most(caught[0], batch)
    assert held < 50_000_000
    assert sorted(set(counted.column("gram").to_numpy())) == sorted(every.view(np.int64))
    trusted = [t for k, t in enumerate(texts) if k % 2]
    assert sum(counted.column("n").to_numpy()) == sum(len(t.encode()) + 1 for t in trusted)
    one = pa.RecordBatch.from_arrays([batch.column(1), batch.column(0)], names=["weight", "text"])
    scored, held = most(caught[1], one)
    assert held < 50_000_000
    assert scored.column("n_bytes").to_pylist() == [len(t.encode()) + 1 for t in texts]
    assert sum(scored.column("total").to_numpy()) == float((np.arange(len(every)) * times).sum())
