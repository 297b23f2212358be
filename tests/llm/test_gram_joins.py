"""N-gram tables that are not sent to the tasks: what moves, and what the driver holds."""

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import prose
from pyspark.sql import functions as F

from postroad.llm import grams, perplexity
from postroad.llm.arrays import chunks, distinct, framed, gram_keys


def documents(spark, texts):
    """The texts with ids, and a table of all their n-grams."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    every = distinct(np.concatenate([gram_keys(*framed(data, offsets), 5) for _, data, offsets in chunks(batch, 0)]))[0]
    table = spark.createDataFrame(pa.table({"gram": every.view(np.int64), "value": np.sqrt(np.arange(len(every)))}))
    return spark.createDataFrame([(k // 2, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3), table


def nodes(plan):
    """All nodes of a plan that has run."""
    yield plan
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        yield from nodes(plan.executedPlan())
    elif name.endswith("QueryStage"):
        yield from nodes(plan.plan())
    for k in range(plan.children().size()):
        yield from nodes(plan.children().apply(k))


def test_texts_and_their_ngrams_move_once(spark):
    texts = [prose(k, 400) for k in range(1200)]
    df, table = documents(spark, texts)
    found = grams.joined(df, table, 5, "text", ("doc_id", "text"), "value", part=800_000)
    rows = found.collect()
    at = [x for x in nodes(found._jdf.queryExecution().executedPlan()) if x.nodeName() == "Exchange"]
    assert sum(x.metrics().apply("shuffleBytesWritten").value() for x in at) < sum(map(len, texts))
    whole = grams.scored(df, table, 5, keep=("doc_id", "text"), sent=10**9).collect()
    assert sorted(rows) == sorted(whole) and len(rows) == 1200


def test_odd_texts_have_the_same_totals(spark):
    df, table = documents(spark, ["", "a", "a", "", "é" * 300, prose(1, 50), prose(1, 50), "x"])
    df = df.union(spark.createDataFrame([(None, None), (None, None), (1, None)], df.schema))
    key = lambda r: tuple(str(x) for x in r)
    for part in (10, 10**9):
        some = grams.joined(df, table, 5, "text", ("doc_id",), "value", part=part).collect()
        assert sorted(some, key=key) == sorted(grams.scored(df, table, 5, sent=10**9).collect(), key=key)
    none = df.where("false")
    assert grams.joined(none, table, 5, "text", ("doc_id",), "value").count() == 0
    with pytest.raises(Exception, match="no value for an n-gram"):
        grams.joined(df, table.where("value > 3"), 5, "text", ("doc_id",), "value").collect()


def test_the_driver_holds_no_table_of_more_than_a_million(spark, monkeypatch):
    df, table = documents(spark, [prose(1, 50)])
    table = table.union(spark.range(1_500_000).select((-F.col("id") - 1).alias("gram"), F.lit(0.0).alias("value")))
    kept = type(df).toArrow
    monkeypatch.setattr(type(df), "toArrow", lambda self: kept(self) if self.columns == ["at", "id"] else pytest.fail("the table goes to the driver"))
    assert grams.scored(df, table, 5).count() == 1


def test_trusted_ids_go_to_the_tasks_as_numbers(spark):
    docs = spark.createDataFrame([(1, "aa"), (2, "bb"), (2, "cc"), (None, "dd"), (7, None), (0, "ee"), (-3, "ff")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1, 0), (7, 1, 0), (-3, 1, None), (1, 0, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    of = lambda found: sorted((r.gram, r.value) for r in found.collect())
    numbers = perplexity.fitted(docs, labels, order=2)
    texts = perplexity.fitted(docs.withColumn("doc_id", F.col("doc_id").cast("string")), labels.withColumn("doc_id", F.col("doc_id").cast("string")), order=2)
    assert of(numbers) == of(texts) and len(of(numbers)) == 19
    assert of(perplexity.fitted(docs, labels.where("quality = 0"), order=2)) != of(numbers)
    caught = []
    kept = grams.counts
    try:
        grams.counts = lambda df, *more, **options: caught.append(df) or kept(df, *more, **options)
        perplexity.fitted(docs, labels, order=2)
    finally:
        grams.counts = kept
    assert not [x for x in nodes(caught[0]._jdf.queryExecution().executedPlan()) if "Join" in x.nodeName()]
