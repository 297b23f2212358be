"""What a worker of the pipeline holds: after a task of the tokenizer, and of a batch."""

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from odd_rows import prose

from postroad.llm import piece_tokens


def test_a_worker_holds_its_memories_as_bytes_between_tasks(spark, monkeypatch):
    vocabulary = piece_tokens.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    caught = []
    kept = type(spark.range(1)).mapInArrow
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda self, function, schema, *more: caught.append(function) or kept(self, function, schema, *more))
    texts = [prose(k, 200) for k in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    rows = [r.asDict() for r in piece_tokens.encode(spark.createDataFrame(pa.Table.from_batches([batch])), vocabulary).collect()]
    encoder = piece_tokens._encoder(vocabulary)
    first = pa.Table.from_batches(caught[0](iter([batch])))
    assert not encoder.known and not encoder.older and not encoder.fits
    monkeypatch.setattr(piece_tokens.Encoder, "encode_segment", lambda self, segment: 1 / 0)  # nothing is forgotten
    again = pa.Table.from_batches(caught[0](iter([batch])))
    assert again == first and sorted(rows, key=lambda r: r["doc_id"]) == first.to_pylist()


def test_stages_of_the_pipeline_send_texts_in_small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "concat('text number ', id) as text")
    try:
        corpus_pipeline.near_duplicates(spark, docs, "")
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sum(r.n for r in sizes) == 3000 and max(r.n for r in sizes) <= 1000
