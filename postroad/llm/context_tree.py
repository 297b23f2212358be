"""Language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions, most significant bit first. For each of the 255 places within a byte there is
a context tree: its nodes are the 0 to `depth` bytes before, and each holds how often a 0 and a 1 followed in the
training texts. A node's Krichevsky-Trofimov estimate and the product of its children's weighted probabilities are
mixed half and half, all the way up (at full depth the estimate stands alone). The weights that the training
texts leave at each node then mix the estimates along a path to the probability of the next bit. A text is coded
from the start mark to the end mark, so its probabilities add up over all texts; -log2 is its code length.

The counts come from a job over all texts that adds up n-grams of depth + 1 bytes. Trees are built by groups of
contexts that share their two nearest bytes, so a node of depth two or more lies within a group; the nodes above
(65,536 contexts at most, which bounds what the driver sees) are summed up from the groups. Each n-gram of the
corpus gets its log probability, and a second pass over the texts adds them up.

Beside it stands a base score of words: add-one unigram probabilities from the same training texts. Words that make
up at least one in `COMMON` of all are at most that many, and go to the tasks; the others are joined by shuffling.
Words are counted by 64-bit hashes.

Defined results: a null text counts as empty and has the end token only. A null id counts as a training document
and is not held out. Each row is scored by itself, repeated ids too. Without training texts all bits are equally
likely and the base score is that of zero counts. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from postroad.llm import grams
from postroad.llm.arrays import LOWER, NOT_SPACE, Table, Words, chunks, counted, distinct, framed, gram_keys
from postroad.llm.shared import written

DEPTH = 5
COMMON = 1 << 20
#: N-grams in a group of contexts, about.
GROUP = 200_000
_HALF = math.log(0.5)


def held_out(key: Column, parts: int = 7, part: int = 2) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def _estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """The log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    log = lambda x: np.fromiter(map(math.lgamma, x.tolist()), np.float64, len(x))
    return log(n0 + 0.5) + log(n1 + 0.5) - math.log(math.pi) - log(n0 + n1 + 1.0)


class Trees:
    """The nodes of depth `top` to `depth` under some n-grams; each leaf's line of ancestors is kept."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int, top: int = 2):
        byte, context = keys & np.uint64(255), keys >> np.uint64(8)
        ids, ones = [], []
        for k in range(8):
            place = np.uint64(1 << k) | (byte >> np.uint64(8 - k))
            ids.append(context << np.uint64(8) | place)
            ones.append((byte >> np.uint64(7 - k)) & np.uint64(1))
        self.ones = np.concatenate(ones).astype(bool)
        weight = np.tile(n.astype(np.float64), 8)
        ids, self.leaf = np.unique(np.concatenate(ids), return_inverse=True)
        size = len(ids)
        n0, n1 = (np.bincount(self.leaf, np.where(self.ones == bit, weight, 0), size) for bit in (False, True))
        self.leaves, estimate = ids, _estimate(n0, n1)
        weighted, line = estimate, np.arange(size)
        self.p = (n1 + 0.5) / (n0 + n1 + 1)
        own = []
        for d in range(depth - 1, top - 1, -1):
            up = (ids >> np.uint64(8) & np.uint64((1 << 8 * d) - 1)) << np.uint64(8) | ids & np.uint64(255)
            ids, parent = np.unique(up, return_inverse=True)
            n0, n1, below = (np.bincount(parent, x, len(ids)) for x in (n0, n1, weighted))
            estimate = _estimate(n0, n1)
            weighted = np.logaddexp(_HALF + estimate, _HALF + below)
            line = parent[line]
            own.append((line, np.exp(_HALF + estimate - weighted), (n1 + 0.5) / (n0 + n1 + 1)))
        self.ids, self.n0, self.n1, self.weighted = ids, n0, n1, weighted
        for line, weight, p in own:  # from the leaves upwards
            self.p = weight[line] * p[line] + (1 - weight[line]) * self.p

    def values(self, upper: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The log10 probability of each n-gram's byte; `upper` has (weight, p) of depth 1 by byte and place, and of depth 0 by place."""
        byte, place = (self.leaves >> np.uint64(8) & np.uint64(255)).astype(int), (self.leaves & np.uint64(255)).astype(int)
        p = self.p
        for (weight, own), at in zip(upper, ((byte, place), place), strict=True):
            p = weight[at] * own[at] + (1 - weight[at]) * p
        p = p[self.leaf]
        return np.log10(np.where(self.ones, p, 1 - p)).reshape(8, -1).sum(axis=0)


def model(counted_: DataFrame, depth: int = DEPTH, group: int = GROUP) -> DataFrame:
    """(gram, value) for every n-gram of `counted_` (gram, n), which is read three times."""
    groups = max(1, -(-counted_.count() // group))
    near = F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit(0xFFFF))
    grouped = counted_.withColumn("part", F.pmod(F.xxhash64(near), F.lit(groups))).groupBy("part")

    def columns(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return rows.column("gram").to_numpy().view(np.uint64), rows.column("n").to_numpy()

    def summed(rows: pa.Table) -> pa.Table:
        t = Trees(*columns(rows), depth)
        return pa.table({"at": (t.ids & np.uint64(0xFFFF)).astype(np.int32), "n0": t.n0, "n1": t.n1, "below": t.weighted})

    nodes = grouped.applyInArrow(summed, "at int, n0 double, n1 double, below double").groupBy("at").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "below")))
    found = nodes.orderBy("at").toArrow()  # one row for each byte and place at most
    at = found.column("at").to_numpy()
    n0, n1, below = (np.bincount(at, found.column(c).to_numpy(), 1 << 16) for c in ("n0", "n1", "below"))
    upper = []
    for _ in range(2):
        estimate = _estimate(n0, n1)
        weighted = np.logaddexp(_HALF + estimate, _HALF + below)
        upper.append((np.exp(_HALF + estimate - weighted).reshape(-1, 256), ((n1 + 0.5) / (n0 + n1 + 1)).reshape(-1, 256)))
        n0, n1, below = (x.reshape(-1, 256).sum(axis=0) for x in (n0, n1, weighted))
    upper[1] = (upper[1][0][0], upper[1][1][0])
    shared = counted_.sparkSession.sparkContext.broadcast(upper)

    def scored(rows: pa.Table) -> pa.Table:
        keys, n = columns(rows)
        return pa.table({"gram": keys.view(np.int64), "value": Trees(keys, n, depth).values(shared.value)})

    return grouped.applyInArrow(scored, "gram long, value double")


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the hash of each word, lower-cased, and its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def handed() -> pa.RecordBatch:
            keys, (n,) = counted(np.concatenate([k for k, _ in held]), [np.concatenate([c for _, c in held])])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["word", "n"])

        for batch in batches:
            for _, data, offsets in chunks(batch, 0):
                held.append(distinct(Words(LOWER[data], offsets, NOT_SPACE).hashes()))
                if sum(len(k) for k, _ in held) >= grams.GATHER:
                    yield handed()
        if held:
            yield handed()

    return df.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def score(df: DataFrame, text: str = "text", key: str = "doc_id", depth: int = DEPTH, common: int = COMMON, sent: int = grams.SENT) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), n_bytes and bits_per_byte."""
    named = df.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out(F.col(key)).alias("held_out"))
    table = written(model(written(grams.counts(named.select("text", (~F.col("held_out")).alias("weight")), depth + 1), "grams"), depth), "model")
    train = named.where(~F.col("held_out"))
    words = written(word_counts(train), "words")
    ends = train.count()
    total = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, v_all = (total.n or 0) + ends, total.v + (ends > 0)
    frequent = F.col("n") * F.lit(common) >= F.lit(total.n or 0)
    often = words.where(frequent).toArrow()  # at most `common` rows
    shared = df.sparkSession.sparkContext.broadcast((often.column("word").to_numpy().view(np.uint64), often.column("n").to_numpy().astype(np.float64)))
    of = math.log10(n_all + v_all + 1)
    end = math.log10(ends + 1) - of
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("word", T.LongType()), T.StructField("n", T.LongType()), T.StructField("doc", T.StructType([T.StructField("key", df.schema[key].dataType), *(T.StructField(c, k) for c, k in (("held_out", T.BooleanType()), ("n_bytes", T.LongType()), ("total", T.DoubleType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base", T.DoubleType())))]))])
    schema_doc = to_arrow_type(schema["doc"].dataType)
    held: list[Table] = []

    def parsed(ids: np.ndarray, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Table(*shared.value))
        frequent = held[0]
        words = Words(LOWER[data], offsets, NOT_SPACE)
        hashes = words.hashes()
        found = frequent.find(hashes)
        known = found >= 0
        logs = np.where(known, np.log10(frequent.values[found] + 1) - of, 0.0) if len(frequent.values) else np.zeros(len(words))
        base = np.bincount(words.row, logs, rows.num_rows) + end
        n_known = np.bincount(words.row[known], minlength=rows.num_rows) + (ends > 0)
        doc = pa.StructArray.from_arrays([*rows.columns, pa.array(words.count + 1), pa.array(n_known), pa.array(base)], names=["key", "held_out", "n_bytes", "total", "n_tokens", "n_known", "base"])
        # A row for the text; its word is its own number, so that these rows are dealt out evenly.
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array(np.zeros(len(ids), np.int64)), doc.cast(schema_doc)], names=["row", "word", "n", "doc"])
        rare, of_row = hashes[~known], ids[words.row[~known]]
        yield pa.RecordBatch.from_arrays([pa.array(of_row), pa.array(rare.view(np.int64)), pa.array(np.ones(len(rare), np.int64)), pa.nulls(len(rare), schema_doc)], names=["row", "word", "n", "doc"])

    if table.count() > sent:
        rows = grams.joined(named, table, depth + 1, "text", ("key", "held_out"), then=parsed, schema=schema)
    else:
        of_grams = table.toArrow()
        grams_sent = df.sparkSession.sparkContext.broadcast((of_grams.column("gram").to_numpy().view(np.uint64), of_grams.column("value").to_numpy()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            values = Table(*grams_sent.value)
            for batch in batches:
                for rows, data, offsets in chunks(batch, 3):
                    whole, at = framed(data, offsets)
                    total = np.add.reduceat(values.values[values.find(gram_keys(whole, at, depth + 1))], at[:-1])
                    scored = pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), pa.array(np.diff(at)), pa.array(total)], names=["key", "held_out", "n_bytes", "total"])
                    yield from parsed(rows.column(0).to_numpy(), scored, data, offsets)

        rows = named.select(F.monotonically_increasing_id().alias("row"), "key", "held_out", "text").mapInArrow(run, schema)
    parts = rows.join(words.where(~frequent).withColumnRenamed("n", "c"), "word", "left")
    log = F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - F.lit(of))
    summed = parts.groupBy("row").agg(F.max("doc").alias("doc"), F.sum(log).alias("rare"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    return summed.select(
        F.col("doc.key").alias(key), "doc.held_out", "doc.n_tokens", (F.col("doc.n_known") + F.col("rare_known")).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("doc.base") + F.col("rare")).alias("base_score"), F.col("doc.total").alias("score"), "doc.n_bytes", (-F.col("doc.total") / F.col("doc.n_bytes") / math.log10(2)).alias("bits_per_byte"),
    )
