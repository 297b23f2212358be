"""SimHash near-duplicates: fingerprints, and links between all pairs within a Hamming distance.

Fingerprints. A text's words are runs without space characters, after lower-casing A-Z; its shingles are all
runs of `shingle` words joined by spaces, repeats included (fewer words: the whole sequence). A bit is set if it
is set in over half of the shingles' XXH64 values.

Pairs. Equal fingerprints are one node. For the others, two fingerprints that differ in at most `distance` bits
agree in full on at least `len(blocks) - distance` of the blocks that the 64 bits are cut into; so every linked
pair meets in a cell of some choice of that many blocks. In a cell the pivot table works: each fingerprint has
been measured against `PIVOTS` reference fingerprints once, when its bits are read, and a pair is discarded as
soon as one of these coordinates differs by more than `distance` (the triangle inequality: no link is lost).
Survivors are verified on the bits. A pivot table alone would have to look at every pair of the corpus.

A cell of more rows than `CELL` is dealt out as pairs of parts, so no task ever holds more than two parts; every
pair still meets. A cell gives the edges of a spanning forest of its links, so a group of n copies gives about n
edges, not n * n, and no link between different groups is lost.

Components. Edges are contracted by alternating large-star and small-star steps in Spark until nothing changes;
each step is checkpointed. Nothing is collected.

Defined results: null, empty and wordless texts have fingerprint zero, which links like any other. Repeated rows
give a row each. Null ids are kept, and are never the smallest unless a component has no other. An empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad.llm.arrays import LOWER, NOT_SPACE, Words, chunks, mixed
from postroad.llm.shared import checkpointed, written

SHINGLE = 4
DISTANCE = 4
CELL = 2048
PIVOTS = 32
#: Pairs looked at together, so that a task's memory stays small.
AT_ONCE = 1 << 20


def fingerprints(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shingle: int = SHINGLE, column: str = "bits") -> DataFrame:
    """The kept columns and the fingerprint as a long. One pass, no shuffle."""
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(column, T.LongType())])
    columns = keep if text in keep else (*keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for rows, data, offsets in chunks(batch, columns.index(text)):
                data = LOWER[data]
                words = Words(data, offsets, NOT_SPACE)
                sizes = words.end - words.start
                # All words in one run, a space after each: a shingle is a slice of it.
                at = np.concatenate([[0], np.cumsum(sizes + 1)])
                joined = np.full(int(at[-1]), 32, np.uint8)
                joined[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = data[NOT_SPACE[data]]
                line = joined.tobytes()
                shingles = np.where(words.count > 0, np.maximum(words.count - shingle + 1, 1), 0)
                begins = np.concatenate([[0], np.cumsum(shingles)])
                first = np.arange(int(begins[-1])) - np.repeat(begins[:-1] - words.first[:-1], shingles)
                last = np.minimum(first + shingle, np.repeat(words.first[1:], shingles))
                hashes = np.array([digest(line[a:b], 42) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)], np.uint64)
                out = np.zeros(rows.num_rows, np.uint64)
                full = np.flatnonzero(shingles)
                for bit in range(64) if len(full) else ():
                    ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), begins[full])
                    out[full] |= (2 * ones > shingles[full]).astype(np.uint64) << np.uint64(bit)
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(keep)], pa.array(out.view(np.int64))], names=[*keep, column])

    return df.select(*columns).mapInArrow(run, schema)


def blocks(n: int) -> list[int]:
    """Masks that cut 64 bits into n runs of nearly equal length."""
    ends = [64 * k // n for k in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:], strict=False)]


def masks(distance: int, parts: int) -> list[int]:
    if not 0 <= distance < parts <= 64:
        raise ValueError("there must be more blocks than differing bits")
    return [sum(choice) for choice in combinations(blocks(parts), parts - distance)]


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, fixed and spread out."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def edges(nodes: DataFrame, distance: int = DISTANCE, parts: int | None = None, column: str = "bits", cell: int = CELL, n_pivots: int = PIVOTS) -> DataFrame:
    """(low, high): spanning edges of the links between the distinct fingerprints of `nodes`.

    `parts` is how many blocks the bits are cut into: more of them make smaller cells, and more copies of the
    fingerprints. Two more than the distance give cells of 21 bits and 15 copies, right for up to some tens of
    millions of distinct fingerprints; for billions take 8 (32 bits, 70 copies).
    """
    parts = parts or distance + 2
    chosen = masks(distance, parts)
    signed = [m - (1 << 64) if m >> 63 else m for m in chosen]
    dealt = nodes.select(F.col(column).alias("bits"), F.explode(F.array(*(F.struct(F.lit(k).alias("band"), F.col(column).bitwiseAND(F.lit(m).cast("long")).alias("at")) for k, m in enumerate(signed)))).alias("x")).select("bits", "x.band", "x.at")
    # The few cells that are too large, and into how many parts each is dealt.
    large = dealt.groupBy("band", "at").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell).select("band", "at", F.ceil(F.col("n") * 1.25 / cell).cast("int").alias("ways"))
    mine = F.pmod(F.xxhash64("bits", F.lit(7)), F.col("ways")).cast("int")
    others = F.sequence(F.lit(0), F.col("ways") - 1)
    cells = dealt.join(large, ["band", "at"], "left").withColumn("ways", F.coalesce("ways", F.lit(1))).withColumn("mine", mine)
    cells = cells.withColumn("other", F.explode(others)).select("bits", "band", "at", "mine", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"))
    # A part of a pair's rows are compared with each other only in the cell (a, a).
    keys = ["band", "at", "a", "b"]
    refs = pivots(n_pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def ended(columns: list[np.ndarray]) -> pa.RecordBatch:
            low, high = _cell_edges(columns, refs, distance)
            return pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.view(np.int64))], names=["low", "high"])

        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
            if not len(columns[0]):
                continue
            # The last cell may go on in the next batch.
            same = np.logical_and.reduce([c == c[-1] for c in columns[2:]])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield ended([c[:cut] for c in columns])
            rest = [c[cut:].copy() for c in columns]
        if rest is not None and len(rest[0]):
            yield ended(rest)

    sorted_ = cells.select("bits", "mine", *keys).repartition(*keys).sortWithinPartitions(*keys)
    return sorted_.mapInArrow(run, "low long, high long").distinct()


def _cell_edges(columns: list[np.ndarray], refs: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges within each cell; rows come sorted by cell."""
    bits, mine = columns[0].view(np.uint64), columns[1]
    heads = np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns[2:]])])
    group = np.cumsum(heads) - 1
    sizes = np.bincount(group)
    single = sizes[group] < 2
    keep = np.flatnonzero(~single)
    bits, mine, group = bits[keep], mine[keep], group[keep]
    if not len(bits):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    crossed = (columns[4] != columns[5])[keep]
    sizes = np.bincount(group)[group]
    begin = np.searchsorted(group, group)
    room = sizes - (np.arange(len(bits)) - begin) - 1  # rows of the cell after this one
    table = np.bitwise_count(bits[:, None] ^ refs[None, :]).astype(np.int8)
    parent = np.arange(len(bits))
    left = np.flatnonzero(room > 0)
    for step in range(1, int(sizes.max())):
        left = left[room[left] >= step]
        for x in (left[k : k + AT_ONCE] for k in range(0, len(left), AT_ONCE)):
            y = x + step
            ok = ~(crossed[x] & (mine[x] == mine[y]))
            x, y = x[ok], y[ok]
            for p in range(len(refs)):
                near = np.abs(table[x, p] - table[y, p]) <= distance
                x, y = x[near], y[near]
                if not len(x):
                    break
            near = np.bitwise_count(bits[x] ^ bits[y]) <= distance
            _union(parent, x[near], y[near])
    root = _roots(parent)
    linked = np.flatnonzero(root != np.arange(len(bits)))
    a, b = bits[linked], bits[root[linked]]
    return np.minimum(a, b), np.maximum(a, b)


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent[:] = up


def _union(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the sets of x[k] and y[k], all k at once: roots hang under smaller roots until all pairs agree."""
    while len(x):
        _roots(parent)
        a, b = parent[x], parent[y]
        open_ = a != b
        if not open_.any():
            return
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def components(edges_: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node with an edge can reach, other nodes left out.

    Large-star hangs a node's larger neighbours under its smallest one, small-star its smaller ones; the two in
    turn end in stars. The smallest neighbour is an aggregate, joined back, so no node's neighbours are gathered.
    """
    current = edges_.select("low", "high").where("low <> high").distinct()
    current = checkpointed(current)
    while True:
        both = current.union(current.select(F.col("high"), F.col("low"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("m").alias("low"), F.col("v").alias("high")).distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high")
        small = small.select(F.col("m").alias("low"), "high").union(small.where("low <> m").select(F.col("m").alias("low"), F.col("low").alias("high"))).distinct()
        following = checkpointed(small)
        # Stars: no node stands on both sides, and each hangs under one. Then nothing changes any more.
        n, m = current.count(), following.count()
        if n == m and not following.exceptAll(current).limit(1).count():
            break
        current = following
    return current.select(F.col("high").alias("node"), F.col("low").alias("root"))


def duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """Each row's `key`, its fingerprint `bits`, and `component`, the smallest key that links reach."""
    prints = checkpointed(fingerprints(df, text, (key,), shingle).toDF("key", "bits"))
    nodes = prints.groupBy("bits").agg(F.min("key").alias("least"))
    roots = components(edges(nodes, distance, parts))
    placed = nodes.join(roots, nodes["bits"] == roots["node"], "left").select("bits", "least", F.coalesce("root", "bits").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    answer = placed.join(least, "root").select("bits", "component")
    return prints.join(answer, "bits").select(F.col("key").alias(key), "bits", "component")


def representatives(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """The rows of `df` of which one stands for each group: the one of the smallest key, and of equal keys one.

    A row is known by its key and a hash of its text, so the texts are not written with the fingerprints; they move
    once, in the join that picks the rows. Of rows with the same key and text one stays, as they are copies.
    """
    at = {c: f"keep_{k}" for k, c in enumerate(df.columns)}
    rows = df.select(*(F.col(f"`{c}`").alias(k) for c, k in at.items()))
    id_, hashed = F.col(at[key]), F.xxhash64(F.coalesce(F.col(at[text]).cast("string"), F.lit("")))
    prints = written(fingerprints(rows.select(at[key], at[text], hashed.alias("hash")), at[text], (at[key], "hash"), shingle), "prints")
    least = F.min(F.struct(id_.isNull().alias("none"), id_.alias("key"), F.col("hash"))).alias("least")
    nodes = written(prints.groupBy("bits").agg(least), "nodes")
    roots = components(edges(nodes, distance, parts))
    placed = nodes.join(roots, nodes["bits"] == roots["node"], "left").select("least", F.coalesce("root", "bits").alias("root"))
    chosen = placed.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.key").alias("of"), F.col("least.hash").alias("hash"))
    # Null keys are marked, as they equal nothing in a join.
    key_of = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    chosen = chosen.select(key_of("of").alias("of"), "hash")
    marked = rows.withColumn("of", key_of(at[key])).withColumn("hash", hashed)
    picked = marked.join(chosen, ["of", "hash"], "left_semi").dropDuplicates(["of", "hash"])
    return picked.select(*(F.col(k).alias(c) for c, k in at.items()))
