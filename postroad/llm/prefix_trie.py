"""Conversation prefix trie by splitter skeleton: what conversations share, as one row for each distinct beginning.

Sequences. A conversation is its turns (role, text), null roles and texts being empty, ordered by turn (null first; of equal turns by
role, then text). Turns are numbered without gathering a conversation: the lines are range-partitioned by conversation and order, each
part is numbered as it streams by, and the few conversations that go on from one part to the next get the earlier parts' counts added.

Paths. A node of depth d is known by 128 bits: the exclusive or of a hash of (place, turn) over the first d turns. A row holds the nodes
of up to `BLOCK` turns of a conversation, so no row grows with a conversation's length; a longer one is several rows, which
are worked off from the deepest block upwards, one round of the following for each block (nearly always there is just one).

A round:

1. splitters: the quantiles of a bounded sample of rows, by (path, conversation). Rows with one beginning are neighbours in this order,
   so a node that more than one shard sees is the beginning of a splitter's path;
2. the skeleton, the trie of all splitter paths, is broadcast: at most `SHARDS` * `BLOCK` nodes, whatever the table holds;
3. each sorted shard is read once, with the nodes of one path in hand. A node that is not in the skeleton is finished there. A skeleton
   node gives a partial aggregate of what the shard adds to it;
4. skeleton nodes combine their partial aggregates by reduction, and then from the leaves of the skeleton to its root.

Skew. Copies of one conversation are split between shards, as the order ends in the conversation's id. Ends of a skeleton node are handed
on as texts of up to `PIECE` ids; the digest of a node reads them in order, one after the other, as SHA-256 demands, and holds one at a time.

Defined results: rows without an id belong to no conversation. Repeated rows are turns of their own. A conversation of which no turn
is left is a member of the root. Very long texts are read for their hash and number of words alone. Other columns are not read, whatever their names.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from postroad.llm.shared import lookup, written

BLOCK = 256
SHARDS = 1024
#: Rows that a shard holds, as long as there are no more than SHARDS shards.
SHARD_ROWS = 50_000
#: Sampled rows for each splitter.
SAMPLED = 16
PIECE = 1 << 12
EMIT = 20_000

#: Which conversations begin alike, and the most turns that they take over.
FAMILY, HEAD = 20, 4

_STEPS = "conv long, block int, path array<binary>, words array<long>, above binary, more boolean"
_FOUND = (
    "kind int, id binary, parent binary, depth long, conv long, n long, kids long, leaves long, saved long, words long, "
    "below_kids long, below_leaves long, below_saved long, ends string, shard int, place long"
)
_NODE = ["id", "parent", "depth", "conv", "n", "kids", "leaves", "saved", "ends"]


def _tasks(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def numbered(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: int | None = None) -> DataFrame:
    """(conv, rank, a, b, words): each turn's number in its conversation from 1, its hashes, and its text's words."""
    c = lambda name: F.col(f"`{name}`")
    lines = df.where(c(conv).isNotNull()).select(c(conv).cast("long").alias("conv"), c(turn).alias("turn"), F.coalesce(c(role).cast("string"), F.lit("")).alias("role"), F.coalesce(c(text).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("line"))
    lines = written(lines, "lines")  # so that a line keeps its number
    order = ["conv", "turn", "role", "text", "line"]
    sorted_ = lines.repartitionByRange(parts or _tasks(df), *order).sortWithinPartitions(*order)
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    sorted_ = sorted_.select("conv", F.spark_partition_id().alias("part"), F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"), words.alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            heads = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            sizes = np.diff(np.append(heads, len(ids)))
            place = np.arange(1, len(ids) + 1) - np.repeat(heads, sizes)
            if ids[0] == last:
                place[: sizes[0]] += seen
            last, seen = ids[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])

    placed = written(sorted_.mapInArrow(run, "conv long, part int, a long, b long, words long, place long"), "placed")
    # Of a part, only its first conversation may go on from an earlier one.
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n")).select("conv", "part", F.sum("n").over(earlier).alias("before")).where("before > 0")
    return lookup(placed, written(carried, "carried"), ["conv", "part"]).select("conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("rank"), "a", "b", "words")


def plain(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The conversations as they stand: (conv, pos, a, b, words), with a place 0 for the root."""
    turns = numbered(df, conv, turn, role, text)
    roots = turns.where("rank = 1").select("conv", F.lit(0).cast("long").alias("pos"), *(F.lit(0).cast("long").alias(x) for x in ("a", "b", "words")))
    return written(turns.withColumnRenamed("rank", "pos").union(roots), "turns")


def rebuilt(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """As `plain`, each conversation c with the first turns of c - c % 20 in place of as many of its own.

    How many, is the unsigned CRC-32 of c's decimal digits, modulo 4.
    """
    turns = written(numbered(df, conv, turn, role, text), "numbered")
    ids = F.col("conv")
    head = F.pmod(F.crc32(ids.cast("string").cast("binary")), F.lit(HEAD))
    sizes = turns.groupBy("conv").agg(F.max("rank").alias("size")).select("conv", "size", head.alias("head"), (ids - ids % FAMILY).alias("base"))
    first = turns.where((ids % FAMILY == 0) & (F.col("rank") < HEAD)).select(ids.alias("base"), "rank", "a", "b", "words")
    bases = first.groupBy("base").agg(F.max("rank").alias("held"))
    sizes = written(sizes.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("held", F.lit(0)))), "conversations")
    short = sizes.where("taken < head").select("conv", (F.col("head") - F.col("taken")).alias("missing"))
    own = lookup(turns.where(F.col("rank") > head), short, ["conv"]).select("conv", (F.col("rank") - F.coalesce("missing", F.lit(0))).alias("pos"), "a", "b", "words")
    taken = sizes.where("taken > 0").join(first, "base").where("rank <= taken").select("conv", F.col("rank").alias("pos"), "a", "b", "words")
    roots = sizes.select("conv", F.lit(0).cast("long").alias("pos"), *(F.lit(0).cast("long").alias(x) for x in ("a", "b", "words")))
    return written(own.union(taken).union(roots), "turns")


def _paths(turns: DataFrame, block: int) -> tuple[DataFrame, int]:
    """Rows of up to `block` nodes, and the number of blocks of the longest conversation."""
    deepest = turns.agg(F.max("pos")).first()[0]
    if deepest is None:
        return turns.sparkSession.createDataFrame([], _STEPS), 0
    n_blocks = deepest // block + 1
    pos = F.col("pos")
    steps = turns.select("conv", F.expr(f"cast(pos div {block} as int)").alias("block"), "pos", F.xxhash64(pos, "a").alias("x"), F.xxhash64(pos, "b", F.lit(7)).alias("y"), "words")
    rows = steps.groupBy("conv", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "x", "y", "words"))).alias("steps"))
    if n_blocks == 1:
        rows = rows.select("*", *(F.lit(None).cast("long").alias(c) for c in ("x", "y")), F.lit(False).alias("more"))
    else:
        order = Window.partitionBy("conv").orderBy("block")
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        sums = steps.groupBy("conv", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
        marks = sums.select("conv", "block", F.bit_xor("x").over(earlier).alias("x"), F.bit_xor("y").over(earlier).alias("y"), F.lead("block").over(order).isNotNull().alias("more")).where("more or block > 0")
        rows = lookup(rows, written(marks, "marks"), ["conv", "block"]).withColumn("more", F.coalesce("more", F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends, inner = lists.offsets.to_numpy(), lists.values
            x, y, words = (inner.field(k).to_numpy() for k in (1, 2, 3))
            carried = [[0 if v is None else v for v in batch.column(k).to_pylist()] for k in (3, 4)]
            nodes = np.empty((int(ends[-1] - ends[0]), 2), np.dtype(">i8"))
            for k in range(batch.num_rows):
                a, b = ends[k], ends[k + 1]
                for side, values in ((0, x), (1, y)):
                    nodes[a - ends[0] : b - ends[0], side] = np.bitwise_xor.accumulate(values[a:b]) ^ carried[side][k]
            path = pa.Array.from_buffers(pa.binary(), len(nodes), [None, pa.py_buffer((np.arange(len(nodes) + 1) * 16).astype(np.int32)), pa.py_buffer(nodes.tobytes())])
            at = pa.array((ends - ends[0]).astype(np.int32))
            above = [None if v is None else np.array([v, w], ">i8").tobytes() for v, w in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(at, path), pa.ListArray.from_arrays(at, pa.array(words[ends[0] : ends[-1]])), pa.array(above, pa.binary()), batch.column(5)], names=["conv", "block", "path", "words", "above", "more"])

    rows = rows.select("conv", "block", "steps", "x", "y", "more")
    return written(rows.mapInArrow(run, _STEPS), "paths"), n_blocks


def _splitters(rows: DataFrame, shards: int) -> list[tuple]:
    """At most `shards` - 1 rows in order, as (path, more, conversation): quantiles of a bounded sample."""
    sample = rows.orderBy(F.xxhash64("conv", F.lit(3)), "conv").limit(SAMPLED * shards).select("path", "more", "conv").collect()
    keys = sorted(([bytes(x) for x in r.path], r.more, r.conv) for r in sample)
    return [keys[len(keys) * k // shards] for k in range(1, shards) if len(keys) >= shards]


class _Node:
    __slots__ = ("id", "words", "conv", "n", "kids", "leaves", "saved", "below", "ends", "held", "pieces")

    def __init__(self, id_: bytes, words: int, held: bool):
        self.id, self.words, self.held = id_, words, held  # held: in the skeleton
        self.conv, self.n, self.kids, self.leaves, self.saved, self.pieces = None, 0, 0, 0, 0, 0
        self.below: tuple[int, int, int] | None = None
        self.ends = None

    def join(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None or conv < self.conv else self.conv
        self.n += n


class _Shards:
    """Sorted shards, one after another: the nodes of the path in hand, and rows of what is finished."""

    def __init__(self, skeleton: frozenset[bytes], first: int):
        self.skeleton, self.first = skeleton, first
        self.stack: list[_Node] = []
        self.shard, self.above = -1, None
        self.out: list[tuple] = []

    def add(self, shard: int, path: list[bytes], words: list[int], conv: int, more: bool, above: bytes | None, below: tuple) -> None:
        stack, same = self.stack, 0
        if shard == self.shard:
            for node, step in zip(stack, path, strict=False):
                if node.id != step:
                    break
                same += 1
        self.close(same)
        self.shard = shard
        if not same:
            self.above = above
        for step, n in zip(path[same:], words[same:], strict=True):
            stack.append(_Node(step, n, step in self.skeleton))
        top = stack[-1]
        top.join(conv, 1)
        if more:
            top.below = below
        elif top.held:
            top.ends = top.ends or []
            top.ends.append(str(conv))
            if len(top.ends) == PIECE:
                self.piece(top)
        elif top.ends is None:
            top.ends = hashlib.sha256(str(conv).encode())
        else:
            top.ends.update(b",%d" % conv)

    def piece(self, node: _Node) -> None:
        self.out.append((2, node.id, *[None] * 11, ",".join(node.ends), self.shard, node.pieces))
        node.pieces += 1
        node.ends = []

    def close(self, keep: int) -> None:
        stack = self.stack
        while len(stack) > keep:
            node = stack.pop()
            up = stack[-1] if stack else None
            depth = self.first + len(stack)
            kids, leaves, saved = node.below or (0, 0, 0)
            parent = up.id if up else self.above
            if up:
                up.join(node.conv, node.n)
            if node.held:
                if node.ends:
                    self.piece(node)
                self.out.append((1, node.id, parent, depth, node.conv, node.n, node.kids, node.leaves, node.saved, node.words, kids, leaves, saved, None, self.shard, None))
                continue
            kids += node.kids
            leaves = leaves + node.leaves or 1
            saved += node.saved + (node.n - 1) * node.words
            if up:
                up.kids, up.leaves, up.saved = up.kids + 1, up.leaves + leaves, up.saved + saved
            ends = (node.ends or hashlib.sha256()).hexdigest()
            self.out.append((0, node.id, parent, depth, node.conv, node.n, kids, leaves, saved, *[None] * 4, ends, None, None))


def _round(rows: DataFrame, below: DataFrame | None, block: int, size: int, shards: int | None) -> DataFrame:
    """All nodes of the given rows, which are one block; `below` has what hangs under their last nodes."""
    if below is not None:
        rows = lookup(rows.withColumn("last", F.element_at("path", -1)), below, ["last"])
    else:
        rows = rows.select("*", *(F.lit(None).cast("long").alias(c) for c in ("below_kids", "below_leaves", "below_saved")))
    session = rows.sparkSession
    shards = shards or min(SHARDS, max(_tasks(rows), rows.count() // SHARD_ROWS + 1))
    splitters = _splitters(rows, shards)
    shared = session.sparkContext.broadcast((splitters, frozenset(node for path, _, _ in splitters for node in path)))
    names = ["path", "words", "conv", "more", "above", "below_kids", "below_leaves", "below_saved"]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value[0]
        for batch in batches:
            own = zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(2).to_pylist(), strict=True)
            at = [bisect_right(keys, key) for key in own]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], names=[*names, "shard"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Shards(shared.value[1], block * size)
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(9)]
            for path, words, conv, more, above, kids, leaves, saved, shard in zip(*columns, strict=True):
                state.add(shard, path, words, conv, more, above, (kids or 0, leaves or 0, saved or 0))
                if len(state.out) >= EMIT:
                    yield _rows(state.out)
        state.close(0)
        yield _rows(state.out)

    schema = "path array<binary>, words array<long>, conv long, more boolean, above binary, below_kids long, below_leaves long, below_saved long, shard int"
    sorted_ = rows.select(*names).mapInArrow(dealt, schema).repartition(shards, "shard").sortWithinPartitions("shard", "path", "more", "conv")
    found = written(sorted_.mapInArrow(scan, _FOUND), "nodes")
    done = found.where("kind = 0").select(*_NODE)
    return done.union(_reduced(found)) if splitters else done


_KINDS = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 10, pa.string(), pa.int32(), pa.int64()]
_NAMES = [c.split()[0] for c in _FOUND.split(", ")]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = zip(*out, strict=True) if out else [()] * len(_KINDS)
    batch = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _KINDS, strict=True)], names=_NAMES)
    out.clear()
    return batch


def _reduced(found: DataFrame) -> DataFrame:
    """The skeleton's nodes: partial aggregates by node, then from the deepest nodes up. There are no more than the skeleton holds."""
    sums = [F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")]
    same = [F.max(c).alias(c) for c in ("parent", "depth", "words", "below_kids", "below_leaves", "below_saved")]
    parts = found.where("kind = 1").groupBy("id").agg(F.min("conv").alias("conv"), *sums, *same)
    nodes = {bytes(r.id): r.asDict() for r in parts.collect()}
    for node in sorted(nodes.values(), key=lambda r: -r["depth"]):
        node["kids"] += node["below_kids"]
        node["leaves"] = node["leaves"] + node["below_leaves"] or 1
        node["saved"] += node["below_saved"] + (node["n"] - 1) * node["words"]
        up = nodes.get(bytes(node["parent"])) if node["parent"] is not None else None
        if up:
            up["kids"], up["leaves"], up["saved"] = up["kids"] + 1, up["leaves"] + node["leaves"], up["saved"] + node["saved"]
    columns = _NODE[:-1]
    rows = [tuple(r[c] for c in columns) for r in nodes.values()]
    held = found.sparkSession.createDataFrame(rows, "id binary, parent binary, depth long, conv long, n long, kids long, leaves long, saved long")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            for id_, ends in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if id_ != last:
                    if last is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], names=["id", "ends"])
                    last, state = id_, hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], names=["id", "ends"])

    pieces = found.where("kind = 2").select("id", "shard", "place", "ends").repartition("id").sortWithinPartitions("id", "shard", "place")
    ends = written(pieces.mapInArrow(digests, "id binary, ends string"), "ends")
    return held.join(ends, "id", "left").select(*columns, F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends"))


def trie(turns: DataFrame, block: int = BLOCK, shards: int | None = None) -> DataFrame:
    """The nodes of all conversations in `turns`, a result of `plain` or `rebuilt`.

    Gives id, parent, depth, conv (the smallest member), n (members), kids, leaves, saved (words that need not be read again) and ends
    (the SHA-256 of the ids of the conversations that end there).
    """
    rows, n_blocks = _paths(turns, block)
    nodes, below = None, None
    for k in range(n_blocks - 1, -1, -1):
        some = written(_round(rows.where(F.col("block") == k), below, k, block, shards), "trie")
        nodes = some if nodes is None else nodes.union(some)
        tops = some.where((F.col("depth") == k * block) & F.col("parent").isNotNull())
        below = tops.groupBy(F.col("parent").alias("last")).agg(F.count(F.lit(1)).alias("below_kids"), F.sum("leaves").alias("below_leaves"), F.sum("saved").alias("below_saved"))
    if nodes is None:
        return turns.sparkSession.createDataFrame([], "id binary, parent binary, depth long, conv long, n long, kids long, leaves long, saved long, ends string")
    return nodes


def report(nodes: DataFrame) -> DataFrame:
    """The nodes with their parents' smallest members in place of ids."""
    parents = nodes.where("kids > 0").select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv_id"))
    named = lookup(nodes, parents, ["parent"])
    return named.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
