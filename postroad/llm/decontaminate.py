"""Benchmark decontamination: the hashes of all benchmark word windows, tested on every window of every text.

Words are runs of ASCII letters and digits and of characters beyond ASCII, after lower-casing A-Z. An item's
windows are its runs of `window` words; an item of fewer words, but not none, is one window. The hashes go to
every task as a table. A text's windows are hashed by array arithmetic, looked up, and each hit is compared
word for word, so equal hashes of unequal windows do no harm. There is no shuffle.

The table's size is checked: benchmark items beyond `block_chars` characters are taken in blocks of about that
size, one pass of the documents for each block, with the hits so far written to the shared folder between.

Defined results: a null or empty text has no words and no hits. Items with null or no words have no window.
Equal items are all reported. Each row of the documents is judged by itself, repeated ids too; an empty table
of documents gives no rows, an empty benchmark no hits. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad.llm.arrays import ALPHANUMERIC, LOWER, Table, Words, chunks
from postroad.llm.shared import checkpointed

WINDOW = 10
BLOCK_CHARS = 20_000_000
HITS = "array<struct<first:bigint,last:bigint,start:bigint,stop:bigint>>"


class Windows:
    """The windows of some items: for each length in words a table of hashes, and the items of each window."""

    def __init__(self, texts: list[tuple[object, str | None]], window: int):
        batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in texts], pa.string())], names=["text"])
        self.items: dict[int, dict[bytes, list]] = defaultdict(dict)
        hashes: dict[int, list[int]] = defaultdict(list)
        done = 0
        for rows, data, offsets in chunks(batch, 0):
            words = Words(LOWER[data], offsets, ALPHANUMERIC)
            of_word = words.hashes()
            for n in sorted({min(int(c), window) for c in words.count} - {0}):
                for first, key in zip(*map(np.ndarray.tolist, words.windows(of_word, n)), strict=True):
                    row = int(words.row[first])
                    if n == min(int(words.count[row]), window):
                        of = self.items[n].setdefault(words.text(first, n), [])
                        if not of or of[-1] != done + row:
                            of.append(done + row)
                        hashes[n].append(key)
            done += rows.num_rows
        self.ids = [i for i, _ in texts]
        self.tables = {n: Table(k := np.unique(np.array(h, np.uint64)), np.zeros(len(k))) for n, h in hashes.items()}

    def hits(self, words: Words) -> tuple[dict[int, list[tuple[int, int]]], dict[int, set]]:
        """By row: the runs of hit words (first, one past the last, in words of the chunk), and the items found."""
        runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        items: dict[int, set] = defaultdict(set)
        of_word = words.hashes() if self.tables else None
        for n, table in self.tables.items():
            firsts, keys = words.windows(of_word, n)
            for first in firsts[table.find(keys) >= 0].tolist():
                of = self.items[n].get(words.text(first, n))
                if of is not None:
                    row = int(words.row[first])
                    runs[row].append((first, first + n))
                    items[row].update(of)
        return runs, items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching runs become one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[object, str | None]]]:
    items = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"))
    chars = items.agg(F.sum(F.length("text") + 100)).first()[0] or 0
    n = -(-int(chars) // limit) or 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r.item, r.text) for r in part.toLocalIterator()]


def find(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", keep: tuple[str, ...] = ("doc_id",), item: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS, with_text: bool = False) -> DataFrame:
    """Each document's kept columns, `n_words`, `spans` and `items`.

    A span is a run of hit words: `first` word and `last` (one past it), `start` and `stop` in bytes of the UTF-8
    text. Spans come in order and do not touch. `items` are the benchmark ids with a window in the text, distinct.
    """
    id_type = benchmark.schema[item].dataType
    inner = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T._parse_datatype_string(HITS)), T.StructField("items", T.ArrayType(id_type))])
    current = documents.select(*(F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)), F.col(text).alias("the_text"), F.lit(0).cast("long").alias("n_words"), F.expr(f"cast(array() as {HITS})").alias("spans"), F.lit(None).cast(T.ArrayType(id_type)).alias("items"))
    schema = T.StructType([*current.schema.fields[: len(keep) + 1], *inner.fields])
    for k, block in enumerate(_blocks(benchmark, item, item_text, block_chars)):
        current = (checkpointed(current) if k else current).mapInArrow(_finder(documents, Windows(block, window), len(keep)), schema)
    return current.select(*(F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep)), *([F.col("the_text").alias(text)] if with_text else []), "n_words", "spans", "items")


def _finder(documents: DataFrame, windows: Windows, at: int):
    shared = documents.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            for rows, data, offsets in chunks(batch, at):
                words = Words(LOWER[data], offsets, ALPHANUMERIC)
                runs, items = windows.hits(words)
                spans, found = rows.column(at + 2).to_pylist(), rows.column(at + 3).to_pylist()
                for row, new in runs.items():
                    base = int(words.first[row])
                    old = [(s["first"] + base, s["last"] + base) for s in spans[row] or []]
                    spans[row] = [{"first": a - base, "last": b - base, "start": int(words.start[a] - offsets[row]), "stop": int(words.end[b - 1] - offsets[row])} for a, b in merged(old + new)]
                    ids = dict.fromkeys([*(found[row] or []), *(windows.ids[i] for i in sorted(items[row]))])
                    found[row] = list(ids)
                yield pa.RecordBatch.from_arrays([*rows.columns[: at + 1], pa.array(words.count.astype(np.int64)), pa.array(spans, rows.schema.field(at + 2).type), pa.array([f or [] for f in found], rows.schema.field(at + 3).type)], names=rows.schema.names)

    return run


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and the digest of the items, from what `find` gave."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])
    items = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", chars: str = "n_chars", drop_share: float = 0.5, item: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without benchmark passages, in their own columns.

    Hit spans are cut out, and a line break stands in their place. A document goes as a whole if more than
    `drop_share` of its words are cut. What a cut brings together is searched again until nothing is found.
    A document without hits stays exactly as it is; `chars`, if there is such a column, follows the text.
    """
    names, schema = documents.columns, documents.schema
    if len(set(names)) < len(names):
        raise ValueError("the documents' column names must differ")
    inner = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(schema.fields)] + [T.StructField("of", T.LongType()), T.StructField("cut", T.LongType())])
    current = documents.select(*(documents[f"`{n}`"].alias(f"c{k}") for k, n in enumerate(names)), F.lit(None).cast("long").alias("of"), F.lit(0).cast("long").alias("cut"))
    for turn in count():  # each turn that goes on has cut a word, so there is a last one
        before, blocks = current, 0
        for block in _blocks(benchmark, item, item_text, block_chars):
            current = (checkpointed(current) if turn or blocks else current).mapInArrow(_cutter(documents, Windows(block, window), names.index(text)), inner)
            blocks += 1
        if blocks == 1:
            break  # the task itself has searched again
        current = checkpointed(current)
        if turn and current.agg(F.sum("cut")).first()[0] == before.agg(F.sum("cut")).first()[0]:
            break
    kept = current.where(F.col("cut") <= F.lit(drop_share) * F.col("of"))
    length = F.when(F.col("cut") > 0, F.length(f"c{names.index(text)}")).otherwise(F.col(f"c{names.index(chars)}")).cast(schema[chars].dataType) if chars in names else None
    return kept.select(*(length.alias(n) if n == chars else F.col(f"c{k}").alias(n) for k, n in enumerate(names)))


def _cutter(documents: DataFrame, windows: Windows, at: int):
    shared = documents.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            for rows, data, offsets in chunks(batch, at):
                words = Words(LOWER[data], offsets, ALPHANUMERIC)
                runs, _ = windows.hits(words)
                of = np.array([n if o is None else o for n, o in zip(words.count.tolist(), rows.column(rows.num_columns - 2).to_pylist(), strict=True)], np.int64)
                cut = rows.column(rows.num_columns - 1).to_numpy().copy()
                texts = rows.column(at)
                if runs:
                    changed = texts.to_pylist()
                    for row, found in runs.items():
                        raw = data[offsets[row] : offsets[row + 1]].tobytes()
                        base, begin, own = 0, int(offsets[row]), words
                        while found:
                            for a, b in reversed(merged(found)):
                                raw = raw[: own.start[a] - begin] + b"\n" + raw[own.end[b - 1] - begin :]
                                cut[row] += b - a
                            left = np.frombuffer(raw, np.uint8)
                            own, begin = Words(LOWER[left], np.array([0, len(left)]), ALPHANUMERIC), 0
                            found = windows.hits(own)[0].get(base, [])
                        changed[row] = raw.decode()
                    texts = pa.array(changed, texts.type)
                yield pa.RecordBatch.from_arrays([*rows.columns[:at], texts, *rows.columns[at + 1 : -2], pa.array(of), pa.array(cut)], names=rows.schema.names)

    return run
