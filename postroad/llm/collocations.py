"""Phrase collocations by relational mining in sets: sorted occurrence relations, extended by one word a round.

Pieces and words. Texts (null: empty) are lower-cased (A-Z) and split at `[.,;:!?\\x0A-\\x0D]` into pieces, and those into words
`[^\\x20\\x09]+`. Everything is counted by language (null: `und`).

Rounds. R1 holds (piece, place, word) of every occurrence of a frequent word, sorted; it is written once, as rows of arrays, each
of at most `SEGMENT` occurrences and the few that follow them. Round k

1. merge-joins R(k-1) with R1 by piece and place + k - 1,
2. counts the groups of equal phrases, by their words: tasks add up as they go, Spark adds up the sums,
3. semi-joins the joined rows with the frequent groups and writes them as R(k), sorted as they were,

so no phrase is extended that is not frequent itself, and no occurrence is shuffled, only sums. The semi-joins go through a bit map of
`1 << BITS` bits, whatever the table's size. It keeps every frequent group and may let others through, which the next count drops.

Exactness. A word is held as 64 bits, of which the table of all words shows that no two words of a language share them; if they do, others
are taken. Counts are longs and scores decimals of 38 digits: a and l * r may reach 10**16 and 10**38.

Skew. A hot language, word or phrase is one row of sums per task. Before a language's phrases are ranked, a count by grains of the
score leaves little more than the best ones.

Defined results: null and empty texts have no words. Repeated rows count as often as they stand. Very long texts are cut into segments,
and no phrase is lost at a cut. Other columns are not read, whatever their names. An empty table gives no rows. Scores of equal value are ordered by a, then by the phrase's
UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from postroad.llm.arrays import LOWER, Words, chunks, mixed, powers
from postroad.llm.shared import is_small, written

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
#: The bytes that end a piece, and those that stand between words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"

#: Occurrences in a row of a relation.
SEGMENT = 64
#: Rows of a relation that a task looks at together.
SLICE = 1 << 12
#: Sums that a task gathers before it hands them on.
GATHER = 1 << 19
#: Words that a task gathers before it hands their sums on.
GATHER_WORDS = 1 << 19
#: Bits of the semi-joins' map: 16 MB.
BITS = 27
#: Steps of the logarithm by which scores are told apart before they are ranked.
GRAIN = 50
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_LONG_WORD = 256

_ENDS = np.isin(np.arange(256), list(PIECE_ENDS))
_INSIDE = ~(_ENDS | np.isin(np.arange(256), list(BLANKS)))

RELATION = "lang string, piece array<int>, place array<int>, word array<long>, own int, at array<int>"


def _lang(lang: str) -> Column:
    return F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und"))


def _codes(words: Words, seed: int) -> np.ndarray:
    """64 bits for each word: sums of a number for each byte value, weighed by its place; long words by XXH64."""
    up, down = powers(len(words.data))
    values = mixed((np.arange(256, dtype=np.uint64) + np.uint64(256 * seed + 1)) * _PRIME)
    sums = np.zeros(len(words.data) + 1, np.uint64)
    np.cumsum(values[words.data] * up[: len(words.data)], out=sums[1:])
    out = mixed((sums[words.end] - sums[words.start]) * down[words.start])
    for k in np.flatnonzero(words.end - words.start >= _LONG_WORD):
        out[k] = xxhash.xxh64_intdigest(words.text(int(k)), seed)
    return out


def _longer(codes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The bits of a phrase with one more word."""
    return mixed(codes * _PRIME + word + np.uint64(1))


def _words(data: np.ndarray, offsets: np.ndarray, seed: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words, their bits, and the piece each stands in, counted through the chunk."""
    words = Words(LOWER[data], offsets, _INSIDE)
    ends = np.cumsum(_ENDS[data])
    return words, _codes(words, seed), ends[words.start] if len(words) else np.zeros(0, np.int64)


def word_counts(df: DataFrame, text: str = "text", lang: str = "lang", seed: int = 0) -> DataFrame:
    """(lang, word, n): all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple]] = {}

        def size() -> int:
            return sum(len(n) for found in held.values() for _, _, n, _ in found)

        def merged(found: list[tuple]) -> tuple:
            codes, others, n = (np.concatenate([f[k] for f in found]) for k in range(3))
            order = np.argsort(codes, kind="stable")
            codes, others, n = codes[order], others[order], n[order]
            # Words of equal bits are told apart by 64 other bits; they may make two rows of one word, which Spark adds up.
            heads = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (others[1:] != others[:-1])]))
            texts = pa.concat_arrays([f[3] for f in found]).take(pa.array(order[heads]))
            return codes[heads], others[heads], np.add.reduceat(n, heads), texts

        def drain() -> Iterator[pa.RecordBatch]:
            for name, found in held.items():
                _, _, n, texts = merged(found)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(n), pa.string()), texts.cast(pa.string()), pa.array(n)], names=["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for part, data, offsets in chunks(batch, 1):
                words, codes, _ = _words(data, offsets, seed)
                names, others = part.column(0).to_pylist(), words.hashes()
                for name in set(names):
                    mine = np.flatnonzero(np.array([n == name for n in names])[words.row])
                    if not len(mine):
                        continue
                    mine = mine[np.argsort(codes[mine], kind="stable")]
                    new = (codes[mine[1:]] != codes[mine[:-1]]) | (others[mine[1:]] != others[mine[:-1]])
                    heads = np.flatnonzero(np.concatenate([[True], new]))
                    first, n = mine[heads], np.diff(np.append(heads, len(mine)))
                    index, ends = _spread(words.start[first], words.end[first])
                    texts = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(words.data[index].tobytes())])
                    held.setdefault(name, []).append((codes[first], others[first], n, texts))
                if size() > 2 * GATHER_WORDS:
                    for name in held:
                        held[name] = [merged(held[name])]
                    if size() > GATHER_WORDS:
                        yield from drain()
        yield from drain()

    parts = df.select(_lang(lang).alias("lang"), F.col(f"`{text}`").alias("text")).mapInArrow(run, "lang string, word string, n long")
    return parts.repartition("lang", "word").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _coded(words: DataFrame, seed: int) -> DataFrame:
    """(lang, code, word, n): words with the bits that stand for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, 1):
                codes = _codes(Words(data, offsets, np.ones(256, bool)), seed)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(codes.view(np.int64)), part.column(1), part.column(2)], names=["lang", "code", "word", "n"])

    return words.mapInArrow(run, "lang string, code long, word string, n long")


def word_table(df: DataFrame, text: str = "text", lang: str = "lang", seeds: int = 8) -> tuple[DataFrame, int]:
    """`word_counts` with bits that no two words of a language share, and the seed that gives them."""
    counted_ = written(word_counts(df, text, lang), "words")
    for seed in range(seeds):
        table = _coded(counted_, seed)
        if not table.groupBy("lang", "code").agg(F.count(F.lit(1)).alias("words")).where("words > 1").limit(1).count():
            return table, seed
    raise ValueError("words share their bits under every seed")


def bit_map(codes: DataFrame, bits: int = BITS) -> np.ndarray:
    """A map with the lowest bits of each `code` set. At most 2 ** (bits - 6) rows come to the driver, whatever the table holds."""
    low = F.col("code").bitwiseAND(F.lit((1 << bits) - 1))
    parts = codes.select(F.shiftright(low, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(F.lit(63)).cast("int")).alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[parts.column("at").to_numpy()] = parts.column("bits").to_numpy()
    return out.view(np.uint64)


def _in_map(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    low = codes & np.uint64(len(table) * 64 - 1)
    return (table[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _relation(lang: pa.Array, ends: np.ndarray, piece: np.ndarray, place: np.ndarray, word: np.ndarray, own: np.ndarray, at_ends: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    lists = [_cut(piece.astype(np.int32), ends), _cut(place.astype(np.int32), ends), _cut(word.view(np.int64), ends)]
    return pa.RecordBatch.from_arrays([lang, *lists, pa.array(own.astype(np.int32)), _cut(at.astype(np.int32), at_ends)], names=["lang", "piece", "place", "word", "own", "at"])


def _lang_bits(names: list[str]) -> np.ndarray:
    bits = {name: xxhash.xxh64_intdigest(name) for name in set(names)}
    return np.array([bits[name] for name in names], np.uint64)


def _spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each begin to its end, one range after another, and where each range begins."""
    ends = np.concatenate([[0], np.cumsum(end - begin)])
    return np.arange(int(ends[-1])) + np.repeat(begin - ends[:-1], end - begin), ends


def occurrences(df: DataFrame, frequent: np.ndarray, text: str = "text", lang: str = "lang", seed: int = 0, max_words: int = MAX_WORDS, segment: int = SEGMENT) -> DataFrame:
    """R1: segments of sorted (piece, place, word), of words in the map. `own` of them begin phrases; the rest only follow.

    `at` holds the occurrences that begin a phrase of R1, which are the `own` ones.
    """
    shared = df.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, 1):
                words, codes, pieces = _words(data, offsets, seed)
                bits = _lang_bits(part.column(0).to_pylist())
                new = np.ones(len(words), bool)
                new[1:] = (pieces[1:] != pieces[:-1]) | (words.row[1:] != words.row[:-1])
                starts = np.flatnonzero(new)
                place = np.arange(len(words)) - np.repeat(starts, np.diff(np.append(starts, len(words))))
                keep = np.flatnonzero(_in_map(shared.value, mixed(codes ^ bits[words.row])))
                if not len(keep):
                    continue
                # Each row's kept words, in segments; a segment goes on with the next words of its row.
                first = np.searchsorted(keep, words.first)
                sizes = np.diff(first)
                parts = -(-sizes // segment)
                row = np.repeat(np.arange(len(sizes)), parts)
                number = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                begin = first[row] + number * segment
                last = np.minimum(begin + segment, first[row + 1])
                index, ends = _spread(begin, np.minimum(last + max_words - 1, first[row + 1]))
                some = keep[index]
                at, at_ends = _spread(np.zeros_like(begin), last - begin)
                yield _relation(part.column(0).take(pa.array(row)), ends, pieces[some] - np.repeat(pieces[words.first[row]], np.diff(ends)), place[some], codes[some], last - begin, at_ends, at)

    return df.select(_lang(lang).alias("lang"), F.col(f"`{text}`").alias("text")).mapInArrow(run, RELATION)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most `SLICE` rows, so that what a task works out for one stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE):
            yield batch.slice(first, SLICE)


class _Rows:
    """A batch of a relation: its lists one after another, and `at` counted through the batch."""

    def __init__(self, batch: pa.RecordBatch):
        self.lang = batch.column(0)
        self.ends, self.at_ends = (batch.column(k).offsets.to_numpy().astype(np.int64) for k in (3, 5))
        first, first_at = self.ends[0], self.at_ends[0]
        self.piece, self.place, word = (batch.column(k).values.to_numpy()[first : self.ends[-1]] for k in (1, 2, 3))
        self.word = word.view(np.uint64)
        self.ends, self.at_ends = self.ends - first, self.at_ends - first_at
        self.own = batch.column(4).to_numpy()
        self.row = np.repeat(np.arange(batch.num_rows), np.diff(self.at_ends))
        self.at = batch.column(5).values.to_numpy()[first_at : first_at + self.at_ends[-1]] + self.ends[self.row]
        self.bits = _lang_bits(self.lang.to_pylist())

    def join(self, k: int) -> None:
        """Merge join of R(k) and R1 by piece and place + k: `at` keeps the phrases that go on.

        Both are sorted, and the words of a phrase stand side by side in R1; so the row that matches can only be the next one.
        """
        after = np.minimum(self.at + k, len(self.word) - 1)
        goes_on = (self.at + k < self.ends[self.row + 1]) & (self.piece[after] == self.piece[self.at]) & (self.place[after] == self.place[self.at] + k)
        self.keep(goes_on)

    def keep(self, which: np.ndarray) -> None:
        self.at, self.row = self.at[which], self.row[which]

    def codes(self, k: int) -> np.ndarray:
        """The bits of each phrase of `k` words, with its language."""
        codes = self.word[self.at]
        for j in range(1, k):
            codes = _longer(codes, self.word[self.at + j])
        return mixed(codes ^ self.bits[self.row])


def phrase_counts(relation: DataFrame, k: int) -> DataFrame:
    """(lang, w1 .. wk, n): groups of the phrases of `k` words that R(k-1) and R1 join to."""
    names = [f"w{j + 1}" for j in range(k)]

    def summed(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
        columns, n = [np.concatenate(c) for c in zip(*(c for c, _ in parts), strict=True)], np.concatenate([n for _, n in parts])
        codes = columns[0]
        for c in columns[1:]:
            codes = _longer(codes, c)
        order = np.argsort(codes, kind="stable")
        columns = [c[order] for c in columns]
        # Phrases of equal bits may make two rows of one phrase, which Spark adds up.
        heads = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]))
        return [c[heads] for c in columns], np.add.reduceat(n[order], heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[list[np.ndarray], np.ndarray]]] = {}

        def size() -> int:
            return sum(len(n) for parts in held.values() for _, n in parts)

        def drain() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                columns, n = summed(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *(pa.array(c.view(np.int64)) for c in columns), pa.array(n)], names=["lang", *names, "n"])
            held.clear()

        for batch in _slices(batches):
            rows = _Rows(batch)
            rows.join(k - 1)
            langs = rows.lang.to_pylist()
            for lang in set(langs):
                at = rows.at[np.array([x == lang for x in langs])[rows.row]]
                if len(at):
                    held.setdefault(lang, []).append(summed([([rows.word[at + j] for j in range(k)], np.ones(len(at), np.int64))]))
            if size() > GATHER:
                for lang in held:
                    held[lang] = [summed(held[lang])]
                if size() > GATHER // 2:
                    yield from drain()
        yield from drain()

    schema = ", ".join(["lang string", *(f"{c} long" for c in names), "n long"])
    # The tasks have added up what they hold; dealt out first, the sums are added once and not also where they come from.
    return relation.mapInArrow(run, schema).repartition("lang", *names).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def extended(relation: DataFrame, k: int, frequent: np.ndarray) -> DataFrame:
    """R(k): the join of R(k-1) and R1, of phrases in the map; of R1 what such a phrase holds, and what follows the last one."""
    shared = relation.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = _Rows(batch)
            rows.join(k - 1)
            rows.keep(_in_map(shared.value, rows.codes(k)))
            if not len(rows.at):
                continue
            used = np.zeros(len(rows.word), bool)
            for j in range(k):
                used[rows.at + j] = True
            held = np.bincount(rows.row, minlength=batch.num_rows)
            index, _ = _spread(rows.ends[:-1] + rows.own, rows.ends[1:])
            used[index] = True
            kept_rows = np.flatnonzero(held)
            of = np.repeat(np.arange(batch.num_rows), np.diff(rows.ends))
            used &= held[of] > 0
            moved = np.concatenate([[0], np.cumsum(used)])
            begins = moved[rows.ends]
            own = moved[(rows.ends[:-1] + rows.own)[kept_rows]] - begins[:-1][kept_rows]
            yield _relation(
                rows.lang.take(pa.array(kept_rows)), np.concatenate([[0], begins[1:][kept_rows]]), rows.piece[used], rows.place[used], rows.word[used], own,
                np.concatenate([[0], np.cumsum(held[kept_rows])]), moved[rows.at] - begins[rows.row],
            )

    return relation.mapInArrow(run, RELATION)


def _bits(phrases: DataFrame, k: int) -> DataFrame:
    """(code): what stands for phrase and language in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(j + 1).to_numpy().view(np.uint64) for j in range(k)]
            codes = columns[0]
            for c in columns[1:]:
                codes = _longer(codes, c)
            codes = mixed(codes ^ _lang_bits(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64))], names=["code"])

    return phrases.select("lang", *(f"w{j + 1}" for j in range(k))).mapInArrow(run, "code long")


def mined(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, segment: int = SEGMENT, bits: int = BITS) -> tuple[DataFrame, dict[int, DataFrame]]:
    """The word table (lang, code, word, n), and by length k the frequent phrases (lang, w1 .. wk, n), each a written table."""
    often = F.col("n") >= min_count
    words, seed = word_table(df, text, lang)
    frequent = {1: written(words.where(often).select("lang", F.col("code").alias("w1"), "n"), "phrases1")}
    relation = written(occurrences(df, bit_map(_bits(frequent[1], 1), bits), text, lang, seed, max_words, segment), "r1")
    for k in range(2, max_words + 1):
        frequent[k] = written(phrase_counts(relation, k).where(often), f"phrases{k}")
        if k < max_words:
            relation = written(extended(relation, k, bit_map(_bits(frequent[k], k), bits)), f"r{k}")
    return words, frequent


def _with(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a table of one row for each key. Rows are distinct phrases here; adaptive execution splits a key that many of them share."""
    return rows.join(F.broadcast(table) if is_small(table) else table, keys, "left")


def _scored(frequent: dict[int, DataFrame], k: int) -> DataFrame:
    """(lang, w1 .. wk, a, l, r, score): each phrase with its lowest cut."""
    wide = "decimal(38,0)"
    rows = frequent[k].withColumnRenamed("n", "a")
    cuts = []
    for cut in range(1, k):
        left = [f"w{j + 1}" for j in range(cut)]
        right = [f"w{j + 1}" for j in range(cut, k)]
        first = frequent[cut].withColumnRenamed("n", f"l{cut}")
        rest = frequent[k - cut].select("lang", *(F.col(f"w{j + 1}").alias(c) for j, c in enumerate(right)), F.col("n").alias(f"r{cut}"))
        rows = _with(_with(rows, first, ["lang", *left]), rest, ["lang", *right])
        a, product = F.col("a").cast("decimal(19,0)"), F.col(f"l{cut}").cast("decimal(19,0)") * F.col(f"r{cut}").cast("decimal(19,0)")
        squared = (a * a).cast(wide) * F.lit(1_000_000).cast("decimal(7,0)")
        score = F.call_function("div", squared.cast(wide), product.cast(wide))
        cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r")))
    least = F.array_min(F.array(*cuts))
    names = [f"w{j + 1}" for j in range(k)]
    return rows.withColumn("least", least).select("lang", *names, "a", "least.l", "least.r", F.col("least.score").cast("long").alias("score"))


def _absorbed(frequent: dict[int, DataFrame], k: int) -> DataFrame | None:
    """(lang, w1 .. wk, longest): the greatest count of a longer phrase that holds these words."""
    held = None
    for longer, table in frequent.items():
        for first in range(longer - k + 1 if longer > k else 0):
            inside = table.select("lang", *(F.col(f"w{first + j + 1}").alias(f"w{j + 1}") for j in range(k)), "n")
            held = inside if held is None else held.union(inside)
    names = [f"w{j + 1}" for j in range(k)]
    return None if held is None else held.groupBy("lang", *names).agg(F.max("n").alias("longest"))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, share: int = 50, top: int = TOP, segment: int = SEGMENT, bits: int = BITS) -> DataFrame:
    """Each language's best `top` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase goes if a longer frequent one that holds it occurs at least `share` percent as often.
    """
    words, frequent = mined(df, text, lang, min_count, max_words, segment, bits)
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    tables = []
    for k in range(2, max_words + 1):
        names = [f"w{j + 1}" for j in range(k)]
        rows, absorbed = _scored(frequent, k), _absorbed(frequent, k)
        if absorbed is not None:
            rows = _with(rows, written(absorbed, "absorbed"), ["lang", *names]).where(F.col("longest").isNull() | (100 * F.col("longest") < share * F.col("a"))).drop("longest")
        missing = [F.lit(None).cast("long").alias(f"w{j + 1}") for j in range(k, max_words)]
        tables.append(rows.select("lang", *names, *missing, "a", "l", "r", "score", F.floor(F.log1p("score") * GRAIN).alias("grain")))
    found = written(reduce(DataFrame.union, tables), "candidates")
    # Of each language, the grains of score that hold its best phrases; so few phrases are spelled and ranked.
    upto = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("grain")))
    grains = found.groupBy("lang", "grain").count().withColumn("above", upto - F.col("count")).where(F.col("above") < top).select("lang", "grain")
    best = written(found.join(F.broadcast(grains), ["lang", "grain"], "left_semi"), "best")
    spelled = words.where(F.col("n") >= min_count).select("lang", "code", "word")
    used = reduce(DataFrame.union, [best.select("lang", F.col(f"w{j + 1}").alias("code")) for j in range(max_words)]).where("code is not null").distinct()
    spelled = written(spelled.join(used, ["lang", "code"], "left_semi"), "spelled")
    for j in range(max_words):
        best = _with(best, spelled.select("lang", F.col("code").alias(f"w{j + 1}"), F.col("word").alias(f"text{j}")), ["lang", f"w{j + 1}"])
    best = best.withColumn("phrase", F.concat_ws(" ", *(f"text{j}" for j in range(max_words))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return _with(ranked, totals, ["lang"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
