"""Language identification by mixture inference: a text is words drawn from several languages in unknown proportions.

Words and likelihoods. Texts are lower-cased; words are runs of ASCII letters and characters beyond ASCII. A language gives a word the
product of its bytes' probabilities, each after the three bytes before it (a blank stands at both ends), interpolated from the
counts of 1 to 4 bytes. Counts of 3 and 4 bytes are kept in `SLOTS` hashed slots, so a language takes 1.3 MB whatever
it was learned from, and that table is what goes to the tasks.

Learning. At most about `max_per_language` labelled documents of each language, whole, chosen by a hash of id and text; this bounds the
fit alone. All labelled documents whose crc32(id as text) mod 4 is not 2 are open to the choice. Every text of the table is then judged.

Inference, for each text. Expectation-maximisation over all learned languages gives proportions. A set of languages is then grown from the one that explains
the whole text best: the language of the greatest proportion joins next, proportions are estimated anew within the set, and it stays if the
log likelihood grows by more than `PENALTY` * log(1 + words). Languages that explain less than one word do not ask. The prediction is the
language of the greatest proportion in the set, and the score is this proportion.

Defined results: null texts and texts without a letter are `und` with score 0 and no languages, and so is everything if nothing could be learned.
Null ids are documents like others (crc32 of the empty text). Repeated rows give a row each. Ties go to the smaller language name. Very long texts are read whole, word by
distinct word. An empty table gives no rows. Only the named columns are read, so others may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad.llm.arrays import Words, chunks, counted, mixed
from postroad.llm.shared import lookup, written

MAX_PER_LANGUAGE = 5000
PENALTY = 2.0
STEPS = 15
#: Weight of the shorter context in an interpolation.
BELOW = 5.0
SLOTS = 1 << 17
ORDERS = 4
#: Where the slots of 1, 2, 3 and 4 bytes begin, and where they end.
STARTS = [0, 1 << 8, (1 << 8) + (1 << 16), (1 << 8) + (1 << 16) + SLOTS, (1 << 8) + (1 << 16) + 2 * SLOTS]
#: Numbers that a task holds at once in a table of words by languages.
AT_ONCE = 4_000_000
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2

_LETTERS = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: str) -> Column:
    """Whether a document is kept from learning."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


def _slots(words: Words, chosen: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each byte of the chosen words and the blank after them, the slots of the 1 to 4 bytes that end there, and where each word begins."""
    sizes = words.end[chosen] - words.start[chosen]
    begins = np.concatenate([[0], np.cumsum(sizes + ORDERS)])
    line = np.full(int(begins[-1]), 32, np.uint8)  # three blanks, the word, one blank
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    line[np.repeat(begins[:-1] + ORDERS - 1, sizes) + inside] = words.data[np.repeat(words.start[chosen], sizes) + inside]
    keep = np.ones(len(line), bool)
    for k in range(ORDERS - 1):
        keep[begins[:-1] + k] = False
    at = np.flatnonzero(keep)
    wide, key, out = line.astype(np.uint64), np.zeros(len(at), np.uint64), []
    for order in range(ORDERS):
        key = key | wide[at - order] << np.uint64(8 * order)
        slot = key if order < 2 else mixed(key * _PRIME) & np.uint64(SLOTS - 1)
        out.append(slot.astype(np.int64) + STARTS[order])
    return out, begins[:-1] - np.arange(len(sizes)) * (ORDERS - 1)


def _context_slots(slots: list[np.ndarray], begins: np.ndarray) -> list[np.ndarray]:
    """The slots of the contexts: those of one byte less that end at the byte before, and at a word's begin those of blanks."""
    blanks = [32, 32 << 8 | 32, 32 << 16 | 32 << 8 | 32]
    out = []
    for order in range(1, ORDERS):
        before = np.empty_like(slots[order - 1])
        before[1:] = slots[order - 1][:-1]
        code = np.uint64(blanks[order - 1])
        before[begins] = int(code if order < 3 else mixed(np.array([code]) * _PRIME)[0] & np.uint64(SLOTS - 1)) + STARTS[order - 1]
        out.append(before)
    return out


def _lowered(batch: pa.RecordBatch, column: int) -> pa.RecordBatch:
    return batch.set_column(column, batch.schema.names[column], pc.utf8_lower(batch.column(column)))


def learned(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_per_language: int = MAX_PER_LANGUAGE) -> DataFrame:
    """(lang, slot, n): how often each run of 1 to 4 bytes occurs in the documents that a language is learned from."""
    rows = df.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull() & ~held_out(key)).select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"), F.pmod(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")), F.lit(1 << 30)).alias("draw"))
    shares = written(rows.groupBy("lang").agg(F.ceil(F.lit(float(max_per_language << 30)) / F.count(F.lit(1))).alias("share")), "shares")
    rows = lookup(rows, shares, ["lang"]).where("draw < share").select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, data, offsets in chunks(_lowered(batch, 1), 1):
                words = Words(data, offsets, _LETTERS)
                names = part.column(0).to_pylist()
                for name in set(names):
                    mine = np.flatnonzero(np.array([n == name for n in names])[words.row])
                    if len(mine):
                        sums = held.setdefault(name, np.zeros(STARTS[-1], np.int64))
                        slots, begins = _slots(words, mine)
                        # Blanks before a word count as a context of its first bytes.
                        blank = [s[begins] for s in _context_slots(slots, begins)]
                        sums += np.bincount(np.concatenate([*slots, *blank]), minlength=STARTS[-1])
        for name, sums in held.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(sums[at])], names=["lang", "slot", "n"])

    return rows.mapInArrow(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


class Model:
    """The learned languages in order, and their counts: a row for each slot, a column for each language."""

    def __init__(self, names: list[str], slots: np.ndarray, of: np.ndarray, n: np.ndarray):
        self.names = names
        self.counts = np.zeros((STARTS[-1], len(names)), np.float32)
        self.counts[slots, of] = n
        self.all = self.counts[: STARTS[1]].sum(axis=0)

    @classmethod
    def of(cls, table: DataFrame) -> Model:
        """From a result of `learned`, which has at most STARTS[-1] rows for each language."""
        rows = table.toArrow()
        langs = np.array(rows.column("lang").to_pylist(), object)
        names = sorted(set(langs.tolist()))
        place = {name: k for k, name in enumerate(names)}
        return cls(names, rows.column("slot").to_numpy(), np.array([place[x] for x in langs], np.int64), rows.column("n").to_numpy())

    def likelihoods(self, words: Words, chosen: np.ndarray) -> np.ndarray:
        """The log likelihood of each chosen word in each language."""
        out = np.zeros((len(chosen), len(self.names)))
        sizes = np.cumsum(words.end[chosen] - words.start[chosen] + 1)
        first = 0
        while first < len(chosen):
            limit = (sizes[first - 1] if first else 0) + max(1, AT_ONCE // len(self.names))
            last = max(first + 1, int(np.searchsorted(sizes, limit, "right")))
            slots, begins = _slots(words, chosen[first:last])
            contexts = _context_slots(slots, begins)
            p = (self.counts[slots[0]] + 0.5) / (self.all + 128)
            for order in range(1, ORDERS):
                of = self.counts[contexts[order - 1]]
                p = (np.minimum(self.counts[slots[order]], of) + BELOW * p) / (of + BELOW)
            out[first:last] = np.add.reduceat(np.log(p), begins, axis=0)
            first = last
        return out


def _proportions(likely: np.ndarray, times: np.ndarray, begins: np.ndarray, of: np.ndarray, allowed: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for many texts at once: proportions (texts by languages) and log likelihoods.

    Rows of `likely` are the words of the texts, `times` how often each stands there, `of` its text, `begins` each text's first row.
    """
    masked = np.where(allowed[of], likely, -np.inf)
    top = masked.max(axis=1)
    near = np.exp(masked - top[:, None])
    total = np.add.reduceat(times, begins)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for step in range(steps + 1):
        mix = near * share[of]
        whole = mix.sum(axis=1)
        if step == steps:
            break
        share = np.add.reduceat(mix * (times / np.maximum(whole, 1e-300))[:, None], begins, axis=0) / total[:, None]
    return share, np.add.reduceat(times * (np.log(np.maximum(whole, 1e-300)) + top), begins)


def infer(likely: np.ndarray, times: np.ndarray, begins: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> np.ndarray:
    """The proportions of the languages chosen for each text; see the head of this module."""
    texts, langs = len(begins), likely.shape[1]
    sizes = np.diff(np.append(begins, len(likely)))
    of = np.repeat(np.arange(texts), sizes)
    n = np.add.reduceat(times, begins)
    price = penalty * np.log1p(n)
    wanted, _ = _proportions(likely, times, begins, of, np.ones((texts, langs), bool), steps)
    alone = np.add.reduceat(likely * times[:, None], begins, axis=0)
    chosen = np.zeros((texts, langs), bool)
    chosen[np.arange(texts), alone.argmax(axis=1)] = True
    reached, share = alone.max(axis=1), chosen.astype(float)
    wanted = np.where(wanted * n[:, None] >= 1, wanted, 0)
    open_ = np.arange(texts)
    while True:
        asks = np.where(chosen[open_], 0, wanted[open_])
        open_, asks = open_[asks.max(axis=1) > 0], asks[asks.max(axis=1) > 0]
        if not len(open_):
            return share
        grown = chosen[open_]
        grown[np.arange(len(open_)), asks.argmax(axis=1)] = True
        rows = np.flatnonzero(np.isin(of, open_))
        own = np.cumsum(np.concatenate([[0], sizes[open_][:-1]]))
        found, value = _proportions(likely[rows], times[rows], own, np.repeat(np.arange(len(open_)), sizes[open_]), grown, steps)
        better = value > reached[open_] + price[open_]
        open_ = open_[better]
        chosen[open_], share[open_], reached[open_] = grown[better], found[better], value[better]


def identify(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", table: DataFrame | None = None, max_per_language: int = MAX_PER_LANGUAGE, penalty: float = PENALTY) -> DataFrame:
    """key, held_out, lang_pred, score, languages (a text's set, greatest proportion first) and shares (their proportions).

    `table` is a result of `learned`; without it, it is learned from `df`.
    """
    table = written(learned(df, text, lang, key, max_per_language) if table is None else table, "languages")
    model = Model.of(table)
    shared = df.sparkSession.sparkContext.broadcast(model)
    limit = max(100_000, 8_000_000 // max(4, len(model.names)))
    names = [key, "held_out", "lang_pred", "score", "languages", "shares"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            letters = pc.fill_null(pc.match_substring_regex(batch.column(2), r"\pL"), False)
            batch = _lowered(batch.append_column("letters", letters), 2)
            for part, data, offsets in chunks(batch, 2, limit):
                found, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                sets: list[list[str]] = [[] for _ in found]
                shares: list[list[float]] = [[] for _ in found]
                words = Words(data, offsets, _LETTERS)
                full = np.flatnonzero(part.column(3).to_numpy(zero_copy_only=False) & (words.count > 0))
                if len(full) and model.names:
                    _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
                    mine = np.isin(words.row, full)
                    pairs, (times,) = counted(words.row[mine].astype(np.uint64) << np.uint64(32) | which[mine].astype(np.uint64), [np.ones(int(mine.sum()))])
                    rows = (pairs >> np.uint64(32)).astype(np.int64)
                    likely = model.likelihoods(words, first)[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)]
                    proportions = infer(likely, times, np.searchsorted(rows, full), penalty)
                    for k, p in zip(full.tolist(), proportions, strict=True):
                        order = [j for j in np.argsort(-p, kind="stable") if p[j] > 0]
                        sets[k], shares[k] = [model.names[j] for j in order], [float(p[j]) for j in order]
                        found[k], score[k] = sets[k][0], min(shares[k][0], 1.0)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found), pa.array(score), pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))], names=names)

    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("languages", T.ArrayType(T.StringType())), T.StructField("shares", T.ArrayType(T.DoubleType()))])
    return df.select(F.col(f"`{key}`"), held_out(key), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)
