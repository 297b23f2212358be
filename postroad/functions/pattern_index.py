"""An index of many title patterns: a text is tested against those patterns alone whose literals it holds.

Each pattern is looked through for literal text that every match must contain (`required_literals`). All literals stand in one
Aho-Corasick automaton; one pass over a title finds the patterns that may match it, and these are tested in order, together with
the patterns that have no literal. So the work for a title grows with what is in the title, not with the number of patterns.

Patterns are Python's: a match is ``re.match``, anchored at the start.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Iterator, Sequence
from re import _constants as ops
from re import _parser

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: More alternatives than this in one pattern are not worth their places in the automaton.
ALTERNATIVES = 16
#: Answers that a process remembers; they are forgotten all at once.
REMEMBERED = 200_000

# The characters beyond ASCII that match ASCII letters in any case.
_FOLD = {0x130: "i", 0x131: "i", 0x17F: "s", 0x212A: "k"}


def folded(text: str) -> str:
    """A text in which characters that match one ASCII letter in any case are that letter in lower case."""
    return text.translate(_FOLD).lower()


def _better(a: list[str] | None, b: list[str] | None) -> list[str] | None:
    """The more telling of two sets of literals: the one whose shortest is longer."""
    if a is None or b is None:
        return b if a is None else a
    return b if min(map(len, b)) > min(map(len, a)) else a


def _required(tree: Iterable) -> list[str] | None:
    """Literals of which every match of a sequence contains one; None if there are none."""
    best: list[str] | None = None
    run = ""

    def ended(best: list[str] | None) -> list[str] | None:
        return _better(best, [run] if run else None)

    for op, value in tree:
        if op is ops.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        if op is ops.AT:  # stands between characters
            continue
        best, run = ended(best), ""
        inner: list[str] | None = None
        if op is ops.SUBPATTERN:
            inner = _required(value[3])
        elif op is ops.ATOMIC_GROUP:
            inner = _required(value)
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
            inner = _required(value[2]) if value[0] > 0 else None
        elif op is ops.BRANCH:
            parts = [_required(branch) for branch in value[1]]
            if all(parts) and sum(map(len, parts)) <= ALTERNATIVES:
                inner = sorted({x for part in parts for x in part})
        elif op is ops.IN and len(value) <= ALTERNATIVES and all(k is ops.LITERAL and c < 128 for k, c in value):
            inner = sorted({chr(c).lower() for _, c in value})
        best = _better(best, inner)
    return ended(best)


def required_literals(pattern: str, flags: int = re.I) -> list[str] | None:
    """Folded ASCII texts of which at least one stands in every text that the pattern matches; None if nothing is known."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return _required(_parser.parse(pattern, flags))


def is_pattern(pattern: str | None) -> bool:
    """Whether Python compiles it."""
    if pattern is None:
        return False
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            re.compile(pattern)
    except (re.error, OverflowError, RecursionError):
        return False
    return True


class PatternIndex:
    """Patterns in order. A pattern is compiled when it is first tried."""

    def __init__(self, patterns: Sequence[str], flags: int = re.I, literals: Sequence[list[str] | None] | None = None):
        self.patterns, self.flags = list(patterns), flags
        self.literals = [required_literals(p, flags) for p in self.patterns] if literals is None else literals
        held: dict[str, list[int]] = {}
        for place, literals in enumerate(self.literals):
            for literal in literals or ():
                held.setdefault(literal, []).append(place)
        self.always = [place for place, literals in enumerate(self.literals) if literals is None]
        self.automaton = ahocorasick.Automaton()
        for literal, places in held.items():
            self.automaton.add_word(literal, places)
        if held:
            self.automaton.make_automaton()
        self.has_words = bool(held)
        self.compiled: dict[int, re.Pattern] = {}
        self.first_of: dict[str, int | None] = {}
        self.all_of: dict[str, list[int]] = {}

    def candidates(self, text: str) -> list[int]:
        """Places of the patterns that may match, in order."""
        if not self.has_words:
            return self.always
        found = set(self.always)
        for _, places in self.automaton.iter(folded(text)):
            found.update(places)
        return sorted(found)

    def matches(self, text: str) -> Iterator[int]:
        """Places of the patterns that match, in order."""
        for place in self.candidates(text):
            pattern = self.compiled.get(place)
            if pattern is None:
                with warnings.catch_warnings():
                    warnings.simplefilter("ignore")
                    pattern = self.compiled[place] = re.compile(self.patterns[place], self.flags)
            if pattern.match(text):
                yield place

    def first(self, text: str | None) -> int | None:
        if text is None:
            return None
        if text not in self.first_of:
            if len(self.first_of) >= REMEMBERED:
                self.first_of.clear()
            self.first_of[text] = next(self.matches(text), None)
        return self.first_of[text]

    def all(self, text: str | None) -> list[int] | None:
        if text is None:
            return None
        if text not in self.all_of:
            if len(self.all_of) >= REMEMBERED:
                self.all_of.clear()
            self.all_of[text] = list(self.matches(text))
        return self.all_of[text]


def _distinct(texts: pa.Array) -> tuple[list[str | None], pa.Array]:
    coded = texts.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices


class _Sent:
    """An index for tasks: sent as plain texts with their literals, and built once in each task that uses it."""

    def __init__(self, spark: SparkSession, patterns: Sequence[str], answers: Sequence[str], flags: int):
        literals = [required_literals(p, flags) for p in patterns]
        self.shared = spark.sparkContext.broadcast((list(patterns), flags, literals, list(answers)))
        self.built: tuple[PatternIndex, list[str]] | None = None

    def get(self) -> tuple[PatternIndex, list[str]]:
        if self.built is None:
            patterns, flags, literals, answers = self.shared.value
            self.built = PatternIndex(patterns, flags, literals), answers
        return self.built


def first_match(spark: SparkSession, text: Column, patterns: Sequence[str], answers: Sequence[str], flags: int = re.I) -> Column:
    """The answer of the first pattern that matches, else null. Each distinct text of a batch is looked up once."""
    sent = _Sent(spark, patterns, answers, flags)

    @F.arrow_udf(T.StringType())
    def answer(texts: pa.Array) -> pa.Array:
        index, answers = sent.get()
        names, places = _distinct(texts)
        found = [index.first(name) for name in names]
        return pa.array([None if k is None else answers[k] for k in found], pa.string()).take(places)

    return answer(text)


def all_matches(spark: SparkSession, text: Column, patterns: Sequence[str], answers: Sequence[str], flags: int = re.I) -> Column:
    """The answers of all patterns that match, in order; null for a null text."""
    sent = _Sent(spark, patterns, answers, flags)

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def found(texts: pa.Array) -> pa.Array:
        index, answers = sent.get()
        names, places = _distinct(texts)
        hits = [index.all(name) for name in names]
        return pa.array([None if h is None else [answers[k] for k in h] for h in hits], pa.list_(pa.string())).take(places)

    return found(text)


def blocks(rows: Iterable, size: int, letters: int, text: str = "pattern") -> Iterator[list]:
    """Runs of rows with at most `size` patterns and about `letters` characters, which is what an index in a task may hold."""
    block, held = [], 0
    for row in rows:
        block.append(row)
        held += len(row[text])
        if len(block) == size or held >= letters:
            yield block
            block, held = [], 0
    if block:
        yield block


def compiles(pattern: Column) -> Column:
    """Whether Python compiles the pattern; each distinct one of a batch is tried once."""

    @F.arrow_udf(T.BooleanType())
    def tried(patterns: pa.Array) -> pa.Array:
        names, places = _distinct(patterns)
        return pa.compute.fill_null(pa.array([is_pattern(name) for name in names], pa.bool_()).take(places), False)

    return tried(pattern)


def compile_all(patterns: Column) -> Column:
    """Whether Python compiles every pattern of a list; null for a null list."""

    @F.arrow_udf(T.BooleanType())
    def tried(lists: pa.Array) -> pa.Array:
        lists = lists.cast(pa.list_(pa.string()))
        known: dict[str | None, bool] = {}
        out = []
        for patterns in lists.to_pylist():
            for p in patterns or ():
                if p not in known:
                    known[p] = is_pattern(p)
            out.append(None if patterns is None else all(known[p] for p in patterns))
        return pa.array(out, pa.bool_())

    return tried(patterns)
