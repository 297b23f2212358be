"""Title patterns: anchored at the start, case-insensitive, Unicode-aware.

All pattern semantics live here. The embedded flags make Java's regex engine agree
with Python's ``re.match(p, title, re.I)``: ``i``/``u`` fold case beyond ASCII, ``U``
makes ``\\w`` and friends Unicode classes, ``d`` leaves ``\\n`` as the only line end.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_PREFIX = r"(?iudU)\A(?:"
_CASE_SENSITIVE = r"(?dU)\A(?:"
_NAMED_GROUP = r"(?<!\\)\(\?P<"
_NAMED_REFERENCE = r"(?<!\\)\(\?P=(\w+)\)"


def anchored(pattern: str, prefix: str = _PREFIX) -> str:
    """The Java form of a start-anchored pattern."""
    pattern = re.sub(_NAMED_GROUP, "(?<", pattern)
    pattern = re.sub(_NAMED_REFERENCE, r"\\k<\1>", pattern)
    return f"{prefix}{pattern})"


def anchored_column(pattern: Column) -> Column:
    """`anchored` for patterns held in a column."""
    pattern = F.regexp_replace(pattern, _NAMED_GROUP, "(?<")
    pattern = F.regexp_replace(pattern, _NAMED_REFERENCE, r"\\k<$1>")
    return F.concat(F.lit(_PREFIX), pattern, F.lit(")"))


def title_matches(title: Column, pattern: str) -> Column:
    """Literal pattern: compiled once per task, stays inside generated code."""
    return title.rlike(anchored(pattern))


def title_matches_any(title: Column, patterns: Sequence[str]) -> Column:
    """True if any pattern matches; patterns are not joined, so back-references hold."""
    return reduce(or_, [title_matches(title, p) for p in patterns], F.lit(False))


def title_matches_column(title: Column, pattern: Column) -> Column:
    """Pattern from a column: compiled whenever the pattern changes."""
    return F.call_function("rlike", title, anchored_column(pattern))


def topic_matches(topic: Column, pattern: str) -> Column:
    """Topic patterns of subscriptions: anchored at the start, case-sensitive."""
    return topic.rlike(anchored(pattern, _CASE_SENSITIVE))


def is_valid_pattern(pattern: Column) -> Column:
    """True if the pattern compiles, alone and in its anchored form."""

    def compiles(p: Column) -> Column:
        return F.try_reflect(
            F.lit("java.util.regex.Pattern"), F.lit("compile"), p
        ).isNotNull()

    plain = F.regexp_replace(pattern, _NAMED_GROUP, "(?<")
    plain = F.regexp_replace(plain, _NAMED_REFERENCE, r"\\k<$1>")
    return pattern.isNotNull() & compiles(plain) & compiles(anchored_column(pattern))
