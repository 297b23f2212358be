"""Include and exclude filters on event titles."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postroad.functions.match import title_matches_any
from postroad.functions.pattern_index import all_matches, blocks

Transform = Callable[[DataFrame], DataFrame]

# Patterns of one index in a task: so many, and so many characters of them.
BLOCK_RULES = 100_000
BLOCK_LETTERS = 8_000_000


def title_passes(
    title: Column, include: Sequence[str] | None, exclude: Sequence[str] | None
) -> Column:
    """Include first, then exclude; an empty list is no test; exclude wins."""
    if not include and not exclude:
        raise ValueError("Empty filter params")
    included = title_matches_any(title, include) if include else F.lit(True)
    excluded = title_matches_any(title, exclude) if exclude else F.lit(False)
    return included & ~excluded


def include_events(df: DataFrame, patterns: Sequence[str] | None) -> DataFrame:
    return df.where(title_matches_any(F.col("title"), patterns)) if patterns else df


def exclude_events(df: DataFrame, patterns: Sequence[str] | None) -> DataFrame:
    return df.where(~title_matches_any(F.col("title"), patterns)) if patterns else df


def filter_events(
    df: DataFrame,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
) -> DataFrame:
    return df.where(title_passes(F.col("title"), include, exclude))


def transform_chain(df: DataFrame, transforms: Iterable[Transform]) -> DataFrame:
    """Apply in order; an event dropped by one step does not reach the next."""
    for transform in transforms:
        df = df.transform(transform)
    return df


def indexed_passes(
    spark: SparkSession, title: Column, include: Sequence[str] | None, exclude: Sequence[str] | None
) -> Column:
    """`title_passes` by an index of all patterns, for long lists and for patterns that only Python compiles."""
    if not include and not exclude:
        raise ValueError("Empty filter params")
    patterns = [*(include or ()), *(exclude or ())]
    sides = ["in"] * len(include or ()) + ["out"] * len(exclude or ())
    hits = all_matches(spark, title, patterns, sides)
    included = F.array_contains(hits, "in") if include else F.lit(True)
    return included & ~F.array_contains(hits, "out")


def with_title_hits(events: DataFrame, stories: DataFrame, block: int = BLOCK_RULES) -> DataFrame:
    """Add ``_hits``, the patterns of any story that match the title.

    Titles are looked up in an index of all different patterns, a block of ``block`` patterns at a time, however many
    stories share them.
    """
    empty = F.array().cast("array<string>")
    lists = F.concat(F.coalesce("include", empty), F.coalesce("exclude", empty))
    patterns = stories.select(F.explode(lists).alias("pattern")).where("pattern is not null").distinct().orderBy("pattern")
    found: list[str] = []
    for n, rows in enumerate(blocks(patterns.toLocalIterator(), block, BLOCK_LETTERS)):
        texts = [r.pattern for r in rows]
        found.append(f"_hits{n}")
        events = events.withColumn(found[-1], all_matches(events.sparkSession, F.col("title"), texts, texts))
    hits = F.concat(*found) if found else empty
    return events.withColumn("_hits", F.coalesce(hits, empty)).drop(*found)


def story_filter(fanned: DataFrame) -> DataFrame:
    """Per-story include and exclude lists, on events that carry their story's lists and ``_hits`` (`with_title_hits`)."""

    def is_set(listed: str) -> Column:
        return F.coalesce(F.size(listed), F.lit(0)) > 0

    def any_match(listed: str) -> Column:
        return F.arrays_overlap(F.col(listed), F.col("_hits"))

    kept = fanned.where(
        (~is_set("include") | any_match("include")) & ~(is_set("exclude") & any_match("exclude"))
    )
    return kept.drop("_hits")
