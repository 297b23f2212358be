"""Routing of events to topics, stories and sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from postroad.functions.match import title_matches
from postroad.functions.pattern_index import all_matches, blocks, first_match
from postroad.operators.filters import BLOCK_LETTERS, BLOCK_RULES, story_filter, with_title_hits
from postroad.operators.lookup import MAX_BROADCAST_ROWS, lookup_join
from postroad.session import shared_dir

Rules = Sequence[tuple[str, str]]  # (topic, pattern), first match wins

_CHAIN = 100  # rules per CASE expression


def first_topic(title: Column, rules: Rules) -> Column:
    """Topic of the first pattern that matches the title, else null."""
    chains = []
    for start in range(0, len(rules), _CHAIN):
        chain = F
        for topic, pattern in rules[start : start + _CHAIN]:
            chain = chain.when(title_matches(title, pattern), F.lit(topic))
        chains.append(chain)
    return F.coalesce(*chains) if chains else F.lit(None).cast("string")


def resolve_topic(df: DataFrame, rules: Rules | None) -> DataFrame:
    """Add ``topic`` from an ordered list of rules: stateless, one pass, no shuffle."""
    if rules is None:
        raise ValueError("Topic mappings is empty")
    seen: dict[str, str] = {}
    for topic, pattern in rules:
        seen.setdefault(pattern, topic)
    ordered = [(topic, pattern) for pattern, topic in seen.items()]
    return df.withColumn("topic", first_topic(F.col("title"), ordered))


def dedupe_patterns(rules: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A repeated pattern keeps its first topic and place."""
    return rules.groupBy(*by, "pattern").agg(
        F.min_by("topic", "rank").alias("topic"), F.min("rank").alias("rank")
    )


def _rule_blocks(rules: DataFrame, size: int) -> Iterator[list[Row]]:
    """The rules in order, in blocks whose indexes go to the tasks one by one."""
    return blocks(dedupe_patterns(rules).orderBy("rank").toLocalIterator(), size, BLOCK_LETTERS)


def resolve_topic_table(
    df: DataFrame, rules: DataFrame, block: int = BLOCK_RULES, allow_empty: bool = False
) -> DataFrame:
    """`resolve_topic` for a table ``(rank, topic, pattern)`` of any size: stateless, one pass, no shuffle.

    Each distinct title of a batch is looked up in an index of the patterns (`PatternIndex`), so an event costs about the
    same with 5,000 rules as with 50. A block of ``block`` rules is one index; a title goes on to the next block
    only if no earlier one has a match. An empty table is refused, as rules that were never set must not lose events,
    unless ``allow_empty`` says that a valid document without rules is meant.
    """
    found: list[str] = []
    for n, rows in enumerate(_rule_blocks(rules, block)):
        title = F.when(F.coalesce(*found).isNull(), F.col("title")) if found else F.col("title")
        topic = first_match(df.sparkSession, title, [r.pattern for r in rows], [r.topic for r in rows])
        found.append(f"_topic{n}")
        df = df.withColumn(found[-1], topic)
    if not found and not allow_empty:
        raise ValueError("Topic mappings is empty")
    return df.withColumn("topic", F.coalesce(*found) if found else F.lit(None).cast("string")).drop(*found)


def resolve_distinct_titles(
    df: DataFrame,
    rules: DataFrame,
    block: int = BLOCK_RULES,
    spread_by: Sequence[str] = (),
    max_titles: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Resolve each distinct title of the whole table once, then look the events' titles up.

    Pays off for few titles that are spread over many tasks. The distinct titles are written before they are looked up, as the
    optimizer would test for a match below the grouping, title by title of all events; the looked-up ones are
    written once, measured and joined from there.
    """
    spark = df.sparkSession
    names = shared_dir(spark, "names")
    df.select("title").where(F.col("title").isNotNull()).distinct().write.parquet(names)
    titles = spark.read.schema("title string").parquet(names)
    resolved = resolve_topic_table(titles, rules, block, allow_empty=True).where(F.col("topic").isNotNull())
    path = shared_dir(spark, "titles")
    resolved.select("title", "topic").write.parquet(path)
    known = spark.read.schema("title string, topic string").parquet(path)
    return lookup_join(df, known, ["title"], "left", spread_by, max_rows=max_titles)


def unrouted_events(df: DataFrame) -> DataFrame:
    """Resolved events without a topic, as failures."""
    return df.where(F.col("topic").isNull()).withColumns({
        "error_kind": F.lit("NoMatchedKafkaTopicError"),
        "error": F.lit(""),
    })


def subscriptions(topics: DataFrame, stories: DataFrame, block: int = BLOCK_RULES) -> DataFrame:
    """``(topic, story_id)`` pairs: by topic list, or by topic pattern over ``topics``.

    Each distinct topic is looked up in an index of the topic patterns, a block of them at a time.
    """
    pairs = stories.select("story_id", F.explode("topics").alias("topic"))
    names = topics.select("topic").distinct()
    patterned = stories.select("story_id", F.col("topic_pattern").alias("pattern")).where("pattern is not null")
    for rows in blocks(patterned.toLocalIterator(), block, BLOCK_LETTERS):
        hits = all_matches(names.sparkSession, F.col("topic"), [r.pattern for r in rows], [r.story_id for r in rows], 0)
        pairs = pairs.union(names.withColumn("_hits", hits).select(F.explode("_hits").alias("story_id"), "topic"))
    return pairs.distinct()


def story_fanout(
    events: DataFrame,
    stories: DataFrame,
    topics: DataFrame | None = None,
    spread_by: Sequence[str] = (),
    block: int = BLOCK_RULES,
) -> DataFrame:
    """One copy of an event for each story subscribed to its topic.

    Patterns are matched against distinct topics, so the events meet the stories in an
    equi-join. ``topics`` names the topics if they are known; else they are read from
    the events' topic column. The pairs are written once, measured and joined from there.
    """
    spark = events.sparkSession
    pairs = subscriptions(events if topics is None else topics, stories, block).join(stories, "story_id")
    path = shared_dir(spark, "subscriptions")
    pairs.write.parquet(path)
    known = spark.read.schema(pairs.schema).parquet(path)
    return lookup_join(events, known, ["topic"], "inner", spread_by)


def story_events(
    events: DataFrame,
    stories: DataFrame,
    topics: DataFrame | None = None,
    spread_by: Sequence[str] = (),
    block: int = BLOCK_RULES,
) -> DataFrame:
    """`story_fanout`, then `story_filter`, with each title tested before the fan-out."""
    tested = with_title_hits(events, stories, block)
    return story_filter(story_fanout(tested, stories, events if topics is None else topics, spread_by, block))


def dispatch_to_sink(events: DataFrame, sinks: DataFrame) -> DataFrame:
    """Events of requests that name a sink, with the sink's parameters.

    An unknown sink fails its whole request: one row under the id ``root``.
    """
    params = [c for c in sinks.columns if c != "sink_id"]
    asking = events.where(F.col("sink_id").isNotNull())
    joined = lookup_join(asking, sinks.withColumn("_known", F.lit(True)), ["sink_id"])
    known = F.col("_known").isNotNull()
    of_request = ("request_id", "sink_id", "pos")
    of_event = [F.when(known, F.col(c)).alias(c) for c in events.columns if c not in (*of_request, "id")]
    return joined.where(known | (F.col("pos") == 0)).select(
        *of_request,
        F.when(known, F.col("id")).otherwise("root").alias("id"),
        *of_event,
        *params,
        F.when(~known, "InvalidArgumentError").alias("error_kind"),
        F.when(~known, F.format_string("Sink '%s' not found.", "sink_id")).alias("error"),
    )
