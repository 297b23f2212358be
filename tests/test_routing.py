"""Routing, fan-out, filters and lookups."""

import random
import re

import pytest
from pyspark.sql import functions as F

from postroad.operators import filters, lookup, routing

PARTS = ["order", "cart", "Refund", "stock_low", "x1", "pay"]


def drawn_rules(draw, n):
    """Rules of literal parts, classes, optional ends and catch-alls, in random order."""
    def pattern():
        head = re.escape(draw.choice(PARTS))
        return draw.choice([head + r"\.", head + r"[a-d]*$", head + "?", rf"(?:{head}|{draw.choice(PARTS)})\.\w+", rf".*{head}$"])

    return [(f"topic-{draw.randrange(4)}", pattern()) for _ in range(n)]


def drawn_titles(draw, n):
    return sorted({draw.choice(["", "."]).join([draw.choice(PARTS).swapcase(), draw.choice(["a", "bcd", "made", "Paid.x"])]) for _ in range(n)})


def first_match(rules, title):
    return next((t for t, p in rules if re.match(p, title, re.I)), None)


CASES = []
for seed in range(4):
    draw = random.Random(seed)
    CASES.append((drawn_rules(draw, 8), drawn_titles(draw, 30)))
RULES, TITLES = CASES[0]
EXPECTED = {t: first_match(RULES, t) for t in TITLES}


def titled(spark, titles):
    return spark.createDataFrame([(t,) for t in titles], "title string")


def topics(df):
    return {r.title: r.topic for r in df.collect()}


def table(spark, rules):
    rows = [(i * 3, t, p) for i, (t, p) in enumerate(rules)]
    return spark.createDataFrame(rows, "rank int, topic string, pattern string")


@pytest.mark.parametrize("case", range(len(CASES)))
def test_first_match(spark, case):
    rules, titles = CASES[case]
    expected = {t: first_match(rules, t) for t in titles}
    df = titled(spark, titles)
    assert topics(routing.resolve_topic(df, rules)) == expected
    assert topics(routing.resolve_topic_table(df, table(spark, rules))) == expected


@pytest.mark.parametrize("limits", [{}, {"block": 2}, {"max_titles": 1}, {"block": 1, "max_titles": 1}])
def test_distinct_titles(spark, limits):
    df = titled(spark, list(EXPECTED) * 3).withColumn("id", F.monotonically_increasing_id())
    found = routing.resolve_distinct_titles(df, table(spark, RULES), spread_by=["id"], **limits)
    assert found.count() == 3 * len(EXPECTED)
    assert topics(found) == EXPECTED


def test_no_rules(spark):
    df = titled(spark, ["a"])
    with pytest.raises(ValueError):
        routing.resolve_topic(df, None)
    assert topics(routing.resolve_topic(df, [])) == {"a": None}
    with pytest.raises(ValueError):
        routing.resolve_topic_table(df, table(spark, []))
    assert topics(routing.resolve_topic_table(df, table(spark, []), allow_empty=True)) == {"a": None}
    assert topics(routing.resolve_distinct_titles(df, table(spark, []))) == {"a": None}
    assert routing.unrouted_events(routing.resolve_topic(df, [])).first().error_kind == "NoMatchedKafkaTopicError"


def test_many_rules(spark):
    rules = [(f"t{i}", rf"k{i}\b") for i in range(250)]
    df = titled(spark, [f"K{i}.x" for i in range(0, 260, 7)])
    expected = {f"K{i}.x": f"t{i}" if i < 250 else None for i in range(0, 260, 7)}
    assert topics(routing.resolve_topic(df, rules)) == expected


@pytest.mark.parametrize("seed", range(3))
def test_changed_rules(spark, seed):
    """Rules that are shuffled, cut and added to are taken as they stand."""
    draw = random.Random(100 + seed)
    rules, titles = drawn_rules(draw, 6), drawn_titles(draw, 20)
    for _ in range(3):
        assert topics(routing.resolve_topic(titled(spark, titles), rules)) == {t: first_match(rules, t) for t in titles}
        rules = draw.sample(rules, draw.randint(1, len(rules))) + drawn_rules(draw, draw.randint(0, 2))


def test_repeated_pattern_keeps_first_topic(spark):
    rules = [("a", "x"), ("b", "y"), ("c", "x")]
    kept = {r.pattern: r.topic for r in routing.dedupe_patterns(table(spark, rules)).collect()}
    assert kept == {"x": "a", "y": "b"}


def test_back_references_stay_apart(spark):
    df = titled(spark, ["aa", "bb", "ab"])
    kept = filters.include_events(df, [r"(a)\1", r"(b)\1"]).collect()
    assert sorted(r.title for r in kept) == ["aa", "bb"]


def test_filter_rules(spark):
    df = titled(spark, ["user.a", "USER.b", "x.user", "user.err"])
    with pytest.raises(ValueError):
        filters.filter_events(df, [], None)
    kept = filters.filter_events(df, [r"user\."], [r".*err"]).collect()
    assert sorted(r.title for r in kept) == ["USER.b", "user.a"]
    assert filters.include_events(df, []).count() == filters.exclude_events(df, None).count() == 4


STORIES = [
    ("s1", ["t1"], None, ["user"], None),
    ("s2", None, "t[12]", None, [".*x"]),
    ("s3", ["t2", "t1"], "t1", [], []),
    ("s4", ["t9"], None, None, None),
    ("s5", None, "T1", None, None),
]


@pytest.mark.parametrize("block", [1, 1000])
def test_stories_against_a_loop(spark, block):
    stories = spark.createDataFrame(
        STORIES, "story_id string, topics array<string>, topic_pattern string, include array<string>, exclude array<string>"
    )
    rows = [(f"{i}", f"t{i % 3 + 1}", ["user.a", "user.x", "msg.x", "Msg"][i % 4]) for i in range(24)]
    events = spark.createDataFrame(rows, "id string, topic string, title string")
    found = routing.story_events(events, stories, block=block)

    def matches(patterns, title):
        return any(re.match(p, title, re.I) for p in patterns)

    expected = sorted(
        (s, i)
        for s, listed, pattern, include, exclude in STORIES
        for i, topic, title in rows
        if (topic in (listed or []) or (pattern and re.match(pattern, topic)))
        and (not include or matches(include, title))
        and not (exclude and matches(exclude, title))
    )
    assert sorted((r.story_id, r.id) for r in found.collect()) == expected


def test_lookup_is_broadcast_only_when_small(spark):
    facts = spark.range(2000).selectExpr("id", "if(id % 3 = 0, 0, id % 50) as k")
    small = spark.range(40).selectExpr("id as k", "id * 2 as v")
    plans = {}
    for limit in (1000, 10):
        joined = lookup.lookup_join(facts, small, ["k"], "left", spread_by=["id"], max_rows=limit)
        plans[limit] = joined._jdf.queryExecution().optimizedPlan().toString()
        rows = {r.id: r.v for r in joined.collect()}
        assert rows == {r.id: (r.k * 2 if r.k < 40 else None) for r in facts.collect()}
    assert "broadcast" in plans[1000] and "_salt" not in plans[1000]
    assert "broadcast" not in plans[10] and "_salt" in plans[10]


def test_dispatch(spark):
    rows = [("r1", 0, "a", "s1"), ("r1", 1, "b", "s1"), ("r2", 0, "c", "nope"), ("r2", 1, "d", "nope"), ("r3", 0, "e", None)]
    events = spark.createDataFrame(rows, "request_id string, pos int, id string, sink_id string")
    sinks = spark.createDataFrame([("s1", "http://example.invalid/")], "sink_id string, url string")
    found = routing.dispatch_to_sink(events, sinks).orderBy("request_id", "pos").collect()
    assert [(r.request_id, r.id, r.url, r.error) for r in found] == [
        ("r1", "a", "http://example.invalid/", None),
        ("r1", "b", "http://example.invalid/", None),
        ("r2", "root", None, "Sink 'nope' not found."),
    ]


def test_only_distinct_titles_are_looked_up(spark, monkeypatch):
    import pyarrow as pa

    seen = spark.sparkContext.accumulator(0)

    def counting(session, text, patterns, answers):
        @F.arrow_udf("string")
        def found(texts: pa.Array) -> pa.Array:
            seen.add(len(texts))
            return pa.array([answers[0] if t in patterns else None for t in texts.to_pylist()], pa.string())

        return found(text)

    monkeypatch.setattr(routing, "first_match", counting)
    df = spark.range(20_000, numPartitions=4).select("id", F.concat(F.lit("t"), F.col("id") % 3).alias("title"))
    rules = spark.createDataFrame([(0, "a", "t0"), (1, "b", "t1")], "rank int, topic string, pattern string")
    routed = routing.resolve_distinct_titles(df, rules, block=1, spread_by=["id"], max_titles=1)
    assert {(r.title, r.topic, r.n) for r in routed.groupBy("title", "topic").agg(F.count("*").alias("n")).collect()} == {
        ("t0", "a", 6667), ("t1", "b", 6667), ("t2", None, 6666)
    }
    assert seen.value <= 12
