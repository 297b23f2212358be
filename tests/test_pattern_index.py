"""The pattern index against Python's ``re``, and what it costs with many rules."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from postroad.functions import pattern_index
from postroad.functions.pattern_index import PatternIndex, required_literals
from postroad.operators import filters, routing
from postroad.sources import control

WORDS = ["user", "Msg", "straße", "İx", "ſtop", "Kelvin", "kelvin", "a.b", "x_y", ".", "-", "é"]


def drawn(seed, n):
    """Patterns of escaped and bare words, classes, alternatives, repeats, inline flags and back-references."""
    draw, out = random.Random(seed), []
    while len(out) < n:
        parts = []
        for _ in range(draw.randrange(1, 4)):
            w, v = draw.choice(WORDS), draw.choice(WORDS)
            parts.append(draw.choice([
                re.escape(w), w, ".*", f"[{w[:2]}]", f"(?:{re.escape(w)}|{re.escape(v)})", re.escape(w) + "?", r"\w+", f"({re.escape(w[:2])})+", f"(?-i:{re.escape(w)})",
                f"(?={re.escape(w)})", f"(?!{re.escape(w)})", f"(?P<n_1>{re.escape(w)})(?P=n_1)", "(?>a*)", "x{,2}", "$", r"\b",
            ]))
        if pattern_index.is_pattern("".join(parts)):
            out.append("".join(parts))
    return out


@pytest.mark.parametrize("flags", [re.I, 0])
def test_index_equals_re(flags):
    patterns, draw = drawn(1, 500), random.Random(2)
    index, hits, tried = PatternIndex(patterns, flags), 0, 0
    for _ in range(1500):
        title = "".join(draw.choice(WORDS + [w.swapcase() for w in WORDS]) for _ in range(draw.randrange(4)))
        expected = [k for k, p in enumerate(patterns) if re.match(p, title, flags)]
        assert index.all(title) == expected and index.first(title) == next(iter(expected), None)
        hits, tried = hits + len(expected), tried + len(index.candidates(title))
    assert hits > 10_000 and tried < 0.7 * 1500 * len(patterns)


def test_literals_that_a_match_must_hold():
    assert required_literals(r"user\.(click|view)") == ["user."]
    assert required_literals(r".*error$") == ["error"]
    assert required_literals(r"(?:order|refund)s?") == ["order", "refund"]
    assert required_literals(r"x{0,3}(ab)+") == ["ab"]
    assert required_literals("é.*") is None and required_literals("") is None and required_literals("(a|.*)") is None
    assert pattern_index.folded("İıſK USER") == "iisk user"


def titled(spark, titles):
    return spark.createDataFrame([(t,) for t in titles], "title string")


@pytest.mark.parametrize("block", [7, 1000])
def test_rules_equal_re(spark, block):
    patterns = drawn(5, 60)
    rows = [(k, f"t{k % 11}", p) for k, p in enumerate(patterns)]
    draw = random.Random(6)
    titles = sorted({"".join(draw.choice(WORDS) for _ in range(3)) for _ in range(120)}) + [None, ""]
    df = titled(spark, titles)
    table = spark.createDataFrame(rows, "rank int, topic string, pattern string")
    expected = {t: None if t is None else next((f"t{k % 11}" for k, p in enumerate(patterns) if re.match(p, t, re.I)), None) for t in titles}
    for found in (routing.resolve_topic_table(df, table, block), routing.resolve_distinct_titles(df, table, block)):
        assert {r.title: r.topic for r in found.collect()} == expected
    include, exclude = patterns[:20], patterns[20:40]
    passes = lambda t: any(re.match(p, t, re.I) for p in include) and not any(re.match(p, t, re.I) for p in exclude)
    kept = df.where(filters.indexed_passes(spark, F.col("title"), include, exclude))
    assert {r.title for r in kept.collect()} == {t for t in titles if t is not None and passes(t)}


def test_five_thousand_rules_cost_little_more_than_fifty(spark):
    df = spark.range(400_000).select(F.format_string("shop.k%d.paid", F.col("id") % 20_000).alias("title"))

    def seconds(n):
        table = spark.createDataFrame([(k, f"t{k % 9}", rf"shop\.k{k * (20_000 // n)}\.(paid|sent)") for k in range(n)], "rank int, topic string, pattern string")
        routed = routing.resolve_topic_table(df, table)
        assert routed.where("topic is not null").count() == n * 20
        clock = time.monotonic()
        routed.groupBy("topic").count().collect()
        return time.monotonic() - clock

    few, many = min(seconds(50) for _ in range(2)), min(seconds(5000) for _ in range(2))
    assert many < 3 * few + 1


def test_python_patterns_that_java_refuses_are_usable(spark):
    document = '[{"topic":"a","patterns":["(?P<n_1>x)(?P=n_1)","y{,2}z","[[]b","q\\\\Z"]},{"topic":"b","patterns":[".*"]}]'
    bad = ['[{"topic":"a","patterns":["("]}]', '[{"topic":"a","patterns":["a","*"]}]', '[{"topic":"a","patterns":["(?<!a+)b"]}]']
    snapshots = spark.createDataFrame([(1, document), *((k + 2, d) for k, d in enumerate(bad))], "version int, data string")
    rules = control.current_rules(snapshots)
    assert {r.version for r in rules.collect()} == {1}
    found = routing.resolve_topic_table(titled(spark, ["XX", "yyz", "[b", "q", "qq", "yyyz"]), rules)
    assert {r.title: r.topic for r in found.collect()} == {"XX": "a", "yyz": "a", "[b": "a", "q": "a", "qq": "b", "yyyz": "b"}
