"""Title patterns against Python's own matching."""

import re

import pytest
from pyspark.sql import functions as F

from postroad.functions.match import anchored_column, is_valid_pattern, title_matches, topic_matches

TITLES = [
    "user.login", "User.Login", "my.user.login", "user_.login", "", "user\n.login", "éCOLE.x", "École.x",
    "straße.x", "STRASSE.x", "user\r.x", "ab\nab", "aa.b", "user.login\n", "Kelvin.x", "ſ.x", "用户.登录", "a١b",
]
PATTERNS = [
    r"user\..*", r"USER\.", r".*", r"a|user", r"^user", r"user\.login$", r"école", r"STRASSE", r"\w+\.x", r"u.er..login",
    r"(\w)\1\.", r"(?P<a>a)(?P=a)", r"user.\.login", r"(?:user|école)\.", r"[^.]+\.login\Z", r"k", r"\d", r"a\d", r".+\.x", r"",
]


@pytest.mark.parametrize("pattern", [p for p in PATTERNS if r"\Z" not in p])
def test_title_matches_like_python(spark, pattern):
    df = spark.createDataFrame([(t,) for t in TITLES], "title string")
    got = {r.title: r.m for r in df.select("title", title_matches(F.col("title"), pattern).alias("m")).collect()}
    assert got == {t: bool(re.match(pattern, t, re.I)) for t in TITLES}


def test_pattern_column_equals_literal(spark):
    patterns = [p for p in PATTERNS if r"\Z" not in p]
    pairs = spark.createDataFrame([(t, p) for t in TITLES for p in patterns], "title string, pattern string")
    rows = pairs.select("title", "pattern", F.call_function("rlike", "title", anchored_column(F.col("pattern"))).alias("m"))
    for r in rows.collect():
        assert r.m == bool(re.match(r.pattern, r.title, re.I)), (r.title, r.pattern)


def test_topic_patterns_keep_case(spark):
    df = spark.createDataFrame([("event-v2-a",), ("Event-v2-a",), ("x-event-v2",)], "topic string")
    kept = df.where(topic_matches(F.col("topic"), "event-v[0-9]")).collect()
    assert [r.topic for r in kept] == ["event-v2-a"]


def test_invalid_patterns(spark):
    cases = {"a(b": False, "[a": False, "a)(b": False, "a": True, "(?P<n>a)": True, "(?x) a # note": False, "*": False}
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    assert {r.p: r.v for r in df.select("p", is_valid_pattern(F.col("p")).alias("v")).collect()} == cases
