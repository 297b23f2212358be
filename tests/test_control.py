"""Control documents: rules, sinks, stories, runners."""

import json
import random

import pytest

from postroad import schema
from postroad.sources import control


def documents(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "version int, data string")


def test_rules_document(spark):
    """Rank follows entries, then patterns, for documents of any shape."""
    draw = random.Random(11)
    for size in (0, 1, 4):
        entries = [{"topic": f"lane {k}", "patterns": [f"p{draw.randrange(9)}\\d+" for _ in range(draw.randint(0, 3))], "note": k} for k in range(size)]
        rows = control.load_topic_rules(documents(spark, json.dumps(entries, indent=draw.choice([None, 1])))).orderBy("rank").collect()
        flat = [(e["topic"], p) for e in entries for p in e["patterns"]]
        assert [(r.rank, r.topic, r.pattern) for r in rows] == [(k, *x) for k, x in enumerate(flat)]


def test_one_bad_entry_rejects_the_document(spark):
    good = '{"topic":"t","patterns":["a"]}'
    bad = ['{"topic":1,"patterns":["a"]}', '{"topic":"t"}', '{"topic":"t","patterns":"a"}', '{"topic":"t","patterns":[1]}', '{"patterns":["a"]}', "5", '{"topic":"t","patterns":["["]}']
    docs = documents(spark, *[f"[{good},{b}]" for b in bad], "x", "", None, good, f"[{good}] x")
    assert control.load_topic_rules(docs).count() == 0
    assert control.rejected_rules(docs).count() == len(bad) + 5


def test_rules_are_replaced_and_kept(spark):
    def doc(*topics):
        return json.dumps([{"topic": t, "patterns": [t]} for t in topics])

    def now(*texts):
        rows = control.current_rules(documents(spark, *texts)).orderBy("rank").collect()
        return [r.topic for r in rows]

    assert now(doc("a", "b"), doc("c")) == ["c"]
    assert now(doc("a"), "") == now(doc("a"), "x", None, '[{"topic":"t","patterns":["("]}]') == ["a"]
    assert now(doc("a"), "[]") == []
    assert now("x") == []


def sink_text(draw, nested):
    """A sink text and what it should load as."""
    doc = {"uri": f"https://sink{draw.randrange(9)}.example.invalid/in#{draw.randrange(9)}", "method": draw.choice(["post", "Put", "PATCH"])}
    row = {"url": doc["uri"], "method": doc["method"].upper(), "headers": None, **schema.SINK_DEFAULTS}
    if draw.random() < 0.5:
        doc["headers"] = row["headers"] = {f"X-{k}": str(draw.random()) for k in range(draw.randint(0, 2))}
    for name, type_ in (("timeout", float), ("max_retry_times", int), ("exp_backoff_factor", float), ("exp_backoff_max_delay", float)):
        value = type_(draw.randint(0, 50))
        doc[name] = draw.choice([value, str(value), "", None])
        if doc[name] not in ("", None):
            row[name] = value
    return "http#" + json.dumps({"default-request": doc} if nested else doc), row


def test_sink_texts(spark):
    draw = random.Random(5)
    drawn = [sink_text(draw, k % 2) for k in range(30)]
    df = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(drawn)], "k int, data string")
    for found, (_, row) in zip(control.load_sinks(df).orderBy("k").collect(), drawn, strict=True):
        assert found.error is None
        assert {name: found[name] for name in row} == row
    bare = control.load_sinks(spark.createDataFrame([('http#{"uri":"u","method":"put"}',)], "data string"), defaults=False).first()
    assert bare.timeout is None and bare.max_retry_times is None


@pytest.mark.parametrize("wrong", ['"timeout":"soon"', '"max_retry_times":2.5', '"headers":["x"]', '"headers":{"n":1}', '"exp_backoff_factor":true', '"timeout":{}', '"headers":"x"'])
def test_wrong_parameters_are_errors(spark, wrong):
    good, bad = 'http#{"uri":"u","method":"post"}', f'http#{{"uri":"v","method":"post",{wrong}}}'
    assert control.load_sinks(spark.createDataFrame([(bad,)], "data string")).first().error
    docs = documents(spark, json.dumps({"a": good}), json.dumps({"a": bad}))
    assert control.current_sinks(docs).first().url == "u"


def test_bad_sink_texts(spark):
    texts = ["http", 'ftp#{"uri":"u","method":"post"}', "http#x", 'http#{"method":"post"}', 'http#{"uri":"u"}', 'http#{"uri":"u","method":"get"}', None]
    df = spark.createDataFrame([(t,) for t in texts], "data string")
    assert all(r.error for r in control.load_sinks(df).collect())


def test_sinks_add_up(spark):
    def sink(n, method="post"):
        return "http#" + json.dumps({"uri": f"u{n}", "method": method})

    docs = documents(
        spark, json.dumps({"a": sink(1), "b": sink(2)}), json.dumps({"b": sink(3), "c": "bad", "d": sink(4)}),
        json.dumps({"a": sink(5, "get")}), "", "[1]", None,
    )
    found = {r.sink_id: r.url for r in control.current_sinks(docs).collect()}
    assert found == {"a": "u1", "b": "u3", "d": "u4"}


def nodes(spark, stories):
    rows = [(f"/root/stories/{s}/{n}", d) for s, parts in stories.items() for n, d in parts.items()]
    return spark.createDataFrame([*rows, ("/root/topics", "[]"), ("/root/stories/x/other", "y")], "path string, data string")


SINK = 'http#{"uri":"u","method":"post"}'


def test_stories(spark):
    kafka = 'kafka#{"topics":["t1","t2"],"group-id":"g","bootstrap-servers":"x"}'
    df = nodes(spark, {
        "a": {"source": kafka, "sink": SINK, "status": "INIT", "operators": 'filter#{"event-name-white-list":["u.*"],"event-name-black-list":""}'},
        "b": {"source": 'kafka#{"topics":"","topic-pattern":"t.*","group-id":""}', "sink": SINK, "status": "DISABLED"},
        "c": {"source": 'kafka#{}', "sink": SINK, "status": ""},
        "d": {"source": 'file#{}', "sink": SINK, "status": ""},
        "e": {"source": kafka, "sink": SINK},
        "f": {"source": kafka, "sink": SINK, "status": "", "operators": "filter#{}"},
        "g": {"source": kafka, "sink": SINK, "status": "", "operators": 'map#{"event-name-white-list":["u"]}'},
        "h": {"sink": SINK, "status": ""},
        "i": {"source": kafka, "status": ""},
    })
    found = {r.story_id: r for r in control.load_stories(df, "relay", "proj", "prod").collect()}
    a, b = found["a"], found["b"]
    assert (a.topics, a.topic_pattern, a.group_id, a.include, a.exclude, a.status, a.error) == (["t1", "t2"], None, "g", ["u.*"], None, "NORMAL", None)
    assert (b.topics, b.topic_pattern, b.group_id, b.status, b.error) == (None, "t.*", "relay_proj_prod_b", "DISABLED", None)
    assert all(found[s].error for s in "cdefghi") and len(found) == 9


@pytest.mark.parametrize(
    ("operators", "topics"),
    [
        ('filter#{"event-name-white-list":["user",1],"event-name-black-list":["x"]}', '["t"]'),
        ('filter#{"event-name-white-list":["("]}', '["t"]'),
        ('filter#{"event-name-black-list":"user"}', '["t"]'),
        (None, '["t",5]'),
    ],
)
def test_faulty_lists_stop_a_story(spark, operators, topics):
    parts = {"source": f'kafka#{{"topics":{topics},"topic-pattern":"t.*"}}', "sink": SINK, "status": ""}
    if operators:
        parts["operators"] = operators
    assert control.load_stories(nodes(spark, {"s": parts}), "g", "p", "e").first().error


def test_runner_choice(spark):
    """A project's own runners, or else those for all, or none; and only stories that are not disabled."""
    draw = random.Random(2)
    table = {"all": ["east", "west"], "shop": ["north"], "empty": []}
    stories = [(f"story {k}", draw.choice(["east", "west", "north", "south"]), draw.choice(["NORMAL", "DISABLED"])) for k in range(20)]
    df = spark.createDataFrame(stories, "story_id string, runner string, status string")
    for known in (table, {"shop": table["shop"]}, {"all": []}):
        rows = spark.createDataFrame(list(known.items()), "project_id string, runners array<string>")
        for project in ("shop", "empty", "other"):
            chosen = known.get(project, known.get("all", []))
            expected = sorted(s for s, runner, status in stories if runner in chosen and status == "NORMAL")
            assert sorted(r.story_id for r in control.active_stories(df, rows, project).collect()) == expected
