"""Strict JSON and event parsing against Python's own JSON."""

import json
import random

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postroad.functions import json_scan
from postroad.functions.strict_json import with_variant
from postroad.operators import parse
from postroad import schema

TEXTS = [
    '{"a":1}', "[1,2]", "1,2", "1],[2", '1},{"v":2', "", "  ", '"a', '"a", "b', '{"a":1} x', '{"a":1,}', "null", "true", "tru",
    "{'a':1}", "1 ]", ' {"a":"\\u00e9"}\n', "01", '{"a":1}{"b":2}', "[1,]", "/*c*/1", "-", "1.", ".5", "1e5", '"\t"', "[[]]", "{}",
    '"\\x"', "abc", '{"a":1,"a":2}', "\ufeff1", "[1 2]", '{"a" 1}', "1 // c", "+1", "{a:1}",
]


def is_json(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def parsed(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = with_variant(df, F.col("t"), "v").select("i", F.to_json("v").alias("j")).collect()
    return [r.j for r in sorted(rows, key=lambda r: r.i)]


def test_strict_json_like_python(spark):
    for text, found in zip(TEXTS, parsed(spark, TEXTS)):
        assert (found is not None) == is_json(text), text
        if found is not None:
            assert json.loads(found) == json.loads(text)


values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**53), 2**53) | st.text(st.characters(codec="utf-8"), max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("abc\"\\é ", max_size=3), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(values, st.sampled_from(["", " ", "]", "}", ",1", '"', "x", '],["']), st.integers(0, 6)), min_size=40, max_size=60))
def test_strict_json_on_damaged_texts(spark, cases):
    texts = []
    for value, tail, cut in cases:
        text = json.dumps(value, ensure_ascii=cut % 2 == 0)
        texts.append(text[: len(text) - cut] + tail)
    for text, found in zip(texts, parsed(spark, texts)):
        assert (found is not None) == is_json(text), text


def bodies(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "request_id string, body string")


GOOD = '{"published": "week 7", "id": "no-4", "title": "Crate.packed"}'
FAULTS = {
    "NOT_JSON": ["{", "no json", None, GOOD + GOOD, "[" + GOOD],
    "NOT_AN_EVENT": ["7", "false", '"text"', "null"],
    "EMPTY_BODY": ["[]", " [ ] "],
    "BAD_ELEMENT": [
        *(json.dumps({k: v for k, v in json.loads(GOOD).items() if k != gone}) for gone in ("id", "title", "published")),
        *(json.dumps({**json.loads(GOOD), k: v}) for k, v in (("id", 3), ("title", None), ("published", ["a"]))),
        f"[{GOOD}, 8]", f"[[{GOOD}]]", '["text"]', "[null]",
    ],
}


def test_bad_bodies(spark):
    cases = [(kind, text) for kind, texts in FAULTS.items() for text in texts]
    df = bodies(spark, *(text for _, text in cases))
    assert parse.parse_request_bodies(df).count() == 0
    found = {int(r.request_id): r.error_kind for r in parse.quarantine_bodies(df).collect()}
    assert [found[k] for k in range(len(cases))] == [kind for kind, _ in cases]


def test_good_bodies(spark):
    """Random events, alone and in lists: fields, places and extra columns are those of Python's parser."""
    draw = random.Random(9)

    def event(k):
        body = {"id": draw.choice(["", f"no-{k}"]), "title": f"Crate.{k}", "published": draw.choice(["", "week 7"]), "load": [k, {"deep": [{"er": k}]}]}
        for name in draw.sample(["actor", "object", "target", "provider"], draw.randint(0, 4)):
            body[name] = draw.choice([{"id": f"{name} {k}"}, {"id": None, "x": 1}, {"x": {}}])
        return body

    sent = [event(0), *([event(10 * n + k) for k in range(n)] for n in (1, 2, 3))]
    rows = parse.parse_request_bodies(bodies(spark, *map(json.dumps, sent))).collect()
    found = {(int(r.request_id), r.pos): r for r in rows}
    expected = {(k, pos): e for k, s in enumerate(sent) for pos, e in enumerate(s if isinstance(s, list) else [s])}
    assert set(found) == set(expected)
    for place, e in expected.items():
        r = found[place]
        assert (r.id, r.title, r.published) == (e["id"], e["title"], e["published"])
        assert json.loads(r.payload) == e
        for name in ("actor", "object", "target"):
            held = (r.extra or {}).get(f"{name}_id")
            assert held == (e.get(name) or {}).get("id")


def test_exact_payload(spark):
    texts = ['{"title":"t\u00e9","id":"1" , "published":"p","n":[1.50,{}],"id":"2"}', '[{"title":"a","id":"b","published":""}]']
    rows = parse.parse_request_bodies(bodies(spark, *texts), exact_payload=True).orderBy("request_id").collect()
    assert [r.payload for r in rows] == [json.dumps(json.loads(texts[0])), json.dumps(json.loads(texts[1])[0])]
    assert rows[0].id == "2"


def messages(spark, rows):
    full = [(k, v, "t", 0, i, None, 0) for i, (k, v) in enumerate(rows)]
    return spark.createDataFrame(full, schema.KAFKA_SOURCE)


def test_kafka_messages(spark):
    good = GOOD.encode()
    df = messages(spark, [
        (b"k", good), (None, good), (b"\xff", good), (b"k", b""), (b"k", None), (b"k", b"[1]"), (b"k", b'{"id":"\xff"}'),
        (b"k", b'{"id":"a","title":"b"}'), (b"k", b" \n" + good),
    ])
    kept = parse.parse_kafka_messages(df).orderBy("offset").collect()
    assert [(r.offset, r.key) for r in kept] == [(0, "k"), (1, None), (8, "k")]
    assert json.loads(kept[2].payload)["id"] == "no-4"
    bad = parse.quarantine_messages(df).orderBy("offset").collect()
    assert [(r.offset, r.error_kind) for r in bad] == [
        (2, "BAD_KEY"), (3, "EMPTY_VALUE"), (4, "EMPTY_VALUE"), (5, "NOT_AN_EVENT"), (6, "NOT_JSON"), (7, "BAD_EVENT"),
    ]


def test_text_is_parsed_once(spark):
    """The filter on the fault must not bring a second parse of the received text, or of an outsize one's envelope, into the plan."""
    df = messages(spark, [(b"k", GOOD.encode())])
    plan = parse.parse_kafka_messages(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 2 and plan.count("envelope_of") <= 1


OUTSIZE = [
    '"load":1e400', '"load":' + "7" * 50, '"load":' + "8" * 3000, '"load":' + "[" * 2000 + "]" * 2000, '"load":' + '{"a":' * 30_000 + "0" + "}" * 30_000,
    '"load":-0.0,"b":1.50,"a":1E+2', '"actor":{"id":' + "9" * 1500 + "}", '"object":{"x":' + "[" * 1200 + "]" * 1200 + ',"id":{"k":[1, 2]}}', '"load":"' + "[\\\"" * 600 + '"',
]


def test_outsize_texts_come_through_as_received(spark):
    """Long numbers and deep nesting, alone, in lists and as messages; the payload is the received text."""
    event = lambda more, k: f'{{"id" :"e{k}",{more} , "title":"T", "published":"p"}}'
    alone = [event(more, k) for k, more in enumerate(OUTSIZE)]
    listed = [f" [ {e}, {GOOD}\n,{e}]" for e in alone]
    rows = parse.parse_request_bodies(bodies(spark, *alone, *listed)).collect()
    found = {(int(r.request_id), r.pos): r for r in rows}
    n = len(alone)
    assert set(found) == {(k, 0) for k in range(n)} | {(n + k, pos) for k in range(n) for pos in range(3)}
    for k, text in enumerate(alone):
        for r in (found[k, 0], found[n + k, 0], found[n + k, 2]):
            assert (r.id, r.title, r.published, r.payload) == (f"e{k}", "T", "p", text)
        assert found[n + k, 1].payload == GOOD
    assert found[6, 0].extra == {"actor_id": "9" * 1500} and found[7, 0].extra == {"object_id": '{"k":[1, 2]}'}
    kept = parse.parse_kafka_messages(messages(spark, [(b"k", t.encode()) for t in alone])).orderBy("offset").collect()
    assert [r.payload for r in kept] == alone
    whole = parse.examine_bodies(bodies(spark, *alone, *listed)).collect()
    assert {(int(r.request_id), r.pos): r.payload for r in whole} == {k: r.payload for k, r in found.items()}


def test_outsize_faults_are_refused(spark):
    """Texts that are long and faulty, in ways that only a whole parse finds."""
    deep = "[" * 1500
    faults = [
        (f'{{"id":"a","title":"t","published":"p","x":{deep}{"]" * 1499}}}', "NOT_JSON"), (f'{{"id":"a","title":"t","published":"p","x":{deep}{"]" * 1500}}} 1', "NOT_JSON"),
        (f'{{"id":"a","title":"t","published":"p","x":{"7" * 1200}x}}', "NOT_JSON"), (f'{{"id":"a","title":"t","published":"p","x":0{"7" * 1200}}}', "NOT_JSON"),
        (f'{{"id":{"7" * 1200},"title":"t","published":"p"}}', "BAD_ELEMENT"), (f'{{"id":"a","title":"t","x":{deep}{"]" * 1500}}}', "BAD_ELEMENT"),
        (f'{deep}{"]" * 1500}', "BAD_ELEMENT"), ("7" * 1200, "NOT_AN_EVENT"), (f'[{GOOD},{"7" * 1200}]', "BAD_ELEMENT"), ("x" * 2000, "NOT_JSON"),
        (f'{{"id":"a","title":"t","published":"p","published":{"7" * 1200}}}', "BAD_ELEMENT"),
    ]
    df = bodies(spark, *(text for text, _ in faults))
    assert parse.parse_request_bodies(df).count() == 0
    found = {int(r.request_id): r.error_kind for r in parse.quarantine_bodies(df).collect()}
    assert [found[k] for k in range(len(faults))] == [kind for _, kind in faults]
    both = {int(r.request_id): (r.error_kind, r.error, r.id) for r in parse.examine_bodies(df).collect()}
    said = {int(r.request_id): (r.error_kind, r.error, None) for r in parse.quarantine_bodies(df).collect()}
    assert both == said


def test_slices_are_what_stands_between_commas(spark):
    draw = random.Random(4)

    def value(depth):
        kind = draw.randrange(8 if depth < 4 else 4)
        if kind == 0:
            return draw.choice([1, -2.5, 10**40, True, None])
        if kind < 4:
            return "".join(draw.choice('a"\\[]{},:é😀 \n') for _ in range(draw.randrange(6)))
        if kind < 6:
            return [value(depth + 1) for _ in range(draw.randrange(4))]
        return {draw.choice('abc"\\,') + str(k): value(depth + 1) for k in range(draw.randrange(4))}

    texts, expected = [None, "", "x[", "{}", '{"a":[1]}', "]", "[", '"[1]"'], [None] * 8
    for _ in range(400):
        parts = [json.dumps(value(0), ensure_ascii=draw.random() < 0.5, indent=draw.choice([None, 1])) for _ in range(draw.randrange(5))]
        texts.append(draw.choice(["", " ", "\n"]) + "[" + draw.choice([" , ", ","]).join(draw.choice(["", "\t"]) + p for p in parts) + draw.choice(["", " "]) + "]")
        expected.append(parts)
    for size in (len(texts), 7):
        found = []
        for k in range(0, len(texts), size):
            found += json_scan.list_elements(pa.array(texts, pa.string()).slice(k, size)).to_pylist()
        assert found == expected


def test_summary_and_records(spark):
    df = messages(spark, [(b"k", b'{"id":"1","title":"t","published":"p","actor":{"id":"a"}}')])
    event = parse.event_summary(parse.parse_kafka_messages(df)).first()
    assert event.summary == (
        '{"id":"1","title":"t","published":"p","extra":{"actor_id":"a"},"topic":"t","partition":0,"offset":0,"key":"k"}'
    )
    record = parse.to_kafka_records(parse.parse_kafka_messages(df)).first()
    assert (record.topic, bytes(record.key)) == ("t", b"1")
