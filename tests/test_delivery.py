"""Rounds, outcomes, offsets and replay against loop models."""

import random

import pytest
from pyspark.sql import functions as F

from postroad.functions.text import backoff_delay, dead_letter_topic, header_map, merge_maps, merge_options, parse_headers, parse_zoned_time
from postroad.operators import delivery, replay, report


def make_log(seed, n=400, partitions=3):
    rng = random.Random(seed)
    rows, offsets = [], [0] * partitions
    for _ in range(n):
        p = 0 if rng.random() < 0.5 else rng.randrange(partitions)
        offsets[p] += rng.choice([1, 1, 1, 2, 9])
        rows.append((f"t{p % 2}", p, offsets[p], rng.random() < 0.6, rng.randrange(1000)))
    return rows


def model_rounds(rows, c):
    """Take turns over the partitions as a consumer does."""
    queues = {}
    for topic, part, off, passes, _ in sorted(rows):
        queues.setdefault((topic, part), []).append((off, passes))
    rounds, number = [], 0
    while queues:
        number += 1
        taken = {}
        for key in list(queues):
            sent = 0
            while queues[key] and sent < c:
                off, passes = queues[key].pop(0)
                taken.setdefault(key, []).append((off, passes))
                sent += passes
            if not queues[key]:
                del queues[key]
        rounds.append(taken)
    return rounds


@pytest.mark.parametrize("c, chunk", [(1, 1 << 18), (1, 16), (2, 7), (3, 1)])
def test_rounds(spark, c, chunk):
    rows = make_log(c)
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ok boolean, ts int")
    found = delivery.delivery_rounds(df, F.col("ok"), c, chunk=chunk).collect()
    expected = {
        (t, p, off): i for i, taken in enumerate(model_rounds(rows, c), 1) for (t, p), events in taken.items() for off, _ in events
    }
    assert {(r.topic, r.partition, r.offset): r["round"] for r in found} == expected


@pytest.mark.parametrize("c, unknown_at", [(1, None), (2, 150), (3, 10), (1, 0)])
def test_committable_offsets(spark, c, unknown_at):
    rows = make_log(c + 10)
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ok boolean, ts int")
    status = F.when(F.col("passes"), F.when(F.col("offset") >= (unknown_at if unknown_at is not None else 1 << 40), "UNKNOWN").otherwise("DONE"))
    rounds = delivery.delivery_rounds(df, F.col("ok"), c, chunk=32).withColumn("status", status)
    committed = {}
    for taken in model_rounds(rows, c):
        sent = [off for events in taken.values() for off, passes in events if passes]
        if unknown_at is not None and any(off >= unknown_at for off in sent):
            break
        if sent:
            committed |= {key: events[-1][0] + 1 for key, events in taken.items()}
    found = {(r.topic, r.partition): r.next_offset for r in delivery.committable_offsets(rounds).collect()}
    assert found == committed


def test_trailing_filtered_events(spark):
    rows = [("t", 0, 1, True), ("t", 0, 2, False), ("t", 0, 3, False)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ok boolean")
    results = delivery.delivery_rounds(df, F.col("ok")).withColumn("status", F.lit("DONE"))
    assert delivery.committable_offsets(results).first().next_offset == 2
    assert delivery.committable_offsets(results, commit_filtered=True).first().next_offset == 4
    none = delivery.delivery_rounds(df, F.lit(False)).withColumn("status", F.lit(None).cast("string"))
    assert delivery.committable_offsets(none).count() == 0


KINDS = [None, None, None, "connection", "timeout", "invalid_url", "response", "payload", "other"]
BODIES = ["ok", "OK", " ok", "retry", "Retry", "exponential_backoff_retry", "what", ""]


def model_attempt(n, status, body, kind, limit, factor=0.1, cap=60.0):
    wait = min(2 ** (n - 1) * factor, cap)
    if kind in ("response", "payload"):
        return "DEAD_LETTER", kind, None
    if kind:
        return None, None, wait
    if status != 200:
        return "DEAD_LETTER", f"Non-200 Status Code: {status}", None
    if body.lower() == "ok":
        return "DONE", None, None
    if body.lower() in ("retry", "exponential_backoff_retry"):
        if n > limit:
            return "DEAD_LETTER", "Maximum Retries", None
        return None, None, 0.0 if body.lower() == "retry" else wait
    return "DEAD_LETTER", f"Unexpected Response: {body}", None


@pytest.mark.parametrize("limit, width", [(3, 4096), (0, 1), (5, 3)])
def test_outcomes(spark, limit, width):
    rng = random.Random(limit)
    rows = []
    for e in range(300):
        for n in range(1, rng.randrange(2, 12)):
            kind = rng.choice(KINDS)
            body = rng.choice(["retry", "exponential_backoff_retry", rng.choice(BODIES)])
            rows.append((e, n, rng.choice([200] * 9 + [500]) if not kind else None, body if not kind else None, kind))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "event_id int, attempt int, http_status int, body string, error_kind string")
    expected = {}
    for e in range(300):
        status, error, count, delay = "UNKNOWN", "HttpSink is closed", 0, 0.0
        for _, n, code, body, kind in sorted(r for r in rows if r[0] == e):
            end, why, wait = model_attempt(n, code, body, kind, limit)
            count, delay = count + 1, delay + (wait or 0.0)
            if end:
                status, error = end, why
                break
        expected[e] = (status, error, count, pytest.approx(delay))
    found = delivery.delivery_outcome(delivery.classify_attempt(df, limit), width=width).collect()
    assert {r.event_id: (r.status, r.error, r.attempts, r.total_delay) for r in found} == expected


def test_backoff(spark):
    rows = spark.range(1, 12).select(backoff_delay(F.col("id"), 0.1, 60.0).alias("d")).collect()
    assert rows[0].d == 0.1 and rows[4].d == 1.6 and rows[10].d == 60.0


def test_dead_letter_names(spark):
    cases = {
        "event-v2-a": "event-v2-dead-letter-a",
        "a": "dead-letter-a",
        "event-v12-a": "dead-letter-event-v12-a",
        "event-v3-dead-letter-a": "event-v3-dead-letter-dead-letter-a",
        "": "dead-letter-",
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.d for r in df.select("t", dead_letter_topic(F.col("t")).alias("d")).collect()} == cases


def model_replay(rows, start, end):
    kept = set()
    for key in {r[:2] for r in rows}:
        log = sorted((r[2], r[4]) for r in rows if r[:2] == key)
        begin = next((off for off, ts in log if ts >= start), None)
        for off, ts in log:
            if begin is None or off < begin:
                continue
            if end is not None and ts > end:
                break
            kept.add((*key, off))
    return kept


@pytest.mark.parametrize("start, end", [(0, None), (300, 700), (700, 300), (990, 999), (2000, None), (500, 500)])
def test_replay(spark, start, end):
    rows = make_log(3)
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ok boolean, ts int").withColumn(
        "timestamp", F.timestamp_millis("ts")
    )
    bound = [F.timestamp_millis(F.lit(t)) if t is not None else None for t in (start, end)]
    found = replay.replay_window(df, *bound).collect()
    assert {(r.topic, r.partition, r.offset) for r in found} == model_replay(rows, start, end)


def test_replay_without_seek_limits(spark, monkeypatch):
    rows = make_log(4)
    monkeypatch.setattr(replay, "MAX_SEEK_ROWS", 1)
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ok boolean, ts int").withColumn(
        "timestamp", F.timestamp_millis("ts")
    )
    found = replay.replay_window(df, F.timestamp_millis(F.lit(200)), F.timestamp_millis(F.lit(600))).collect()
    assert {(r.topic, r.partition, r.offset) for r in found} == model_replay(rows, 200, 600)


def test_times_and_headers(spark):
    texts = ["2021-03-30T14:17:36+0200", "2021-03-30T14:17:36+02:00", "2021-03-30T12:17:36Z", "2021-03-30T14:17:36", "x", "2021-03-30 14:17:36+0200"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", F.unix_millis(parse_zoned_time(F.col("t"))).alias("ms")).orderBy("i").collect()
    assert [r.ms for r in rows] == [1617106656000] * 3 + [None] * 3
    headers = ["a=1", "b=x=y", "a=2"]
    assert parse_headers(headers) == {"a": "2", "b": "x=y"}
    with pytest.raises(ValueError):
        parse_headers(["plain"])
    df = spark.createDataFrame([(headers,)], "h array<string>")
    defaults = F.create_map(F.lit("b"), F.lit("d"), F.lit("c"), F.lit("d"))
    row = df.select(merge_maps(defaults, header_map(F.col("h"))).alias("m")).first()
    assert row.m == {"a": "2", "b": "x=y", "c": "d"}
    assert merge_options({"a": {"x": 1, "y": 2}, "b": 1}, {"a": {"y": 3}}) == {"a": {"x": 1, "y": 3}, "b": 1}


def test_acknowledgement(spark):
    rows = [
        ("r1", 0, "e1", None, None), ("r1", 1, "e2", "RuntimeError", "refused"), ("r1", 2, "e3", None, None),
        ("r2", 0, "e1", None, None), ("r3", 0, "e1", "TimeoutError", None),
        ("r4", 0, "b", "E", "first"), ("r4", 1, "a", "E", "x"), ("r4", 2, "b", "E", "last"), ("r4", 3, "a", None, None),
    ]
    df = spark.createDataFrame(rows, "request_id string, pos int, id string, error_kind string, error string")
    acks = {r.request_id: r for r in report.batch_ack(df).collect()}
    assert (acks["r1"].status, acks["r1"].http_code, acks["r1"].details) == ("part_succ", 400, {"e2": "<RuntimeError> refused"})
    assert acks["r1"].plain == "part_ok\ne2: <RuntimeError> refused"
    assert (acks["r2"].status, acks["r2"].http_code, acks["r2"].plain, acks["r2"].details) == ("all_succ", 200, "ok", {})
    assert acks["r3"].plain == "fail\ne1: <TimeoutError> "
    assert acks["r4"].details == {"b": "<E> last", "a": "<E> x"}
    assert acks["r4"].plain == "part_ok\nb: <E> last\na: <E> x"
    long = {(r.request_id, r.id): (r.pos, r.detail) for r in report.ack_details(df).collect()}
    assert long[("r4", "b")] == (0, "<E> last")


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 7 + [1.0], [1e-9, 1e9, 0.0, 2.5], [0.1 * i for i in range(1001)], []])
def test_exact_median(spark, values):
    import statistics

    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    assert report.exact_median(df, "v", bins=4) == (statistics.median(values) if values else None)
