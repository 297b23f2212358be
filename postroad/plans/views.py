"""Event-relay inputs derived from the given tables, in Spark.

Every view is a projection of a whole table (or a bounded expansion of its rows), so the
work of a query grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Routing rules in order of precedence: (topic, pattern).
RULES = [
    ("event-v2-user", r"user\.(click|view)"),
    ("event-v2-message", r"message\."),
    ("event-v2-user-rest", r"user\..*"),
    ("event-v2-buy", r"my\.profile\.purchase$"),
    ("event-v2-late", r"user\.(click|view)"),
    ("event-v2-visit", r"my\.profile\.v|my\.profile\.s"),
]

INCLUDE = [r"user\.", r"message\.(c|v)"]
EXCLUDE = [r".*error$", r"USER\.signup"]

# story_id, topics, topic_pattern, include, exclude
STORIES = [
    ("audit", ["event-v2-t0", "event-v2-t1"], None, None, None),
    ("users", ["event-v2-t0"], None, [r"user\.", r"my\.profile\.view"], [r".*error"]),
    ("buys", None, r"event-v2-", [r".*\.purchase"], None),
    ("quiet", ["event-v2-t1"], None, None, [r".*\.(click|view)", r"message\."]),
    ("none", ["event-v2-t9"], None, [r".*"], None),
]

REPLAY_START = "2024-01-08 00:00:00"
REPLAY_END = "2024-01-10 12:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kv_events(events: DataFrame) -> DataFrame:
    """A partitioned log: two topics of three partitions, offsets with gaps."""
    return events.selectExpr(
        "cast(event_id as string) as id",
        """concat(case cast(user_id % 3 as int) when 0 then 'user.' when 1 then 'Message.'
                  else 'my.profile.' end, event_type) as title""",
        "cast(ts as string) as published",
        "props as payload",
        "concat('event-v2-t', cast(user_id % 2 as string)) as topic",
        "cast(user_id % 3 as int) as `partition`",
        "event_id as `offset`",
        # Record times are out of order by up to ten hours.
        "cast(ts + make_interval(0, 0, 0, 0, cast(event_id * 37 % 11 as int)) as timestamp) as timestamp",
        "cast(ts as timestamp) as ts",
        "user_id",
        "value",
    )


def request_bodies(events: DataFrame) -> DataFrame:
    """Requests of one to four events; some are no JSON, empty, or hold a bad event."""
    element = """concat('{"id":"', event_id, '-', j, '"',
        if(event_id % 97 = 0 and j = event_id % 4, '',
           concat(',"title":"', if(j % 2 = 0, 'user.', 'my.profile.'), event_type, '"')),
        ',"published":"p', event_id, '"',
        if(j = 1, '', concat(',"actor":{"id":"u', user_id, '"}')),
        if(j = 2, ',"target":{"id":7}', ''), ',"props":', props, '}')"""
    return events.selectExpr(
        "event_id",
        "user_id",
        "cast(event_id as string) as request_id",
        f"""case when event_id % 41 = 0 then 'abc' when event_id % 43 = 0 then '[]'
            when event_id % 47 = 0 then '"text"' when event_id % 53 = 0 then concat(props, ' x')
            when event_id % 4 = 0 then
              concat(' ', array_join(transform(sequence(0, 0), j -> {element}), ''))
            else concat('[', array_join(transform(
              sequence(0, cast(event_id % 4 as int)), j -> {element}), ' , '), ']')
            end as body""",
        "if(event_id % 5 = 0, concat('sink', event_id % 7), cast(null as string)) as sink_id",
    )


def kafka_messages(documents: DataFrame) -> DataFrame:
    """Log records whose values carry the whole text of each document; some are faulty."""
    good = """to_json(named_struct('id', concat('d', doc_id), 'title', concat(source, '.', lang),
        'published', cast(n_chars as string), 'content', text,
        'actor', named_struct('id', source), 'object', named_struct('kind', lang)))"""
    return documents.selectExpr(
        "doc_id",
        f"""cast(case when doc_id % 41 = 0 then 'abc' when doc_id % 43 = 0 then ''
            when doc_id % 47 = 0 then '[1]' when doc_id % 53 = 0 then '{{"id":5,"title":"t"}}'
            when doc_id % 59 = 0 then concat({good}, '}}') else {good} end as binary) as value""",
        "if(doc_id % 61 = 0, x'ff41', cast(concat('k', doc_id) as binary)) as key",
        "'event-v1-docs' as topic",
        "cast(doc_id % 8 as int) as `partition`",
        "doc_id as `offset`",
    )


def attempts(events: DataFrame) -> DataFrame:
    """One to six attempts per event, with every kind of reply."""
    rows = events.selectExpr(
        "event_id",
        "concat('sink', user_id % 7) as sink_id",
        "value",
        "inline(transform(sequence(1, cast(1 + event_id % 6 as int)), a -> struct(a as attempt)))",
    )
    coded = rows.withColumn("k", F.expr("cast((event_id * 7 + attempt * 3) % 10 as int)"))
    return coded.selectExpr(
        "event_id",
        "sink_id",
        "attempt",
        "case when k in (0,1,2) then null when k = 3 then 500 else 200 end as http_status",
        """case when k in (0,1,2) then null when k = 3 then 'err' when k = 4 then 'OK'
           when k in (5,6) then 'retry' when k in (7,8) then 'exponential_backoff_retry'
           else 'something else' end as body""",
        "case when k = 0 then 'connection' when k = 1 then 'timeout' when k = 2 then 'payload' end as error_kind",
        "cast(floor(value) as bigint) + attempt as duration_ms",
    )


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, t, p) for i, (t, p) in enumerate(RULES)], "rank int, topic string, pattern string"
    )


def stories_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        STORIES,
        "story_id string, topics array<string>, topic_pattern string, "
        "include array<string>, exclude array<string>",
    )


def sinks_table(spark: SparkSession) -> DataFrame:
    rows = [(f"sink{i}", f"http://example.invalid/s{i}", "POST") for i in range(5)]
    return spark.createDataFrame(rows, "sink_id string, url string, method string")


RULES_DOCUMENT = r"""case
    when o_orderkey % 11 = 0 then 'not json' when o_orderkey % 13 = 0 then ''
    when o_orderkey % 17 = 0 then '[{"topic":5,"patterns":["a"]}]'
    when o_orderkey % 19 = 0 then '[{"topic":"t","patterns":["("]}]'
    when o_orderkey % 23 = 0 then '[{"topic":"t","patterns":["a",1]}]'
    when o_orderkey % 29 = 0 then '{"topic":"t","patterns":["a"]}'
    when o_orderkey % 31 = 0 then null
    else concat('[{"topic":"event-', lower(o_orderstatus), '","patterns":["user.k', o_orderkey,
                '","my[.]a+"]}, {"patterns":[".*"],"note":1,"topic":"event-default"}]') end"""


def rule_snapshots(orders: DataFrame) -> DataFrame:
    """Versions of rule documents, one rule set per customer; about a third is invalid."""
    return orders.selectExpr("o_custkey as owner", "o_orderkey as version", f"{RULES_DOCUMENT} as data")


# Sink text of row ``k`` with quotes as in JSON.
SINK_TEXT = """case
    when k % 11 = 0 then 'http' when k % 13 = 0 then 'ftp#{"uri":"u","method":"post"}'
    when k % 17 = 0 then 'http#{"uri":"u","method":"get"}'
    when k % 19 = 0 then 'http#{"method":"post"}' when k % 23 = 0 then 'http#{"uri"'
    when k % 3 = 0 then concat('http#{"default-request":{"method":"put","uri":"http://example.invalid/', k,
        '","headers":{"accept":"v=', k % 5, '"}},"other":1}')
    else concat('http#{"method":"Post","uri":"http://example.invalid/#', k, '","timeout":', k % 7,
        ',"max_retry_times":', case when k % 2 = 0 then '""' else '0' end,
        ',"exp_backoff_factor":0.5}') end"""


def sink_texts(customer: DataFrame) -> DataFrame:
    return customer.selectExpr("c_name as sink_id", "c_custkey as k").selectExpr(
        "sink_id", f"{SINK_TEXT} as data"
    )


def sink_snapshots(orders: DataFrame) -> DataFrame:
    """Versions of sink documents; the sink ``shared`` is in every one of them."""
    return (
        orders.selectExpr("o_orderkey as version", "o_custkey as owner", "o_orderkey as k")
        .selectExpr("version", "owner", f"replace({SINK_TEXT}, '\"', '\\\\\"') as escaped")
        .selectExpr(
            "version",
            """case when version % 37 = 0 then '[]' when version % 39 = 0 then ''
               else concat('{"cust', owner, '":"', escaped, '","shared":"', escaped, '"}') end as data""",
        )
    )


def story_nodes(customer: DataFrame) -> DataFrame:
    """Control nodes of one story per customer."""
    base = customer.selectExpr("c_custkey as k", "concat('/root/stories/s', c_custkey, '/') as path")
    return base.selectExpr(
        "inline(array("
        """struct(concat(path, 'source') as path, case when k % 29 = 0 then 'amqp#{}'
             when k % 31 = 0 then 'kafka#{"topics":""}'
             when k % 5 = 0 then concat('kafka#{"topic-pattern":"event-v', k % 4, '-.*","group-id":"g#', k, '"}')
             else concat('kafka#{"topics":["event-v2-t', k % 2, '","event-v1-', k, '"],"group-id":""}')
             end as data),"""
        f"struct(concat(path, 'sink') as path, {SINK_TEXT} as data),"
        """struct(concat(path, 'operators') as path, case when k % 2 = 0 then null
             when k % 37 = 0 then 'filter#{}' when k % 41 = 0 then 'map#{}'
             when k % 7 = 0 then concat('filter#{"event-name-black-list":["a', k, '"],"event-name-white-list":""}')
             else concat('filter#{"event-name-white-list":["user[.]', k, '","b"],"event-name-black-list":["c"]}')
             end as data),"""
        "struct(concat(path, 'status') as path, if(k % 10 = 0, 'DISABLED', 'INIT') as data)))"
    ).where("data is not null")


def lifecycle_log(events: DataFrame) -> DataFrame:
    """Structured log of each event's stages; how far it got depends on its id."""
    return events.selectExpr(
        "cast(event_id as string) as id",
        "cast(ts as timestamp) as base",
        """posexplode(slice(array('RECEIVED','TO_KAFKA','IN_KAFKA','FROM_KAFKA','TO_SINK',
           'RETRY_TO_SINK', if(event_id % 9 = 0, 'TO_DEAD_LETTER', 'IN_SINK')),
           1, cast(1 + event_id % 7 as int))) as (step, status)""",
    ).selectExpr("id", "status", "base + make_interval(0, 0, 0, 0, 0, 0, step div 2) as ts")
