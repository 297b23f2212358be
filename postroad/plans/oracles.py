"""The registered queries as independent SQL for DuckDB, on the same tables."""

from __future__ import annotations

from postroad.plans import views


def _quote(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("'", "''") + "'"


def _match(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {_quote(f'^(?:{pattern})')}, 'i')"


def _any(column: str, patterns: list[str]) -> str:
    return "(" + " or ".join(_match(column, p) for p in patterns) + ")"


def _topic(column: str, rules: list[tuple[str, str]] = views.RULES) -> str:
    cases = " ".join(f"when {_match(column, p)} then {_quote(t)}" for t, p in rules)
    return f"case {cases} end"


# --- views -----------------------------------------------------------------------

_LOG = """log as (
  select cast(event_id as varchar) as id,
    concat(case cast(user_id % 3 as int) when 0 then 'user.' when 1 then 'Message.'
           else 'my.profile.' end, event_type) as title,
    cast(ts as varchar) as published, props as payload,
    concat('event-v2-t', cast(user_id % 2 as varchar)) as topic,
    cast(user_id % 3 as int) as "partition", event_id as "offset",
    ts + (event_id * 37 % 11) * interval 1 hour as "timestamp", ts, user_id, value, event_id
  from events)"""

_ELEMENT = """concat('{"id":"', event_id, '-', j, '"',
    case when event_id % 97 = 0 and j = event_id % 4 then '' else
      concat(',"title":"', case when j % 2 = 0 then 'user.' else 'my.profile.' end, event_type, '"') end,
    ',"published":"p', event_id, '"',
    case when j = 1 then '' else concat(',"actor":{"id":"u', user_id, '"}') end,
    case when j = 2 then ',"target":{"id":7}' else '' end, ',"props":', props, '}')"""

_BODIES = f"""pieces as (
  select event_id, user_id, event_type, props, j, {_ELEMENT} as el
  from events, unnest(range(0, 1 + event_id % 4)) t(j)),
bodies as (
  select event_id, cast(event_id as varchar) as request_id,
    case when event_id % 41 = 0 then 'abc' when event_id % 43 = 0 then '[]'
      when event_id % 47 = 0 then '"text"' when event_id % 53 = 0 then concat(any_value(props), ' x')
      when event_id % 4 = 0 then concat(' ', string_agg(el, ''))
      else concat('[', string_agg(el, ' , ' order by j), ']') end as body,
    case when event_id % 5 = 0 then concat('sink', event_id % 7) end as sink_id
  from pieces group by event_id),
judged as (
  select *, case when not json_valid(body) then 'NOT_JSON'
      when json_type(body) not in ('ARRAY', 'OBJECT') then 'NOT_AN_EVENT'
      when json_type(body) = 'ARRAY' and json_array_length(body) = 0 then 'EMPTY_BODY' end as fault
  from bodies),
items as (
  select event_id, request_id, sink_id, case when json_type(body) = 'OBJECT' then 0 else i end as pos,
    case when json_type(body) = 'OBJECT' then cast(body as json) else json_extract(body, '$[' || i || ']') end as e
  from judged, unnest(range(0, case when fault is not null then 0 when json_type(body) = 'OBJECT' then 1
                              else cast(json_array_length(body) as bigint) end)) t(i)),
checked as (
  select *, coalesce(json_type(e, '$.id') = 'VARCHAR' and json_type(e, '$.title') = 'VARCHAR'
      and json_type(e, '$.published') = 'VARCHAR', false) as good from items),
parsed as (
  select request_id, event_id, sink_id, cast(pos as int) as pos,
    json_extract_string(e, '$.id') as id, json_extract_string(e, '$.title') as title,
    json_extract_string(e, '$.published') as published, json_extract_string(e, '$.actor.id') as actor_id,
    json_extract_string(e, '$.object.id') as object_id, json_extract_string(e, '$.target.id') as target_id
  from checked c where not exists (
    select 1 from checked b where b.request_id = c.request_id and not b.good)),
rejected as (
  select request_id, fault as error_kind,
    case fault when 'NOT_JSON' then 'Request body must not an non-empty Json.'
      when 'NOT_AN_EVENT' then 'Invalid format of the event'
      else 'Invalid format of request body.' end as error
  from judged where fault is not null
  union all
  select request_id, 'BAD_ELEMENT', concat('element ', min(pos), ': not a string: title')
  from checked where not good group by request_id)"""

_ATTEMPTS = """attempts as (
  select event_id, sink_id, attempt,
    case when k in (0,1,2) then null when k = 3 then 500 else 200 end as http_status,
    case when k in (0,1,2) then null when k = 3 then 'err' when k = 4 then 'OK' when k in (5,6) then 'retry'
         when k in (7,8) then 'exponential_backoff_retry' else 'something else' end as body,
    case when k = 0 then 'connection' when k = 1 then 'timeout' when k = 2 then 'payload' end as error_kind,
    cast(floor(value) as bigint) + attempt as duration_ms
  from (select event_id, concat('sink', user_id % 7) as sink_id, value, cast(a as int) as attempt,
               cast((event_id * 7 + a * 3) % 10 as int) as k
        from events, unnest(range(1, 2 + {count})) t(a)))"""


def _classified(max_retry: str = "3", factor: str = "0.1", cap: str = "60.0", count: str = "event_id % 6") -> str:
    return f"""{_ATTEMPTS.format(count=count)},
actions as (
  select *, case when error_kind = 'payload' then 'DEAD_LETTER' when error_kind is not null then 'BACKOFF'
      when http_status <> 200 then 'DEAD_LETTER' when lower(body) = 'ok' then 'DONE'
      when body in ('retry', 'exponential_backoff_retry') and attempt > {max_retry} then 'DEAD_LETTER'
      when body = 'retry' then 'RETRY' when body = 'exponential_backoff_retry' then 'BACKOFF'
      else 'DEAD_LETTER' end as action
  from attempts),
classified as (
  select *, case when action in ('DONE', 'DEAD_LETTER') then action end as status,
    case when action <> 'DEAD_LETTER' then null when error_kind is not null then error_kind
      when http_status <> 200 then concat('Non-200 Status Code: ', http_status)
      when body in ('retry', 'exponential_backoff_retry') then 'Maximum Retries'
      else concat('Unexpected Response: ', body) end as error,
    case action when 'RETRY' then 0.0::double
      when 'BACKOFF' then least(pow(2.0::double, attempt - 1) * {factor}::double, {cap}::double) end as delay
  from actions)"""


_OUTCOME = """outcome as (
  select c.event_id, coalesce(max(c.status), 'UNKNOWN') as status,
    case when max(c.status) is null then 'HttpSink is closed' else max(c.error) end as error,
    cast(count(*) as bigint) as attempts, coalesce(sum(c.delay), 0.0) as total_delay
  from classified c join (select event_id, min(case when status is not null then attempt end) as last
                          from classified group by event_id) l on c.event_id = l.event_id
  where last is null or attempt <= last group by c.event_id)"""

_PASSES = f"""({_any("title", views.INCLUDE)} and not {_any("title", views.EXCLUDE)})"""


def _rounds(c: int) -> str:
    return f"""{_LOG}, rounds as (
  select *, {_PASSES} as passes,
    cast(floor(coalesce(sum(cast({_PASSES} as int)) over (partition by topic, "partition" order by "offset"
      rows between unbounded preceding and 1 preceding), 0) / {c}) + 1 as bigint) as round
  from log)"""


_RESULTS = f"""{_rounds(2)}, results as (
  select *, case when not passes then null
      when "partition" = 2 and "offset" >= (select cast(floor(max(event_id) * 0.7) as bigint) from events) then 'UNKNOWN'
      when "offset" % 10 = 3 then 'DEAD_LETTER' else 'DONE' end as status
  from rounds)"""

_PUBLISHED = f"""{_BODIES}, routed as (
  select *, {_topic("title")} as topic from parsed),
published as (
  select request_id, event_id, sink_id, pos,
    case when event_id % 10 = 1 then request_id else id end as id,
    case when topic is null then 'NoMatchedKafkaTopicError'
      when pos in (1, 3) and event_id % 6 = 1 then 'KafkaError' end as error_kind,
    case when topic is not null and pos in (1, 3) and event_id % 6 = 1 then concat('refused ', pos) end as error
  from routed)"""

_RULE_DOCUMENTS = """documents_of as (
  select o_custkey as owner, o_orderkey as version,
    case when o_orderkey % 11 = 0 then 'not json' when o_orderkey % 13 = 0 then ''
    when o_orderkey % 17 = 0 then '[{"topic":5,"patterns":["a"]}]'
    when o_orderkey % 19 = 0 then '[{"topic":"t","patterns":["("]}]'
    when o_orderkey % 23 = 0 then '[{"topic":"t","patterns":["a",1]}]'
    when o_orderkey % 29 = 0 then '{"topic":"t","patterns":["a"]}'
    when o_orderkey % 31 = 0 then null
    else concat('[{"topic":"event-', lower(o_orderstatus), '","patterns":["user.k', o_orderkey,
                '","my[.]a+"]}, {"patterns":[".*"],"note":1,"topic":"event-default"}]') end as data
  from orders),
lists as (
  select owner, version, case when is_list then data else '[]' end as data, is_list
  from (select *, case when json_valid(data) then json_type(data) = 'ARRAY' else false end as is_list
        from documents_of)),
entries as (
  select owner, version, i, json_extract(data, '$[' || i || ']') as e
  from lists, unnest(range(0, cast(json_array_length(data) as bigint))) t(i)),
patterns as (
  select owner, version, i, j, json_extract_string(e, '$.topic') as topic,
    json_extract_string(e, '$.patterns[' || j || ']') as pattern,
    json_type(e, '$.topic') = 'VARCHAR' and json_type(e, '$.patterns[' || j || ']') = 'VARCHAR'
      and json_extract_string(e, '$.patterns[' || j || ']') <> '(' as good
  from entries, unnest(range(0, cast(json_array_length(e, '$.patterns') as bigint))) t(j)),
good_documents as (
  select l.owner, l.version from lists l where is_list and not exists (
    select 1 from patterns p where p.owner = l.owner and p.version = l.version and not good)),
rules as (
  select p.owner, p.version, cast(row_number() over (partition by p.owner, p.version order by i, j) - 1 as int) as rank,
    topic, pattern
  from patterns p join good_documents g on p.owner = g.owner and p.version = g.version)"""


def _sink_text(k: str) -> str:
    return f"""case
    when {k} % 11 = 0 then 'http' when {k} % 13 = 0 then 'ftp#{{"uri":"u","method":"post"}}'
    when {k} % 17 = 0 then 'http#{{"uri":"u","method":"get"}}'
    when {k} % 19 = 0 then 'http#{{"method":"post"}}' when {k} % 23 = 0 then 'http#{{"uri"'
    when {k} % 3 = 0 then concat('http#{{"default-request":{{"method":"put","uri":"http://example.invalid/', {k},
        '","headers":{{"accept":"v=', {k} % 5, '"}}}},"other":1}}')
    else concat('http#{{"method":"Post","uri":"http://example.invalid/#', {k}, '","timeout":', {k} % 7,
        ',"max_retry_times":', case when {k} % 2 = 0 then '""' else '0' end,
        ',"exp_backoff_factor":0.5}}') end"""


def _sinks(source: str) -> str:
    """Parameters of the sink texts in ``source(.., data)``, as ``params``."""
    return f"""split_up as (
  select *, case when position('#' in data) > 0 then left(data, position('#' in data) - 1) else data end as kind,
    case when position('#' in data) > 0 then substr(data, position('#' in data) + 1) end as doc from {source}),
requests as (
  select *, case when doc is null or not json_valid(doc) then null
      else coalesce(json_extract(doc, '$."default-request"'), cast(doc as json)) end as r from split_up),
params as (
  select *, json_extract_string(r, '$.uri') as url, upper(json_extract_string(r, '$.method')) as method,
    json_extract_string(r, '$.headers.accept') as accept,
    coalesce(try_cast(nullif(json_extract_string(r, '$.timeout'), '') as double), 300.0) as timeout,
    coalesce(try_cast(nullif(json_extract_string(r, '$.max_retry_times'), '') as int), 3) as max_retry_times,
    coalesce(try_cast(nullif(json_extract_string(r, '$.exp_backoff_factor'), '') as double), 0.1) as exp_backoff_factor,
    coalesce(try_cast(nullif(json_extract_string(r, '$.exp_backoff_max_delay'), '') as double), 60.0) as exp_backoff_max_delay,
    case when doc is null or kind <> 'http' then 'Invalid sink type'
      when r is null then 'sink parameters are not JSON'
      when coalesce(json_type(r, '$.uri'), '') <> 'VARCHAR' then 'missing uri'
      when coalesce(json_type(r, '$.method'), '') <> 'VARCHAR' then 'missing method'
      when upper(json_extract_string(r, '$.method')) not in ('POST', 'PUT', 'PATCH')
        then 'method is not POST, PUT or PATCH' end as error
  from requests)"""


_STORIES = f"""nodes as (
  select c_custkey as k, c_nationkey, {_sink_text("c_custkey")} as data,
    case when k % 29 = 0 then 'amqp' when k % 31 = 0 then 'unset' when k % 5 = 0 then 'pattern' else 'list' end as source,
    case when k % 2 = 0 then 'none' when k % 37 = 0 then 'empty' when k % 41 = 0 then 'map'
      when k % 7 = 0 then 'black' else 'white' end as op
  from customer),
{_sinks("nodes")},
stories as (
  select concat('s', k) as story_id, c_nationkey,
    case when source = 'list' then concat('event-v2-t', k % 2, '|event-v1-', k) end as topics,
    case when source = 'pattern' then concat('event-v', k % 4, '-.*') end as topic_pattern,
    case when source = 'pattern' then concat('g#', k) else concat('relay_proj_test_s', k) end as group_id,
    url, method,
    case when op = 'white' then concat('user[.]', k, '|b') end as include,
    case when op = 'white' then 'c' when op = 'black' then concat('a', k) end as exclude,
    case when k % 10 = 0 then 'DISABLED' else 'NORMAL' end as status,
    case when source = 'amqp' then 'source is not kafka'
      when source = 'unset' then 'topics or topic-pattern must be set'
      when error is not null then error when op = 'map' then 'operator is not filter'
      when op = 'empty' then 'Empty filter params' end as error
  from params)"""


def _active(runners: str) -> str:
    return f"""with {_STORIES}
select story_id, n_name as runner from stories s join nation n on n.n_nationkey = s.c_nationkey
where error is null and status = 'NORMAL' and {runners}"""


_FANNED = f"""subscribed(story_id, by_topic, include, exclude) as (values
  ('audit', '^event-v2-t[01]$', null, null),
  ('users', '^event-v2-t0$', 'users', 'users'),
  ('buys', '^event-v2-', 'buys', null),
  ('quiet', '^event-v2-t1$', null, 'quiet'),
  ('none', '^event-v2-t9$', 'none', null)),
fanned as (
  select s.story_id, log.* from log join subscribed s on regexp_matches(log.topic, s.by_topic))"""


def _story_verdicts() -> str:
    tests = []
    for story_id, _, _, include, exclude in views.STORIES:
        kept = _any("title", include) if include else "true"
        dropped = _any("title", exclude) if exclude else "false"
        tests.append(f"when {_quote(story_id)} then {kept} and not {dropped}")
    return f"case story_id {' '.join(tests)} end"


_START = f"timestamp '{views.REPLAY_START}'"
_END = f"timestamp '{views.REPLAY_END}'"
_BOUNDS = f"""bounds as (
  select topic, "partition", min(case when "timestamp" >= {_START} then "offset" end) as lo,
    min(case when "timestamp" > {_END} then "offset" end) as hi
  from log group by topic, "partition")"""
_REPLAYED = f"""{_LOG}, {_BOUNDS}, replayed as (
  select log.* from log join bounds b on log.topic = b.topic and log."partition" = b."partition"
  where "offset" >= lo and (hi is null or "offset" < hi))"""

_LIFECYCLE = """stages as (
  select cast(event_id as varchar) as id, s as step, ts + (s // 2) * interval 1 second as ts,
    case s when 0 then 'RECEIVED' when 1 then 'TO_KAFKA' when 2 then 'IN_KAFKA' when 3 then 'FROM_KAFKA'
      when 4 then 'TO_SINK' when 5 then 'RETRY_TO_SINK'
      else case when event_id % 9 = 0 then 'TO_DEAD_LETTER' else 'IN_SINK' end end as status
  from events, unnest(range(0, 1 + event_id % 7)) t(s))"""

_MESSAGES = """texts as (
  select doc_id, text, source, lang, n_chars,
    case when doc_id % 41 = 0 then 'abc' when doc_id % 43 = 0 then ''
      when doc_id % 47 = 0 then '[1]' when doc_id % 53 = 0 then '{"id":5,"title":"t"}'
      when doc_id % 59 = 0 then concat(cast(good as varchar), '}') else cast(good as varchar) end as value
  from (select *, json_object('id', concat('d', doc_id), 'title', concat(source, '.', lang), 'published',
          cast(n_chars as varchar), 'content', text, 'actor', json_object('id', source),
          'object', json_object('kind', lang)) as good from documents)),
faults as (
  select *, case when value = '' then 'EMPTY_VALUE' when not json_valid(value) then 'NOT_JSON'
      when json_type(value) <> 'OBJECT' then 'NOT_AN_EVENT'
      when coalesce(json_type(value, '$.id'), '') <> 'VARCHAR' then 'BAD_EVENT'
      when doc_id % 61 = 0 then 'BAD_KEY' end as error_kind from texts)"""

_STREAMED_ATTEMPTS = f"""{_classified(count="200")}, {_OUTCOME}"""



def _sent_requests(limit: str) -> str:
    """What becomes of events for sinks: tries go by the scripted replies until one ends the delivery."""
    return f"""asked as (
  select *, cast(right(sink_id, 1) as int) as s from parsed where sink_id is not null),
tries as (
  select *, n, ((event_id + pos) * 7 + n * 3) % 10 as k from asked, unnest(range(1, 12)) t(n) where s < 5),
ending as (
  select *, k in (2, 3, 4, 9) or (k between 5 and 8 and n > {limit}) as ends,
    case when k in (5, 6) then 0.0 else least(pow(2.0::double, n - 1) * 0.1, 60.0::double) end as wait
  from tries),
sent as (
  select request_id, sink_id, pos, id, s, title, arg_min(k, n) filter (ends) as k, min(n) filter (ends) as attempts,
    coalesce(list_sum(list(wait order by n)[1 : min(n) filter (ends) - 1]), 0.0) as total_delay
  from ending group by all),
sent_results as (
  select request_id, pos, id, sink_id, concat('http://example.invalid/s', s) as url,
    case when k = 4 then 'DONE' else 'DEAD_LETTER' end as status,
    case when k = 4 then null when k = 2 then 'PayloadFailed' else 'Exception' end as error_kind,
    case k when 4 then null when 2 then 'payload' when 3 then 'Non-200 Status Code: 500'
      when 9 then 'Unexpected Response: something else' else 'Maximum Retries' end as error,
    attempts, round(total_delay, 6) as total_delay
  from sent
  union all
  select request_id, pos, 'root', sink_id, null, null, 'InvalidArgumentError', concat('Sink ''', sink_id, ''' not found.'), null, null
  from asked where s >= 5 and pos = 0)"""


def _answers(everything: str) -> str:
    return f"""everything as ({everything}),
        failures as (
          select request_id, id, min(pos) as pos,
            arg_max(concat('<', error_kind, '> ', coalesce(error, '')), pos) as detail
          from everything where error_kind is not null group by request_id, id),
        told as (
          select request_id, string_agg(concat(id, '=', detail), ';' order by pos) as details,
            string_agg(concat(id, ': ', detail), chr(10) order by pos) as lines
          from failures group by request_id),
        counted as (select request_id, count(*) as total, count(*) filter (error_kind is null) as succeeded
          from everything group by request_id)
        select c.request_id,
          case when succeeded = total then 'all_succ' when succeeded > 0 then 'part_succ' else 'all_fail' end as status,
          cast(case when succeeded = total then 200 else 400 end as int) as http_code,
          coalesce(details, '') as details,
          case when succeeded = total then 'ok' when succeeded > 0 then concat('part_ok', chr(10), lines)
            else concat('fail', chr(10), lines) end as plain
        from counted c left join told t on c.request_id = t.request_id"""


ORACLES: dict[str, str] = {
    "kafka_topics_source": f"""with {_LOG}
        select id, title, topic, "partition", "offset", id as key from log where topic = 'event-v2-t1'""",
    "kafka_pattern_source": f"""with {_LOG}
        select id, title, topic, "partition", "offset", id as key from log
        where regexp_matches(topic, '^event-v[0-9]-(t0|x)')""",
    "request_bodies_source": f"with {_BODIES} select request_id, pos, id, title, sink_id from parsed",
    "replay_window": f'with {_REPLAYED} select topic, "partition", "offset", id from replayed',
    "seek_offsets": f"with {_LOG}, {_BOUNDS} select * from bounds where lo is not null",
    "load_topic_rules": f"with {_RULE_DOCUMENTS} select owner, version, rank, topic, pattern from rules",
    "rejected_rules": f"""with {_RULE_DOCUMENTS} select owner, version from lists
        except select owner, version from good_documents""",
    "current_rules": f"""with {_RULE_DOCUMENTS}
        select r.owner, r.version, rank, topic, pattern from rules r join
          (select owner, max(version) as version from good_documents group by owner) g
        on r.owner = g.owner and r.version = g.version""",
    "load_sinks": f"""with texts as (select c_name as sink_id, {_sink_text("c_custkey")} as data from customer),
        {_sinks("texts")}
        select sink_id, url, method, accept, timeout, max_retry_times, exp_backoff_factor,
          exp_backoff_max_delay, error from params""",
    "current_sinks": f"""with versions as (
          select o_orderkey as version, o_custkey as owner, {_sink_text("o_orderkey")} as data from orders
          where o_orderkey % 37 <> 0 and o_orderkey % 39 <> 0),
        named as (select version, concat('cust', owner) as sink_id, data from versions
          union all select version, 'shared', data from versions),
        {_sinks("named")}
        select sink_id, version, url, method, timeout, max_retry_times from params where error is null
        qualify row_number() over (partition by sink_id order by version desc) = 1""",
    "load_stories": f"""with {_STORIES} select story_id, topics, topic_pattern, group_id, url, method,
        include, exclude, status, error from stories""",
    "active_stories": _active(
        "n_regionkey = (select r_regionkey from region where r_name = 'ASIA')"
    ),
    "active_stories_shared": _active("n_nationkey % 4 = 1"),
    "parse_request_bodies": f"""with {_BODIES} select request_id, pos, id, title, published, actor_id,
        object_id, target_id from parsed""",
    "quarantine_bodies": f"with {_BODIES} select request_id, error_kind, error from rejected",
    "parse_kafka_messages": f"""with {_MESSAGES}
        select json_extract_string(value, '$.id') as id, json_extract_string(value, '$.title') as title,
          json_extract_string(value, '$.published') as published,
          json_extract_string(value, '$.actor.id') as actor_id,
          json_extract_string(value, '$.object.id') as object_id, 'event-v1-docs' as topic,
          cast(doc_id % 8 as int) as "partition", doc_id as "offset", concat('k', doc_id) as key,
          md5(text) as content_md5
        from faults where error_kind is null""",
    "quarantine_messages": f"""with {_MESSAGES}
        select doc_id as "offset", error_kind, case error_kind
          when 'EMPTY_VALUE' then 'Message value must not be empty.'
          when 'NOT_JSON' then 'Request body must not an non-empty Json.'
          when 'NOT_AN_EVENT' then 'Invalid format of the event'
          when 'BAD_EVENT' then 'not a string: id, published' else 'not a string: key' end as error
        from faults where error_kind is not null""",
    "validate_envelope": """select event_id, concat_ws(', ', case when event_id % 3 <> 0 then 'id' end,
        case when event_id % 4 = 0 then 'title' end, case when event_id % 5 = 0 then 'published' end)
        as bad_fields from events""",
    "extract_extra": """select event_id,
        nullif(concat_ws(',', case when event_id % 3 <> 1 then 'actor_id' end,
          case when event_id % 4 = 0 then 'object_id' end,
          case when event_id % 5 <> 0 and event_id % 2 = 0 then 'target_id' end), '') as present,
        case event_id % 3 when 0 then concat('u', user_id) when 2 then cast(user_id as varchar) end as actor_id,
        case when event_id % 4 = 0 then '{"x":1}' end as object_id, cast(null as varchar) as target_id
        from events""",
    "payload_text_exact": f"""with {_BODIES}
        select request_id, c.pos, replace(replace(replace(el, ',"', ', "'), '":', '": '), '":  ', '": ') as payload
        from parsed c join pieces p on p.event_id = c.event_id and p.j = c.pos""",
    "event_summary": f"""with {_LOG} select "offset", concat('{{"id":"', id, '","title":"', title,
        '","published":"', published, '","topic":"', topic, '","partition":', "partition", ',"offset":', "offset",
        '}}') as summary from log""",
    "to_kafka_records": f"with {_LOG} select topic, id as key, payload as value from log",
    "include_events": f"with {_LOG} select id, title from log where {_any('title', views.INCLUDE)}",
    "exclude_events": f"with {_LOG} select id, title from log where not {_any('title', views.EXCLUDE)}",
    "filter_events": f"with {_LOG} select id, title from log where {_PASSES}",
    "transform_chain": f"""with {_LOG} select id, upper(title) as title from log
        where regexp_matches(title, '^(user\\.|my\\.profile)', 'i')
          and not regexp_matches(title, '^my\\.profile\\.(view|click)', 'i')""",
    "filter_documents": f"""select doc_id from documents
        where {_any("text", ["[a-m]", "é"])} and not {_any("text", ["(is|un|la) "])}""",
    "story_filter": f"with {_LOG}, {_FANNED} select story_id, id, title from fanned where {_story_verdicts()}",
    "resolve_topic": f"with {_LOG} select id, title, {_topic('title')} as topic from log",
    "dedupe_patterns": f"""with {_RULE_DOCUMENTS}
        select owner, pattern, cast(min(version * 4 + rank) as bigint) as rank,
          arg_min(topic, version * 4 + rank) as topic
        from rules group by owner, pattern""",
    "unrouted_events": f"""with {_LOG} select id, title, 'NoMatchedKafkaTopicError' as error_kind from log
        where {_topic('title')} is null""",
    "story_fanout": f"with {_LOG}, {_FANNED} select story_id, topic, id from fanned",
    "dispatch_to_sink": f"""with {_BODIES}, numbered as (
          select *, cast(right(sink_id, 1) as int) < 5 as known from parsed where sink_id is not null)
        select request_id, sink_id, case when known then id else 'root' end as id,
          case when known then title end as title,
          case when known then concat('http://example.invalid/s', right(sink_id, 1)) end as url,
          case when not known then 'InvalidArgumentError' end as error_kind,
          case when not known then concat('Sink ''', sink_id, ''' not found.') end as error
        from numbered where known or pos = 0""",
    "delivery_rounds": f'with {_rounds(1)} select topic, "partition", "offset", round from rounds',
    "delivery_rounds_concurrent": f'with {_rounds(3)} select topic, "partition", "offset", round from rounds',
    "classify_attempt": f"""with {_classified()}
        select event_id, attempt, action, status, error, delay from classified""",
    "backoff_delays": """select event_id, least(pow(2.0::double, event_id % 12) * 0.5, 60.0::double) as delay,
        least(pow(2.0::double, event_id % 12) * (event_id % 3 + 0.25::double), 9.0::double) as capped from events""",
    "delivery_outcome": f"""with {_classified()}, {_OUTCOME}
        select event_id, status, error, attempts, round(total_delay, 6) as total_delay from outcome""",
    "delivery_outcome_spans": f"""with {_classified("event_id % 3", "1.0", "3.0")}, {_OUTCOME}
        select * from outcome""",
    "committable_offsets": f"""with {_RESULTS}
        select topic, "partition", max("offset") + 1 as next_offset from results
        where round < coalesce((select min(round) from results where status = 'UNKNOWN'), 9223372036854775807)
          and round in (select round from results where passes)
        group by topic, "partition" """,
    "committable_offsets_filtered": f"""with {_LOG}
        select topic, "partition", max("offset") + 1 as next_offset from log group by topic, "partition" """,
    "offset_ledger": f"""with {_RESULTS}, marks as (
          select "offset" % 3 as batch, min(case when status = 'UNKNOWN' then round end) as broken, max(case when passes then round end) as sent
          from results group by 1),
        settled as (
          select r.* from results r join marks m on m.batch = r."offset" % 3
          where (m.broken is null or r.round < m.broken) and r.round <= m.sent)
        select r.topic, r."partition", max(s."offset") + 1 as next_offset, max(r."offset") + 1 as seen
        from results r left join settled s on s.topic = r.topic and s."partition" = r."partition" and s."offset" = r."offset"
        group by r.topic, r."partition" """,
    "dead_letter_topics": f"""with {_LOG} select "offset", regexp_replace(concat(
          case "offset" % 5 when 0 then '' when 1 then 'event-v2-' when 2 then 'event-v12-'
            when 3 then 'x-event-v1-' else 'event-v3-dead-letter-' end, topic),
          '^(event-v[0-9]-)?', '\\1dead-letter-') as topic from log""",
    "dead_letter_records": f"""with {_RESULTS}
        select regexp_replace(topic, '^(event-v[0-9]-)?', '\\1dead-letter-') as topic, id as key, payload as value
        from results where status = 'DEAD_LETTER'""",
    "batch_ack": f"""with {_PUBLISHED}, {_answers("""
          select request_id, pos, id, error_kind, error from published
          union all select request_id, 0, 'root', 'EventValidationError', error from rejected""")}""",
    "ack_status": f"""with {_PUBLISHED}, counted as (
          select request_id, count(*) as total, count(*) filter (error_kind is null) as succeeded
          from published group by request_id)
        select *, case when succeeded = total then 'all_succ' when succeeded > 0 then 'part_succ'
            else 'all_fail' end as status,
          cast(case when succeeded = total then 200 else 400 end as int) as http_code from counted""",
    "ack_details": f"""with {_PUBLISHED}
        select request_id, id, min(pos) as pos,
          arg_max(concat('<', error_kind, '> ', coalesce(error, '')), pos) as detail
        from published where error_kind is not null group by request_id, id""",
    "topic_counts": f"""with {_LOG} select coalesce({_topic('title')}, 'unknown') as topic, count(*) as n
        from log group by 1""",
    "sink_counts": f"""with {_PUBLISHED} select coalesce(sink_id, 'kafka') as sink_id, count(*) as events,
        count(*) filter (error_kind is not null) as failed from published group by 1""",
    "path_counts": f"""with {_PUBLISHED}
        select case when sink_id is null then 'kafka' else 'sink' end as path,
          count(distinct request_id) as requests,
          count(distinct case when error_kind is not null then request_id end) as failed
        from published group by 1""",
    "story_outcome_counts": f"""with {_RESULTS},
        {_FANNED.replace("select s.story_id, log.* from log", "select s.story_id, log.* from results log")}
        select story_id, count(*) as new, count(*) filter (status = 'DONE') as done,
          count(*) filter (status = 'UNKNOWN') as unknown,
          count(*) filter (status = 'DEAD_LETTER') as dead_letter
        from fanned where passes group by story_id""",
    "send_time_stats": f"""with {_ATTEMPTS.format(count="event_id % 6")}, timed as (
          select *, case when error_kind is null or error_kind = 'payload' then duration_ms end as ms from attempts)
        select sink_id, count(ms) as answered, min(ms) as min_ms, max(ms) as max_ms, round(avg(ms), 6) as avg_ms,
          median(ms) as median_ms, count(*) filter (attempt > 1) as retries
        from timed group by sink_id""",
    "latency_summary": """with times as (
          select 'request_time' as metric, value as t from events
          union all select 'receive_time', value * 2 + user_id from events where event_id % 3 <> 0)
        select metric, count(t) as n, max(t) as max, median(t) as median, round(avg(t), 6) as mean, min(t) as min
        from times group by metric""",
    "poll_counts": f'with {_LOG} select topic, "partition", count(*) as n from log group by topic, "partition"',
    "replay_count": f"""with {_RESULTS} select count(*) as total, count(*) filter (status = 'DONE') as done,
          count(*) filter (status = 'DEAD_LETTER') as dead_letter,
          count(*) filter (status = 'UNKNOWN') as unknown
        from results where passes""",
    "lifecycle_counts": f"with {_LIFECYCLE} select status, count(*) as n from stages group by status",
    "lifecycle_latest": f"""with {_LIFECYCLE} select id, status from stages
        qualify row_number() over (partition by id order by ts desc, step desc) = 1""",
    "windowed_counts": f"""with {_LOG}
        select strftime(time_bucket(interval 6 hours, ts, timestamp '1970-01-01'), '%Y-%m-%d %H:%M:%S') as window_start,
          coalesce({_topic('title')}, 'unknown') as topic, count(*) as n from log group by 1, 2""",
    "valid_patterns": """select event_id, concat(case event_id % 5 when 0 then '(' when 1 then '' when 2 then '['
            when 3 then '(?:' else 'a|' end, event_type, case when event_id % 2 = 0 then ')' else '' end) as pattern,
          case when event_id % 5 in (0, 3) then event_id % 2 = 0 when event_id % 5 = 2 then false
            else event_id % 2 <> 0 end as valid from events""",
    "zoned_times": """select event_id, case event_id % 5 when 0 then s - 7200000 when 1 then s + 19800000
            when 2 then s end as ms
        from (select event_id, epoch_us(ts) // 1000000 * 1000 as s from events)""",
    "header_maps": """select event_id, 'last' as a, concat('x=', user_id) as b, 'kept' as c,
        cast(3 as int) as n from events""",
    "windowed_counts_stream": f"""with {_LOG}
        select strftime(time_bucket(interval 6 hours, ts, timestamp '1970-01-01'), '%Y-%m-%d %H:%M:%S') as window_start,
          topic, count(*) as n from log group by 1, 2""",
    "route_by_state": f"""with {_LOG} select id, title,
        case when event_id % 3 = 0 then {_topic('title')} else {_topic('title', views.RULES[::-1])} end as topic from log""",
    "publish": f"""with {_LOG}, routed as (select *, {_topic('title')} as target from log)
        select target as topic, id as key, concat('{{"id":"', id, '","title":"', title, '","published":"', published,
          '","user":', user_id, '}}') as value from routed where target is not null""",
    "deliver_events": f"""with {_LOG}, {_STREAMED_ATTEMPTS}
        select id, status, error, attempts, round(total_delay, 6) as total_delay
        from log join outcome o on log.event_id = o.event_id where {_PASSES}""",
    "run_story": f"""with {_LOG}, {_STREAMED_ATTEMPTS}
        select regexp_replace(topic, '^(event-v[0-9]-)?', '\\1dead-letter-') as topic, id as key
        from log join outcome o on log.event_id = o.event_id where {_PASSES} and status = 'DEAD_LETTER'""",
    "payload_text": f"""with {_BODIES} select c.request_id, c.pos, case when c.event_id % 4 = 0 then concat(' ', el) else el end as payload
        from parsed c join pieces p on p.event_id = c.event_id and p.j = c.pos""",
    "examine_bodies": f"""with {_BODIES} select request_id, pos, id, title, null as error_kind, null as error from parsed
        union all select request_id, null, null, null, error_kind, error from rejected""",
    "sink_lanes": f"""with {_BODIES}, sized as (
          select sink_id, count(*) filter (cast(right(sink_id, 1) as int) < 5 or pos = 0) as n,
            greatest(cast(right(sink_id, 1) as int) * 3, 1) as most
          from parsed where sink_id is not null group by sink_id),
        laned as (select *, least(cast(ceil(n / 50) as int), most) as lanes from sized)
        select sink_id, n, lanes::bigint as lanes, cast(most // lanes as int) as at_once from laned""",
    "deliver_requests": f"""with {_BODIES}, {_sent_requests("s")} select * from sent_results""",
    "handle_requests": f"""with {_BODIES}, {_sent_requests("3")}, {_answers(f"""
          select request_id, pos, id, case when {_topic("title")} is null then 'NoMatchedKafkaTopicError' end as error_kind,
            '' as error from parsed where sink_id is null
          union all select request_id, pos, id, error_kind, error from sent_results
          union all select request_id, 0, 'root', 'EventValidationError', error from rejected""")}""",
    "run_shared": f"""with {_LOG}, {_FANNED}, {_STREAMED_ATTEMPTS}
        select story_id, id, status, error, attempts from fanned join outcome o on fanned.event_id = o.event_id
        where {_story_verdicts()}""",
    "lifecycle_log": f"""with {_LOG}, {_FANNED}, {_STREAMED_ATTEMPTS}, sent as (
          select story_id, status, attempts from fanned join outcome o on fanned.event_id = o.event_id where {_story_verdicts()})
        select story_id, 'FROM_KAFKA' as status, count(*) as n from sent group by 1
        union all select story_id, 'TO_SINK', count(*) from sent group by 1
        union all select story_id, 'RETRY_TO_SINK', cast(sum(attempts - 1) as bigint) from sent group by 1 having sum(attempts - 1) > 0
        union all select story_id, 'IN_SINK', count(*) from sent where status = 'DONE' group by 1
        union all select story_id, 'TO_DEAD_LETTER', count(*) from sent where status = 'DEAD_LETTER' group by 1""",
    "replay_events": f"""with {_REPLAYED}, {_STREAMED_ATTEMPTS}
        select count(*) as total, count(*) filter (status = 'DONE') as done,
          count(*) filter (status = 'DEAD_LETTER') as dead_letter,
          count(*) filter (status = 'UNKNOWN') as unknown
        from replayed r join outcome o on r.event_id = o.event_id""",
    "row_transform": f"""with {_LOG} select id, upper(title) as title from log where event_id % 2 = 0""",
}
ORACLES["replay_landed"], ORACLES["seek_landed"] = ORACLES["replay_window"], ORACLES["seek_offsets"]
ORACLES["closed_windows"] = ORACLES["windowed_counts_stream"]
ORACLES["story_filter_large"] = ORACLES["story_filter"]
for _same in ("resolve_topic_table", "resolve_distinct_titles", "resolve_distinct_titles_large", "route_stream"):
    ORACLES[_same] = ORACLES["resolve_topic"]
