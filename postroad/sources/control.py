"""Control tables: routing rules, sinks, stories, and their current versions.

Documents arrive as rows of text. They are parsed with the same strict JSON rules as
events; a fault is kept as a row with an ``error`` instead of stopping the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postroad import schema
from postroad.functions.pattern_index import compile_all, compiles
from postroad.functions.strict_json import evaluate_once, field, is_json_string, with_variant
from postroad.functions.text import group_id
from postroad.operators.lookup import lookup_join


def _strings(value: Column, path: str) -> Column:
    """A JSON list of strings as an array; null for anything else."""
    listed = field(value, path, "array<variant>")
    strict = F.forall(listed, is_json_string)
    return F.when(strict, F.transform(listed, lambda v: F.try_variant_get(v, "$", "string")))


def _examined_rules(df: DataFrame, data: str) -> DataFrame:
    """Add ``_entries`` (topic, patterns) and ``_valid``: one bad entry rejects all."""
    entries = F.transform(
        field(F.col("_value"), "$", "array<variant>"),
        lambda e: F.struct(
            F.when(is_json_string(field(e, "$.topic")), field(e, "$.topic", "string")).alias("topic"),
            _strings(e, "$.patterns").alias("patterns"),
        ),
    )
    staged = evaluate_once(with_variant(df, F.col(data), "_value"), _entries=entries)
    complete = F.forall("_entries", lambda e: e["topic"].isNotNull() & e["patterns"].isNotNull())
    usable = compile_all(F.flatten(F.transform("_entries", lambda e: e["patterns"])))
    return staged.withColumn("_valid", F.coalesce(complete & usable, F.lit(False))).drop("_value")


def _ranked_rules(examined: DataFrame, keep: Sequence[str]) -> DataFrame:
    nested = F.transform(
        "_entries",
        lambda e: F.transform(e["patterns"], lambda p: F.struct(e["topic"].alias("topic"), p.alias("pattern"))),
    )
    return examined.select(*keep, F.posexplode(F.flatten(nested)).alias("rank", "_rule")).select(
        *keep, "rank", "_rule.topic", "_rule.pattern"
    )


def load_topic_rules(df: DataFrame, data: str = "data") -> DataFrame:
    """Documents ``[{"topic", "patterns": [..]}]`` as rules ``(rank, topic, pattern)``.

    Rank follows entry order, then pattern order. A document with any bad entry gives
    no rules (see `rejected_rules`).
    """
    keep = [c for c in df.columns if c != data]
    return _ranked_rules(_examined_rules(df, data).where("_valid"), keep)


def rejected_rules(df: DataFrame, data: str = "data") -> DataFrame:
    return _examined_rules(df, data).where(~F.col("_valid")).drop("_entries", "_valid")


def has_valid_rules(snapshots: DataFrame, data: str = "data") -> bool:
    """Whether any document is valid, one without rules included."""
    return not _examined_rules(snapshots, data).where("_valid").isEmpty()


def current_rules(snapshots: DataFrame, by: Sequence[str] = (), data: str = "data") -> DataFrame:
    """Rules of the latest valid document; invalid or empty ones leave the old rules.

    ``snapshots`` has ``version`` and the document; ``by`` names columns that tell
    independent rule sets apart. A document that comes back unchanged is examined once.
    """
    texts = snapshots.groupBy(*by, data).agg(F.max("version").alias("version"))
    valid = _examined_rules(texts, data).where("_valid")
    latest = valid.groupBy(*by).agg(
        F.max("version").alias("version"), F.max_by("_entries", "version").alias("_entries")
    )
    return _ranked_rules(latest, [*by, "version"])


NUMBERS = {
    "timeout": "double",
    "max_retry_times": "int",
    "exp_backoff_factor": "double",
    "exp_backoff_max_delay": "double",
}


def _number(value: Column, name: str) -> Column:
    """A parameter as a number; an absent one or ``""`` counts as not given."""
    return F.nullif(field(value, f"$.{name}", "string"), F.lit("")).try_cast(NUMBERS[name])


def _given(value: Column, path: str) -> Column:
    """Whether there is a value that is neither null nor ``""``."""
    found = field(value, path)
    void = found.isNull() | (F.schema_of_variant(found) == "VOID")
    return ~void & ~F.coalesce(field(value, path, "string") == "", F.lit(False))


def _wrong_number(value: Column) -> Column:
    """A number that is given and is none."""
    return reduce(or_, [_given(value, f"$.{n}") & _number(value, n).isNull() for n in NUMBERS])


def _wrong_headers(value: Column) -> Column:
    """Headers that are given and are no object of strings."""
    texts = F.forall(F.map_values(field(value, "$.headers", "map<string,variant>")), is_json_string)
    return _given(value, "$.headers") & ~F.coalesce(texts, F.lit(False))


def _wrong_strings(value: Column, path: str) -> Column:
    """A list that is given and is no list of strings."""
    return _given(value, path) & _strings(value, path).isNull()


def _wrong_patterns(patterns: Column) -> Column:
    return ~F.coalesce(compile_all(patterns), F.lit(True))


def _sink_columns(
    df: DataFrame, data: Column, defaults: bool = True
) -> tuple[DataFrame, dict[str, Column], Column]:
    """Stage one sink text ``http#{json}``; give its parameter columns and its error."""
    parts = F.split(data, "#", 2)
    staged = evaluate_once(df, _type=F.get(parts, F.lit(0)), _json=F.get(parts, F.lit(1)))
    staged = with_variant(staged, F.col("_json"), "_doc")
    request = F.coalesce(field(F.col("_doc"), "$['default-request']"), F.col("_doc"))
    staged = evaluate_once(staged, _sink=request).drop("_doc")
    value = F.col("_sink")
    method = F.upper(field(value, "$.method", "string"))
    columns = {
        "url": field(value, "$.uri", "string"),
        "method": method,
        "headers": field(value, "$.headers", "map<string,string>"),
        **{name: _number(value, name) for name in NUMBERS},
    }
    if defaults:
        for name, default in schema.SINK_DEFAULTS.items():
            columns[name] = F.coalesce(columns[name], F.lit(default))
    error = (
        F.when(F.col("_json").isNull() | (F.col("_type") != "http"), "Invalid sink type")
        .when(value.isNull(), "sink parameters are not JSON")
        .when(~is_json_string(field(value, "$.uri")), "missing uri")
        .when(~is_json_string(field(value, "$.method")), "missing method")
        .when(~method.isin(schema.HTTP_METHODS), "method is not POST, PUT or PATCH")
        .when(_wrong_headers(value), "headers are not an object of strings")
        .when(_wrong_number(value), "a parameter is not a number")
    )
    return staged, columns, error


def load_sinks(df: DataFrame, data: str = "data", defaults: bool = True) -> DataFrame:
    """Sink texts as parameter rows with an ``error`` column, null for usable sinks.

    The older form nests the parameters under ``default-request``. ``defaults`` fills
    in parameters that are not given.
    """
    keep = [c for c in df.columns if c != data]
    staged, columns, error = _sink_columns(df, F.col(data), defaults)
    return staged.select(*keep, *[c.alias(n) for n, c in columns.items()], error.alias("error"))


def sink_entries(documents: DataFrame, data: str = "data") -> DataFrame:
    """Documents ``{"<sink id>": "http#{..}"}`` as ``(sink_id, data)`` rows.

    Documents that are not JSON objects give nothing.
    """
    keep = [c for c in documents.columns if c != data]
    parsed = with_variant(documents, F.col(data), "_value")
    entries = field(F.col("_value"), "$", "map<string,variant>")
    return parsed.select(*keep, F.explode(entries).alias("sink_id", "_text")).select(
        *keep, "sink_id", F.try_variant_get("_text", "$", "string").alias(data)
    )


def current_sinks(snapshots: DataFrame, by: Sequence[str] = (), data: str = "data") -> DataFrame:
    """Latest usable entry of each sink: documents add and update, they do not remove.

    A bad entry is skipped and leaves the older one in place. An entry that comes back
    unchanged is examined once.
    """
    texts = (
        sink_entries(snapshots, data)
        .groupBy(*by, "sink_id", data)
        .agg(F.max("version").alias("version"))
    )
    staged, columns, error = _sink_columns(texts, F.col(data))
    params = F.struct(*[c.alias(n) for n, c in columns.items()])
    usable = evaluate_once(staged, _error=error, _params=params).where(F.col("_error").isNull())
    latest = usable.groupBy(*by, "sink_id").agg(
        F.max("version").alias("version"), F.max_by("_params", "version").alias("_params")
    )
    return latest.select(*by, "sink_id", "version", "_params.*")


def load_stories(
    nodes: DataFrame, group_prefix: str, project_id: str, env: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Nodes ``(path, data)`` as one row per story.

    A path ends in ``stories/<story id>/<node>`` with nodes ``source``, ``sink``,
    ``status`` and perhaps ``operators``. A story that cannot run has an ``error``.
    ``keep`` names columns that belong to a story's key.
    """
    path = r"(?:^|/)stories/([^/]+)/(source|sink|operators|status)$"
    named = nodes.select(
        *keep,
        F.regexp_extract("path", path, 1).alias("story_id"),
        F.regexp_extract("path", path, 2).alias("node"),
        "data",
    ).where(F.col("story_id") != "")
    stories = named.groupBy(*keep, "story_id").pivot(
        "node", ["source", "sink", "operators", "status"]
    ).agg(F.first("data"))

    for node in ("source", "operators"):
        parts = F.split(node, "#", 2)
        stories = evaluate_once(
            stories,
            **{f"_{node}_type": F.get(parts, F.lit(0)), f"_{node}_json": F.get(parts, F.lit(1))},
        )
        stories = with_variant(stories, F.col(f"_{node}_json"), f"_{node}")
    staged, sink, sink_error = _sink_columns(stories, F.col("sink"))

    source, operators = F.col("_source"), F.col("_operators")
    topics = _strings(source, "$.topics")
    topic_pattern = F.nullif(field(source, "$['topic-pattern']", "string"), F.lit(""))
    include = _strings(operators, "$['event-name-white-list']")
    exclude = _strings(operators, "$['event-name-black-list']")
    has_filter = F.col("operators").isNotNull()
    empty = F.array().cast("array<string>")
    error = (
        F.when(F.col("source").isNull(), "missing source")
        .when(F.col("_source_json").isNull() | (F.col("_source_type") != "kafka"), "source is not kafka")
        .when(source.isNull(), "source parameters are not JSON")
        .when(_wrong_strings(source, "$.topics"), "topics are not a list of strings")
        .when(topics.isNull() & topic_pattern.isNull(), "topics or topic-pattern must be set")
        .when(topic_pattern.isNotNull() & ~compiles(topic_pattern), "topic-pattern does not compile")
        .when(F.col("sink").isNull(), "missing sink")
        .when(sink_error.isNotNull(), sink_error)
        .when(
            has_filter & (F.col("_operators_json").isNull() | (F.col("_operators_type") != "filter")),
            "operator is not filter",
        )
        .when(has_filter & operators.isNull(), "operator parameters are not JSON")
        .when(
            has_filter
            & (
                _wrong_strings(operators, "$['event-name-white-list']")
                | _wrong_strings(operators, "$['event-name-black-list']")
            ),
            "a filter list is not a list of strings",
        )
        .when(has_filter & (_wrong_patterns(include) | _wrong_patterns(exclude)), "a filter pattern does not compile")
        .when(
            has_filter
            & (F.size(F.coalesce(include, empty)) + F.size(F.coalesce(exclude, empty)) == 0),
            "Empty filter params",
        )
        .when(F.col("status").isNull(), "missing status")
    )
    return staged.select(
        *keep,
        "story_id",
        topics.alias("topics"),
        topic_pattern.alias("topic_pattern"),
        F.coalesce(
            F.nullif(field(source, "$['group-id']", "string"), F.lit("")),
            group_id(F.col("story_id"), group_prefix, project_id, env),
        ).alias("group_id"),
        *[c.alias(n) for n, c in sink.items()],
        include.alias("include"),
        exclude.alias("exclude"),
        F.when(F.col("status") == "DISABLED", "DISABLED").otherwise("NORMAL").alias("status"),
        error.alias("error"),
    )


def active_stories(stories: DataFrame, runners: DataFrame, project_id: str) -> DataFrame:
    """Stories to run: those of the project's runners, else of ``all``, else none.

    ``runners`` has ``(project_id, runners ARRAY<STRING>)``; stories have a ``runner``
    column. Only NORMAL stories run.
    """
    mine = F.max_by("runners", F.col("project_id") == project_id)
    chosen = (
        runners.where(F.col("project_id").isin(project_id, "all"))
        .agg(mine.alias("runners"))
        .select(F.explode("runners").alias("runner"))
        .distinct()
    )
    return lookup_join(
        stories.where(F.col("status") == "NORMAL"), chosen, ["runner"], "left_semi", ["story_id"]
    )
