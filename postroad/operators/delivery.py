"""Delivery accounting: rounds, attempt outcomes, offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from postroad import schema
from postroad.functions.text import backoff_delay, dead_letter_topic

PARTITION = ("topic", "partition")
CHUNK = 1 << 18  # offsets of one partition that share a task


def _scalar(value: Column | float | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def delivery_rounds(
    df: DataFrame,
    passes: Column,
    c: int = 1,
    by: Sequence[str] = PARTITION,
    chunk: int = CHUNK,
) -> DataFrame:
    """Add ``passes`` and ``round``: each round sends up to ``c`` passing events.

    Rounds count from 1 per partition, in offset order; a filtered event falls into the
    round of the next passing one. The running count is taken within chunks of
    ``chunk`` offsets, and chunk totals carry over, so no task holds a whole partition.
    """
    marked = df.withColumn("passes", F.coalesce(passes, F.lit(False))).withColumn(
        "_chunk", F.expr(f"`offset` div {chunk}")
    )
    passing = F.col("passes").cast("long")
    in_chunk = (
        Window.partitionBy(*by, "_chunk")
        .orderBy("offset")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        marked.groupBy(*by, "_chunk")
        .agg(F.sum(passing).alias("_n"))
        .withColumn("_carried", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    before = F.coalesce(F.sum(passing).over(in_chunk), F.lit(0))
    return (
        marked.withColumn("_before", before)
        .join(carried, [*by, "_chunk"])
        .withColumn("round", F.expr(f"(_before + _carried) div {c} + 1"))
        .select(*df.columns, "passes", "round")
    )


def classify_attempt(
    attempts: DataFrame,
    max_retry: Column | int = schema.SINK_DEFAULTS["max_retry_times"],
    factor: Column | float = schema.SINK_DEFAULTS["exp_backoff_factor"],
    cap: Column | float = schema.SINK_DEFAULTS["exp_backoff_max_delay"],
) -> DataFrame:
    """Add ``action, status, error, delay`` to each attempt.

    ``action`` is DONE, DEAD_LETTER, RETRY (at once) or BACKOFF (after ``delay``
    seconds); ``status`` is set only where the attempt ends the delivery. Input columns
    are ``attempt, http_status, body, error_kind`` and, if there is one, the text of
    the exception in ``error``.
    """
    raised = F.col("error_kind").isNotNull()
    reply = F.lower("body")
    answered = F.col("http_status") == 200
    out_of_retries = F.col("attempt") > _scalar(max_retry)
    broken = F.col("error_kind").isin("response", "payload")
    exception = F.coalesce("error", "error_kind") if "error" in attempts.columns else F.col("error_kind")

    action = (
        F.when(raised, F.when(broken, "DEAD_LETTER").otherwise("BACKOFF"))
        .when(~answered, "DEAD_LETTER")
        .when(reply == "ok", "DONE")
        .when(
            reply.isin("retry", "exponential_backoff_retry"),
            F.when(out_of_retries, "DEAD_LETTER")
            .when(reply == "retry", "RETRY")
            .otherwise("BACKOFF"),
        )
        .otherwise("DEAD_LETTER")
    )
    reason = (
        F.when(raised, exception)
        .when(~answered, F.format_string("Non-200 Status Code: %d", "http_status"))
        .when(reply.isin("retry", "exponential_backoff_retry"), schema.MAX_RETRIES)
        .otherwise(F.concat(F.lit("Unexpected Response: "), F.col("body")))
    )
    act = F.col("action")
    return attempts.withColumn("action", action).withColumns({
        "status": F.when(act.isin("DONE", "DEAD_LETTER"), act),
        "error": F.when(act == "DEAD_LETTER", reason),
        "delay": F.when(act == "RETRY", F.lit(0.0)).when(
            act == "BACKOFF", backoff_delay(F.col("attempt"), factor, cap)
        ),
    })


def delivery_outcome(
    classified: DataFrame, key: Sequence[str] = ("event_id",), width: int = 4096
) -> DataFrame:
    """Per event: ``status, error, attempts, total_delay`` up to its first ending attempt.

    Takes the output of `classify_attempt`; later attempts are ignored; without an
    ending attempt the status is UNKNOWN. Attempts are first reduced in spans of
    ``width``, so an event with very many of them is spread over tasks.
    """
    span = F.expr(f"(attempt - 1) div {width}")
    ended = F.col("status").isNotNull()
    within = Window.partitionBy(*key, "_span")
    spans = (
        classified.select(*key, "attempt", "status", "error", "delay", span.alias("_span"))
        .withColumn("_end", F.min(F.when(ended, F.col("attempt"))).over(within))
        .where(F.col("_end").isNull() | (F.col("attempt") <= F.col("_end")))
        .groupBy(*key, "_span")
        .agg(
            F.max("status").alias("status"),
            F.max("error").alias("error"),
            F.count("*").alias("n"),
            F.coalesce(F.sum("delay"), F.lit(0.0)).alias("delay"),
        )
    )
    last = F.min(F.when(ended, F.col("_span"))).over(Window.partitionBy(*key))
    return (
        spans.withColumn("_last", last)
        .where(F.col("_last").isNull() | (F.col("_span") <= F.col("_last")))
        .groupBy(*key)
        .agg(
            F.coalesce(F.max("status"), F.lit("UNKNOWN")).alias("status"),
            F.when(F.max("status").isNull(), schema.SINK_CLOSED)
            .otherwise(F.max("error"))
            .alias("error"),
            F.sum("n").alias("attempts"),
            F.sum("delay").alias("total_delay"),
        )
    )


def committable_offsets(
    results: DataFrame, by: Sequence[str] = PARTITION, commit_filtered: bool = False
) -> DataFrame:
    """Per partition: the offset to resume from, over the rounds that are settled.

    ``results`` has ``round, passes, offset, status`` (status of passing events). Rounds
    from the first one with an UNKNOWN on are left out, and so is a trailing round in
    which no partition sends anything, unless ``commit_filtered``.
    """
    unknown = F.col("passes") & (F.coalesce("status", F.lit("UNKNOWN")) == "UNKNOWN")
    # One pass over the events; both limits and the answer come from this table.
    results = results.groupBy(*by, "round").agg(
        F.max("offset").alias("offset"), F.max("passes").alias("sent"), F.max(unknown).alias("unknown")
    )
    marks = results.agg(
        F.min(F.when(F.col("unknown"), F.col("round"))).alias("broken"),
        F.max(F.when(F.col("sent"), F.col("round"))).alias("sent"),
    )
    first_broken = marks.select("broken").scalar()
    settled = results.where(F.coalesce(F.col("round") < first_broken, F.lit(True)))
    if not commit_filtered:
        settled = settled.where(F.col("round") <= marks.select("sent").scalar())
    return settled.groupBy(*by).agg((F.max("offset") + 1).alias("next_offset"))


def offset_ledger(results: DataFrame, before: DataFrame | None = None, by: Sequence[str] = PARTITION) -> DataFrame:
    """Per partition ``next_offset``, to resume from, and ``seen``, one beyond the last record: carried from batch to batch.

    ``results`` is one batch as for `committable_offsets`, ``before`` the ledger of the batches so far. A trailing run of filtered
    events, which its own batch does not settle, lies below the next offset of the first batch that sends again. The difference
    of the two columns is what is open; ``next_offset`` is null as long as nothing was settled.
    """
    seen = results.groupBy(*by).agg((F.max("offset") + 1).alias("seen"))
    now = seen.join(committable_offsets(results, by), list(by), "left").select(*by, "next_offset", "seen")
    both = now if before is None else now.unionByName(before.select(*by, "next_offset", "seen"))
    return both.groupBy(*by).agg(F.max("next_offset").alias("next_offset"), F.max("seen").alias("seen"))


def dead_letter_records(results: DataFrame) -> DataFrame:
    """Dead-lettered results of a story as ``(topic, key, value)``."""
    return results.where(F.col("status") == "DEAD_LETTER").select(
        dead_letter_topic(F.col("topic")).alias("topic"),
        F.col("id").cast("binary").alias("key"),
        F.col("payload").cast("binary").alias("value"),
    )
