"""Acknowledgements, counters and timing reports."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from postroad import schema


def _failed() -> Column:
    return F.col("error_kind").isNotNull()


def _error_text() -> Column:
    return F.format_string("<%s> %s", "error_kind", F.coalesce("error", F.lit("")))


def _status(total: str, succeeded: str) -> Column:
    return (
        F.when(F.col(succeeded) == F.col(total), "all_succ")
        .when(F.col(succeeded) > 0, "part_succ")
        .otherwise("all_fail")
    )


def ack_status(results: DataFrame) -> DataFrame:
    """Per request: ``total, succeeded, status, http_code``, by partial counts."""
    return (
        results.groupBy("request_id")
        .agg(F.count("*").alias("total"), F.count_if(~_failed()).alias("succeeded"))
        .withColumn("status", _status("total", "succeeded"))
        .withColumn("http_code", F.when(F.col("status") == "all_succ", 200).otherwise(400))
    )


def ack_details(results: DataFrame) -> DataFrame:
    """One row per failed event id of a request: its first place and its last error."""
    return (
        results.where(_failed())
        .groupBy("request_id", "id")
        .agg(F.min("pos").alias("pos"), F.max_by(_error_text(), "pos").alias("detail"))
    )


def batch_ack(results: DataFrame) -> DataFrame:
    """The answer to each request: JSON form ``status, details`` and plain form ``plain``.

    ``results`` has ``request_id, pos, id, error_kind, error``. Only failures are
    gathered, and a request's failures are no more than the events of one body, which
    was one row. For tables where that does not hold, `ack_status` and `ack_details`
    give the same in long form.
    """
    entry = F.struct("id", "pos", _error_text().alias("detail"))
    failures = F.array_sort(F.collect_list(F.when(_failed(), entry)))
    grouped = results.groupBy("request_id").agg(
        F.count("*").alias("total"),
        F.count_if(~_failed()).alias("succeeded"),
        failures.alias("_all"),
    )
    first = F.filter("_all", lambda e, i: (i == 0) | (F.get("_all", i - 1)["id"] != e["id"]))
    last = F.filter(
        "_all",
        lambda e, i: (i == F.size("_all") - 1) | (F.get("_all", i + 1)["id"] != e["id"]),
    )
    by_place = F.array_sort(
        F.zip_with(
            first, last, lambda f, t: F.struct(f["pos"], f["id"].alias("id"), t["detail"].alias("detail"))
        )
    )
    lines = F.array_join(F.transform("_ordered", lambda e: F.concat(e["id"], F.lit(": "), e["detail"])), "\n")
    status = F.col("status")
    return (
        grouped.withColumn("_ordered", by_place)
        .withColumn("status", _status("total", "succeeded"))
        .select(
            "request_id",
            "status",
            F.when(status == "all_succ", 200).otherwise(400).alias("http_code"),
            F.map_from_entries(
                F.transform("_ordered", lambda e: F.struct(e["id"], e["detail"]))
            ).alias("details"),
            F.when(status == "all_succ", F.lit("ok"))
            .when(status == "part_succ", F.concat(F.lit("part_ok\n"), lines))
            .otherwise(F.concat(F.lit("fail\n"), lines))
            .alias("plain"),
        )
    )


def rejected_results(rejected: DataFrame) -> DataFrame:
    """Rejected bodies as results under the id ``root``, ready for `batch_ack`."""
    return rejected.select(
        "request_id",
        F.lit(0).alias("pos"),
        F.lit("root").alias("id"),
        F.lit("EventValidationError").alias("error_kind"),
        "error",
    )


def topic_counts(events: DataFrame) -> DataFrame:
    return events.groupBy(F.coalesce("topic", F.lit("unknown")).alias("topic")).agg(
        F.count("*").alias("n")
    )


def sink_counts(events: DataFrame) -> DataFrame:
    """Events and failures per sink; events without a sink count under ``kafka``."""
    return events.groupBy(F.coalesce("sink_id", F.lit("kafka")).alias("sink_id")).agg(
        F.count("*").alias("events"), F.count_if(_failed()).alias("failed")
    )


def path_counts(results: DataFrame) -> DataFrame:
    """Requests, and requests with any failure, per path (kafka or sink)."""
    path = F.when(F.col("sink_id").isNull(), "kafka").otherwise("sink").alias("path")
    requests = results.groupBy(path, "request_id").agg(F.count_if(_failed()).alias("failures"))
    return requests.groupBy("path").agg(
        F.count("*").alias("requests"), F.count_if(F.col("failures") > 0).alias("failed")
    )


def story_outcome_counts(results: DataFrame) -> DataFrame:
    """Per story: events sent, and how each of them ended."""
    outcomes = {"done": "DONE", "unknown": "UNKNOWN", "dead_letter": "DEAD_LETTER"}
    return results.groupBy("story_id").agg(
        F.count("*").alias("new"),
        *[F.count_if(F.col("status") == s).alias(name) for name, s in outcomes.items()],
    )


def send_time_stats(attempts: DataFrame, by: Sequence[str] = ("sink_id",)) -> DataFrame:
    """Duration of answered attempts in whole ms, and the number of retries, per sink.

    An attempt is answered when the head of the reply is there, so one whose payload could
    not be read counts.

    The median comes from a table of (duration, count), which stays small because
    durations are whole milliseconds under a timeout.
    """
    answered = F.coalesce(F.col("error_kind"), F.lit("payload")) == "payload"
    counted = attempts.groupBy(*by, F.when(answered, F.col("duration_ms")).alias("ms")).agg(
        F.count("*").alias("n"), F.count_if(F.col("attempt") > 1).alias("retries")
    )
    in_order = Window.partitionBy(*by).orderBy("ms")
    timed = F.when(F.col("ms").isNotNull(), F.col("n"))
    ranked = counted.withColumn("_upto", F.coalesce(F.sum(timed).over(in_order), F.lit(0))).withColumn(
        "_all", F.sum(timed).over(Window.partitionBy(*by))
    )

    def value_at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") >= rank, F.col("ms")))

    lower = value_at(F.floor((F.col("_all") + 1) / 2))
    upper = value_at(F.floor((F.col("_all") + 2) / 2))
    return ranked.groupBy(*by).agg(
        F.sum(timed).alias("answered"),
        F.min("ms").alias("min_ms"),
        F.max("ms").alias("max_ms"),
        (F.sum(F.col("ms") * F.col("n")) / F.sum(timed)).alias("avg_ms"),
        ((lower + upper) / 2).alias("median_ms"),
        F.sum("retries").alias("retries"),
    )


def exact_median(df: DataFrame, value: str, bins: int = 1 << 16) -> float | None:
    """The exact median of a numeric column, by jobs that each read this column.

    A job counts the values in equal-width bins, and the next one looks only into the
    bin that holds the middle rank, until that bin holds one value. Counts per bin are
    all that meets in one task, however the values are spread. NaN counts as missing, as
    null does; infinite values are the least and the greatest.
    """
    values = df.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    span = values.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if span.n == 0:
        return None
    total, rank = span.n, (span.n + 1) // 2
    while span.lo < span.hi:
        # Halved, so that no difference overflows; infinite values have bins of their own.
        lo, hi = (min(max(end, -sys.float_info.max), sys.float_info.max) for end in (span.lo, span.hi))
        part = (F.col("v") / 2 - lo / 2) / (hi / 2 - lo / 2) if lo < hi else F.lit(0.5)
        inside = F.floor(F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0)) * bins)
        place = F.when(F.col("v") < lo, -1).when(F.col("v") > hi, bins + 1).otherwise(inside)
        counts = (
            values.where(F.col("v").between(span.lo, span.hi))
            .groupBy(place.alias("bin"))
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        )
        upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("bin")))
        span = upto.where(F.col("upto") >= rank).orderBy("bin").first()
        rank -= span.upto - span.n
    if total % 2:
        return span.lo
    above = values.agg(
        F.count_if(F.col("v") <= span.lo).alias("upto"),
        F.min(F.when(F.col("v") > span.lo, F.col("v"))).alias("next"),
    ).first()
    return span.lo if above.upto > total // 2 else (span.lo + above.next) / 2


def latency_summary(df: DataFrame, columns: Sequence[str] = ("request_time", "receive_time")) -> DataFrame:
    """``metric, n, max, median, mean, min`` of each time column; nulls are left out."""
    parts = [
        df.agg(
            F.count(c).alias("n"),
            F.max(c).alias("max"),
            F.avg(c).alias("mean"),
            F.min(c).alias("min"),
        ).select(
            F.lit(c).alias("metric"),
            "n",
            "max",
            F.lit(exact_median(df, c)).cast("double").alias("median"),
            "mean",
            "min",
        )
        for c in columns
    ]
    return reduce(DataFrame.union, parts)


def poll_counts(records: DataFrame, by: Sequence[str] = ("topic", "partition")) -> DataFrame:
    return records.groupBy(*by).agg(F.count("*").alias("n"))


def replay_count(results: DataFrame) -> DataFrame:
    """One row: events resent, and how they ended."""
    return results.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in schema.EVENT_STATUSES],
    )


def lifecycle_log(results: DataFrame, ts: str = "sent_at") -> DataFrame:
    """The stages that delivered events went through, from their results: ``(id, status, step, ts)`` and the story if there is one.

    An event that was read is FROM_KAFKA, and TO_SINK once it is sent; each attempt that is to be followed by another is
    RETRY_TO_SINK, also if none followed; the end is IN_SINK or TO_DEAD_LETTER. All stages of a try have its time; ``step`` orders them.
    """
    tried = F.coalesce("attempts", F.lit(0)) > 0
    retries = F.col("attempts") - F.when(F.col("status") == "UNKNOWN", 0).otherwise(1)
    end = F.when(F.col("status") == "DONE", "IN_SINK").when(F.col("status") == "DEAD_LETTER", "TO_DEAD_LETTER")
    stages = F.concat(
        F.array(F.lit("FROM_KAFKA")),
        F.when(tried, F.array(F.lit("TO_SINK"))).otherwise(F.array().cast("array<string>")),
        F.when(tried, F.array_repeat(F.lit("RETRY_TO_SINK"), retries.cast("int"))).otherwise(F.array().cast("array<string>")),
        F.array_compact(F.array(end)),
    )
    keep = [c for c in ("story_id",) if c in results.columns]
    return results.select(*keep, "id", F.col(ts).alias("ts"), F.posexplode(stages).alias("step", "status"))


def lifecycle_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count("*").alias("n"))


def lifecycle_latest(log: DataFrame) -> DataFrame:
    """Latest lifecycle status of each event; at one instant the later stage wins.

    A status that is not listed comes before those that are; of several, the greatest text wins.
    """
    stage = F.array_position(F.array(*[F.lit(s) for s in schema.LIFECYCLE]), F.col("status"))
    latest = F.max(F.struct(F.unix_micros("ts").alias("at"), F.coalesce(stage, F.lit(0)).alias("stage"), "status"))
    return log.groupBy("id").agg(latest.alias("_last")).select(
        "id", "_last.status", F.timestamp_micros("_last.at").alias("ts")
    )


def windowed_counts(events: DataFrame, width: str, key: str, late: str = "10 minutes") -> DataFrame:
    """Events per time window and key, on a table or a stream. ``ts`` is the event time."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    return (
        timed.groupBy(F.window("ts", width), F.coalesce(key, F.lit("unknown")).alias(key))
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "n")
    )
