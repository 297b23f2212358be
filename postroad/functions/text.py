"""Small scalar helpers: names, delays, times, headers, option maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def dead_letter_topic(topic: Column) -> Column:
    """Insert ``dead-letter-`` after an ``event-v<digit>-`` prefix, else in front."""
    return F.regexp_replace(topic, r"^(event-v[0-9]-)?", "$1dead-letter-")


def backoff_delay(n: Column, factor: Column | float, cap: Column | float) -> Column:
    """Seconds to wait after attempt ``n`` (from 1)."""
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    cap = cap if isinstance(cap, Column) else F.lit(float(cap))
    return F.least(F.pow(F.lit(2.0), n - 1) * factor, cap)


def group_id(story_id: Column, prefix: str, project_id: str, env: str) -> Column:
    """Default consumer group name of a story."""
    return F.format_string("%s_%s_%s_%s", F.lit(prefix), F.lit(project_id), F.lit(env), story_id)


def parse_zoned_time(text: Column) -> Column:
    """``2021-03-30T14:17:36+0200``; the zone is required. Null if malformed."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXX")),
    )


def header_map(headers: Column) -> Column:
    """``["k=v", ..]`` to a map; split at the first ``=``, a repeated key keeps the last."""

    def key(h: Column) -> Column:
        return F.split(h, "=", 2)[0]

    last = F.filter(
        headers,
        lambda h, i: ~F.exists(
            F.slice(headers, i + 2, F.size(headers)), lambda later: key(later) == key(h)
        ),
    )
    return F.map_from_entries(F.transform(last, lambda h: F.struct(key(h), F.split(h, "=", 2)[1])))


def parse_headers(headers: Iterable[str]) -> dict[str, str]:
    """`header_map` for a list given by the caller."""
    return dict(h.split("=", 1) for h in headers)


def merge_maps(defaults: Column, overrides: Column) -> Column:
    """Union of two maps; an override wins."""
    missing = F.map_filter(defaults, lambda k, _: ~F.map_contains_key(overrides, k))
    return F.map_concat(missing, overrides)


def merge_options(defaults: Mapping[str, Any], overrides: Mapping[str, Any]) -> dict[str, Any]:
    """Nested union of reader options; an override wins, inputs stay unchanged."""
    merged = {**defaults, **overrides}
    for key in defaults.keys() & overrides.keys():
        if isinstance(defaults[key], Mapping) and isinstance(overrides[key], Mapping):
            merged[key] = merge_options(defaults[key], overrides[key])
    return merged
