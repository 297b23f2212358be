"""License scans by diagonal voting.

Every run of k words of every text is hashed. A sieve of the templates' hashes (a fixed list, a few hundred) drops
the runs that can't match where they are made; the others are joined in Spark with the templates' positions, on
the hash and on the words themselves. A hit at word p of a text and word t of a template votes for diagonal p - t.
Votes are counted by text, template and diagonal; diagonals at most `gap` apart are merged, which bridges words put in
or left out; and a merged span is verified by the share of the template's runs that it holds.

A phrase is a template that must match in full on one diagonal; a notice needs `least` of its runs.

Words are runs of ASCII letters and digits and of characters beyond ASCII, after lower-casing A-Z.

Defined results: null and empty texts have no words and no spans. Each row is scanned by itself, repeated ids too.
An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad.llm.arrays import ALPHANUMERIC, LOWER, Table, Words, chunks

GAP = 3
LEAST = 0.6


class Template(NamedTuple):
    name: str
    label: str
    kind: str  # phrase or notice
    k: int
    text: str


#: Phrases and labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: The opening words of public license notices, and the usual statements of a license.
NOTICES = {
    "mit-notice": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        "released under the mit license",
    ],
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    ],
    "gpl-notice": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    ],
    "gpl-3.0": ["licensed under the gnu general public license version 3"],
    "cc-by-4.0": ["this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4 0"],
    "bsd-notice": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}
TEMPLATES = [Template(f"phrase {p}", label, "phrase", 2, p) for p, label in PHRASES.items()] + [Template(f"{label} {n}", label, "notice", 3, t) for label, texts in NOTICES.items() for n, t in enumerate(texts)]


def _hashed(text: str, k: int) -> list[tuple[int, int, str]]:
    """(position, hash, words) of each run of k words."""
    data = np.frombuffer(text.encode(), np.uint8)
    words = Words(LOWER[data], np.array([0, len(data)]), ALPHANUMERIC)
    first, keys = words.windows(words.hashes(), k)
    return [(int(p), int(h), words.text(int(p), k).decode()) for p, h in zip(first, keys, strict=True)]


def spans(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), templates: list[Template] = TEMPLATES, gap: int = GAP, least: float = LEAST) -> DataFrame:
    """A row for each verified span, and one with nulls for a text without: row (a number of the input row), the kept columns,
    n_words, template, label, kind, first_word, last_word (one past it) and coverage.
    """
    session = df.sparkSession
    runs = [(t.name, t.label, t.kind, p, h - (1 << 64) if h >> 63 else h, words) for t in templates for p, h, words in _hashed(t.text, t.k)]
    totals = {t.name: len(_hashed(t.text, t.k)) for t in templates}
    if not runs or not all(totals.values()):
        raise ValueError("a template has fewer words than its k")
    positions = session.createDataFrame([(*r, totals[r[0]]) for r in runs], "template string, label string, kind string, t int, hash long, words string, runs int")
    sieve = {k: np.unique(np.array([h & (1 << 64) - 1 for name, _, _, _, h, _ in runs for t in templates if t.name == name and t.k == k], np.uint64)) for k in sorted({t.k for t in templates})}
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("kept"), F.col(text).alias("text"))
    hit = T._parse_datatype_string("array<struct<k:int,p:bigint,hash:bigint,words:string>>")
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("kept", rows.schema["kept"].dataType), T.StructField("n_words", T.LongType()), T.StructField("hits", hit)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: Table(h, np.zeros(len(h))) for k, h in sieve.items()}
        for batch in batches:
            for part, data, offsets in chunks(batch, 2):
                words = Words(LOWER[data], offsets, ALPHANUMERIC)
                hashes = words.hashes()
                hits: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for k, table in tables.items():
                    first, keys = words.windows(hashes, k)
                    for n in np.flatnonzero(table.find(keys) >= 0).tolist():
                        at = int(first[n])
                        row = int(words.row[at])
                        hits[row].append({"k": k, "p": at - int(words.first[row]), "hash": int(keys[n : n + 1].view(np.int64)[0]), "words": words.text(at, k).decode()})
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(words.count), pa.array(hits, arrow_hits)], names=schema.names)

    arrow_hits = pa.list_(pa.struct([("k", pa.int32()), ("p", pa.int64()), ("hash", pa.int64()), ("words", pa.string())]))
    votes = rows.mapInArrow(run, schema).select("row", "kept", "n_words", F.explode_outer("hits").alias("hit")).select("row", "kept", "n_words", F.col("hit.k").alias("k"), F.col("hit.p").alias("p"), F.col("hit.hash").alias("hash"), F.col("hit.words").alias("words"))
    votes = votes.join(F.broadcast(positions), ["hash", "words"], "left").repartition("row")  # the templates are a fixed list
    facts = ["row", "kept", "n_words", "template", "label", "kind", "runs"]
    diagonals = votes.groupBy(*facts, (F.col("p") - F.col("t")).alias("d")).agg(F.min("p").alias("first_word"), F.max(F.col("p") + F.col("k")).alias("last_word"), F.collect_set("t").alias("ts"))
    order = Window.partitionBy("row", "template").orderBy("d")
    # A phrase stays on its diagonal; a notice goes on as long as the next diagonal is near.
    apart = F.coalesce((F.col("kind") == "phrase") | (F.col("d") - F.lag("d").over(order) > gap), F.lit(True))
    merged = diagonals.withColumn("apart", apart.cast("int")).withColumn("span", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = merged.groupBy(*facts, "span").agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), (F.size(F.array_distinct(F.flatten(F.collect_list("ts")))) / F.first("runs")).alias("coverage"))
    enough = F.coalesce(F.col("coverage") >= F.when(F.col("kind") == "phrase", 1.0).otherwise(least), F.lit(False))
    blank = lambda c: F.when(enough, F.col(c)).alias(c)
    return found.select("row", *(F.col(f"kept.{c}") for c in keep), "n_words", *map(blank, ("template", "label", "kind", "first_word", "last_word")), F.when(F.col("template").isNotNull(), F.col("coverage")).alias("coverage"))


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each input row, from what `spans` gave."""
    phrase = F.col("kind") == "phrase"
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    of = lambda c: F.when(phrase, F.col(c))
    return found.groupBy("row", key, "n_words").agg(
        F.count(of("first_word")).alias("n_base"), F.min(of("first_word")).alias("first_word"), F.max(of("first_word")).alias("last_word"),
        joined(of("label")).alias("base_labels"), joined("label").alias("labels"), F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
    ).drop("row")
