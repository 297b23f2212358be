"""Quality rules with thresholds that follow the data, by language and source. DataFrame functions only.

Each document gets counts of words, characters, symbols, repeated lines and repeated three-word windows. Four
rates of these are sketched for each language and source: a sketch counts rows by value, with values from 128 on
cut to their seven highest bits, so it is off by less than 1/64 of a value, has a few hundred entries at most, and two
sketches are merged by adding counts. A group with fewer than `min_rows` rows takes the merged sketches of its
language, a language with fewer those of the whole table.

Only documents that pass the base rules are sketched. From a sketch come quantiles, and from these the fences; no threshold is fixed.

- Symbols, repeated lines and repeated windows: `reach` times the distance from the median to the 90th percentile, above the
  latter. The least of the fences of the group, its language and the whole table holds (each of at least `min_rows` rows but the last),
  since a source that is full of junk would fence in its junk. A fence is a rate; a document is outside if its count is more than the fence lets
  expect by over `NOISE` standard deviations of a count, so a short text does not go for one symbol.
- Word lengths: `WIDE` times the distance of the quartiles (or of two neighbouring values of the sketch, if that is more) above the upper and
  below the lower one, by the wider of the fences of group and language.

A document outside any fence goes, and so does one that fails the base rules.

Three-word windows are compared by 64-bit hashes of their words within a text.

Defined results: a null text has no words, so it fails the base rules. Null languages and sources are groups of
their own. Each row is judged by itself, repeated ids too; an empty table gives no rows. Only the named columns
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postroad.llm.shared import lookup, written

MIN_WORDS = 50
MIN_ROWS = 200
REACH = 10
WIDE = 6
NOISE = 3.0
#: metric -> its count, what it is counted among, and the unit of the rate: per 1,000 lines or words, and hundredths of characters a word.
METRICS = {"symbols": ("n_symbols", "n_words", 1000), "dup_lines": ("n_dup_lines", "n_lines", 1000), "repeats": ("n_repeat_words", "n_words", 1000), "word_length": ("word_chars", "n_words", 100)}
SHARES = ("symbols", "dup_lines", "repeats")
BLANK = "[\\x20\\x09-\\x0D]+"


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (those with a word)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    solid = F.translate(whole, " \t\n\x0b\x0c\r", "")
    first = df.select(
        "*",
        F.filter(F.split(whole, BLANK), lambda w: w != "").alias("_words"),
        solid.alias("_solid"),
        F.filter(F.split(whole, "\n"), lambda line: F.translate(line, " \t\n\x0b\x0c\r", "") != "").alias("_lines"),
    )
    word = lambda k: F.get("_words", k)
    windows = F.transform(F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))), lambda w, k: F.xxhash64(w, word(k + 1), word(k + 2)))
    second = first.withColumn("_windows", windows)
    second = second.withColumn("_twice", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    placed = F.when(F.col("_twice"), F.sort_array(F.transform("_windows", lambda h, k: F.struct(h.alias("h"), k.alias("k")))))
    third = second.withColumn("_placed", placed)
    at = lambda k: F.get("_placed", k)["h"]
    equal = F.filter("_placed", lambda x, k: (x["h"] == at(k - 1)) | (x["h"] == at(k + 1)))
    reached = F.array_distinct(F.flatten(F.transform(equal, lambda x: F.array(x["k"], x["k"] + 1, x["k"] + 2))))
    return third.select(
        *df.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length("_solid").cast("long").alias("word_chars"),
        (F.length("_solid") - F.length(F.translate("_solid", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.size(reached), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def base_failed(min_words: int = MIN_WORDS) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _rate(metric: str) -> Column:
    n, of, unit = METRICS[metric]
    return F.floor(unit * F.col(n) / F.greatest(F.col(of), F.lit(1))).cast("long")


def sketches(counted: DataFrame, keys: list[str], min_words: int = MIN_WORDS) -> DataFrame:
    """(keys, metric, value, n): the sketch of each group and metric; n rows have this value once it is cut."""
    rates = F.array(*(F.struct(F.lit(metric).alias("metric"), _rate(metric).alias("value")) for metric in METRICS))
    rows = counted.where(~base_failed(min_words)).select(*keys, F.explode(rates).alias("x"))
    drop = "greatest(length(bin(x.value)) - 7, 0)"  # bits beyond the seven highest
    cut = F.expr(f"shiftleft(shiftright(x.value, {drop}), {drop})")
    return rows.select(*keys, "x.metric", cut.alias("value")).groupBy(*keys, "metric", "value").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of larger groups, from those of smaller ones."""
    return sketch.groupBy(*keys, "metric", "value").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, rows, q25, q50, q75, q90). Entries of a group are few, so one task can have all of them."""
    by = [*keys, "metric"]
    ordered = Window.partitionBy(*by).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    run = sketch.select(*by, "value", F.sum("n").over(ordered).alias("upto"), F.sum("n").over(Window.partitionBy(*by)).alias("rows"))
    quantile = lambda k: F.min(F.when(100 * F.col("upto") >= k * F.col("rows"), F.col("value"))).alias(f"q{k}")
    return run.groupBy(*by).agg(F.first("rows").alias("rows"), *(quantile(k) for k in (25, 50, 75, 90)))


def _fences(sketch: DataFrame, keys: list[str], suffix: str, reach: int, wide: int) -> DataFrame:
    """(keys, metric, rows, share, low, high), the last four with the suffix: a rate's upper fence, and a length's two."""
    spread = wide * F.greatest(F.col("q75") - F.col("q25"), F.expr("q75 div 64"))
    named = {"rows": F.col("rows"), "share": F.col("q90") + reach * (F.col("q90") - F.col("q50")), "low": F.col("q25") - spread, "high": F.col("q75") + spread}
    return quantiles(sketch, keys).select(*keys, "metric", *(c.alias(f"{name}{suffix}") for name, c in named.items()))


def fences(counted: DataFrame, lang: str = "lang", source: str = "source", min_rows: int = MIN_ROWS, reach: int = REACH, wide: int = WIDE) -> DataFrame:
    """One row for each language and source (null as empty text, told apart by a mark): above_* of every metric and below_word_length."""
    own = sketches(counted.select(_name(lang).alias("lang_"), _name(source).alias("source_"), "n_words", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "word_chars"), ["lang_", "source_"])
    own = written(own, "sketches")  # a few hundred entries for each group
    a = _fences(own, ["lang_", "source_"], "", reach, wide)
    b = _fences(merged(own, ["lang_"]), ["lang_"], "_b", reach, wide)
    c = _fences(merged(own, []), [], "_c", reach, wide)
    joined = a.join(b, ["lang_", "metric"]).join(F.broadcast(c), "metric")  # c has one row for each metric
    of_group, of_lang = F.col("rows") >= min_rows, F.col("rows_b") >= min_rows
    share = F.least(F.when(of_group, F.col("share")), F.when(of_lang, F.col("share_b")), F.col("share_c"))
    within = lambda pick, name: F.coalesce(pick(F.when(of_group, F.col(name)), F.when(of_lang, F.col(f"{name}_b"))), F.col(f"{name}_c"))
    of = lambda metric, value: F.max(F.when(F.col("metric") == metric, value))
    columns = [of(metric, share).alias(f"above_{metric}") for metric in SHARES]
    columns += [of("word_length", within(F.greatest, "high")).alias("above_word_length"), of("word_length", within(F.least, "low")).alias("below_word_length")]
    return joined.groupBy("lang_", "source_").agg(*columns)


def _name(column: str) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def judged(counted: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source", min_words: int = MIN_WORDS, noise: float = NOISE) -> DataFrame:
    """`counted` with base_failed and kept; `limits` are what `fences` gave."""
    rows = lookup(counted.withColumn("lang_", _name(lang)).withColumn("source_", _name(source)), limits, ["lang_", "source_"])
    outside = (_rate("word_length") > F.col("above_word_length")) | (_rate("word_length") < F.col("below_word_length"))
    for metric in SHARES:
        n, of, unit = METRICS[metric]
        expected = F.col(f"above_{metric}") * F.col(of).cast("double")  # both sides in units of the rate
        beyond = unit * F.col(n).cast("double") - expected
        outside = outside | ((beyond > 0) & (beyond * beyond > noise * noise * unit * (expected + unit)))
    failed = base_failed(min_words)
    return rows.select(*counted.columns, failed.alias("base_failed"), (~failed & ~F.coalesce(outside, F.lit(False))).alias("kept"))


def judge(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, the counts, base_failed and kept. The texts are read once."""
    renamed = df.select(*(F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    counted = written(counts(renamed).drop("text"), "counts")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged(counted, written(fences(counted), "fences")).select(*(F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep)), *names)


def kept(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of `df` that pass, in its own columns.

    The texts are counted twice, once for the fences and once to be judged, so that no copy of them is written.
    """
    row = [F.col(f"`{c}`").alias(f"keep_{k}") for k, c in enumerate(df.columns)]
    renamed = df.select(*row, F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    names = ["lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    limits = written(fences(written(counts(renamed.select("lang", "source", "text")).select(*names), "counts")), "fences")
    # A row number keeps the filter above the counts; pushed down, it would have them worked out many times over.
    counted = counts(renamed).drop("text").withColumn("_at", F.monotonically_increasing_id())
    return judged(counted, limits).where(F.col("kept") & (F.col("_at") >= 0)).select(*(F.col(f"keep_{k}").alias(c) for k, c in enumerate(df.columns)))
