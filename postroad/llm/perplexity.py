"""Quality classifier: the perplexity of each text under an interpolated modified Kneser-Ney model of trusted text.

The model is over bytes. It learns from all trusted documents, those labelled good and not toxic. Counting is a job over all
texts: it gives every n-gram of the corpus with its count in the trusted ones. From the longest n-grams, the
levels below follow by sharded groupings (how many different n-grams end in this one), context sums by windows of
at most 256 rows, and each level's probabilities by a join with the level below. So every n-gram of the corpus has
its log probability, and a text's perplexity is the sum over its bytes.

Thresholds belong to languages, and come from the perplexities of all documents: with q the quantiles of bits per
byte in a language, a document is rejected above `q50 + reach * (q50 - q05)`, or q50 + `least` if that is more. The
lower half says how much sound text varies, as junk lies above. A text of n bytes is allowed `noise` / sqrt(n) bits
more, since the mean of few bytes varies more. A language with fewer than `min_rows` documents takes the
quantiles of the whole table.

Defined results: a null text counts as empty. An empty text has one byte, the closing one, and is judged like any
other. Null languages are a group of their own. Without trusted documents every byte is equally likely, so
nothing is rejected for its wording. Repeated ids are judged row by row; a repeated label counts as bad if any of its
rows is. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad.llm import grams
from postroad.llm.shared import lookup, written

ORDER = 5
MIN_ROWS = 100
REACH = 4.0
LEAST = 0.4
NOISE = 4.0
#: Relative error of the quantiles' ranks: one in this many.
ACCURACY = 10_000
#: Trusted ids, if numbers, that go to the tasks as an array of 8 bytes each; a join would hold some 100 bytes of each in the driver.
SENT_IDS = 1_500_000


def trusted_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(id): all documents labelled good and not toxic."""
    good = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where("q = 1 and t = 0")
    return good.select("id")


def _discounts(level: DataFrame, k: int) -> DataFrame:
    n = lambda c: F.sum((F.col("a") == c).cast("long")).alias(f"n{c}")
    return level.agg(F.lit(k).alias("k"), *(n(c) for c in range(1, 5)))


def _discount(n: list[int]) -> list[float]:
    """The discounts of counts 1, 2 and 3 or more; where the counts of counts say nothing, a half."""
    n1, n2 = n[0], n[1]
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    found = [(i + 1) - (i + 2) * y * n[i + 1] / n[i] if n[i] and n[i + 1] else 0.5 for i in range(3)]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(found)]


def model(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, value): the log10 probability of each n-gram's last byte after the others.

    `counted` (gram, n) holds trained n-grams, and with n = 0 those that are only to be scored.
    """
    levels = {order: counted.select("gram", F.col("n").alias("a"))}
    for k in range(order - 1, 0, -1):
        # How many different longer n-grams that were seen end in this one.
        levels[k] = levels[k + 1].groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")).agg(F.sum((F.col("a") > 0).cast("long")).alias("a"))
    numbers = None
    for k, level in levels.items():
        numbers = _discounts(level, k) if numbers is None else numbers.union(_discounts(level, k))
    discounts = {r.k: _discount([r[f"n{c}"] or 0 for c in range(1, 5)]) for r in numbers.collect()}  # one row a level
    below = None
    for k in range(1, order + 1):
        d1, d2, d3 = discounts[k]
        a = F.col("a")
        context = Window.partitionBy("context")
        times = lambda test: F.sum(test.cast("long")).over(context)  # noqa: B023, E731
        rest = d1 * times(a == 1) + d2 * times(a == 2) + d3 * times(a >= 3)
        level = levels[k].withColumn("context", F.shiftrightunsigned("gram", 8)).select("gram", "a", F.sum("a").over(context).alias("of"), rest.alias("rest"))
        level = level.withColumn("shorter", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)))
        if below is None:
            level = level.withColumn("p_below", F.lit(1 / 256))
        else:
            level = level.join(below, "shorter")
        own = a - F.when(a == 0, 0.0).when(a == 1, d1).when(a == 2, d2).otherwise(d3)
        p = F.when(F.col("of") > 0, (own + F.col("rest") * F.col("p_below")) / F.col("of")).otherwise(F.col("p_below"))
        below = level.select(F.col("gram").alias("shorter"), p.alias("p_below"))
    return below.select(F.col("shorter").alias("gram"), F.log10("p_below").alias("value"))


def fitted(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", order: int = ORDER) -> DataFrame:
    """The model of the trusted documents among `df`, with every n-gram of `df`."""
    ids, named = trusted_ids(labels), df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    if isinstance(ids.schema["id"].dataType, T.IntegralType) and ids.schema["id"].dataType == named.schema["id"].dataType and ids.count() <= SENT_IDS:
        known = np.sort(ids.select(F.col("id").cast("long")).toArrow().column(0).to_numpy())
        found = grams.counts(named, order, weight="id", ids=known)
    else:
        # Few ids go to every task, more are joined by shuffling.
        marked = lookup(named, ids.withColumn("weight", F.lit(1)), ["id"], salts=8)
        found = grams.counts(marked.select("text", F.coalesce("weight", F.lit(0)).alias("weight")), order)
    return written(model(written(found, "grams"), order), "model")


def bits(df: DataFrame, table: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), order: int = ORDER, sent: int = grams.SENT) -> DataFrame:
    """The kept columns, n_bytes, and `bits`, the cross entropy in bits per byte. One pass."""
    rows = grams.scored(df, table, order, text, keep, sent)
    return rows.select(*keep, "n_bytes", (-F.col("total") / F.col("n_bytes") / F.log10(F.lit(2.0))).alias("bits"))


def thresholds(measured: DataFrame, lang: str, min_rows: int = MIN_ROWS, reach: float = REACH, least: float = LEAST) -> DataFrame:
    """(lang_, limit_): the most bits per byte that a language allows."""
    sketch = F.percentile_approx("bits", [0.05, 0.5], ACCURACY).alias("q")
    by_lang = measured.groupBy(named(lang).alias("lang_")).agg(F.count(F.lit(1)).alias("n"), sketch)
    everything = measured.agg(sketch).select(F.col("q").alias("q_all"))
    q = F.when(F.col("n") >= min_rows, F.col("q")).otherwise(F.col("q_all"))
    limits = by_lang.crossJoin(F.broadcast(everything)).select("lang_", q.alias("q"))  # one row
    return limits.select("lang_", (F.col("q")[1] + F.greatest(reach * (F.col("q")[1] - F.col("q")[0]), F.lit(least))).alias("limit_"))


def named(column: str) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _judged(measured: DataFrame, limits: DataFrame, lang: str, noise: float) -> DataFrame:
    rows = lookup(measured.withColumn("lang_", named(lang)), limits, ["lang_"])
    return rows.withColumn("limit_", F.col("limit_") + noise / F.sqrt("n_bytes"))


def judge(df: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", order: int = ORDER, min_rows: int = MIN_ROWS, reach: float = REACH, least: float = LEAST, noise: float = NOISE) -> DataFrame:
    """key, lang, n_bytes, bits, perplexity (per byte), threshold (a perplexity) and kept."""
    measured = written(bits(df, fitted(df, labels, text, key, order), text, (key, lang), order), "bits")
    rows = _judged(measured, written(thresholds(measured, lang, min_rows, reach, least), "limits"), lang, noise)
    return rows.select(key, lang, "n_bytes", "bits", F.pow(F.lit(2.0), "bits").alias("perplexity"), F.pow(F.lit(2.0), "limit_").alias("threshold"), (F.col("bits") <= F.col("limit_")).alias("kept"))


def kept(df: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", order: int = ORDER, min_rows: int = MIN_ROWS, reach: float = REACH, least: float = LEAST, noise: float = NOISE) -> DataFrame:
    """The rows of `df` that pass, in its own columns.

    The texts are scored twice, once for the thresholds and once to be judged, so that no copy of them is written.
    """
    at = {c: f"keep_{k}" for k, c in enumerate(df.columns)}
    rows = df.select(*(F.col(f"`{c}`").alias(k) for c, k in at.items()))
    table = fitted(rows, labels, at[text], at[key], order)
    measured = written(bits(rows, table, at[text], (at[lang],), order), "bits")
    limits = written(thresholds(measured, at[lang], min_rows, reach, least), "limits")
    judged = _judged(bits(rows, table, at[text], tuple(rows.columns), order), limits, at[lang], noise)
    return judged.where(F.col("bits") <= F.col("limit_")).select(*(F.col(k).alias(c) for c, k in at.items()))
