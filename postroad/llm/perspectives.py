"""Chat formatting with the perspective rotated: DataFrame functions only.

For every speaker of a conversation the dialogue is rendered once with that speaker as the assistant and all others
as users under their own names; roles in `context` (system) stay what they are and get no view of their own. The
mask says which characters to learn from: what the assistant says, and the mark that ends it.

A view comes in parts of at most `part_turns` turns, counted by their order and not by their numbers, so no task gathers a long
conversation and null or repeated turn numbers do no harm. Every speaker gets every part, also those in which only others speak:
the parts of a view, one after another, are the whole dialogue. `offset` says where a part's characters begin in it; the mask counts from the part's begin.

Conversations of at most `part_turns` turns are one part and move once. Of longer ones the turns are ranked without their texts: range-partitioned by
conversation and order, counted in each slice, with the earlier slices' counts added.

Defined results: a null text is an empty turn, a null role the speaker `unknown`, a null turn number comes first; turns
of the same number stand in the order of role and the text's MD5, and repeated rows are all kept. Very long texts are one turn like others. A null conversation id is a conversation of its own. Marks
in a text or a name are broken up by a space, so that no turn can forge another; line breaks in a name become spaces.
Conversations without speakers and empty tables give no rows. Only the named columns are read, so others may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postroad.llm.shared import lookup, written

PART_TURNS = 64
CONTEXT = ("system",)
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _safe(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("< |im_"))


def _ranked(turns: DataFrame) -> DataFrame:
    """The turns of long conversations with `rank`, from 0. No text takes part in the ranking."""
    tasks = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    turns = written(turns.withColumn("line", F.monotonically_increasing_id()), "turns")  # so that a line keeps its number
    order = ["key", "turn", "who", "digest", "line"]
    slices = turns.select(*order).repartitionByRange(tasks, *order).withColumn("slice", F.spark_partition_id())
    slices = written(slices, "slices")
    within = Window.partitionBy("key", "slice").orderBy(*order)
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # Of a slice, only its first conversation may go on from an earlier one.
    before = slices.groupBy("key", "slice").agg(F.count(F.lit(1)).alias("n")).select("key", "slice", F.sum("n").over(earlier).alias("before")).where("before > 0")
    ranks = lookup(slices.withColumn("at", F.row_number().over(within)), written(before, "before"), ["key", "slice"])
    ranks = ranks.select("line", (F.col("at") + F.coalesce("before", F.lit(0)) - 1).alias("rank"))
    return turns.join(ranks, "line").drop("line")


def _parts(df: DataFrame, conversation: str, turn: str, role: str, text: str, part_turns: int) -> DataFrame:
    """(conversation, key, part, said, speakers): parts of at most `part_turns` turns, each with all speakers of its conversation."""
    who = F.translate(_safe(F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("unknown"))), "\r\n", "  ")
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{conversation}`").cast("string")), F.lit(""))  # never null
    safe = _safe(F.col(f"`{text}`").cast("string"))
    rows = df.select(F.col(f"`{conversation}`").alias("conversation"), key.alias("key"), F.col(f"`{turn}`").cast("long").alias("turn"), who.alias("who"), F.md5(safe.cast("binary")).alias("digest"), safe.alias("text"))
    said = F.sort_array(F.collect_list(F.struct("turn", "who", "digest", "text"))).alias("said")
    long = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_turns).select("key", F.lit(True).alias("long")), "long")
    marked = lookup(rows, long, ["key"])
    whole = marked.where("long is null").groupBy("conversation", "key").agg(said).select("conversation", "key", F.lit(0).cast("long").alias("part"), "said", F.array_distinct(F.col("said")["who"]).alias("speakers"))
    if not long.limit(1).count():
        return whole
    rest = marked.where("long").drop("long")
    cut = _ranked(rest).groupBy("conversation", "key", F.floor(F.col("rank") / part_turns).cast("long").alias("part")).agg(said)
    # A row for each speaker and part is what the views are; so the names are not gathered.
    speakers = rest.select("key", "who").distinct().select("key", F.array("who").alias("speakers"))
    return whole.union(cut.join(speakers, "key").select("conversation", "key", "part", "said", "speakers"))


def rotate(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_turns: int = PART_TURNS, context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """(conversation, part, speaker, offset, n_turns, n_own, rendered, mask): one row for each part of a view. `mask` lists spans of characters, [first, last)."""
    parts = _parts(df, conversation, turn, role, text, part_turns)
    silent = F.array(*map(F.lit, context)) if context else F.expr("cast(array() as array<string>)")
    views = parts.select("conversation", "key", "part", F.explode(F.array_except("speakers", silent)).alias("speaker"), "said")
    own = lambda x: x["who"] == F.col("speaker")
    title = lambda x: F.when(own(x), F.lit("assistant")).when(F.array_contains(silent, x["who"]), x["who"]).otherwise(F.concat(F.lit("user name="), x["who"]))
    turns = F.transform("said", lambda x: F.struct(F.concat(F.lit(BEGIN), title(x), F.lit("\n")).alias("head"), F.concat(x["text"], F.lit(END)).alias("body"), own(x).alias("own")))
    start = F.expr("named_struct('at', 0L, 'mask', cast(array() as array<struct<first:bigint,last:bigint>>))")

    def step(done: Column, x: Column) -> Column:
        first = done["at"] + F.length(x["head"])
        last = first + F.length(x["body"])
        span = F.array(F.struct(first.alias("first"), last.alias("last")))
        return F.struct((last + 1).alias("at"), F.when(x["own"], F.concat(done["mask"], span)).otherwise(done["mask"]).alias("mask"))

    rendered = views.withColumn("turns", turns).select(
        "conversation", "key", "part", "speaker", F.size("said").cast("long").alias("n_turns"), F.size(F.filter("turns", lambda x: x["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit("\n"))), "").alias("rendered"), F.aggregate("turns", start, step)["mask"].alias("mask"),
    )
    return _with_offsets(rendered, views, title, conversation)


def _with_offsets(rendered: DataFrame, views: DataFrame, title, conversation: str) -> DataFrame:
    """Add `offset`: the characters of a view's earlier parts. Only views of several parts are summed, by their lengths."""
    size = F.aggregate("said", F.lit(0).cast("long"), lambda n, x: n + F.length(F.lit(BEGIN)) + F.length(title(x)) + F.length(x["text"]) + F.length(F.lit(END)) + 2)
    several = views.where("part > 0").select("key").distinct()
    sizes = views.join(several, "key", "left_semi").select("key", "part", "speaker", size.alias("size"))
    earlier = Window.partitionBy("key", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(sizes.select("key", "part", "speaker", F.sum("size").over(earlier).alias("offset")).where("part > 0"), "offsets")
    placed = lookup(rendered, offsets, ["key", "part", "speaker"])
    return placed.select(F.col("conversation").alias(conversation), "part", "speaker", F.coalesce("offset", F.lit(0)).cast("long").alias("offset"), "n_turns", "n_own", "rendered", "mask")


def report(views: DataFrame) -> DataFrame:
    """The views with their masks as text, `first-last` joined by commas."""
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s["first"].cast("string"), s["last"].cast("string"))), ",")
    return views.withColumn("mask", spans)
