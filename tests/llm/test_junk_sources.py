"""A source that is full of junk does not set its own fences."""

import pytest
from odd_rows import prose
from pyspark.sql import functions as F

from postroad.llm import quality_rules


@pytest.mark.parametrize("share", [30, 45, 60])
@pytest.mark.parametrize("alone", [False, True])
def test_junk_of_a_junk_heavy_source_goes(spark, share, alone):
    """The source is one of its language, or all of it."""
    sound = [prose(k, 40) + f"\nthen line {k} follows\n" + prose(k + 3, 40) for k in range(7)]
    words = [f"a{k} b{k}" for k in range(30)]
    symbols = " ".join(words) + " # " * 50
    lines = "\n".join([f"{w} here" for w in words] + ["q"] * 45)
    n = F.col("id")
    rows = spark.range(3000).withColumn("hot", n < 600).withColumn("junk", F.col("hot") & (n % 100 < share))
    good = F.element_at(F.array(*map(F.lit, sound)), (n % 7 + 1).cast("int"))
    bad = F.when(n % 2 == 0, F.lit(symbols)).otherwise(F.lit(lines))
    df = rows.select(n.alias("doc_id"), F.when(F.col("junk"), bad).otherwise(good).alias("text"), F.when(F.col("hot") & F.lit(alone), "xx").otherwise("en").alias("lang"), F.when(F.col("hot"), "hot").otherwise((n % 3).cast("string")).alias("source"), "junk", (F.col("junk") & (n % 2 == 0)).alias("of_symbols"))
    judged = quality_rules.judge(df, keep=("doc_id", "junk", "of_symbols"))
    assert judged.where("not base_failed and of_symbols").count() > 0
    assert judged.where("kept and junk").count() == 0
    assert judged.where("not kept and not junk").count() == 0
