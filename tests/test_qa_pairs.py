"""Question-answer pairs: any numbering, conversations over many ranges."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vqaspark.operators import prepare as P


def lead_pairs(df):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return (df.where("conv_id is not null and turn is not null")
            .select("conv_id", "turn", "role", F.col("text").alias("question"), F.lead("role").over(w).alias("n"),
                    F.lead("text").over(w).alias("answer"))
            .where("role = 'user' and n = 'assistant'").select("conv_id", "turn", "question", "answer"))


@pytest.fixture(scope="module")
def turns(spark):
    r = random.Random(4)
    rows = [(1, t, "user" if t % 2 else "assistant", f"h{t}") for t in range(-60, 900)]                 # one hot conversation
    for c in range(2, 60):
        numbers = sorted(r.sample(range(-5000, 5000), r.randint(1, 40))) if c % 3 else list(range(r.randint(1, 9)))
        rows += [(c, n, r.choice(["user", "assistant", "system", None]), r.choice(["", None, "x", f"t{n}"])) for n in numbers]
    rows += [(None, 1, "user", "q"), (None, 2, "assistant", "a"), (70, None, "user", "q"), (70, 1, "assistant", "a"), (71, 2 ** 40, "user", "q"),
             (71, 2 ** 50, "assistant", "far")]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)


@pytest.mark.parametrize("size", [1, 7, 64, P.TURN_RANGE])
def test_same_rows_as_lead(turns, size):
    got = sorted(map(tuple, P.qa_pairs(turns, turn_range=size).collect()), key=str)
    assert got == sorted(map(tuple, lead_pairs(turns).collect()), key=str) and (71, 2 ** 40, "q", "far") in got


def test_a_hot_conversation_spreads(spark):
    hot = spark.range(20000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = P.qa_pairs(hot, turn_range=500).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in out) == 10000 and len(out) > 2 and max(r["count"] for r in out) < 9000


def test_empty(spark):
    assert P.qa_pairs(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0
