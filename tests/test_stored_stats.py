"""Bucketed tables, weighted BERTScore, mergeable sketches."""

import math
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from vqaspark.operators import joins as J
from vqaspark.operators import stats as ST
from vqaspark.operators.metrics import bert as B
from vqaspark.sources import buckets as BK


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_sides_meet_without_a_shuffle(spark, tmp_path, no_broadcast):
    tag = uuid.uuid4().hex[:6]
    rows = spark.range(2000).select((F.col("id") % 500).alias("a"), F.col("id").alias("b"), F.concat(F.lit("x"), F.col("id")).alias("prediction"))
    preds = BK.store_bucketed(rows, f"p_{tag}", ["a", "b"], 6, str(tmp_path / "p"))
    refs = BK.store_bucketed(rows.withColumnRenamed("prediction", "reference"), f"r_{tag}", ["a", "b"], 6, str(tmp_path / "r"))
    assert BK.bucketing_of(spark, f"p_{tag}") == (6, ["a", "b"])
    out = J.align_predictions(preds, refs, ["a", "b"], check="lazy")
    assert "Exchange" not in _plan(out) and out.where("prediction = reference").count() == 2000
    both = J.compare_models(preds, refs, ["a", "b"], teacher_col="prediction", student_col="reference")
    assert "Exchange" not in _plan(both) and both.where("match").count() == 2000
    unstored = J.compare_models(rows, rows.withColumnRenamed("prediction", "reference"), ["a", "b"], teacher_col="prediction", student_col="reference")
    assert "Exchange" in _plan(unstored)
    broken = BK.store_bucketed(rows.where("b > 0").withColumnRenamed("prediction", "reference"), f"b_{tag}", ["a", "b"], 6, str(tmp_path / "b"))
    with pytest.raises(Exception, match="one row per key"):
        J.align_predictions(preds, broken, ["a", "b"], check="lazy").count()
    spark.range(3).write.option("path", str(tmp_path / "plain")).saveAsTable(f"n_{tag}")
    assert BK.bucketing_of(spark, f"n_{tag}") is None


def test_weighted_bertscore_against_brute_force(spark):
    r = random.Random(2)
    rows = []
    for s in [f"s{i}" for i in range(12)]:
        for side in ("pred", "ref"):
            if (s, side) == ("s3", "ref"):
                continue
            rows += [(s, side, p, [r.gauss(0, 1) for _ in range(4)], r.choice(["the", "a", "car", f"w{r.randint(0, 9)}", None])) for p in range(r.randint(1, 7))]
    rows.append(("s9", "pred", 99, [1.0, 0.0, 0.0, 0.0], "only-in-pred"))
    df = spark.createDataFrame(rows, "sample_id string, side string, pos long, vector array<double>, token string")
    refs = {x[0] for x in rows if x[1] == "ref"}
    d = {t: len({x[0] for x in rows if x[1] == "ref" and x[4] == t}) for t in {x[4] for x in rows}}
    idf = {t: math.log((len(refs) + 1) / (n + 1)) for t, n in d.items() if t is not None}
    got_idf = {x["token"]: x["idf"] for x in B.idf_weights(df).collect()}
    assert got_idf.keys() == idf.keys() and all(abs(got_idf[t] - idf[t]) < 1e-12 for t in idf)

    def side_mean(s, side):
        mine = [x for x in rows if x[0] == s and x[1] == side]
        other = [x for x in rows if x[0] == s and x[1] != side]
        if not mine or not other:
            return 0.0
        unit = lambda v: np.array(v) / np.linalg.norm(v)
        w = [(idf.get(x[4], 0.0) if x[4] is not None else 0.0, max(float(unit(x[3]) @ unit(y[3])) for y in other)) for x in mine]
        total = sum(a for a, _ in w)
        return sum(a * b for a, b in w) / total if total else 0.0

    got = {x.sample_id: x for x in B.bertscore_weighted(df, digits=None, block=3).collect()}
    rescaled = {x.sample_id: x for x in B.bertscore_weighted(df, digits=None, baseline=(0.5, 0.25, 0.2)).collect()}
    assert len(got) == 12
    for s in got:
        p, q = side_mean(s, "pred"), side_mean(s, "ref")
        f = 2 * p * q / (p + q) if p + q else 0.0
        assert np.allclose([got[s].precision, got[s].recall, got[s].f1], [p, q, f])
        assert np.allclose([rescaled[s].precision, rescaled[s].recall, rescaled[s].f1], [(p - 0.5) / 0.5, (q - 0.25) / 0.75, (f - 0.2) / 0.8])


def test_merged_sketches_are_one_pass(spark, tmp_path):
    df = spark.range(60000).select(F.when(F.col("id") % 10 == 0, "dev").otherwise("train").alias("split"), (F.col("id") % 7001).alias("image_id"),
                                   F.repeat(F.lit("w "), (F.hash("id") % 300 + 300).cast("int")).alias("question"), F.lit(None).cast("string").alias("answer"))
    path = str(tmp_path / "sk")
    for run in range(3):
        ST.split_sketches(df.where(F.pmod(F.hash("image_id", "question"), F.lit(3)) == run)).write.parquet(f"{path}/run={run}")
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    merged = {r["split"]: r for r in ST.merge_sketches(stored).collect()}
    for r in df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("image_id").alias("images"),
                                     F.sort_array(F.collect_list((F.length("question") / 2).cast("int"))).alias("w")).collect():
        m = merged[r["split"]]
        assert m.num_samples == r.n and abs(m.unique_images / r.images - 1) < 0.05
        for q, x in ((0.5, m.question_words_p50), (0.9, m.question_words_p90)):
            lo, hi = np.searchsorted(r.w, x, "left") / r.n, np.searchsorted(r.w, x, "right") / r.n
            assert lo - 0.01 <= q <= hi + 0.01
        assert m.question_words_max == r.w[-1] and m.answer_words_p50 is None and m.answer_words_max is None
    assert ST.merge_sketches(stored.limit(0)).count() == 0
