"""Values the blueprint measured on sf0.01 with independent probes."""

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q():
    import __spark_entry__ as E
    return E.queries()


def test_labeled_exact_match_golden(spark, q):
    r = q["exact_match_labeled"](spark, SF).first()
    assert (r["matches"], r["labeled"], r["exact_match"]) == (39383, 49187, 0.800679)


def test_agreement_golden(spark, q):
    assert q["agreement"](spark, SF).first()["agreement"] == 0.2


def test_qa_pairs_and_manifest_goldens(spark, q):
    assert q["qa_pairs"](spark, SF).count() == 233
    assert q["image_path"](spark, SF).count() == 279
    c = q["image_manifest_counts"](spark, SF).first()
    assert (c["kept"], c["missing"]) == (199, 80)


def test_hash_split_dev_golden(spark, q):
    assert q["hash_split"](spark, SF).where(F.col("split") == "dev").count() == 96


def test_checkpoint_numeric_vs_text_golden(spark, q):
    from vqaspark.plans import fixtures as FX
    ck = FX.checkpoints(spark, SF)
    text_max = ck.groupBy("run_id").agg(F.max("name").alias("t"))
    num = q["latest_checkpoint"](spark, SF)
    j = num.join(text_max, "run_id")
    assert num.count() == 150
    assert j.where(F.col("t") != F.col("latest_checkpoint")).count() == 1


def test_kd_combined_loss_golden(spark, q):
    r = q["kd_combined_loss"](spark, SF).first()
    assert (r["num_tokens"], r["loss"]) == (399, 2.082893)
