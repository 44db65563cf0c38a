"""Tables stored in an order: positions, spans and batches by file."""

import hashlib

import pytest
from pyspark.sql import functions as F

from vqaspark.operators import prepare as P
from vqaspark.sources import ordered as O


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    df = spark.range(5000).select((F.col("id") * 7).alias("id"), F.concat(F.lit("q"), F.col("id").cast("string")).alias("question"))
    path = str(tmp_path_factory.mktemp("ordered") / "s")
    assert O.store_shuffled(df.repartition(3), path, num_files=20) == 5000
    want = sorted((i * 7 for i in range(5000)), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    return path, want


def test_positions_are_the_shuffled_order(spark, store):
    path, want = store
    got = {r.position: r.id for r in O.read_ordered(spark, path).select("id", "position").collect()}
    assert got == dict(enumerate(want)) and O.count(spark, path) == 5000
    files = [r.id for r in O._rows(spark, path).orderBy(O.PART).select("id").limit(5000).collect()]
    assert files == want               # files hold the order: a reader sorts nothing


def test_a_row_and_a_batch_open_their_files_only(spark, store):
    path, want = store
    for i in (0, 3777, 4999):
        one = O.get_row(spark, path, i)
        assert [(r.id, r["index"]) for r in one.collect()] == [(want[i], i)] and len(one.inputFiles()) == 1
    assert O.get_row(spark, path, 5000).count() == 0 and O.read_span(spark, path, 40, 40).count() == 0
    batch = O.get_batch(spark, path, 40, 64)
    assert [r.id for r in batch.orderBy("batch_pos").collect()] == want[2560:2624] and len(batch.inputFiles()) <= 2
    wide = O.read_span(spark, path, 100, 900)
    assert [r.id for r in wide.orderBy("position").collect()] == want[100:900]
    assert [r.batch_pos for r in O.get_batch(spark, path, 78, 64).orderBy("batch_pos").collect()] == list(range(8))
    with pytest.raises(ValueError):
        O.get_row(spark, path, -1)
    with pytest.raises(ValueError):
        O.get_batch(spark, path, 0, 0)


def test_reading_does_not_sort(spark, store):
    plan = O.read_ordered(spark, store[0])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan


def test_empty_and_taken_names(spark, tmp_path):
    assert O.write_ordered(spark.range(0), str(tmp_path / "e"), "id") == 0
    assert O.read_ordered(spark, str(tmp_path / "e")).count() == 0 == O.count(spark, str(tmp_path / "e"))
    with pytest.raises(ValueError):
        O.write_ordered(spark.range(3).withColumn("_row", F.lit(1)), str(tmp_path / "t"), "id")


def test_prepare_shuffles_all_rows(spark):
    df = spark.range(300).select("id", F.lit("q").alias("question"), F.lit("a").alias("answer"))
    order = [r.id for r in P.prepare_dataset(df).collect()]
    assert order == sorted(range(300), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    assert [r.id for r in P.prepare_dataset(df, seed=7).collect()] != order
    assert [r.id for r in P.prepare_dataset(df, max_samples=20).collect()] == order[:20]
    assert [r.id for r in P.prepare_dataset(df.coalesce(1), shuffle=False).collect()] == list(range(300))
