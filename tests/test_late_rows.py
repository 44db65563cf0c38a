"""Late rows of streams: counted over all batches, and kept as data."""

import os

import pytest
from pyspark.sql import functions as F

from vqaspark.streaming import stream as ST


def _files(spark, root, days):
    """One row per file, in this order."""
    for i, day in enumerate(days):
        spark.sql(f"select {i % 2} as run_id, {day} as ts, cast({i} as double) as loss").coalesce(1).write.mode("append").parquet(root)


DAYS = [f"timestamp'2024-01-{d:02d} 12:00:00'" for d in (10, 1, 2, 3, 11, 4, 12, 11)]


@pytest.fixture
def few_reports(spark):
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "1")
    yield
    spark.conf.unset(key)


def test_dropped_rows_of_all_batches_are_counted(spark, tmp_path, few_reports):
    root = str(tmp_path / "in")
    _files(spark, root, DAYS)
    agg = ST.windowed_loss(ST.file_stream(spark, root), "1 day").select("run_id", F.col("window.start").alias("ws"), "num_logs")
    with pytest.raises(RuntimeError, match="[34] rows came too late"):
        ST.run_upserts(agg, ["run_id", "ws"], str(tmp_path / "sink"), str(tmp_path / "ckpt"))
    out = ST.run_upserts(agg, ["run_id", "ws"], str(tmp_path / "sink2"), str(tmp_path / "ckpt2"), late="ignore")
    assert out.agg(F.sum("num_logs")).first()[0] in (4, 5)


def test_late_rows_are_kept(spark, tmp_path, few_reports):
    root = str(tmp_path / "in")
    _files(spark, root, DAYS + ["cast(null as timestamp)"])
    windows, late = ST.run_windows(ST.file_stream(spark, root), "1 day", str(tmp_path / "sink"), str(tmp_path / "ckpt"))
    got = {(r.run_id, r.window.start.day): r.num_logs for r in windows.collect()}
    assert got == {(0, 10): 1, (0, 11): 1, (0, 12): 1, (1, 11): 1}
    rows = late.orderBy("loss").collect()
    assert [r.loss for r in rows] == [1.0, 2.0, 3.0, 5.0, 8.0] and sum(got.values()) + len(rows) == len(DAYS) + 1
    assert rows[0].watermark.day == 9 and rows[3].watermark.day == 10 and rows[-1].ts is None


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    """A new run over more files goes on from the checkpoint; written batches count once."""
    root, sink, ckpt = str(tmp_path / "in"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    _files(spark, root, DAYS[:4])
    ST.run_windows(ST.file_stream(spark, root), "1 day", sink, ckpt)
    done = os.path.join(ckpt, "commits")
    last = max(int(x) for x in os.listdir(done) if x.isdigit())
    for name in (str(last), f".{last}.crc"):              # as if it died before the commit
        os.remove(os.path.join(done, name))
    _files(spark, root, DAYS[4:])
    windows, late = ST.run_windows(ST.file_stream(spark, root), "1 day", sink, ckpt)
    assert windows.agg(F.sum("num_logs")).first()[0] + late.count() == len(DAYS)
    assert late.count() == 4
