"""Streaming = batch, file layouts, entry contract."""

import json
import os

import pytest

from pyspark.sql import functions as F

from vqaspark.operators import prepare as P
from vqaspark.sources import files as FI
from vqaspark.sources import splits as SP
from vqaspark.streaming import stream as ST

SF01 = "/root/testdata/sf0.01"


def _split_table(spark, name, out, n):
    spark.read.parquet(f"{SF01}/{name}.parquet").repartition(n).write.mode("overwrite").parquet(out)


def test_stream_windows_equal_batch_over_many_microbatches(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "events")
    _split_table(spark, "events", src, 5)
    ev = ST.file_stream(spark, src, max_files_per_trigger=1).withColumn("ts", F.col("ts").cast("timestamp"))
    log = ev.select(F.col("user_id").alias("run_id"), "ts", F.col("value").alias("loss"))
    agg = ST.windowed_loss(log, watermark="400 days").select(
        "run_id", F.col("window.start").alias("ws"), "num_logs", "sum_loss")
    out = ST.run_upserts(agg, ["run_id", "ws"], os.path.join(tmpdir_fresh, "sink"),
                         os.path.join(tmpdir_fresh, "ck"))
    batch = (spark.read.parquet(src).withColumn("ts", F.col("ts").cast("timestamp"))
             .groupBy(F.col("user_id").alias("run_id"), F.window("ts", "1 day").start.alias("ws"))
             .agg(F.count(F.lit(1)).alias("num_logs"), F.sum("value").alias("sum_loss")))
    a = sorted((r["run_id"], r["ws"], r["num_logs"], round(r["sum_loss"], 6)) for r in out.collect())
    b = sorted((r["run_id"], r["ws"], r["num_logs"], round(r["sum_loss"], 6)) for r in batch.collect())
    assert a == b
    # rows far behind the watermark are an error, not a smaller count; without one none is lost
    late = os.path.join(tmpdir_fresh, "late")
    for i, day in enumerate((10, 20, 1)):
        d = spark.createDataFrame([(1, f"2024-01-{day:02d} 00:00:00", 1.0)], "run_id long, t string, loss double")
        d.select("run_id", F.col("t").cast("timestamp").alias("ts"), "loss").coalesce(1).write.mode("append").parquet(late)
    for mark, n in (("1 hour", None), (None, 3)):
        agg = ST.windowed_loss(ST.file_stream(spark, late), mark).select("run_id", F.col("window.start").alias("ws"), "num_logs")
        where = [os.path.join(tmpdir_fresh, f"{x}-{n}") for x in ("s", "c")]
        if n is None:
            with pytest.raises(RuntimeError, match="too late"):
                ST.run_upserts(agg, ["run_id", "ws"], *where)
        else:
            assert ST.run_upserts(agg, ["run_id", "ws"], *where).agg(F.sum("num_logs")).first()[0] == n
    batches = {os.path.basename(p) for p in os.listdir(os.path.join(tmpdir_fresh, "sink"))}
    assert len([x for x in batches if x.startswith("batch_id=")]) >= 5


def test_stream_prepare_equals_batch(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "conv")
    _split_table(spark, "conversations", src, 3)
    conv = ST.file_stream(spark, src)
    req = conv.where(F.col("role") == "user").select(
        (F.shiftleft("conv_id", 20) + F.col("turn")).alias("id"), F.col("text").alias("question"))
    out = ST.run_append(ST.prepare_stream(req), os.path.join(tmpdir_fresh, "o"), os.path.join(tmpdir_fresh, "c"))
    bconv = spark.read.parquet(src)
    breq = bconv.where(F.col("role") == "user").select(
        (F.shiftleft("conv_id", 20) + F.col("turn")).alias("id"), F.col("text").alias("question"))
    b = P.render_chat(P.build_prompt_messages(P.valid_requests(breq.withColumn("image_path", F.lit("x")))))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, b.select("id", "text").collect()))


def test_table_stream_reads_a_file_or_a_folder_of_files(spark, tmpdir_fresh):
    import shutil

    from vqaspark.plans.q_stream import q_stream_prepare
    rows = [(c, t, ["user", "assistant"][t % 2], [f"text {c} {t}", "", None][c % 3]) for c in range(9) for t in range(4)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    folder, file = (os.path.join(tmpdir_fresh, x) for x in ("folder", "file"))
    conv.repartition(3).write.parquet(os.path.join(folder, "conversations.parquet"))
    conv.coalesce(1).write.parquet(os.path.join(tmpdir_fresh, "one"))
    os.makedirs(file)
    part = next(n for n in os.listdir(os.path.join(tmpdir_fresh, "one")) if n.startswith("part-"))
    shutil.copy(os.path.join(tmpdir_fresh, "one", part), os.path.join(file, "conversations.parquet"))
    want = [(c << 20) + t for c, t, role, text in rows if role == "user" and text]
    for root in (folder, file, f"file://{folder}"):
        got = q_stream_prepare(spark, root).collect()
        assert sorted(r.id for r in got) == want
    # batches are bounded in bytes; a larger file is one of its own
    s = ST.table_stream(spark, folder, "conversations", max_bytes_per_trigger=1)
    seen = []
    q = (s.writeStream.foreachBatch(lambda df, i: seen.append(df.count())).trigger(availableNow=True)
          .option("checkpointLocation", os.path.join(tmpdir_fresh, "ck")).start())
    q.awaitTermination()
    assert len(seen) == 3 and sum(seen) == len(rows)


def test_running_exact_match(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "p")
    spark.createDataFrame([(i, "a" if i % 4 else "b", "a") for i in range(40)],
                          "id long, teacher_answer string, reference_answer string") \
        .repartition(4).write.parquet(src)
    s = ST.file_stream(spark, src)
    out = ST.run_complete(ST.running_exact_match(s), os.path.join(tmpdir_fresh, "o"),
                          os.path.join(tmpdir_fresh, "c")).first()
    assert (out["num_samples"], out["matches"]) == (40, 30)


def test_annotation_map_multiline_file(spark, tmpdir_fresh):
    doc = {"images": {"7": "a.jpg", "8": "b.jpg"},
           "annotations": {"100": {"image_id": 7, "question": "Màu gì?", "answer": "đỏ"},
                           "101": {"image_id": 9, "question": "q2", "answer": "a2"}}}
    path = os.path.join(tmpdir_fresh, "train.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)
    # another split reuses image id 7: each file has its own lookup
    with open(os.path.join(tmpdir_fresh, "dev.json"), "w", encoding="utf-8") as f:
        json.dump({"images": {"7": "dev.jpg"}, "annotations": {"9": {"image_id": 7, "question": "q", "answer": "a"}}}, f)
    ann = FI.read_annotation_map(spark, os.path.join(tmpdir_fresh, "*.json"), multi_line=True)
    rows = sorted((r["ann_id"], r["image_id"], r["question"], r["answer"], r["filename"]) for r in ann.collect())
    assert rows == [("100", 7, "Màu gì?", "đỏ", "a.jpg"), ("101", 9, "q2", "a2", None), ("9", 7, "q", "a", "dev.jpg")]
    with open(os.path.join(tmpdir_fresh, "cut.json"), "w", encoding="utf-8") as f:
        f.write(json.dumps(doc)[:60])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        FI.read_annotation_map(spark, os.path.join(tmpdir_fresh, "cut.json"), multi_line=True).collect()
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        FI.read_requests(spark, os.path.join(tmpdir_fresh, "cut.json")).collect()


def test_requests_both_layouts(spark, tmpdir_fresh):
    d1 = os.path.join(tmpdir_fresh, "wrapped.json")
    d2 = os.path.join(tmpdir_fresh, "list.json")
    with open(d1, "w") as f:
        json.dump({"annotations": [{"image_id": 1, "image_path": "x.jpg", "question": "q"},
                                   {"image_id": 2, "image_path": "", "question": "q2", "answer": "a"}]}, f)
    with open(d2, "w") as f:
        json.dump([{"id": 5, "image_path": "y.jpg", "question": "q5", "answer": "a5"}], f)
    w = FI.read_requests(spark, d1).orderBy("id").collect()
    assert [(r["id"], r["image_path"], r["answer"]) for r in w] == [(1, "x.jpg", None), (2, "", "a")]
    lst = FI.read_requests(spark, d2).collect()
    assert [(r["id"], r["question"], r["answer"]) for r in lst] == [(5, "q5", "a5")]
    # four questions about one image stay four requests, in file order
    with open(d2, "w") as f:
        json.dump([{"image_id": 5, "image_path": "y.jpg", "question": f"q{i}"} for i in (3, 1, 2, 0)], f)
    same = FI.read_requests(spark, d2)
    assert same.select("sample_id").distinct().count() == 4
    assert [r["question"] for r in P.limit_then_filter(same, 2, "sample_id").orderBy("sample_id").collect()] == ["q3", "q1"]
    # P3 drops the empty path; P4 limit applies before it
    both = FI.read_requests(spark, d1)
    assert P.limit_then_filter(both, 1, "id").count() == 1
    assert P.limit_then_filter(both.where("id = 2"), 1, "id").count() == 0


def test_binary_listing_and_image_validation(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "imgs")
    os.makedirs(os.path.join(root, "sub"))
    with open(os.path.join(root, "a.jpg"), "wb") as f:
        f.write(bytes.fromhex("FFD8FFE000104A464946") + b"\x00" * 20)
    with open(os.path.join(root, "sub", "b.jpg"), "wb") as f:
        f.write(b"<html>not an image</html>")
    with open(os.path.join(root, "c.jpg"), "wb") as f:
        pass
    ls = FI.image_listing(spark, root)
    # zero-byte files never reach a Spark file scan, so the empty one is absent
    assert "content" not in ls.columns and ls.count() == 2
    v = {os.path.basename(r["path"]): (r["image_format"], r["image_valid"])
         for r in P.validate_images(FI.image_listing(spark, root, with_content=True)).collect()}
    assert v == {"a.jpg": ("jpeg", True), "b.jpg": (None, False)}


def test_splits_roundtrip_and_unknown_split(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1, 1, "q", "a", "train"), (2, 2, "q", "a", "dev")],
                               "id long, image_id long, question string, answer string, split string")
    path = os.path.join(tmpdir_fresh, "ds")
    SP.write_splits(df, path)
    loaded = SP.load_splits(spark, path)
    assert SP.get_split(loaded, "dev").count() == 1
    try:
        SP.get_split(loaded, "test")
        raise AssertionError("expected ValueError")
    except ValueError as e:
        assert "dev" in str(e) and "train" in str(e)
    plan = SP.get_split(loaded, "dev", check=False)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_dataset_to_json_positions_for_missing_ids(spark, tmpdir_fresh):
    df = spark.createDataFrame([("q1", None), (None, "a2")], "question string, answer string").coalesce(1)
    path = os.path.join(tmpdir_fresh, "j")
    assert FI.dataset_to_json(df, path) == 2
    rows = sorted((r["id"], r["question"], r["answer"]) for r in spark.read.json(path).collect())
    assert rows == [(0, "q1", ""), (1, "", "a2")]


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 100
    assert set(E.oracle_sql()) <= set(E.queries())
    assert {"id", "text", "shuffle_key"} <= set(df.columns)


def test_stream_exact_match_equals_batch_on_item_predictions(spark, tmpdir_fresh):
    from vqaspark.operators.metrics.exact import exact_match
    from vqaspark.plans.fixtures import item_preds
    src = os.path.join(tmpdir_fresh, "preds")
    item_preds(spark, "/root/testdata/sf0.001").repartition(6).write.parquet(src)
    s = ST.file_stream(spark, src, max_files_per_trigger=2)
    out = ST.run_complete(ST.running_exact_match(s), os.path.join(tmpdir_fresh, "o"),
                          os.path.join(tmpdir_fresh, "c")).first()
    b = exact_match(spark.read.parquet(src), "teacher_answer", "reference_answer").first()
    assert out["num_samples"] == b["num_samples"] == 6000
    assert out["matches"] / out["num_samples"] == pytest.approx(b["exact_match"])


def test_header_only_validation_matches_full_read(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "imgs")
    os.makedirs(root)
    with open(os.path.join(root, "a.jpg"), "wb") as f:
        f.write(bytes.fromhex("FFD8FFE000104A464946") + b"\x00" * 5000)
    with open(os.path.join(root, "b.jpg"), "wb") as f:
        f.write(bytes.fromhex("89504E470D0A1A0A") + b"\x01" * 100)
    with open(os.path.join(root, "c.jpg"), "wb") as f:
        f.write(b"GIF? no, text")
    with open(os.path.join(root, "a b 100%.jpg"), "wb") as f:
        f.write(b"GIF89a....")
    with open(os.path.join(root, "w.jpg"), "wb") as f:
        f.write(b"RIFF\x00\x00\x00\x00WAVEfmt ")
    with open(os.path.join(root, "x.jpg"), "wb") as f:
        f.write(b"RIFF\x00\x00\x00\x00WEBPVP8 ")
    full = {os.path.basename(r["path"]): (r["image_format"], r["image_valid"])
            for r in P.validate_images(FI.image_listing(spark, root, with_content=True)).collect()}
    head = {os.path.basename(r["path"]): (r["image_format"], r["image_valid"])
            for r in P.validate_images(FI.image_listing(spark, root, with_header=True), header_only=True).collect()}
    assert full == head == {"a.jpg": ("jpeg", True), "b.jpg": ("png", True), "c.jpg": (None, False), "a b 100%.jpg": ("gif", True),
                            "w.jpg": (None, False), "x.jpg": ("webp", True)}
    from vqaspark.operators import joins as J
    listing = FI.image_listing(spark, root)
    names = ["a.jpg", "a b 100%.jpg", "no.jpg"]
    samples = spark.createDataFrame([(os.path.join(root, n),) for n in names], "image_path string")
    assert {os.path.basename(r[0]) for r in J.image_exists(samples, listing).collect()} == set(names[:2])
    assert [os.path.basename(r[0]) for r in J.image_missing(samples, listing).collect()] == ["no.jpg"]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_page_files_follow_the_pages(spark, sf):
    from vqaspark.plans import q_files as Q
    pages = Q.read_table(spark, sf, "pages").count()
    files = Q._by_bucket(Q.FI.image_listing(spark, Q._page_files(spark, sf), glob="*.txt"))
    assert files.count() >= pages / Q.PAGES_PER_FILE
    assert files.select("bucket", "part").distinct().count() == files.count()
