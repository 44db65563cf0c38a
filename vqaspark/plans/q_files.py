"""Queries: file sources and sinks, each a round trip through files that
Spark writes from the given tables into the shared scratch folder."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from vqaspark.operators import joins as J
from vqaspark.operators import predict as PR
from vqaspark.operators import prepare as P
from vqaspark.plans import fixtures as FX
from vqaspark.plans import sql as S
from vqaspark.plans.q_joins import _REQ_PATH_SQL, requests_with_paths
from vqaspark.plans.q_metrics import q_all_metrics
from vqaspark.plans.q_predict import TEACHER, first_words_sql, q_compare_from_requests, q_predict_requests
from vqaspark.plans.registry import ORACLE, register
from vqaspark.session import scratch_path
from vqaspark.sources import files as FI
from vqaspark.sources import splits as SP
from vqaspark.sources.tables import read_table


@register("annotations_explode", f"""
select s.id as ann_id, s.image_id, s.question, s.answer,
       'training-images/' || coalesce(l.filename, printf('%012d.jpg', s.image_id)) as image_path
from ({S.SAMPLES}) s left join ({S.LOOKUP}) l on s.image_id = l.image_id""")
def q_annotations_explode(spark, sf):
    path = scratch_path(spark, "annotations")
    FI.write_annotation_shards(FX.vqa_samples(spark, sf), FX.image_lookup(spark, sf), path, rows_per_shard=100)
    ann = FI.read_annotation_map(spark, path)
    return ann.select(F.col("ann_id").cast("bigint").alias("ann_id"), "image_id", "question", "answer",
                      P.image_path_column(F.col("image_id"), F.col("filename"), FX.IMAGES_ROOT).alias("image_path"))


@register("requests_read", f"""
select 'wrapped' as layout, id, image_id, image_path, question from ({_REQ_PATH_SQL}) r
union all
select 'list' as layout, id, image_id, image_path, question from ({_REQ_PATH_SQL}) r""")
def q_requests_read(spark, sf):
    req = requests_with_paths(spark, sf)
    base = scratch_path(spark, "requests")
    wrapped, listed = os.path.join(base, "wrapped"), os.path.join(base, "list")
    # {"annotations": [...]} objects, one bounded shard per line
    shards = max(1, -(-req.count() // 100))
    (req.withColumn("_s", F.pmod(F.xxhash64("id"), F.lit(shards)))
        .groupBy("_s").agg(F.collect_list(F.struct(
            F.col("id"), F.col("image_id"), F.col("image_path"), F.col("question"))).alias("annotations"))
        .select("annotations").write.mode("overwrite").json(wrapped))
    # bare request objects (elements of the list layout), one per line
    req.select("id", "image_id", "image_path", "question").write.mode("overwrite").json(listed)
    w = FI.read_requests(spark, wrapped, multi_line=False).withColumn("layout", F.lit("wrapped"))
    lst = FI.read_requests(spark, listed, multi_line=False).withColumn("layout", F.lit("list"))
    cols = ["layout", "id", "image_id", "image_path", "question"]
    return w.select(*cols).unionByName(lst.select(*cols))


def _object_files(rows, shard, value, path) -> str:
    """A file per shard with one JSON object or list over many lines."""
    (rows.groupBy(shard.alias("shard")).agg(value.alias("o"))
         .select("shard", F.to_json("o", {"pretty": "true"}).alias("value")).write.partitionBy("shard").text(path))
    return path


@register("annotations_multiline", ORACLE["annotations_explode"])
def q_annotations_multiline(spark, sf):
    """Annotation files of one large object over many lines, read by byte
    ranges."""
    path = scratch_path(spark, "annotation-objects")
    s = FX.vqa_samples(spark, sf).join(FX.image_lookup(spark, sf), "image_id", "left")
    entry = F.struct(F.col("id").cast("string"), F.struct("image_id", "question", "answer"))
    named = F.array_distinct(F.collect_list(F.when(F.col("filename").isNotNull(), F.struct(F.col("image_id").cast("string"), F.col("filename")))))
    _object_files(s, F.expr("image_id div 100"), F.struct(F.map_from_entries(named).alias("images"),
                                                          F.map_from_entries(F.collect_list(entry)).alias("annotations")), path)
    ann = FI.read_annotation_map(spark, path, multi_line=True)
    return ann.select(F.col("ann_id").cast("bigint").alias("ann_id"), "image_id", "question", "answer",
                      P.image_path_column(F.col("image_id"), F.col("filename"), FX.IMAGES_ROOT).alias("image_path"))


_REQUEST_POSITIONS = f"""
select image_id // 100 as shard, row_number() over (partition by image_id // 100 order by id) - 1 as position, id, image_path, question
from ({_REQ_PATH_SQL}) r"""


def _request_files(spark, sf, wrapped: bool) -> str:
    """Request files of one list, or of one object that holds it."""
    path = scratch_path(spark, "request-objects")
    listed = F.sort_array(F.collect_list(F.struct("id", "image_id", "image_path", "question")))
    return _object_files(requests_with_paths(spark, sf), F.expr("image_id div 100"),
                         F.struct(listed.alias("annotations")) if wrapped else listed, path)


@register("requests_positions", f"""
select 'wrapped' as layout, * from ({_REQUEST_POSITIONS}) a union all select 'list' as layout, * from ({_REQUEST_POSITIONS}) b""")
def q_requests_positions(spark, sf):
    """Both layouts of request files over many lines: each request with its
    place in its file (its ``sample_id``)."""
    both = [FI.read_requests(spark, _request_files(spark, sf, w)).withColumn("layout", F.lit("wrapped" if w else "list")) for w in (True, False)]
    return both[0].unionByName(both[1]).select(
        "layout", F.regexp_extract("sample_id.file", r"/shard=(\d+)/", 1).cast("bigint").alias("shard"),
        F.col("sample_id.position").alias("position"), "id", "image_path", "question")


@register("predict_from_requests", f"""
select id, image_id, image_path, question, {first_words_sql('question', 3)} as predicted_answer,
       cast(null as varchar) as reference_answer
from ({_REQ_PATH_SQL}) r where image_path <> '' and question <> ''""")
def q_predict_from_requests(spark, sf):
    """Prediction straight from request files."""
    return PR.predict_from_requests(spark, _request_files(spark, sf, wrapped=True), TEACHER)


PAGE_BUCKETS = 7
PAGES_PER_FILE = 25


def _part():
    return F.floor(F.col("page_id") / (PAGE_BUCKETS * PAGES_PER_FILE))


def _page_files(spark, sf):
    """Write the pages as text files (the blobs a binaryFile listing sees), some with the ASCII magic of a GIF,
    25 to a file (``bucket``, ``part``) so that the files follow the input in number and not in size, and return the root."""
    root = scratch_path(spark, "page-files")
    p = read_table(spark, sf, "pages")
    (p.select((F.col("page_id") % PAGE_BUCKETS).alias("bucket"), _part().alias("part"),
              F.concat(F.when(F.col("page_id") % PAGE_BUCKETS < 3, F.lit("GIF89a")).otherwise(""),
                       F.coalesce("html", F.lit(""))).alias("value"))
      .repartition("bucket", "part").write.mode("overwrite").partitionBy("bucket", "part").text(root))
    return root


_PAGE_BYTES = f"""
select page_id % {PAGE_BUCKETS} as bucket,
       sum(octet_length(encode(coalesce(html, ''))) + 1 + case when page_id % {PAGE_BUCKETS} < 3 then 6 else 0 end) as n
from pages group by 1"""


def _by_bucket(listing):
    at = r"/bucket=(\d+)/part=(\d+)/[^/]+$"
    return (listing.withColumn("bucket", F.regexp_extract("path", at, 1).cast("bigint"))
            .withColumn("part", F.regexp_extract("path", at, 2).cast("bigint")))


@register("image_listing", f"select cast(bucket as bigint) as bucket, cast(n as bigint) as length from ({_PAGE_BYTES}) b")
def q_image_listing(spark, sf):
    """Listing of written files (binaryFile, ``content`` pruned): bytes by folder."""
    ls = FI.image_listing(spark, _page_files(spark, sf), glob="*.txt")
    return _by_bucket(ls).groupBy("bucket").agg(F.sum("length").alias("length"))


@register("validate_images", f"""
select cast(bucket as bigint) as bucket, case when bucket < 3 then 'gif' end as image_format, bucket < 3 as image_valid,
       cast(n as bigint) as length from ({_PAGE_BYTES}) b""")
def q_validate_images(spark, sf):
    """Magic-byte validation: files that begin with a GIF header are valid,
    the others are HTML text."""
    ls = FI.image_listing(spark, _page_files(spark, sf), glob="*.txt", with_header=True)
    v = _by_bucket(P.validate_images(ls, header_only=True))
    return v.groupBy("bucket", "image_format", "image_valid").agg(F.sum("length").alias("length"))


@register("listed_images_exist", f"""
select page_id, page_id % {PAGE_BUCKETS} < {PAGE_BUCKETS} - 2 as found from pages""")
def q_listed_images_exist(spark, sf):
    """Listing (URIs) joined with plain paths: pages of two folders point to
    files that were never written."""
    root = _page_files(spark, sf)
    ls = _by_bucket(FI.image_listing(spark, root, glob="*.txt")).where(F.col("bucket") < PAGE_BUCKETS - 2)
    first = ls.groupBy("bucket", "part").agg(F.min("path").alias("path"))
    pages = read_table(spark, sf, "pages").select("page_id", (F.col("page_id") % PAGE_BUCKETS).alias("bucket"), _part().alias("part"))
    plain = J.plain_path("path")
    samples = pages.join(first, ["bucket", "part"], "left").select(
        "page_id", F.coalesce(plain, F.concat(F.lit("/nowhere/"), F.col("bucket").cast("string"), F.lit("/"), F.col("part").cast("string"))).alias("image_path"))
    return (J.image_exists(samples, ls).select("page_id", F.lit(True).alias("found"))
            .unionByName(J.image_missing(samples, ls).select("page_id", F.lit(False).alias("found"))))


_PRED_SCHEMA = ("id bigint, image_id bigint, image_path string, question string, "
                "predicted_answer string, reference_answer string")


@register("sink_predictions", ORACLE["predict_requests"])
def q_sink_predictions(spark, sf):
    path = scratch_path(spark, "predictions")
    FI.save_predictions(q_predict_requests(spark, sf), path)
    return spark.read.schema(_PRED_SCHEMA).json(path)


@register("sink_comparisons", ORACLE["compare_from_requests"])
def q_sink_comparisons(spark, sf):
    path = scratch_path(spark, "comparisons")
    FI.save_comparisons(q_compare_from_requests(spark, sf), path)
    return spark.read.schema("id bigint, question string, teacher_answer string, "
                             "student_answer string, match boolean").json(path)


@register("eval_report", f"select '7B-trained' as model, m.* from ({ORACLE['all_metrics']}) m")
def q_eval_report(spark, sf):
    path = scratch_path(spark, "report")
    FI.save_report(q_all_metrics(spark, sf).select(F.lit("7B-trained").alias("model"), "*"), path)
    return spark.read.schema("model string, num_samples bigint, exact_match double, rouge_l double, "
                             "bertscore_f1 double").json(path)


@register("history_sink", f"select run_id, step, epoch, loss, eval_loss from ({S.TRAIN_LOG}) l")
def q_history_sink(spark, sf):
    path = scratch_path(spark, "history")
    FI.history_sink(FX.train_log(spark, sf), path)
    return spark.read.parquet(path).select("run_id", "step", "epoch", "loss", "eval_loss")


@register("history_replay", f"select run_id, step, epoch, loss, eval_loss from ({S.TRAIN_LOG}) l")
def q_history_replay(spark, sf):
    """History appended in two batches, the first one twice: rows stand once."""
    path = scratch_path(spark, "history-batches")
    log = FX.train_log(spark, sf)
    for part in (0, 1, 0):
        FI.append_history(log.where(F.col("run_id") % 2 == part), path, f"half-{part}")
    return FI.read_history(spark, path).select("run_id", "step", "epoch", "loss", "eval_loss")


@register("write_partitioned", f"select id, image_id, question, answer, split from ({S.DATASET}) d")
def q_write_partitioned(spark, sf):
    path = scratch_path(spark, "splits")
    SP.write_splits(FX.vqa_dataset(spark, sf), path)
    # each partition directory read on its own (no other split is opened)
    out = spark.createDataFrame([], "id bigint, image_id bigint, question string, answer string, split string")
    for name in SP.stored_splits(spark, path):
        one = spark.read.schema("id bigint, image_id bigint, question string, answer string").parquet(
            os.path.join(path, f"split={name}"))
        out = out.unionByName(one.withColumn("split", F.lit(name)))
    return out
