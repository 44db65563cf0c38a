"""Inputs derived from the driver's tables.

The reference works on (image, question, answer) records, model predictions,
training logs and logits.  None of those ship with the test data, so each is
derived here, by Spark, from the given tables; every derivation is a plain
projection/join whose work grows with the tables.  The same derivations are
written in SQL in ``plans/sql.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vqaspark.functions.hashing import hash_choice
from vqaspark.operators.prepare import qa_pairs
from vqaspark.sources.tables import read_table

IMAGES_ROOT = "training-images"
SPLIT_SEED = 42


def sample_id(conv_id, turn):
    """One bigint per conversation turn: conv_id in the high 43 bits, turn in
    the low 20.  Numbers beyond that raise: no two turns share an id."""
    c, t = F.col(conv_id), F.col(turn)
    fits = c.isNull() | t.isNull() | ((t >= 0) & (t < 1 << 20) & (c >= 0) & (c < 1 << 43))
    return F.when(fits, F.shiftleft(c, 20) + t).otherwise(F.raise_error(F.lit("a turn or conversation number has no id here")).cast("bigint"))


def qa(spark: SparkSession, sf: str) -> DataFrame:
    return qa_pairs(read_table(spark, sf, "conversations"))


def vqa_samples(spark: SparkSession, sf: str) -> DataFrame:
    """(id, image_id, question, answer): one VQA record per QA pair; the
    conversation stands in for the image."""
    return qa(spark, sf).select(sample_id("conv_id", "turn").alias("id"),
                                F.col("conv_id").alias("image_id"),
                                "question", "answer")


def split_of(id_col: str = "id", seed: int = SPLIT_SEED):
    return hash_choice(id_col, (0.8, 0.1, 0.1), ("train", "dev", "test"), seed)


def vqa_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The split dataset (DM1): samples with a stable hash split column."""
    return vqa_samples(spark, sf).withColumn("split", split_of("id"))


def image_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every user turn as an inference request (image_id = conversation)."""
    c = read_table(spark, sf, "conversations")
    return (c.where(F.col("role") == "user")
             .select(sample_id("conv_id", "turn").alias("id"),
                     F.col("conv_id").alias("image_id"),
                     F.col("text").alias("question")))


def image_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Annotation-file ``images`` map: image_id -> filename (2 of 3 pages)."""
    p = read_table(spark, sf, "pages")
    return (p.where(F.col("page_id") % 3 != 0)
             .select(F.col("page_id").alias("image_id"), F.col("url").alias("filename")))


def image_files(spark: SparkSession, sf: str, root: str = IMAGES_ROOT) -> DataFrame:
    """The listing of files that exist (what a binaryFile scan returns)."""
    p = read_table(spark, sf, "pages")
    named = p.where(F.col("page_id") % 7 != 0).select(F.col("url").alias("name"))
    padded = (p.where(F.col("page_id") % 6 == 0)
               .select(F.format_string("%012d.jpg", F.col("page_id")).alias("name")))
    return (named.unionByName(padded)
                 .select(F.concat(F.lit(root + "/"), F.col("name")).alias("path"))
                 .distinct())


def item_preds(spark: SparkSession, sf: str) -> DataFrame:
    """Short answers with NULL, empty, padded, upper-cased, shortened and
    longer variants (one row per lineitem)."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                   "l_quantity")
    part = read_table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    j = li.join(part, li.l_partkey == part.p_partkey)
    pk, ok = F.col("l_partkey"), F.col("l_orderkey")
    name = F.col("p_name")
    ref = (F.when(pk % 11 == 0, F.lit(None).cast("string"))
            .when(pk % 11 == 1, F.lit("")).otherwise(name))
    teacher = (F.when(ok % 5 == 0, F.concat(F.lit(" "), F.upper(name), F.lit(" ")))
                .when(ok % 5 == 1, F.split_part(name, F.lit(" "), F.lit(1))).otherwise(name))
    student = (F.when(ok % 3 == 0, F.split_part(name, F.lit(" "), F.lit(2)))
                .when(ok % 3 == 1, F.concat(name, F.lit(" "), F.lower(F.col("p_type"))))
                .otherwise(name))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                    ref.alias("reference_answer"), teacher.alias("teacher_answer"),
                    student.alias("student_answer"))


# (order, line, part, supplier, quantity) is unique in every test scale.
ITEM_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def train_log(spark: SparkSession, sf: str, eval_every: int = 50) -> DataFrame:
    """Training history rows: run = user, step = event_id, loss = value, an
    eval loss on every ``eval_every``-th step.  No window needed."""
    e = read_table(spark, sf, "events")
    step = F.col("event_id")
    return e.select(F.col("user_id").alias("run_id"), step.alias("step"),
                    (step / F.lit(1000.0)).alias("epoch"),
                    F.col("value").alias("loss"),
                    F.when(step % eval_every == 0, F.col("value") * F.lit(0.9)).alias("eval_loss"),
                    F.col("ts"))


def checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    """Checkpoint directory names per run: ``checkpoint-<k>``."""
    e = read_table(spark, sf, "events")
    return e.select(F.col("user_id").alias("run_id"),
                    F.concat(F.lit("checkpoint-"),
                             F.get_json_object("props", "$.k")).alias("name"))


def logits(spark: SparkSession, sf: str) -> DataFrame:
    """Per answer token: teacher logits = embedding of ``vec_id``, student
    logits = embedding of ``vec_id + 1``, target label = the row's label (-100,
    a masked prompt token, on every fifth row), sample = label.  An equi-join on ``vec_id + 1`` (no unpartitioned lead)."""
    e = read_table(spark, sf, "embeddings")
    t = e.select(F.col("vec_id").alias("pos"), F.col("label").alias("sample_id"),
                 F.when(F.col("vec_id") % 5 == 0, -100).otherwise(F.col("label")).alias("label"),
                 F.col("embedding").alias("teacher_logits"))
    s = e.select((F.col("vec_id") - 1).alias("pos"), F.col("embedding").alias("student_logits"))
    return t.join(s, "pos")


def token_vectors(spark: SparkSession, sf: str, width: int = 32) -> DataFrame:
    """BERTScore input: a sample is ``width`` consecutive ids (answers are
    short, however many there are), side = pred (even ids) / ref (odd)."""
    e = read_table(spark, sf, "embeddings")
    return e.select(F.expr(f"vec_id div {int(width)}").alias("sample_id"),
                    F.when(F.col("vec_id") % 2 == 0, "pred").otherwise("ref").alias("side"),
                    F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"))
