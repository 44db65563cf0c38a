"""Queries: image paths/existence, alignment, teacher-student comparison,
registry join."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vqaspark.operators import joins as J
from vqaspark.operators.metrics.exact import exact_match
from vqaspark.plans import fixtures as FX
from vqaspark.plans import sql as S
from vqaspark.plans.registry import register
from vqaspark.sources import buckets as BK

_REQ_PATH_SQL = f"""
select r.id, r.image_id, r.question,
       'training-images/' || coalesce(l.filename, printf('%012d.jpg', r.image_id)) as image_path
from ({S.REQUESTS}) r left join ({S.LOOKUP}) l on r.image_id = l.image_id"""


def requests_with_paths(spark, sf):
    return J.attach_image_paths(FX.image_requests(spark, sf), FX.image_lookup(spark, sf), FX.IMAGES_ROOT)


@register("image_path", f"select id, image_path from ({_REQ_PATH_SQL}) x")
def q_image_path(spark, sf):
    return requests_with_paths(spark, sf).select("id", "image_path")


@register("image_exists", f"""
select id, image_path from ({_REQ_PATH_SQL}) x where image_path in (select path from ({S.FILES}) f)""")
def q_image_exists(spark, sf):
    return J.image_exists(requests_with_paths(spark, sf), FX.image_files(spark, sf)).select("id", "image_path")


@register("image_missing", f"""
select id, image_path from ({_REQ_PATH_SQL}) x where image_path not in (select path from ({S.FILES}) f)""")
def q_image_missing(spark, sf):
    return J.image_missing(requests_with_paths(spark, sf), FX.image_files(spark, sf)).select("id", "image_path")


@register("image_manifest_counts", f"""
select count(*) filter (where f.path is not null) as kept, count(*) filter (where f.path is null) as missing
from ({_REQ_PATH_SQL}) x left join ({S.FILES}) f on x.image_path = f.path""")
def q_image_manifest_counts(spark, sf):
    return J.image_manifest_counts(requests_with_paths(spark, sf), FX.image_files(spark, sf))


_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"


@register("align_predictions", f"""
select {_KEY}, teacher_answer as prediction, reference_answer as reference from ({S.ITEM_PREDS}) p""")
def q_align_predictions(spark, sf):
    p = FX.item_preds(spark, sf)
    preds = p.select(*FX.ITEM_KEY, F.col("teacher_answer").alias("prediction"))
    refs = p.select(*FX.ITEM_KEY, F.col("reference_answer").alias("reference"))
    return J.align_predictions(preds, refs, FX.ITEM_KEY, check="lazy")


@register("compare_models", f"""
select {_KEY}, teacher_answer, student_answer, coalesce(lower(teacher_answer) = lower(student_answer), false) as match
from ({S.ITEM_PREDS}) p""")
def q_compare_models(spark, sf):
    p = FX.item_preds(spark, sf)
    t = p.select(*FX.ITEM_KEY, "teacher_answer")
    s = p.select(*FX.ITEM_KEY, "student_answer")
    return J.compare_models(t, s, FX.ITEM_KEY)


def _stored(spark, sf, *sides):
    """Sides of the item answers, each stored by the key."""
    p = FX.item_preds(spark, sf)
    tag = uuid.uuid4().hex[:8]
    return [BK.store_bucketed(p.select(*FX.ITEM_KEY, c.alias(n)), f"side_{n}_{tag}", FX.ITEM_KEY, 8)
            for n, c in sides]


@register("align_stored", f"""
select {_KEY}, teacher_answer as prediction, reference_answer as reference from ({S.ITEM_PREDS}) p""")
def q_align_stored(spark, sf):
    """Predictions and references stored by the key: checked and aligned
    without a shuffle."""
    preds, refs = _stored(spark, sf, ("prediction", F.col("teacher_answer")), ("reference", F.col("reference_answer")))
    return J.align_predictions(preds, refs, FX.ITEM_KEY, check="lazy")


@register("compare_stored", f"""
select {_KEY}, teacher_answer, student_answer, coalesce(lower(teacher_answer) = lower(student_answer), false) as match
from ({S.ITEM_PREDS}) p""")
def q_compare_stored(spark, sf):
    t, s = _stored(spark, sf, ("teacher_answer", F.col("teacher_answer")), ("student_answer", F.col("student_answer")))
    return J.compare_models(t, s, FX.ITEM_KEY)


_LONG_SQL = f"""
select {_KEY}, '7B-trained' as model_id, teacher_answer as answer, reference_answer from ({S.ITEM_PREDS}) p
union all
select {_KEY}, '2B-distilled' as model_id, student_answer as answer, reference_answer from ({S.ITEM_PREDS}) p"""


@register("model_registry_join", f"""
with reg(model_id, params, purpose) as (values ('7B-base', '7B', 'base_model_for_training'),
  ('7B-trained', '7B', 'teacher_model'), ('2B-distilled', '2B', 'student_model_distilled'))
select l.model_id, reg.params, reg.purpose, count(*) as num_samples,
  avg(case when {S.norm('answer')} = {S.norm('reference_answer')} then 1.0 else 0.0 end) as exact_match
from ({_LONG_SQL}) l left join reg on l.model_id = reg.model_id
group by l.model_id, reg.params, reg.purpose""")
def q_model_registry_join(spark, sf):
    p = FX.item_preds(spark, sf)
    # one scan, each row a (model, answer) row per model; two rows per model
    # are left before the catalogue is joined
    models = F.array(F.struct(F.lit("7B-trained").alias("model_id"), F.col("teacher_answer").alias("answer")),
                     F.struct(F.lit("2B-distilled").alias("model_id"), F.col("student_answer").alias("answer")))
    long = (p.select(*FX.ITEM_KEY, "reference_answer", F.explode(models).alias("_m"))
             .select(*FX.ITEM_KEY, "_m.model_id", "_m.answer", "reference_answer"))
    per_model = exact_match(long, "answer", "reference_answer", group_by=["model_id"])
    return J.model_registry_join(per_model, J.model_registry(spark)).select(
        "model_id", "params", "purpose", "num_samples", "exact_match")
