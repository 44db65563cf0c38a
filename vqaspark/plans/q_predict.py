"""Queries: batch prediction with the pluggable model, dead letters,
teacher+student in one pass, distillation examples, synthetic labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from vqaspark.operators import predict as PR
from vqaspark.operators import prepare as P
from vqaspark.operators.models import FirstWordsModel
from vqaspark.operators.tokenize import FileTokenizer
from vqaspark.plans import fixtures as FX
from vqaspark.plans import sql as S
from vqaspark.plans.q_joins import _REQ_PATH_SQL, requests_with_paths
from vqaspark.plans.registry import register

TEACHER = FirstWordsModel(3)
STUDENT = FirstWordsModel(2)
FLAKY = FirstWordsModel(3, fail_modulo=13)


def first_words_sql(expr: str, n: int) -> str:
    return f"array_to_string(list_slice({S.words(expr)}, 1, {n}), ' ')"


def labelled_requests(spark, sf):
    """Requests with their reference answer when the turn was answered."""
    qa = FX.vqa_samples(spark, sf).select("id", "answer")
    return requests_with_paths(spark, sf).join(qa, "id", "left")


_LABELLED_SQL = f"""
select r.*, s.answer from ({_REQ_PATH_SQL}) r left join ({S.SAMPLES}) s on r.id = s.id"""


@register("valid_requests", f"select id from ({_REQ_PATH_SQL}) r where image_path <> '' and question <> ''")
def q_valid_requests(spark, sf):
    return P.valid_requests(requests_with_paths(spark, sf)).select("id")


@register("limit_then_filter", f"""
select id from (select * from ({_REQ_PATH_SQL}) r order by id limit 100) x
where image_path <> '' and question <> ''""")
def q_limit_then_filter(spark, sf):
    return P.limit_then_filter(requests_with_paths(spark, sf), 100, "id").select("id")


@register("predict_requests", f"""
select id, image_id, image_path, question, {first_words_sql('question', 3)} as predicted_answer,
       answer as reference_answer
from ({_LABELLED_SQL}) r where image_path <> '' and question <> ''""")
def q_predict_requests(spark, sf):
    req = P.valid_requests(labelled_requests(spark, sf))
    pred = PR.predict_ok(req, TEACHER)
    return PR.to_prediction_records(pred)


@register("predict_dead_letter", f"""
select id, 'ValueError' as error, 'model failed on input' as error_message from ({_REQ_PATH_SQL}) r
where image_path <> '' and question <> '' and length(question) % 13 = 0""")
def q_predict_dead_letter(spark, sf):
    req = P.valid_requests(requests_with_paths(spark, sf))
    return PR.dead_letter(req, FLAKY).select("id", "error", "error_message")


@register("compare_from_requests", f"""
select id, question, {first_words_sql('question', 3)} as teacher_answer,
       {first_words_sql('question', 2)} as student_answer,
       coalesce(lower({first_words_sql('question', 3)}) = lower({first_words_sql('question', 2)}), false) as match
from ({_REQ_PATH_SQL}) r where image_path <> '' and question <> ''""")
def q_compare_from_requests(spark, sf):
    req = P.valid_requests(requests_with_paths(spark, sf))
    return PR.predict_pair(req, TEACHER, STUDENT).select(
        "id", "question", "teacher_answer", "student_answer", "match")


@register("compare_dead_letter", f"""
select id, {first_words_sql('question', 2)} as student_answer, 'ValueError: model failed on input' as teacher_error,
       cast(null as varchar) as student_error, false as match
from ({_REQ_PATH_SQL}) r where image_path <> '' and question <> '' and length(question) % 13 = 0""")
def q_compare_dead_letter(spark, sf):
    req = P.valid_requests(requests_with_paths(spark, sf))
    return PR.pair_dead_letter(req, FLAKY, STUDENT).select(
        "id", "student_answer", "teacher_error", "student_error", "match")


def _distill_sql():
    prompt = ("'<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' || chr(10) || "
              "'<|im_start|>user' || chr(10) || '<|vision_start|><|image_pad|><|vision_end|>' || question || "
              "'<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)")
    full = f"({prompt} || {first_words_sql('question', 3)})"
    ids = (f"list_transform({S.words(full)}, lambda t: "
           f"cast('0x' || substr(md5(t), 1, 8) as bigint) % 1048576)")
    plen = f"len({S.words(prompt)})"
    return f"""
select id, plen as prompt_len, greatest(n, 512) as seq_len, n - plen as answer_tokens,
  cast(list_sum(list_transform(list_slice(ids, plen + 1, n), lambda x: x)) as bigint) as label_sum,
  cast(list_sum(ids) as bigint) as input_sum
from (select id, {ids} as ids, len({ids}) as n, {plen} as plen
      from ({S.SAMPLES}) s) x"""


@register("distill_examples", _distill_sql())
def q_distill_examples(spark, sf):
    s = FX.vqa_samples(spark, sf)
    t = PR.predict_ok(s, TEACHER, out="teacher_answer")
    d = P.distill_examples(t)
    lab = F.filter("labels", lambda x: x != -100)
    return d.select(
        "id", F.col("prompt_len").cast("bigint").alias("prompt_len"),
        F.size("input_ids").cast("bigint").alias("seq_len"),
        F.size(lab).cast("bigint").alias("answer_tokens"),
        F.aggregate(lab, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("label_sum"),
        F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("input_sum"))


@register("distill_tokenized")
def q_distill_tokenized(spark, sf):
    """Distillation examples with a tokenizer file's ids; no SQL spells its
    merges (tested against the library)."""
    import public_tokenizers
    t = PR.predict_ok(FX.vqa_samples(spark, sf), TEACHER, out="teacher_answer")
    d = P.distill_examples(t, tokenizer=FileTokenizer(public_tokenizers.path("byte_bpe_50k.json")))
    return d.select("id", "prompt_len", "input_ids", "labels")


@register("synthetic_labels", f"""
select id, question, answer, 'labelled' as source from ({S.DATASET}) d where split = 'train'
union all
select id, question, {first_words_sql('question', 3)} as answer, 'synthetic' as source
from ({S.REQUESTS}) r where id not in (select id from ({S.SAMPLES}) s)""")
def q_synthetic_labels(spark, sf):
    ds = FX.vqa_dataset(spark, sf)
    train = ds.where(F.col("split") == "train")
    unlabelled = FX.image_requests(spark, sf).join(FX.vqa_samples(spark, sf).select("id"), "id", "left_anti")
    return PR.synthetic_labels(train, unlabelled, TEACHER)
