"""Queries: loading, splitting, preparation, sampling, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from vqaspark.functions import text as T
from vqaspark.operators import prepare as P
from vqaspark.operators import sampling as O
from vqaspark.operators import stats as ST
from vqaspark.plans import fixtures as FX
from vqaspark.plans import sql as S
from vqaspark.plans.registry import register
from vqaspark.session import scratch_path
from vqaspark.sources import ordered as OR
from vqaspark.sources import splits as SP
from vqaspark.sources.tables import read_table


def _written_splits(spark, sf) -> str:
    """Write the derived dataset split-partitioned to the shared scratch
    folder and return its path."""
    path = scratch_path(spark, "vqa-splits")
    SP.write_splits(FX.vqa_dataset(spark, sf), path)
    return path


def _materialized_splits(spark, sf):
    """The written dataset through the S1 reader."""
    return SP.load_splits(spark, _written_splits(spark, sf))


@register("load_splits", f"select id, image_id, question, answer, split from ({S.DATASET}) d")
def q_load_splits(spark, sf):
    return _materialized_splits(spark, sf).select("id", "image_id", "question", "answer", "split")


@register("get_split", f"select id, image_id, question, answer from ({S.DATASET}) d where split = 'dev'")
def q_get_split(spark, sf):
    path = _written_splits(spark, sf)
    known = SP.stored_splits(spark, path)
    return SP.get_split(SP.load_splits(spark, path), "dev", known=known).select("id", "image_id", "question", "answer")


@register("split_stats", f"""
select coalesce(split, 'total') as split, count(*) as num_samples
from ({S.DATASET}) d group by rollup(split)""")
def q_split_stats(spark, sf):
    return ST.split_stats(FX.vqa_dataset(spark, sf))


@register("split_image_stats", f"""
select split, count(*) as num_samples, count(distinct image_id) as unique_images
from ({S.DATASET}) d group by split""")
def q_split_image_stats(spark, sf):
    return ST.split_image_stats(FX.vqa_dataset(spark, sf))


def _len_sql(c):
    chars = f"length({c})"
    w = f"len({S.words(c)})"
    return (f"cast(min({chars}) as bigint) as {c}_chars_min, cast(max({chars}) as bigint) as {c}_chars_max, "
            f"round(avg({chars}), 6) as {c}_chars_avg, cast(min({w}) as bigint) as {c}_words_min, "
            f"cast(max({w}) as bigint) as {c}_words_max, round(avg({w}), 6) as {c}_words_avg, "
            f"quantile_cont({w}, 0.5) as {c}_words_median")


@register("length_profile", f"select {_len_sql('question')}, {_len_sql('answer')} from ({S.SAMPLES}) s")
def q_length_profile(spark, sf):
    return ST.length_profile(FX.vqa_samples(spark, sf))


@register("merged_sketches", f"""
select split, count(*) as num_samples, true as images_near, true as median_near,
       cast(max(len({S.words('question')})) as bigint) as question_words_max
from ({S.DATASET}) d group by split""")
def q_merged_sketches(spark, sf):
    """Sketches of two runs, stored and merged, beside one exact pass: image
    counts within 5 %, medians within 2 % of the ranks."""
    path = scratch_path(spark, "sketches")
    d = FX.vqa_dataset(spark, sf)
    for run in (0, 1):
        ST.split_sketches(d.where(F.col("id") % 2 == run)).write.parquet(f"{path}/run={run}")
    got = ST.merge_sketches(spark.read.parquet(path))
    n, m, words = F.count(F.lit(1)), F.col("question_words_p50"), T.word_count("question")
    exact = d.join(got.select("split", "question_words_p50"), "split").groupBy("split").agg(
        F.count_distinct("image_id").alias("images"), (F.count_if(words < m) / n).alias("below"), (F.count_if(words <= m) / n).alias("up_to"))
    return got.join(exact, "split").select(
        "split", "num_samples", (F.abs(F.col("unique_images") / F.col("images") - 1) <= 0.05).alias("images_near"),
        ((F.col("below") <= 0.52) & (F.col("up_to") >= 0.48)).alias("median_near"), "question_words_max")


@register("qa_pairs", S.QA)
def q_qa_pairs(spark, sf):
    return FX.qa(spark, sf)


@register("normalize_answer", f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       {S.norm('teacher_answer')} as teacher_norm, {S.norm('reference_answer')} as reference_norm
from ({S.ITEM_PREDS}) p""")
def q_normalize_answer(spark, sf):
    p = FX.item_preds(spark, sf)
    return p.select(*FX.ITEM_KEY, T.normalize_answer("teacher_answer").alias("teacher_norm"),
                    T.normalize_answer("reference_answer").alias("reference_norm"))


@register("clean_text", f"""
select id, lower(regexp_replace(question, '[^\\p{{L}}\\p{{N}}\\p{{M}}{S.WS[1:-1]}]', '', 'g')) as question_clean
from ({S.SAMPLES}) s""")
def q_clean_text(spark, sf):
    s = FX.vqa_samples(spark, sf)
    return s.select("id", T.clean_text("question", lowercase=True, remove_special=True).alias("question_clean"))


def _preview_sql(c):
    return f"case when length({c}) > 100 then substr({c}, 1, 100) || '...' else {c} end"


@register("preview", f"""
select id, {_preview_sql('question')} as question_preview, {_preview_sql('answer')} as answer_preview
from ({S.SAMPLES}) s""")
def q_preview(spark, sf):
    s = FX.vqa_samples(spark, sf)
    return s.select("id", T.preview("question").alias("question_preview"),
                    T.preview("answer").alias("answer_preview"))


@register("length_filter", f"""
select id from ({S.SAMPLES}) s
where coalesce(len({S.words('question')}), 0) <= 40 and coalesce(len({S.words('answer')}), 0) <= 100""")
def q_length_filter(spark, sf):
    s = FX.vqa_samples(spark, sf)
    return P.length_filter(s, max_question=40, max_answer=100, unit="words").select("id")


@register("validate_text", f"""
select id,
  coalesce(case when question is null then 'question:null' end,
           case when regexp_replace(question, '^{S.WS}+|{S.WS}+$', '', 'g') = '' then 'question:blank' end,
           case when text is null then 'text:null' end,
           case when regexp_replace(text, '^{S.WS}+|{S.WS}+$', '', 'g') = '' then 'text:blank' end) as text_issue
from (select (conv_id << 20) + turn as id, text, text as question from conversations) c""")
def q_validate_text(spark, sf):
    c = read_table(spark, sf, "conversations")
    c = c.select(FX.sample_id("conv_id", "turn").alias("id"), "text", F.col("text").alias("question"))
    return P.validate_text(c, cols=("question", "text")).select("id", "text_issue")


@register("validate_utf8", f"""
select doc_id, case when doc_id % 10 = 0 then 'raw:invalid_utf8' when text is null then 'raw:null'
                    when regexp_replace(text, '^{S.WS}+|{S.WS}+$', '', 'g') = '' then 'raw:blank' end as text_issue
from documents""")
def q_validate_utf8(spark, sf):
    """Encoding check on binary input: every tenth text gets a broken sequence."""
    d = read_table(spark, sf, "documents")
    broken = F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.unhex(F.lit("C328")))
    raw = F.when(F.col("doc_id") % 10 == 0, broken).otherwise(F.col("text").cast("binary"))
    return P.validate_text(d.select("doc_id", raw.alias("raw")), cols=("raw",), binary=True).select("doc_id", "text_issue")


# Messages are compared flattened: roles, part types and texts.
_MSG_SQL = f"""
select id, 2 as n_messages, 'user,assistant' as roles, 'image,text|text' as part_types,
       question as user_text, answer as assistant_text
from ({S.SAMPLES}) s"""


@register("build_messages", _MSG_SQL)
def q_build_messages(spark, sf):
    m = P.build_messages(FX.vqa_samples(spark, sf)).select("id", "messages")
    msgs = F.col("messages")
    return m.select(
        "id", F.size(msgs).alias("n_messages"),
        F.array_join(F.transform(msgs, lambda x: x["role"]), ",").alias("roles"),
        F.array_join(F.transform(msgs, lambda x: F.array_join(
            F.transform(x["content"], lambda c: c["type"]), ",")), "|").alias("part_types"),
        F.element_at(F.element_at(msgs, 1)["content"], 2)["text"].alias("user_text"),
        F.element_at(F.element_at(msgs, 2)["content"], 1)["text"].alias("assistant_text"))


@register("build_prompt_messages", f"""
select id, 1 as n_messages, 'user' as roles, 'image,text' as part_types, question as user_text
from ({S.SAMPLES}) s""")
def q_build_prompt_messages(spark, sf):
    m = P.build_prompt_messages(FX.vqa_samples(spark, sf)).select("id", "messages")
    msgs = F.col("messages")
    return m.select(
        "id", F.size(msgs).alias("n_messages"),
        F.array_join(F.transform(msgs, lambda x: x["role"]), ",").alias("roles"),
        F.array_join(F.transform(msgs, lambda x: F.array_join(
            F.transform(x["content"], lambda c: c["type"]), ",")), "|").alias("part_types"),
        F.element_at(F.element_at(msgs, 1)["content"], 2)["text"].alias("user_text"))


def _chat_sql(q, a=None, gen=True):
    nl = "chr(10)"
    s = (f"'<|im_start|>system' || {nl} || 'You are a helpful assistant.<|im_end|>' || {nl} || "
         f"'<|im_start|>user' || {nl} || '<|vision_start|><|image_pad|><|vision_end|>' || coalesce({q}, '') || "
         f"'<|im_end|>' || {nl}")
    if a is not None:
        s += f" || '<|im_start|>assistant' || {nl} || coalesce({a}, '') || '<|im_end|>' || {nl}"
    if gen:
        s += f" || '<|im_start|>assistant' || {nl}"
    return s


@register("render_chat", f"select id, {_chat_sql('question', 'answer')} as text from ({S.SAMPLES}) s")
def q_render_chat(spark, sf):
    m = P.build_messages(FX.vqa_samples(spark, sf))
    return P.render_chat(m).select("id", "text")


def _samples_with_path(spark, sf):
    s = FX.vqa_samples(spark, sf)
    lk = FX.image_lookup(spark, sf)
    return (s.join(lk, "image_id", "left")
             .withColumn("image_path", P.image_path_column(F.col("image_id"), F.col("filename"), FX.IMAGES_ROOT))
             .drop("filename"))


_PATH_SQL = f"""
select s.*, 'training-images/' || coalesce(l.filename, printf('%012d.jpg', s.image_id)) as image_path
from ({S.SAMPLES}) s left join ({S.LOOKUP}) l on s.image_id = l.image_id"""


@register("prepare_dataset", f"""
select id, image_id, question, answer, image_path as image, {_chat_sql('question', 'answer')} as text,
       md5('42:' || cast(id as varchar)) as shuffle_key
from ({_PATH_SQL}) s order by shuffle_key, id limit 100""")
def q_prepare_dataset(spark, sf):
    out = P.prepare_dataset(_samples_with_path(spark, sf), max_samples=100, shuffle=True, seed=42)
    return out.select("id", "image_id", "question", "answer",
                      F.element_at("images", 1).alias("image"), "text", "shuffle_key")


@register("shuffle_keys", f"select id, md5('42:' || cast(id as varchar)) as shuffle_key from ({S.SAMPLES}) s")
def q_shuffle_keys(spark, sf):
    return O.with_shuffle_key(FX.vqa_samples(spark, sf)).select("id", "shuffle_key")


@register("sample_n", f"""
select id, question from ({S.SAMPLES}) s
order by md5('42:' || cast(id as varchar)), id limit 50""")
def q_sample_n(spark, sf):
    return O.sample_n(FX.vqa_samples(spark, sf), 50).select("id", "question")


@register("hash_split", f"select doc_id, {S.split_case('doc_id')} as split from documents")
def q_hash_split(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id")
    return O.hash_split(d, id_col="doc_id")


@register("get_sample", f"""
select id, question, answer, idx as "index" from (
  select *, row_number() over (order by id) - 1 as idx from ({S.SAMPLES}) s) x
where idx = 7""")
def q_get_sample(spark, sf):
    return O.get_sample(FX.vqa_samples(spark, sf), 7, "id").select("id", "question", "answer", "index")


@register("assign_batches", f"""
select id, cast(floor(idx / 32) as bigint) as batch_id, cast(idx % 32 as bigint) as batch_pos from (
  select id, row_number() over (order by md5('42:' || cast(id as varchar)), id) - 1 as idx
  from ({S.SAMPLES}) s) x""")
def q_assign_batches(spark, sf):
    s = O.with_shuffle_key(FX.vqa_samples(spark, sf))
    return O.assign_batches(s, 32, ["shuffle_key", "id"]).select("id", "batch_id", "batch_pos")


_SHUFFLED_SQL = f"""
  select id, question, row_number() over (order by md5('42:' || cast(id as varchar)), id) - 1 as idx, count(*) over () as n
  from ({S.SAMPLES}) s"""


def _stored_shuffle(spark, sf) -> str:
    """The samples' whole seeded shuffle, stored once."""
    path = scratch_path(spark, "shuffled")
    OR.store_shuffled(FX.vqa_samples(spark, sf).select("id", "question"), path)
    return path


@register("stored_shuffle", f"select id, idx as position from ({_SHUFFLED_SQL}) x")
def q_stored_shuffle(spark, sf):
    return OR.read_ordered(spark, _stored_shuffle(spark, sf)).select("id", "position")


@register("stored_sample", f"""select id, question, idx as "index" from ({_SHUFFLED_SQL}) x where idx = n * 3 // 4""")
def q_stored_sample(spark, sf):
    """A sample far into the shuffled order: one file is opened."""
    path = _stored_shuffle(spark, sf)
    return OR.get_row(spark, path, OR.count(spark, path) * 3 // 4).select("id", "question", "index")


@register("stored_batch", f"""
select id, question, idx - n // 64 * 32 as batch_pos from ({_SHUFFLED_SQL}) x where idx // 32 = n // 64""")
def q_stored_batch(spark, sf):
    """A batch from the middle of the shuffled order."""
    path = _stored_shuffle(spark, sf)
    return OR.get_batch(spark, path, OR.count(spark, path) // 64, 32).select("id", "question", "batch_pos")


@register("prepare_dataset_all", f"""
select id, idx as position from ({_SHUFFLED_SQL}) x""")
def q_prepare_dataset_all(spark, sf):
    """All prepared rows in shuffled order; the numbers are those of the rows
    as they come (partitions in order, rows within them)."""
    out = P.prepare_dataset(_samples_with_path(spark, sf))
    path = scratch_path(spark, "prepared")
    out.select("id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m")).write.parquet(path)
    rows = spark.read.parquet(path)
    first = OR.first_positions(rows, "p").select("p", "first")
    return rows.join(first, "p").select("id", (F.col("first") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1))).alias("position"))


@register("preview_topk", f"""
select id, {_preview_sql('question')} as question_preview from ({S.SAMPLES}) s order by id limit 5""")
def q_preview_topk(spark, sf):
    s = FX.vqa_samples(spark, sf).select("id", T.preview("question").alias("question_preview"))
    return O.preview_topk(s, 5, "id")


@register("dataset_to_json_positions", """
select case when item_id % 3 = 0 then row_number() over (order by item_id) - 1 else item_id + 1000000 end as id,
       coalesce(text, '') as question, '' as answer from benchmark""")
def q_dataset_to_json_positions(spark, sf):
    """Missing ids become positions in a stated order, whatever the file layout."""
    from vqaspark.sources.files import dataset_to_json
    path = scratch_path(spark, "dataset-json")
    b = read_table(spark, sf, "benchmark")
    rows = b.select(F.when(F.col("item_id") % 3 != 0, F.col("item_id") + 1000000).alias("id"),
                    F.col("text").alias("question"), "item_id")
    dataset_to_json(rows, path, order_cols="item_id")
    return spark.read.schema("id bigint, question string, answer string").json(path)


@register("dataset_to_json_rows", f"""
select coalesce(id, 0) as id, coalesce(question, '') as question, coalesce(answer, '') as answer
from ({S.SAMPLES}) s""")
def q_dataset_to_json_rows(spark, sf):
    from vqaspark.sources.files import dataset_to_json
    path = scratch_path(spark, "dataset-json")
    dataset_to_json(FX.vqa_samples(spark, sf), path)
    return spark.read.schema("id bigint, question string, answer string").json(path)
