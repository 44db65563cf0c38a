"""Queries: exact match, agreement, ROUGE-L, partial match, BERTScore,
BLEU, combined metrics, teacher/student report, quality gate, KD losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from vqaspark.functions import text as T
from vqaspark.operators import prepare as P
from vqaspark.operators.metrics import bert as B
from vqaspark.operators.metrics import bleu as BL
from vqaspark.operators.metrics import exact as E
from vqaspark.operators.metrics import kd as KD
from vqaspark.operators.metrics import partial as PM
from vqaspark.operators.metrics import report as R
from vqaspark.operators.metrics import rouge as RG
from vqaspark.plans import fixtures as FX
from vqaspark.plans import sql as S
from vqaspark.plans.registry import register
from vqaspark.sources.tables import read_table

_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"


def _em_sql(p, r):
    return f"(case when {S.norm(p)} = {S.norm(r)} then 1.0 else 0.0 end)"


@register("exact_match", f"""
select count(*) as num_samples, round(coalesce(avg({_em_sql('teacher_answer', 'reference_answer')}), 0.0), 6) as exact_match
from ({S.ITEM_PREDS}) p""")
def q_exact_match(spark, sf):
    e = E.exact_match(FX.item_preds(spark, sf), "teacher_answer", "reference_answer")
    return e.select("num_samples", F.round("exact_match", 6).alias("exact_match"))


@register("exact_match_labeled", f"""
select cast(sum(case when reference_answer is not null then {_em_sql('teacher_answer', 'reference_answer')} else 0 end) as bigint) as matches,
       count(*) filter (where reference_answer is not null and reference_answer <> '') as labeled,
       round(sum(case when reference_answer is not null then {_em_sql('teacher_answer', 'reference_answer')} else 0 end)
             / count(*) filter (where reference_answer is not null and reference_answer <> ''), 6) as exact_match
from ({S.ITEM_PREDS}) p""")
def q_exact_match_labeled(spark, sf):
    e = E.exact_match_labeled(FX.item_preds(spark, sf), "teacher_answer", "reference_answer")
    return e.select("matches", "labeled", F.round("exact_match", 6).alias("exact_match"))


@register("agreement", f"""
select count(*) as num_samples,
       cast(sum(case when lower(teacher_answer) = lower(student_answer) then 1 else 0 end) as bigint) as agreements,
       round(avg(case when lower(teacher_answer) = lower(student_answer) then 1.0 else 0.0 end), 6) as agreement
from ({S.ITEM_PREDS}) p""")
def q_agreement(spark, sf):
    a = E.agreement(FX.item_preds(spark, sf))
    return a.select("num_samples", "agreements", F.round("agreement", 6).alias("agreement"))


# ---------------------------------------------------------------- ROUGE-L

def tok_sql(expr):
    return (f"list_filter(string_split(regexp_replace(lower({S.norm(f'coalesce({expr}, {chr(39)}{chr(39)})')}), "
            f"'[^a-z0-9]+', ' ', 'g'), ' '), lambda tk_: tk_ <> '')")


def lcs_sql(r, h):
    """LCS length of token lists r, h (DP row carried through list_reduce)."""
    return f"""(case when len({r}) = 0 or len({h}) = 0 then 0 else
list_reduce(
  list_transform({h}, lambda lcs_tok: {{'t': lcs_tok, 'row': [0]::int[]}}),
  lambda lcs_acc, lcs_el: {{'t': lcs_el.t, 'row': list_reduce(
     list_transform(range(1, len({r}) + 1), lambda lcs_j: [lcs_j::int]),
     lambda lcs_cur, lcs_jj: list_append(lcs_cur, (case when {r}[lcs_jj[1]] = lcs_el.t then lcs_acc.row[lcs_jj[1]] + 1
                                      else greatest(lcs_acc.row[lcs_jj[1] + 1], lcs_cur[lcs_jj[1]]) end)::int),
     [0]::int[])}},
  {{'t': '', 'row': list_transform(range(0, len({r}) + 1), lambda lcs_z: 0::int)}}).row[len({r}) + 1] end)"""


def rouge_sql(p, r):
    """Per-row ROUGE-L F1 over a subquery exposing token lists ``{p}t``/``{r}t``."""
    pt, rt = f"{p}_t", f"{r}_t"
    lcs = lcs_sql(rt, pt)
    return (f"(case when len({pt}) = 0 or len({rt}) = 0 then 0.0 else "
            f"(case when {lcs} = 0 then 0.0 else 2.0 * ({lcs} / len({pt})) * ({lcs} / len({rt})) / "
            f"(({lcs} / len({pt})) + ({lcs} / len({rt}))) end) end)")


@register("rouge_l_pairs", f"""
select conv_id, turn, round({rouge_sql('answer', 'question')}, 6) as rouge_l
from (select conv_id, turn, {tok_sql('question')} as question_t, {tok_sql('answer')} as answer_t
      from ({S.QA}) q) sub_""")
def q_rouge_l_pairs(spark, sf):
    s = RG.rouge_l_scores(FX.qa(spark, sf), "answer", "question", stem=False)
    return s.select("conv_id", "turn", F.round("rouge_l", 6).alias("rouge_l"))


@register("rouge_l", f"""
select count(*) as num_samples, round(coalesce(avg({rouge_sql('teacher_answer', 'reference_answer')}), 0.0), 6) as rouge_l
from (select {tok_sql('teacher_answer')} as teacher_answer_t, {tok_sql('reference_answer')} as reference_answer_t
      from ({S.ITEM_PREDS}) p) sub_""")
def q_rouge_l(spark, sf):
    r = RG.rouge_l(FX.item_preds(spark, sf), "teacher_answer", "reference_answer", stem=False)
    return r.select("num_samples", F.round("rouge_l", 6).alias("rouge_l"))


def long_pairs(spark, sf):
    """Whole documents as references; predictions drop every 5th word."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    words = T.split_words(F.col("text"))
    return d.select("doc_id", F.col("text").alias("reference"),
                    F.array_join(F.filter(words, lambda w, i: i % 5 != 4), " ").alias("prediction"))


_LONG_SQL = f"""
with w as (select doc_id, text, {S.words('text')} as words from documents),
     t as (select doc_id, len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) as r,
                  len(regexp_extract_all(lower(array_to_string(list_filter(words, lambda x, i: i % 5 <> 0), ' ')), '[\\p{{L}}\\p{{N}}]+')) as p
           from w)
select doc_id, round(case when coalesce(p, 0) = 0 or coalesce(r, 0) = 0 then 0.0 else 2.0 * p / (p + r) end, 6) as rouge_l from t"""


@register("rouge_l_long", _LONG_SQL)
def q_rouge_l_long(spark, sf):
    """Full-document ROUGE-L (texts up to ~20k words).  The prediction is part
    of the reference in its order, so the oracle knows their longest common
    subsequence without one; other pairs are checked against a plain DP in
    tests."""
    s = RG.rouge_l_scores(long_pairs(spark, sf), "prediction", "reference", tokenizer="unicode", stem=False)
    return s.select("doc_id", F.round("rouge_l", 6).alias("rouge_l"))


@register("partial_match")
def q_partial_match(spark, sf):
    """difflib ratio (no SQL form): rows-only check + literal unit tests."""
    p = FX.item_preds(spark, sf)
    return PM.partial_match(p, "teacher_answer", "reference_answer").select(
        "num_scored", F.round("partial_match", 6).alias("partial_match"))


@register("partial_match_pairs")
def q_partial_match_pairs(spark, sf):
    p = FX.item_preds(spark, sf)
    s = PM.partial_match_scores(p, "student_answer", "reference_answer")
    return s.select(*FX.ITEM_KEY, F.round("partial_match", 6).alias("partial_match"))


# ------------------------------------------------------------- BERTScore

# Greedy matching in SQL; samples of ``width`` consecutive embeddings.
def _bert_sql(width: int = 32, name: str = "") -> str:
    return f"""
tv{name} as (
  select vec_id // {width} as sample_id, case when vec_id % 2 = 0 then 'pred' else 'ref' end as side,
         vec_id as pos, cast(embedding as double[]) as v
  from embeddings),
pairs{name} as (
  select p.sample_id, p.pos as ppos, r.pos as rpos,
         list_dot_product(p.v, r.v) / (sqrt(list_dot_product(p.v, p.v)) * sqrt(list_dot_product(r.v, r.v))) as sim
  from tv{name} p join tv{name} r on p.sample_id = r.sample_id and p.side = 'pred' and r.side = 'ref'),
pb{name} as (select sample_id, ppos, max(sim) as best from pairs{name} group by sample_id, ppos),
rb{name} as (select sample_id, rpos, max(sim) as best from pairs{name} group by sample_id, rpos),
pr{name} as (select sample_id, avg(best) as precision from pb{name} group by sample_id),
rr{name} as (select sample_id, avg(best) as recall from rb{name} group by sample_id),
s{name} as (select i.sample_id, coalesce(precision, 0.0) as precision, coalesce(recall, 0.0) as recall,
             case when coalesce(precision, 0.0) + coalesce(recall, 0.0) = 0 then 0.0
                  else 2 * precision * recall / (precision + recall) end as f1
      from (select distinct sample_id from tv{name}) i left join pr{name} on pr{name}.sample_id = i.sample_id
      left join rr{name} on rr{name}.sample_id = i.sample_id)"""


_BERT_SAMPLES_SQL = f"with {_bert_sql()}"


@register("bertscore_samples", _BERT_SAMPLES_SQL + """
select sample_id, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1 from s""")
def q_bertscore_samples(spark, sf):
    return B.bertscore_samples(FX.token_vectors(spark, sf))


@register("bertscore", _BERT_SAMPLES_SQL + """
select count(*) as num_samples, round(avg(precision), 6) as bertscore_precision,
       round(avg(recall), 6) as bertscore_recall, round(avg(f1), 6) as bertscore_f1 from s""")
def q_bertscore(spark, sf):
    return B.bertscore(FX.token_vectors(spark, sf))


@register("bertscore_weighted", f"""
with {_bert_sql()},
tok as (select vec_id // 32 as sample_id, case when vec_id % 2 = 0 then 'pred' else 'ref' end as side, vec_id as pos,
               cast(label as varchar) as token from embeddings),
refs as (select count(distinct sample_id) as n from tok where side = 'ref'),
idf as (select token, ln((max(refs.n) + 1) / (count(distinct sample_id) filter (where side = 'ref') + 1)) as w
        from tok cross join refs group by token),
wp as (select pb.sample_id, sum(best * w) / nullif(sum(w), 0) as precision from pb join tok on tok.sample_id = pb.sample_id and tok.pos = ppos
       join idf using (token) group by pb.sample_id),
wr as (select rb.sample_id, sum(best * w) / nullif(sum(w), 0) as recall from rb join tok on tok.sample_id = rb.sample_id and tok.pos = rpos
       join idf using (token) group by rb.sample_id),
x as (select i.sample_id, coalesce(wp.precision, 0.0) as p, coalesce(wr.recall, 0.0) as r from (select distinct sample_id from tv) i
      left join wp on wp.sample_id = i.sample_id left join wr on wr.sample_id = i.sample_id)
select sample_id, round((p - 0.1) / 0.9, 6) as precision, round((r - 0.1) / 0.9, 6) as recall,
       round((case when p + r = 0 then 0.0 else 2 * p * r / (p + r) end - 0.2) / 0.8, 6) as f1 from x""")
def q_bertscore_weighted(spark, sf):
    """Matches weighted by inverse document frequency, rescaled by a baseline;
    a token's text is its label."""
    e = read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("pos"), F.col("label").cast("string").alias("token"))
    return B.bertscore_weighted(FX.token_vectors(spark, sf).join(e, "pos"), baseline=(0.1, 0.1, 0.2))


@register("bertscore_text")
def q_bertscore_text(spark, sf):
    """BERTScore from text (question vs answer of every QA pair) with the
    pluggable encoder (deterministic hashing stand-in); rows-only check, the
    matching itself is the oracle-checked ``bertscore`` operator."""
    qa = FX.qa(spark, sf).select(FX.sample_id("conv_id", "turn").alias("sample_id"),
                                 F.col("answer").alias("prediction"), F.col("question").alias("reference"))
    return B.bertscore_from_text(qa, B.HashingEncoder(64))


# ------------------------------------------------------------------ BLEU

def bleu_pairs(spark, sf):
    b = read_table(spark, sf, "benchmark")
    t = T.unicode_tokens(F.col("text"))
    return b.select(F.col("item_id").alias("sample_id"), t.alias("ref_tokens"),
                    F.filter(t, lambda x, i: i % 5 != 4).alias("hyp_tokens"))


def _bleu_sql(max_n=4):
    grams = []
    for n in range(1, max_n + 1):
        for side, col in (("h", "hyp"), ("r", "ref")):
            grams.append(
                f"select sample_id, {n} as n, unnest(list_transform(range(1, len({col}) - {n} + 2), "
                f"lambda i: array_to_string(list_slice({col}, i, i + {n} - 1), ' '))) as g, '{side}' as s from t")
    union = "\nunion all\n".join(grams)
    return f"""
with b as (select item_id as sample_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') as ref from benchmark),
t as (select sample_id, ref, list_filter(ref, lambda x, i: i % 5 <> 0) as hyp from b),
grams as ({union}),
c as (select sample_id, n, g, count(*) filter (where s = 'h') as hc, count(*) filter (where s = 'r') as rc
      from grams group by sample_id, n, g),
pn as (select n, sum(least(hc, rc)) as clipped, sum(hc) as total from c group by n),
l as (select sum(len(hyp)) as hyp_len, sum(len(ref)) as ref_len from t),
p as (select count(*) filter (where clipped > 0) as nz, sum(case when clipped > 0 then ln(clipped / total) end) as sl from pn)
select cast(hyp_len as bigint) as hyp_len, cast(ref_len as bigint) as ref_len,
  round(case when nz < {max_n} then 0.0 else
    (case when hyp_len > ref_len then 1.0 when hyp_len = 0 then 0.0 else exp(1 - ref_len / hyp_len) end)
    * exp(sl / {max_n}) end, 6) as bleu
from l, p"""


@register("bleu", _bleu_sql(4))
def q_bleu(spark, sf):
    return BL.bleu(bleu_pairs(spark, sf), max_n=4)


def _bleu_grouped_sql(max_n=2):
    grams = []
    for n in range(1, max_n + 1):
        for side, col in (("h", "hyp"), ("r", "ref")):
            grams.append(
                f"select sample_id, {n} as n, unnest(list_transform(range(1, len({col}) - {n} + 2), "
                f"lambda i: array_to_string(list_slice({col}, i, i + {n} - 1), ' '))) as g, '{side}' as s from t")
    union = "\nunion all\n".join(grams)
    return f"""
with b as (select item_id as sample_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') as ref from benchmark),
t as (select sample_id, ref, list_filter(ref, lambda x, i: i % 5 <> 0) as hyp from b),
grams as ({union}),
c as (select sample_id, n, g, count(*) filter (where s = 'h') as hc, count(*) filter (where s = 'r') as rc
      from grams group by sample_id, n, g),
pn as (select sample_id, n, sum(least(hc, rc)) as clipped, sum(hc) as total from c group by sample_id, n),
l as (select sample_id, sum(len(hyp)) as hyp_len, sum(len(ref)) as ref_len from t group by sample_id),
p as (select sample_id, count(*) filter (where clipped > 0) as nz,
             sum(case when clipped > 0 then ln(clipped / total) end) as sl from pn group by sample_id)
select l.sample_id, cast(hyp_len as bigint) as hyp_len, cast(ref_len as bigint) as ref_len,
  round(case when coalesce(nz, 0) < {max_n} then 0.0 else
    (case when hyp_len > ref_len then 1.0 when hyp_len = 0 then 0.0 else exp(1 - ref_len / hyp_len) end)
    * exp(sl / {max_n}) end, 6) as bleu
from l left join p on l.sample_id = p.sample_id"""


@register("bleu_by_item", _bleu_grouped_sql(2))
def q_bleu_by_item(spark, sf):
    """Sentence-level BLEU-2 per benchmark item (grouped form)."""
    return BL.bleu(bleu_pairs(spark, sf), max_n=2, group_by="sample_id")


# --------------------------------------------------------- combined / report

@register("all_metrics", f"""
with {_bert_sql()}
select count(*) as num_samples,
  round(coalesce(avg({_em_sql('teacher_answer', 'reference_answer')}), 0.0), 6) as exact_match,
  round(coalesce(avg({rouge_sql('teacher_answer', 'reference_answer')}), 0.0), 6) as rouge_l,
  (select round(avg(f1), 6) from s) as bertscore_f1
from (select teacher_answer, reference_answer, {tok_sql('teacher_answer')} as teacher_answer_t,
             {tok_sql('reference_answer')} as reference_answer_t from ({S.ITEM_PREDS}) p) sub_""")
def q_all_metrics(spark, sf):
    # SQL has no stemmer; stemmed scores are checked by goldens and ``rouge_l_stemmed``
    return R.all_metrics(FX.item_preds(spark, sf), "teacher_answer", "reference_answer", stem=False,
                         bert=B.bertscore(FX.token_vectors(spark, sf)))


@register("comparison_report", f"""
with {_bert_sql()}, {_bert_sql(16, "16")},
x as (select teacher_answer, student_answer, reference_answer,
             {tok_sql('teacher_answer')} as teacher_answer_t, {tok_sql('student_answer')} as student_answer_t,
             {tok_sql('reference_answer')} as reference_answer_t from ({S.ITEM_PREDS}) p),
a as (select avg({_em_sql('teacher_answer', 'reference_answer')}) as t_em,
             avg({_em_sql('student_answer', 'reference_answer')}) as s_em,
             avg({rouge_sql('teacher_answer', 'reference_answer')}) as t_rl,
             avg({rouge_sql('student_answer', 'reference_answer')}) as s_rl,
             avg(case when lower(teacher_answer) = lower(student_answer) then 1.0 else 0.0 end) as agreement,
             count(*) as num_samples from x),
l as (select 'exact_match' as metric, t_em as teacher, s_em as student from a
      union all select 'rouge_l', t_rl, s_rl from a
      union all select 'bertscore_f1', (select round(avg(f1), 6) from s), (select round(avg(f1), 6) from s16))
select metric, round(teacher, 6) as teacher, round(student, 6) as student,
       round(student - teacher, 6) as difference,
       round(case when teacher <> 0 then student / teacher * 100.0 end, 6) as student_pct_of_teacher,
       round((select agreement from a), 6) as agreement, (select num_samples from a) as num_samples
from l""")
def q_comparison_report(spark, sf):
    bert = (B.bertscore(FX.token_vectors(spark, sf)), B.bertscore(FX.token_vectors(spark, sf, 16)))
    return R.comparison_report(FX.item_preds(spark, sf), stem=False, bert=bert)


@register("rouge_l_stemmed")
def q_rouge_l_stemmed(spark, sf):
    """Mean ROUGE-L on stemmed tokens (the default); SQL has no stemmer."""
    return RG.rouge_l(FX.item_preds(spark, sf), "student_answer", "reference_answer").select(
        "num_samples", F.round("rouge_l", 6).alias("rouge_l"))


@register("gate_pass_rate", f"""
select count(*) as num_samples, count(*) filter (where rl >= 0.7) as num_kept,
       round(count(*) filter (where rl >= 0.7) / count(*), 6) as pass_rate from (
  select {rouge_sql('student_answer', 'teacher_answer')} as rl
  from (select *, {tok_sql('student_answer')} as student_answer_t, {tok_sql('teacher_answer')} as teacher_answer_t
        from ({S.ITEM_PREDS}) p) y) x""")
def q_gate_pass_rate(spark, sf):
    s = RG.rouge_l_scores(FX.item_preds(spark, sf), "student_answer", "teacher_answer", stem=False)
    return P.gate_pass_rate(s).withColumn("pass_rate", F.round("pass_rate", 6))


@register("similarity_gate", f"""
select {_KEY}, round(rl, 6) as rouge_l from (
  select *, {rouge_sql('student_answer', 'teacher_answer')} as rl
  from (select *, {tok_sql('student_answer')} as student_answer_t, {tok_sql('teacher_answer')} as teacher_answer_t
        from ({S.ITEM_PREDS}) p) y) x
where rl >= 0.7""")
def q_similarity_gate(spark, sf):
    s = RG.rouge_l_scores(FX.item_preds(spark, sf), "student_answer", "teacher_answer", stem=False)
    return P.similarity_gate(s).select(*FX.ITEM_KEY, F.round("rouge_l", 6).alias("rouge_l"))


# ---------------------------------------------------------------- KD loss

def _lsm(arr, tmp, temp=1.0):
    x = f"list_transform({arr}, lambda v: v / {temp})" if temp != 1.0 else arr
    return x, f"(list_max({x}) + ln(list_sum(list_transform({x}, lambda v: exp(v - list_max({x}))))))"


_LOGITS_SQL = """
select t.vec_id as pos, t.label as sample_id, t.label as label,
       cast(t.embedding as double[]) as tl, cast(s.embedding as double[]) as sl
from embeddings t join embeddings s on s.vec_id = t.vec_id + 1 where t.vec_id % 5 <> 0"""


def _kl_sql(temp):
    tx, tlse = _lsm("tl", "t", temp)
    sx, slse = _lsm("sl", "s", temp)
    return (f"list_sum(list_transform({tx}, lambda v, i: exp(v - {tlse}) * ((v - {tlse}) - ({sx}[i] - {slse}))))")


@register("kd_kl_loss", f"""
select sample_id, count(*) as num_tokens, round(sum({_kl_sql(1.0)}) / count(*), 6) as kd_loss
from ({_LOGITS_SQL}) l group by sample_id""")
def q_kd_kl_loss(spark, sf):
    return KD.kd_kl_loss(FX.logits(spark, sf))


_ALIGNED_SQL = """
select t.sample_id, t.label, t.l as tl, s.l as sl from (
  select vec_id // 32 as sample_id, label, cast(embedding as double[]) as l,
         row_number() over (partition by vec_id // 32 order by vec_id) as k from embeddings where vec_id % 5 <> 0) t join (
  select vec_id // 32 as sample_id, cast(list_slice(embedding, 1, 48) as double[]) as l,
         row_number() over (partition by vec_id // 32 order by vec_id) as k from embeddings where vec_id % 3 <> 0) s
  on t.sample_id = s.sample_id and t.k = s.k"""


@register("kd_aligned", f"""
select sample_id, count(*) as num_tokens, round(sum({_kl_sql(1.0)}) / count(*), 6) as kd_loss
from (select sample_id, label, tl[1:48] as tl, sl from ({_ALIGNED_SQL}) y) l group by sample_id""")
def q_kd_aligned(spark, sf):
    """Teacher and student of different prompts, answer lengths and
    vocabularies: answer tokens are paired in order, both cut to the shorter."""
    e = read_table(spark, sf, "embeddings").select(F.expr("vec_id div 32").alias("sample_id"), F.col("vec_id").alias("pos"), "label", "embedding")

    def side(prompt, logits, name):
        return e.select("sample_id", "pos", F.when(prompt, -100).otherwise(F.col("label")).alias("label"), logits.alias(name))
    teacher = side(F.col("pos") % 5 == 0, F.col("embedding"), "teacher_logits")
    student = side(F.col("pos") % 3 == 0, F.slice("embedding", 1, 48), "student_logits")
    return KD.kd_kl_loss(KD.align_logits(teacher, student))


def _combined_sql(temp=4.0, alpha=0.5):
    sx, slse = _lsm("sl", "s", 1.0)
    ce = f"(-(sl[label + 1] - {slse}))"
    kd = _kl_sql(temp)
    return f"""
select count(*) as num_tokens, round(sum({kd}) / count(*), 6) as kd_term, round(sum({ce}) / count(*), 6) as ce_term,
       round(sum({alpha} * {kd} + {1 - alpha} * {ce}) / count(*), 6) as loss
from ({_LOGITS_SQL}) l"""


@register("kd_combined_loss", _combined_sql())
def q_kd_combined_loss(spark, sf):
    return KD.kd_combined_loss(FX.logits(spark, sf), temperature=4.0, alpha=0.5)
