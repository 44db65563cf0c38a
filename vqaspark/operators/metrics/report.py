"""Score once, aggregate once (A7); one metric by name (A11); teacher/student
report (A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vqaspark.operators.metrics.exact import agree_flag, check_metric, em_flag, exact_match
from vqaspark.operators.metrics.rouge import rouge_f1_udf, rouge_l, rouge_l_scores, rouge_tokens


def all_metrics(df: DataFrame, pred: str = "prediction", ref: str = "reference", group_by=None,
                tokenizer: str = "ascii", stem: bool = True, bert: DataFrame | None = None) -> DataFrame:
    """Exact match and ROUGE-L from one scoring stage and one aggregate.
    BERTScore needs token vectors; pass ``bert`` (output of
    ``bertscore``) to attach its F1, otherwise the column is NULL."""
    s = rouge_l_scores(df.withColumn("_em", em_flag(pred, ref)), pred, ref, "_rl", tokenizer, stem)
    g = s.groupBy() if group_by is None else s.groupBy(group_by)
    out = g.agg(F.count(F.lit(1)).alias("num_samples"),
                F.round(F.coalesce(F.avg("_em"), F.lit(0.0)), 6).alias("exact_match"),
                F.round(F.coalesce(F.avg("_rl"), F.lit(0.0)), 6).alias("rouge_l"))
    if bert is None:
        return out.withColumn("bertscore_f1", F.lit(None).cast("double"))
    if group_by is None:
        # two one-row aggregates side by side: union + max, no join
        both = out.withColumn("bertscore_f1", F.lit(None).cast("double")).unionByName(
            bert.select("bertscore_f1").withColumn("num_samples", F.lit(None).cast("bigint"))
                .withColumn("exact_match", F.lit(None).cast("double"))
                .withColumn("rouge_l", F.lit(None).cast("double")))
        return both.agg(*[F.max(c).alias(c) for c in ("num_samples", "exact_match", "rouge_l", "bertscore_f1")])
    return out.join(bert.select(group_by, "bertscore_f1"), group_by, "left")


def evaluate(df: DataFrame, metric: str, pred: str = "prediction", ref: str = "reference", group_by=None,
             vectors: DataFrame | None = None, **kw) -> DataFrame:
    """One metric by name; an unknown name fails before any job.
    ``bertscore_f1`` is computed from token ``vectors``."""
    check_metric(metric)
    if metric == "exact_match":
        return exact_match(df, pred, ref, group_by)
    if metric == "rouge_l":
        return rouge_l(df, pred, ref, group_by, **kw)
    if metric == "partial_match":
        from vqaspark.operators.metrics.partial import partial_match
        return partial_match(df, pred, ref, **kw)
    if vectors is None:
        raise ValueError("bertscore_f1 needs token vectors")
    from vqaspark.operators.metrics.bert import bertscore
    return bertscore(vectors, group_by=group_by, **kw)


def comparison_report(df: DataFrame, teacher: str = "teacher_answer", student: str = "student_answer",
                      ref: str = "reference_answer", tokenizer: str = "ascii", stem: bool = True,
                      bert: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """A10: one row per metric -- teacher, student, difference, student as a
    percentage of teacher -- with the models' agreement and the sample count.

    One pass: the reference is tokenised once and every row is scored for both
    models, then one aggregate.  ``bert`` = (teacher, student) outputs of
    ``bertscore`` adds the third metric."""
    rt = rouge_tokens(ref, tokenizer, stem)
    rows = df.select(em_flag(teacher, ref).alias("_tem"), em_flag(student, ref).alias("_sem"),
                     F.when(agree_flag(teacher, student), 1.0).otherwise(0.0).alias("_agree"),
                     rt.alias("_rt"), rouge_tokens(teacher, tokenizer, stem).alias("_tt"),
                     rouge_tokens(student, tokenizer, stem).alias("_st"))
    one = rows.select("_tem", "_sem", "_agree", rouge_f1_udf("_tt", "_rt").alias("_trl"), rouge_f1_udf("_st", "_rt").alias("_srl"))
    wide = one.agg(F.count(F.lit(1)).alias("num_samples"), F.avg("_agree").alias("agreement"),
                   *[F.avg(c).alias(c) for c in ("_tem", "_sem", "_trl", "_srl")])
    rep = wide.selectExpr("num_samples", "agreement", "stack(2, 'exact_match', _tem, _sem, "
                          "'rouge_l', _trl, _srl) as (metric, teacher, student)")
    if bert is not None:
        names = ["num_samples", "agreement", "teacher", "student"]
        none = [F.lit(None).cast(t).alias(n) for n, t in zip(names, ("bigint", "double", "double", "double"))]
        sides = [b.select(*[F.col("bertscore_f1").alias(n) if n == side else c for n, c in zip(names, none)])
                 for side, b in zip(("teacher", "student"), bert)]
        parts = wide.select("num_samples", "agreement", *none[2:]).unionByName(sides[0]).unionByName(sides[1])
        third = parts.agg(*[F.max(n).alias(n) for n in names]).select(
            "num_samples", "agreement", F.lit("bertscore_f1").alias("metric"), "teacher", "student")
        rep = rep.unionByName(third)
    return rep.select(
        "metric", F.round("teacher", 6).alias("teacher"), F.round("student", 6).alias("student"),
        F.round(F.col("student") - F.col("teacher"), 6).alias("difference"),
        F.round(F.when(F.col("teacher") != 0, F.col("student") / F.col("teacher") * 100.0), 6)
         .alias("student_pct_of_teacher"),
        F.round("agreement", 6).alias("agreement"), "num_samples")
