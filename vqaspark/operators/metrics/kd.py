"""Distillation losses over token logits.

One row per answer token with teacher and student logit arrays.  Softmax
work is linear per row and stays in native higher-order functions; the row
maximum is subtracted before ``exp`` for stability.  Losses are "batchmean":
summed over tokens, divided by the number of tokens of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def log_sum_exp(arr: Column, temperature: float = 1.0) -> Column:
    """log(sum(exp(x / T))) with the row maximum subtracted, in one pass.

    Per-row scalars (the maximum) ride in the fold's initial state, which is
    evaluated once per row; an expression referenced inside a lambda would be
    re-evaluated for every element once the optimizer inlines it."""
    t = float(temperature)
    init = F.struct(F.array_max(arr).alias("m"), F.lit(0.0).alias("s"))
    return F.aggregate(
        arr, init,
        lambda st, v: F.struct(st["m"].alias("m"), (st["s"] + F.exp((v - st["m"]) / t)).alias("s")),
        lambda st: st["m"] / t + F.log(st["s"]))


def kl_token(t: Column, s: Column, temperature: float = 1.0) -> Column:
    """KL(softmax(t/T) || softmax(s/T)) for one token, O(vocab)."""
    tt = float(temperature)
    init = F.struct(log_sum_exp(t, tt).alias("lt"), log_sum_exp(s, tt).alias("ls"), F.lit(0.0).alias("acc"))
    pairs = F.zip_with(t, s, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def step(st, e):
        lpt = e["a"] / tt - st["lt"]
        lps = e["b"] / tt - st["ls"]
        return F.struct(st["lt"].alias("lt"), st["ls"].alias("ls"),
                        (st["acc"] + F.exp(lpt) * (lpt - lps)).alias("acc"))
    return F.aggregate(pairs, init, step, lambda st: st["acc"])


def _prepare(df: DataFrame, teacher: str, student: str, label: str | None, mask_value: int) -> DataFrame:
    t = F.col(teacher).cast("array<double>")
    s = F.col(student).cast("array<double>")
    k = F.least(F.size(t), F.size(s))  # vocab cut to the smaller one
    out = df.withColumn("_t", F.slice(t, 1, k)).withColumn("_s", F.slice(s, 1, k))
    if label is not None:
        out = out.where(F.col(label) != mask_value)
    return out


TOKEN_RANGE = 4096


def _numbered(df: DataFrame, sample: str, pos: str, keep: dict, label: str, mask_value: int) -> DataFrame:
    """Answer tokens numbered from 0 in each sample by ``pos``.  Positions are
    cut into ranges, each numbered by itself, and ranges get the counts of
    those before them, so that a sample of any length spreads over tasks."""
    rows = (df.where(F.col(label) != mask_value)
            .select(F.col(sample).alias("sample_id"), F.col(pos).alias("_pos"), F.floor(F.col(pos) / F.lit(TOKEN_RANGE)).alias("_r"),
                    *[F.col(c).alias(n) for c, n in keep.items()]))
    before = Window.partitionBy("sample_id").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy("sample_id", "_r").agg(F.count(F.lit(1)).alias("_n"))
             .select("sample_id", "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    k = F.row_number().over(Window.partitionBy("sample_id", "_r").orderBy("_pos")) - 1
    return rows.withColumn("_k", k).join(first, ["sample_id", "_r"]).select("sample_id", (F.col("_first") + F.col("_k")).alias("token"), *keep.values())


def align_logits(teacher: DataFrame, student: DataFrame, sample_col: str = "sample_id", pos_col: str = "pos", label_col: str = "label",
                 teacher_col: str = "teacher_logits", student_col: str = "student_logits", mask_value: int = -100) -> DataFrame:
    """Pair the answer tokens (label not masked, nor null) of teacher and
    student, which may have prompts and answers of different lengths: the k-th
    with the k-th of a sample, both cut to the shorter.  Gives ``sample_id``,
    ``token`` (k, from 0), ``label`` (the teacher's), ``teacher_logits`` and
    ``student_logits`` for the losses, which cut the vocabularies.  Positions
    must be unique in a sample of each side."""
    t = _numbered(teacher, sample_col, pos_col, {label_col: "label", teacher_col: "teacher_logits"}, label_col, mask_value)
    s = _numbered(student, sample_col, pos_col, {student_col: "student_logits"}, label_col, mask_value)
    return t.join(s, ["sample_id", "token"])


def kd_kl_loss(df: DataFrame, teacher: str = "teacher_logits", student: str = "student_logits",
               group_by="sample_id", label: str | None = "label", mask_value: int = -100,
               temperature: float = 1.0, digits: int | None = 6) -> DataFrame:
    """KL(teacher || student) batchmean per group, over unmasked tokens."""
    p = _prepare(df, teacher, student, label, mask_value)
    p = p.withColumn("_kl", kl_token(F.col("_t"), F.col("_s"), temperature))
    g = p.groupBy() if group_by is None else p.groupBy(group_by)
    loss = F.sum("_kl") / F.count(F.lit(1))
    return g.agg(F.count(F.lit(1)).alias("num_tokens"),
                 (F.round(loss, digits) if digits is not None else loss).alias("kd_loss"))


def kd_combined_loss(df: DataFrame, teacher: str = "teacher_logits", student: str = "student_logits",
                     label: str = "label", group_by=None, temperature: float = 4.0, alpha: float = 0.5,
                     scale_t2: bool = False, mask_value: int = -100, digits: int | None = 6) -> DataFrame:
    """``alpha * KD_T + (1 - alpha) * CE`` per token, batchmean.

    KD_T is the KL between teacher and student softmaxes at temperature T
    (times T^2 when ``scale_t2``); CE is the student's cross-entropy of the
    label index at T = 1."""
    p = _prepare(df, teacher, student, label, mask_value)
    kd = kl_token(F.col("_t"), F.col("_s"), temperature)
    if scale_t2:
        kd = kd * F.lit(float(temperature) ** 2)
    p = (p.withColumn("_kd", kd)
          .withColumn("_ce", log_sum_exp(F.col("_s")) - F.element_at(F.col("_s"), F.col(label).cast("int") + 1)))
    p = p.withColumn("_tok", F.lit(float(alpha)) * F.col("_kd") + F.lit(1.0 - float(alpha)) * F.col("_ce"))
    g = p.groupBy() if group_by is None else p.groupBy(group_by)
    n = F.count(F.lit(1))

    def r(c):
        return F.round(c, digits) if digits is not None else c
    return g.agg(n.alias("num_tokens"), r(F.sum("_kd") / n).alias("kd_term"),
                 r(F.sum("_ce") / n).alias("ce_term"), r(F.sum("_tok") / n).alias("loss"))
