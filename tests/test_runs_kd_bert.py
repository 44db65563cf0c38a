"""Run analytics, KD losses and tiled BERTScore against brute force."""

import math

import numpy as np
import pytest

from vqaspark.operators import runs as RU
from vqaspark.operators.metrics import bert as B
from vqaspark.operators.metrics import kd as KD
from vqaspark.operators.metrics import report as R


def test_latest_checkpoint_is_numeric(spark):
    df = spark.createDataFrame([(1, "checkpoint-9"), (1, "checkpoint-10"), (1, "other"), (2, "checkpoint-3")],
                               "run_id long, name string")
    out = {r["run_id"]: r["latest_checkpoint"] for r in RU.latest_checkpoint(df).collect()}
    assert out == {1: "checkpoint-10", 2: "checkpoint-3"}
    keep = RU.checkpoint_retention(df, keep=2).where("run_id = 1").orderBy("rank").collect()
    assert [r["name"] for r in keep] == ["checkpoint-10", "checkpoint-9"]


def test_best_eval_step_first_on_ties(spark):
    df = spark.createDataFrame([(1, 10, 1.0, 0.5), (1, 20, 1.0, 0.5), (1, 30, 1.0, 0.7), (1, 40, 1.0, None)],
                               "run_id long, step long, loss double, eval_loss double")
    r = RU.best_eval_step(df).first()
    assert (r["best_step"], r["best_eval_loss"], r["num_evals"]) == (10, 0.5, 3)
    last = RU.last_log(df.withColumn("epoch", df.step / 10)).first()
    assert last["step"] == 40 and last["eval_loss"] is None


def _np_kl(t, s, T=1.0):
    def lsm(x):
        x = np.asarray(x, dtype=float) / T
        m = x.max()
        return x - (m + math.log(np.exp(x - m).sum()))
    lt, ls = lsm(t), lsm(s)
    return float((np.exp(lt) * (lt - ls)).sum())


def test_kd_losses_match_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [(i % 2, i, int(rng.integers(0, 5)), rng.normal(size=5).tolist(), rng.normal(size=6).tolist())
            for i in range(12)]
    df = spark.createDataFrame(rows, "sample_id long, pos long, label int, teacher_logits array<double>, "
                                     "student_logits array<double>")
    got = {r["sample_id"]: r["kd_loss"] for r in KD.kd_kl_loss(df, digits=None).collect()}
    for sid in (0, 1):
        sel = [r for r in rows if r[0] == sid]
        exp = sum(_np_kl(r[3], r[4][:5]) for r in sel) / len(sel)
        assert got[sid] == pytest.approx(exp, rel=1e-9)
    comb = KD.kd_combined_loss(df, temperature=4.0, alpha=0.5, digits=None).first()
    kd = np.mean([_np_kl(r[3], r[4][:5], 4.0) for r in rows])
    ce = np.mean([-(np.asarray(r[4][:5]) - (max(r[4][:5]) + math.log(np.exp(np.asarray(r[4][:5]) - max(r[4][:5])).sum())))[r[2]]
                  for r in rows])
    assert comb["loss"] == pytest.approx(0.5 * kd + 0.5 * ce, rel=1e-9)
    masked = df.withColumn("label", df.label * 0 - 100)
    assert KD.kd_kl_loss(masked).count() == 0


def test_bertscore_tiles_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for sid in range(3):
        for pos in range(int(rng.integers(5, 40))):
            rows.append((sid, "pred" if pos % 3 else "ref", pos, rng.normal(size=8).tolist()))
    df = spark.createDataFrame(rows, "sample_id long, side string, pos long, vector array<double>")
    for block in (4, 1000):
        got = {r["sample_id"]: r for r in B.bertscore_samples(df, block=block, digits=None).collect()}
        for sid in range(3):
            p = np.array([r[3] for r in rows if r[0] == sid and r[1] == "pred"])
            q = np.array([r[3] for r in rows if r[0] == sid and r[1] == "ref"])
            p /= np.linalg.norm(p, axis=1, keepdims=True)
            q /= np.linalg.norm(q, axis=1, keepdims=True)
            sim = p @ q.T
            P, R = sim.max(axis=1).mean(), sim.max(axis=0).mean()
            assert got[sid]["precision"] == pytest.approx(P, abs=1e-12)
            assert got[sid]["recall"] == pytest.approx(R, abs=1e-12)
            assert got[sid]["f1"] == pytest.approx(2 * P * R / (P + R), abs=1e-12)


def test_bertscore_from_text_with_encoder(spark):
    from vqaspark.operators.metrics import report as R
    df = spark.createDataFrame([(1, "hai con mèo", "hai con mèo"), (2, "một cái ghế", "ba chú chó")],
                               "sample_id long, prediction string, reference string")
    vec = B.text_token_vectors(df, B.HashingEncoder(32))
    assert vec.count() == 12
    s = {r["sample_id"]: r["f1"] for r in B.bertscore_samples(vec).collect()}
    assert s[1] == pytest.approx(1.0) and s[2] < 0.9
    m = R.all_metrics(df, bert=B.bertscore(vec)).first()
    assert m["exact_match"] == 0.5 and m["bertscore_f1"] == pytest.approx((1.0 + s[2]) / 2, abs=1e-6)


def test_bertscore_encodes_bounded_bytes_of_text_at_once(spark, monkeypatch):
    import pyarrow as pa
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[i % 7:i % 7 + i % 30]) or None for i in range(200)]
    b = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts), pa.array(texts[::-1])], names=["i", "p", "r"])
    monkeypatch.setattr(B, "TEXT_BYTES", 300)
    cut = list(B._text_slices([b, b.slice(0, 0)], [1, 2]))
    assert pa.Table.from_batches(cut).equals(pa.Table.from_batches([b])) and len(cut) > 20
    assert all(c.num_rows == 1 or sum(len(t or "") for t in c["p"].to_pylist() + c["r"].to_pylist()) <= 300 for c in cut)
    # tiles of a similarity matrix in both directions give its maxima
    p, r = (np.random.default_rng(i).normal(size=(n, 8)) for i, n in ((1, 23), (2, 17)))
    assert B._greedy_prf(p, r, 5) == pytest.approx(B._greedy_prf(p, r, 100), abs=1e-12)


def test_bertscore_from_text_equals_token_table_path(spark):
    df = spark.createDataFrame([(1, "hai con mèo đen", "hai con mèo"), (2, "một cái ghế", "ba chú chó nhỏ"),
                                (3, "", "x")], "sample_id long, prediction string, reference string")
    a = {r["sample_id"]: (r["precision"], r["recall"], r["f1"])
         for r in B.bertscore_from_text(df, B.HashingEncoder(16), chunk=2).collect()}
    vec = B.text_token_vectors(df, B.HashingEncoder(16))
    b = {r["sample_id"]: (r["precision"], r["recall"], r["f1"]) for r in B.bertscore_samples(vec).collect()}
    assert a[3] == b[3] == (0.0, 0.0, 0.0)
    for k in (1, 2):
        assert a[k] == pytest.approx(b[k], abs=2e-6)


def test_bertscore_one_sided_samples_string_ids_and_groups(spark):
    rows = [("a", "pred", 0, [1.0, 0.0], "x"), ("a", "ref", 0, [1.0, 0.0], "x"), ("b", "pred", 0, [1.0, 0.0], "x"),
            ("c", "ref", 0, [0.0, 1.0], "y"), ("c", "pred", 0, [0.0, 2.0], "y")]
    vec = spark.createDataFrame(rows, "sample_id string, side string, pos long, vector array<double>, grp string")
    assert {r["sample_id"]: r["f1"] for r in B.bertscore_samples(vec).collect()} == {"a": 1.0, "b": 0.0, "c": 1.0}
    r = B.bertscore(vec).first()
    assert (r["num_samples"], r["bertscore_f1"]) == (3, 0.666667)
    by = {r["grp"]: r["bertscore_f1"] for r in B.bertscore(vec, group_by="grp").collect()}
    assert by == {"x": 0.5, "y": 1.0}
    df = spark.createDataFrame([("u", "u", "x"), ("v", "w", "y")], "prediction string, reference string, grp string")
    m = {r["grp"]: r["bertscore_f1"] for r in R.all_metrics(df, group_by="grp", bert=B.bertscore(vec, group_by="grp")).collect()}
    assert m == by
    assert R.evaluate(df, "exact_match").first()["exact_match"] == 0.5
    assert R.evaluate(df, "bertscore_f1", vectors=vec, group_by="grp").count() == 2
    assert R.evaluate(df, "rouge_l", group_by="grp").count() == 2
    with pytest.raises(ValueError):
        R.evaluate(df, "no such metric")


def test_logits_of_different_lengths_are_aligned(spark, monkeypatch):
    import math

    from vqaspark.operators.metrics import kd as KD
    monkeypatch.setattr(KD, "TOKEN_RANGE", 3)
    schema = "sample_id string, pos long, label int, {} array<double>"
    t = [("a", p, -100 if p < 2 else p % 2, [float(p), 1.0, 0.5]) for p in range(12)] + [("b", 0, 1, [1.0, 2.0, 3.0]), (None, 0, 1, [1.0]), ("c", 1, None, [1.0])]
    s = [("a", p * 7, -100 if p == 5 else 0, [0.1 * p, 1.0]) for p in range(9)] + [("b", 4, -100, [1.0, 1.0]), ("d", 0, 0, [1.0])]
    out = KD.align_logits(spark.createDataFrame(t, schema.format("teacher_logits")), spark.createDataFrame(s, schema.format("student_logits")))
    got = {r.token: (r.label, r.teacher_logits, r.student_logits) for r in out.collect()}
    mine, other = [x for x in t if x[0] == "a" and x[2] != -100], [x for x in s if x[0] == "a" and x[2] != -100]
    assert got == {k: (x[2], x[3], y[3]) for k, (x, y) in enumerate(zip(mine, other))} and len(got) == 8

    def softmax(v):
        e = [math.exp(x) for x in v]
        return [x / sum(e) for x in e]
    want = sum(sum(p * math.log(p / q) for p, q in zip(softmax(a[:2]), softmax(b))) for _, a, b in got.values()) / 8
    assert abs(KD.kd_kl_loss(out, digits=None).first()["kd_loss"] - want) < 1e-9
