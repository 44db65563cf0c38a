"""Sampling, positional index, joins and prediction."""

import pytest
from pyspark.sql import functions as F

from vqaspark.operators import joins as J
from vqaspark.operators import predict as PR
from vqaspark.operators import sampling as O
from vqaspark.operators.models import FirstWordsModel
from vqaspark.operators.prepare import resolve_max_samples
from vqaspark.plans import fixtures as FX

SF01 = "/root/testdata/sf0.01"


def test_with_index_matches_sorted_order_and_is_layout_invariant(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("id"), F.col("id").alias("v"))
    expect = sorted(r["id"] for r in df.collect())
    for n in (1, 7, 64):
        got = O.with_index(df.repartition(n), "id", num_partitions=n).select("id", "index").collect()
        assert sorted((r["index"], r["id"]) for r in got) == list(enumerate(expect))


def test_get_sample_and_batches(spark):
    s = FX.vqa_samples(spark, SF01)
    ids = sorted(r["id"] for r in s.select("id").collect())
    assert O.get_sample(s, 7).first()["id"] == ids[7]
    b = O.assign_batches(s, 32).select("id", "batch_id", "batch_pos").collect()
    assert len(b) == len(ids)  # nothing dropped
    by_id = {r["id"]: (r["batch_id"], r["batch_pos"]) for r in b}
    assert [by_id[i] for i in ids[:34]] == [(k // 32, k % 32) for k in range(34)]


def test_hash_split_stable_when_rows_added(spark):
    small = O.hash_split(spark.range(0, 500), "id")
    big = O.hash_split(spark.range(0, 5000), "id")
    a = {r["id"]: r["split"] for r in small.collect()}
    b = {r["id"]: r["split"] for r in big.where("id < 500").collect()}
    assert a == b
    counts = {r["split"]: r["count"] for r in big.groupBy("split").count().collect()}
    assert 0.75 < counts["train"] / 5000 < 0.85
    with pytest.raises(ValueError):
        O.hash_split(spark.range(3), "id", fractions=(0.5, 0.6), names=("a", "b"))


def test_sample_n_is_seeded_and_layout_free(spark):
    df = spark.range(0, 300)
    a = [r["id"] for r in O.sample_n(df, 10).collect()]
    b = [r["id"] for r in O.sample_n(df.repartition(13), 10).collect()]
    c = [r["id"] for r in O.sample_n(df, 10, seed=7).collect()]
    assert a == b and a != c and len(a) == 10
    assert O.sample_n(df, 0).count() == 0


def test_max_samples_rule():
    assert resolve_max_samples(None) is None
    assert resolve_max_samples(0) is None
    assert resolve_max_samples(5) == 5


def test_image_path_format_keeps_long_ids(spark):
    s = spark.createDataFrame([(1, 7), (2, 1234567890123)], "id long, image_id long")
    lk = spark.createDataFrame([(7, "seven.jpg")], "image_id long, filename string")
    out = {r["id"]: r["image_path"] for r in J.attach_image_paths(s, lk, "imgs/").collect()}
    assert out == {1: "imgs/seven.jpg", 2: "imgs/1234567890123.jpg"}
    s2 = spark.createDataFrame([(3, 42)], "id long, image_id long")
    assert J.attach_image_paths(s2, lk, "imgs").first()["image_path"] == "imgs/000000000042.jpg"


def test_align_predictions_checks_key_sets(spark):
    p = spark.createDataFrame([(1, "a"), (2, "b")], "sample_id long, prediction string")
    r = spark.createDataFrame([(1, "a")], "sample_id long, reference string")
    with pytest.raises(ValueError):
        J.align_predictions(p, r, "sample_id")
    assert J.align_predictions(p, r, "sample_id", check=False).count() == 1


def test_compare_models_full_outer_exposes_holes(spark):
    t = spark.createDataFrame([(1, "A"), (2, "b")], "sample_id long, teacher_answer string")
    s = spark.createDataFrame([(1, "a"), (3, "c")], "sample_id long, student_answer string")
    assert J.compare_models(t, s, "sample_id").count() == 1
    full = J.compare_models(t, s, "sample_id", how="full_outer").collect()
    assert len(full) == 3
    assert {r["sample_id"]: r["match"] for r in full} == {1: True, 2: False, 3: False}


def test_registry_join_is_broadcast(spark):
    df = spark.createDataFrame([("7B-trained", "x")], "model_id string, answer string")
    j = J.model_registry_join(df, J.model_registry(spark))
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
    assert j.first()["params"] == "7B"


def test_predict_isolates_row_errors(spark):
    df = spark.createDataFrame([(i, "p", "w" * (13 if i % 3 == 0 else 5) + " two three four")
                                for i in range(30)], "id long, image_path string, question string")
    out = PR.predict(df, FirstWordsModel(2, fail_modulo=13), batch_size=8).collect()
    assert len(out) == 30  # no row lost
    bad = sorted(r["id"] for r in out if r["error"] is not None)
    assert bad == [i for i in range(30) if len("w" * (13 if i % 3 == 0 else 5) + " two three four") % 13 == 0]
    good = [r for r in out if r["error"] is None]
    assert all(r["predicted_answer"] == " ".join(r["question"].split()[:2]) for r in good)


def test_predict_keeps_ids_and_messages(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big, "p", "one two three"), (None, "p", "four five six")],
                               "id long, image_path string, question string").coalesce(1)
    assert {r["id"] for r in PR.predict(df, FirstWordsModel(2)).collect()} == {big, None}
    out = PR.predict_pair(df, FirstWordsModel(2, fail_modulo=13), FirstWordsModel(1)).collect()
    assert {r["id"] for r in out} == {big, None}
    bad = [r for r in out if r["teacher_error"]]
    assert [r["teacher_error"] for r in bad] == ["ValueError: model failed on input"] * 2
    assert all(r["student_error"] is None and not r["match"] for r in out)
    assert PR.pair_dead_letter(df, FirstWordsModel(2, fail_modulo=13), FirstWordsModel(1)).count() == 2
    from vqaspark.operators.udf import map_batches, map_rows
    assert {r["id"] for r in map_batches(df, lambda p: p, "id long, question string").collect()} == {big, None}
    assert {r["id"] for r in map_rows(df, lambda r: {"id": r["id"]}, __import__("pyspark").sql.types.StructType.fromDDL("id long")).collect()} == {big, None}


def test_split_fractions_of_any_fineness(spark):
    from vqaspark.operators.sampling import hash_split
    n = {r["split"]: r["count"] for r in hash_split(spark.range(40_000), fractions=(0.995, 0.0025, 0.0025)).groupBy("split").count().collect()}
    assert 60 < n["dev"] < 140 and 60 < n["test"] < 140


def test_predict_filter_runs_before_model(spark):
    df = spark.createDataFrame([(1, "p", ""), (2, "p", "q a b")], "id long, image_path string, question string")
    from vqaspark.operators.prepare import valid_requests
    out = PR.predict_ok(valid_requests(df), FirstWordsModel(1))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the validity filter sits below the Python stage
    assert plan.index("ArrowEvalPython") < plan.rindex("Filter")
    assert [r["predicted_answer"] for r in out.collect()] == ["q"]


def test_no_unpartitioned_window_in_index(spark):
    df = spark.range(0, 50)
    plan = O.with_index(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_map_batches_and_single_predict(spark):
    from pyspark.sql import types as T

    from vqaspark.operators.udf import map_batches, map_rows, predict_single
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "id long, question string")
    out = map_batches(df, lambda p: p.assign(n=p["question"].str.len()), "id long, question string, n long")
    assert sorted((r["id"], r["n"]) for r in out.collect()) == [(1, 3), (2, 1)]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("upper", T.StringType())])
    rows = map_rows(df, lambda r: {"id": r["id"], "upper": r["question"].upper()}, schema).collect()
    assert sorted((r["id"], r["upper"]) for r in rows) == [(1, "A B"), (2, "C")]
    assert predict_single(spark, FirstWordsModel(1), "x.jpg", "hello world") == "hello"


def test_qa_pairs_join_equals_window(spark):
    from pyspark.sql import Window

    from vqaspark.operators.prepare import qa_pairs
    from vqaspark.sources.tables import read_table
    conv = read_table(spark, SF01, "conversations")
    a = sorted(map(tuple, qa_pairs(conv).collect()))
    w = Window.partitionBy("conv_id").orderBy("turn")
    following = conv.select("conv_id", "turn", "role", F.col("text").alias("question"), F.lead("role").over(w).alias("n"),
                            F.lead("text").over(w).alias("answer")).where("role = 'user' and n = 'assistant'")
    b = sorted(map(tuple, following.select("conv_id", "turn", "question", "answer").collect()))
    assert a == b and len(a) == 233
    # gaps, repeats and dense conversations side by side
    rows = [(1, t, r, f"{t}{r}") for t, r in [(0, "user"), (2, "assistant"), (5, "user"), (9, "assistant")]]
    rows += [(2, t, r, f"{t}{r}") for t, r in [(1, "user"), (1, "system"), (3, "assistant")]]
    rows += [(3, t, r, f"{t}{r}") for t, r in [(0, "user"), (1, "assistant"), (2, "user")]] + [(None, 0, "user", "x"), (4, None, "user", "x")]
    odd = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, qa_pairs(odd).collect()))
    assert [r for r in got if r[0] != 2] == [(1, 0, "0user", "2assistant"), (1, 5, "5user", "9assistant"), (3, 0, "0user", "1assistant")]


def test_retention_limits_before_shuffle(spark):
    from vqaspark.operators.runs import checkpoint_retention
    df = spark.createDataFrame([(r, f"checkpoint-{s}") for r in range(3) for s in range(50)],
                               "run_id long, name string")
    out = checkpoint_retention(df, keep=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.count() == 6


def test_first_n_large_path_equals_topk(spark):
    df = O.with_shuffle_key(spark.range(0, 2000), "id")
    small = [r["id"] for r in O.first_n(df, 150, ["shuffle_key", "id"]).collect()]
    large = O.first_n(df, 150, ["shuffle_key", "id"], distributed=True)
    assert "TakeOrdered" not in large._jdf.queryExecution().executedPlan().toString()
    assert sorted(small) == sorted(r["id"] for r in large.collect())


def test_align_predictions_rejects_duplicate_keys(spark):
    p = spark.createDataFrame([(1, "a"), (1, "b")], "sample_id long, prediction string")
    r = spark.createDataFrame([(1, "a")], "sample_id long, reference string")
    with pytest.raises(ValueError):
        J.align_predictions(p, r, "sample_id")


def test_predict_split_runs_model_once_and_routes(spark, tmp_path):
    df = spark.createDataFrame([(i, "p", "x" * (13 if i % 4 == 0 else 3) + " y") for i in range(20)],
                               "id long, image_path string, question string")
    ok, dead = PR.predict_split(df, FirstWordsModel(1, fail_modulo=13), str(tmp_path / "pred"))
    n_bad = sum(1 for i in range(20) if len("x" * (13 if i % 4 == 0 else 3) + " y") % 13 == 0)
    assert dead.count() == n_bad and ok.count() == 20 - n_bad


def test_predict_from_requests_file(spark, tmp_path):
    import json
    p = tmp_path / "req.json"
    p.write_text(json.dumps({"annotations": [
        {"image_id": 1, "image_path": "a.jpg", "question": "what color", "answer": "red"},
        {"image_id": 2, "image_path": "", "question": "skipped"},
        {"image_id": 3, "image_path": "c.jpg", "question": "how many"}]}))
    out = PR.predict_from_requests(spark, str(p), FirstWordsModel(1)).orderBy("image_id").collect()
    assert [(r["image_id"], r["predicted_answer"], r["reference_answer"]) for r in out] == \
        [(1, "what", "red"), (3, "how", None)]
    assert PR.predict_from_requests(spark, str(p), FirstWordsModel(1), limit=1).count() == 1


def test_align_predictions_lazy_check(spark):
    p = spark.createDataFrame([(1, "a"), (2, "b")], "sample_id long, prediction string")
    r = spark.createDataFrame([(1, "a"), (2, "c")], "sample_id long, reference string")
    good = J.align_predictions(p, r, "sample_id", check="lazy")
    plan = good._jdf.queryExecution().executedPlan().toString()  # before execution: initial plan only
    assert plan.count("Exchange hashpartitioning") == 2  # one per side, none for the join
    assert sorted(map(tuple, good.collect())) == [(1, "a", "a"), (2, "b", "c")]
    bad = J.align_predictions(p, r.where("sample_id = 1"), "sample_id", check="lazy")
    with pytest.raises(Exception, match="one row per key"):
        bad.collect()
    dup = J.align_predictions(p.unionByName(p), r, "sample_id", check="lazy")
    with pytest.raises(Exception, match="one row per key"):
        dup.collect()


def test_get_sample_small_and_large_paths_agree(spark):
    df = spark.range(0, 500).select((F.col("id") * 37 % 500).alias("id"), F.col("id").alias("v"))
    for k in (0, 7, 499):
        small = O.get_sample(df, k).collect()
        large = O.get_sample(df, k, distributed=True).collect()
        assert len(small) == 1 and small[0]["id"] == k and sorted(small[0].asDict().items()) == \
            sorted(large[0].asDict().items())
    assert O.get_sample(df, 500).count() == 0
    assert O.get_sample(df, 500, distributed=True).count() == 0
