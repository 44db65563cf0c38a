"""Tokenizer stage, append-once history, BERTScore ids of any type."""

import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vqaspark.operators import prepare as P
from vqaspark.operators.metrics import bert as B
from vqaspark.operators.tokenize import FileTokenizer, tokenize
from vqaspark.plans.registry import QUERIES, load_all
from vqaspark.sources import files as FI

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(FILE)


def test_ids_and_offsets(spark):
    texts = ["Hello world", "", None, "日本語 é", "a" * 300, "x"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "row long, text string, tok string")
    rows = {r["row"]: r for r in tokenize(df, "text", FileTokenizer(FILE), texts_at_once=2).collect()}
    for i, t in enumerate(texts):
        e = LIB.encode(t or "", add_special_tokens=False)
        assert rows[i].tokens.ids == e.ids and list(zip(rows[i].tokens.starts, rows[i].tokens.ends)) == e.offsets
        assert rows[i].tokens.n_prefix == 0 and rows[i].tok == "clash"


def test_prompt_mask_ends_by_offset(spark):
    df = spark.createDataFrame([(1, "Why?", "\n\n"), (2, "Why?", "Because"), (3, "Why?", None), (4, "", "")],
                               "id long, question string, teacher_answer string")
    rows = {r.id: r for r in P.distill_examples(df, max_length=60, tokenizer=FileTokenizer(FILE)).collect()}
    prompt = rows[3].full_text
    for i, answer in ((1, "\n\n"), (2, "Because"), (3, "")):
        e = LIB.encode(prompt + answer, add_special_tokens=False)
        n = sum(a < len(prompt) for a, _ in e.offsets)
        assert rows[i].prompt_len == n and len(rows[i].input_ids) == max(60, len(e.ids))
        assert rows[i].labels[:len(e.ids)] == [-100] * n + e.ids[n:] and set(rows[i].labels[len(e.ids):]) <= {-100}
        assert rows[i].input_ids[:len(e.ids)] == e.ids
    # The prompt's last line break and the answer's first are one token: it is masked, the rest of the answer is not.
    straddling = LIB.encode(prompt + "\n\n", add_special_tokens=False)
    assert [b - len(prompt) for a, b in straddling.offsets if a < len(prompt) < b] == [1]
    assert [x for x in rows[1].labels if x != -100] == LIB.encode("\n", add_special_tokens=False).ids


def test_distill_query_against_the_library(spark, sf_small):
    load_all()
    rows = QUERIES["distill_tokenized"](spark, sf_small).collect()
    assert len(rows) > 10 and all(len(r.input_ids) == len(r.labels) >= 512 for r in rows)
    for r in rows[:50]:
        kept = [x for x in r.labels if x != -100]
        assert kept == [i for i, x in zip(r.input_ids, r.labels) if x != -100] and set(r.labels[:r.prompt_len]) == {-100}


@pytest.fixture
def sf_small():
    return "/root/testdata/sf0.001"


def test_history_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "h")
    log = spark.range(10).select((F.col("id") % 2).alias("run_id"), F.col("id").alias("step"), F.lit(0.5).alias("epoch"),
                                 F.lit(1.0).alias("loss"), F.lit(None).cast("double").alias("eval_loss"))
    assert FI.read_history(spark, path).count() == 0
    assert FI.append_history(log, path, "a") == 10 and FI.append_history(log.limit(3), path, "a") == 10
    assert FI.append_history(log.where("step < 4"), path, "b-2") == 4
    assert FI.read_history(spark, path).groupBy("batch").count().orderBy("batch").collect() == [("a", 10), ("b-2", 4)]
    # An attempt that died before its commit is not read, and the next one replaces it.
    FI.history_sink(log, os.path.join(path, "batch=c"), mode="overwrite")
    assert FI.read_history(spark, path).count() == 14
    assert FI.append_history(log.where("step < 2"), path, "c") == 2 and FI.read_history(spark, path).count() == 16
    with pytest.raises(ValueError):
        FI.append_history(log, path, "../x")


def test_bertscore_ids_of_any_type(spark):
    enc = B.HashingEncoder(16)
    rows = [("a", "red car", "red car"), (None, "red car", "blue car"), ("b", "", "x"), ("c", None, None)]
    got = {r.sample_id: r.f1 for r in B.bertscore_from_text(spark.createDataFrame(rows, "sample_id string, prediction string, reference string"),
                                                            enc).collect()}
    assert got["a"] == 1.0 and 0 < got[None] < 1 and got["b"] == got["c"] == 0.0
    big = 2 ** 60 + 1
    df = spark.createDataFrame([(big, "a b", "a"), (None, "c", "d e")], "sample_id long, prediction string, reference string")
    vectors = B.text_token_vectors(df, enc).collect()
    assert sorted((str(v.sample_id), v.side, v.pos) for v in vectors) == sorted(
        [(str(big), "pred", 0), (str(big), "pred", 1), (str(big), "ref", 0), ("None", "pred", 0), ("None", "ref", 0), ("None", "ref", 1)])
    assert {r.sample_id for r in B.bertscore_from_text(df, enc).collect()} == {big, None}
