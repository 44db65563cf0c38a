"""Metric semantics on literal cases and properties."""

import difflib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vqaspark.functions.porter import stem
from vqaspark.operators.metrics import exact as E
from vqaspark.operators.metrics import partial as PM
from vqaspark.operators.metrics import rouge as RG
from vqaspark.operators.metrics.bleu import bleu

# The three documented sentence pairs.
PRED = ["hai chú mèo", "một chiếc ghế", "ba con chó"]
REF = ["hai con mèo", "một cái ghế", "ba chú chó"]


def pairs(spark, p, r):
    return spark.createDataFrame(list(zip(range(len(p)), p, r)), "id long, prediction string, reference string")


def test_readme_example_goldens(spark):
    df = pairs(spark, PRED, REF)
    assert E.exact_match(df).first()["exact_match"] == 0.0
    ascii_ = RG.rouge_l(df, stem=False).first()["rouge_l"]
    uni = RG.rouge_l(df, tokenizer="unicode", stem=False).first()["rouge_l"]
    assert round(ascii_, 4) == 0.7389
    assert round(uni, 4) == 0.6667


def test_exact_match_nulls_and_padding(spark):
    df = pairs(spark, ["  Yes ", None, "no", ""], ["yes", None, "No", ""])
    r = E.exact_match(df).first()
    assert r["num_samples"] == 4
    assert r["exact_match"] == pytest.approx(3 / 4)  # NULL never matches, '' == ''


def test_exact_match_empty_input(spark):
    df = pairs(spark, [], [])
    assert E.exact_match(df).first()["exact_match"] == 0.0


def test_labeled_exact_match_denominator_asymmetry(spark):
    df = spark.createDataFrame([("a", "a"), ("", ""), ("b", None), ("c", "x")],
                               "predicted_answer string, reference_answer string")
    r = E.exact_match_labeled(df).first()
    # '' matches '' in the numerator but '' is not counted in the denominator
    assert (r["matches"], r["labeled"]) == (2, 2)
    assert r["exact_match"] == 1.0
    strict = E.exact_match_labeled(df, strict_denominator=True).first()
    assert strict["exact_match"] == pytest.approx(2 / 3)


def test_labeled_exact_match_no_labels(spark):
    df = spark.createDataFrame([("a", None)], "predicted_answer string, reference_answer string")
    assert E.exact_match_labeled(df).first()["exact_match"] == 0.0


def test_agreement_no_strip(spark):
    df = spark.createDataFrame([("A", "a"), (" a", "a"), ("b", "c")], "teacher_answer string, student_answer string")
    r = E.agreement(df).first()
    assert r["agreements"] == 1 and r["agreement"] == pytest.approx(1 / 3)


def test_unknown_metric_raises():
    with pytest.raises(ValueError):
        E.check_metric("bleurt")
    assert E.check_metric("rouge_l") == "rouge_l"


def test_partial_match_literals(spark):
    assert PM.ratio("tide", "diet") == difflib.SequenceMatcher(None, "tide", "diet").ratio()
    assert PM.ratio("", "") == 1.0
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), ("x", None)],
                               "predicted_answer string, reference_answer string")
    s = [r["partial_match"] for r in PM.partial_match_scores(df).collect()]
    assert s[0] == pytest.approx(0.25) and s[1] == pytest.approx(0.5) and s[2] is None
    agg = PM.partial_match(df).first()
    assert agg["num_scored"] == 2 and agg["partial_match"] == pytest.approx(0.375)


def test_partial_match_autojunk_long_text():
    words = [f"w{i % 37}" for i in range(120)]
    ref = " ".join(words)
    pred = " ".join(w for i, w in enumerate(words) if i % 5 != 4)
    assert PM.ratio(pred, ref, autojunk=True) != PM.ratio(pred, ref, autojunk=False)


def dp_lcs(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i][j] = m[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(m[i - 1][j], m[i][j - 1])
    return m[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=40), st.lists(st.sampled_from("abcde"), max_size=40))
def test_bit_parallel_lcs_equals_dp(a, b):
    v = RG.lcs_length(a, b)
    assert v == dp_lcs(a, b)
    assert v == RG.lcs_length(b, a)
    assert v <= min(len(a), len(b))


def test_lcs_long_text_brute_force():
    import random
    rnd = random.Random(7)
    a = [rnd.choice("abcdefghij") for _ in range(400)]
    b = [x for i, x in enumerate(a) if i % 5 != 4] + a[:30]
    assert RG.lcs_length(a, b) == dp_lcs(a, b)


def test_rouge_identity_and_empty(spark):
    df = pairs(spark, ["The Cat sat", "", None], ["the cat SAT ", "x", "y"])
    s = [round(r["rouge_l"], 6) for r in RG.rouge_l_scores(df, stem=False).orderBy("id").collect()]
    assert s == [1.0, 0.0, 0.0]


def test_rouge_with_stemming(spark):
    df = pairs(spark, ["the cats running quickly"], ["the cat runs quick"])
    plain = RG.rouge_l(df, stem=False).first()["rouge_l"]
    stemmed = RG.rouge_l(df, stem=True).first()["rouge_l"]
    assert stemmed > plain


@pytest.mark.parametrize("word,expected", [
    ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"),
    ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"),
    ("conflated", "conflat"), ("hopping", "hop"), ("filing", "file"), ("happy", "happi"),
    ("relational", "relat"), ("conditional", "condit"), ("triplicate", "triplic"),
    ("revival", "reviv"), ("adoption", "adopt"), ("controll", "control"), ("generalization", "gener"),
    ("dies", "die"), ("skies", "sky"), ("tying", "tie"), ("died", "die"), ("spied", "spi"), ("enjoy", "enjoy"),
    ("analogi", "analog"), ("news", "news"),
])
def test_porter_published_examples(word, expected):
    assert stem(word) == expected


def test_bleu_identity_and_brevity(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e"])],
                               "sample_id long, hyp_tokens array<string>, ref_tokens array<string>")
    assert bleu(df).first()["bleu"] == 1.0
    short = spark.createDataFrame([(1, ["a", "b", "c", "d"], ["a", "b", "c", "d", "e"])],
                                  "sample_id long, hyp_tokens array<string>, ref_tokens array<string>")
    import math
    assert short.transform(lambda d: bleu(d)).first()["bleu"] == pytest.approx(round(math.exp(1 - 5 / 4), 6))
