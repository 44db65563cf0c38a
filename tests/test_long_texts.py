"""Whole-document queries without SQL oracles, against brute force on the
smallest fixture (every document, whole texts)."""

import re

import numpy as np

SF0001 = "/root/testdata/sf0.001"
_TOK = re.compile(r"[^\W_]+")


def np_lcs(a, b):
    """Independent DP: row update cur = cummax(max(prev, prev[j-1] + match))."""
    if not a or not b:
        return 0
    vocab = {t: i for i, t in enumerate(set(a) | set(b))}
    ra = np.array([vocab[t] for t in a])
    prev = np.zeros(len(a) + 1, dtype=np.int64)
    for t in b:
        match = (ra == vocab[t]).astype(np.int64)
        cand = np.maximum(prev[1:], prev[:-1] + match)
        cur = np.concatenate([[0], np.maximum.accumulate(cand)])
        prev = cur
    return int(prev[-1])


def test_rouge_l_long_equals_brute_force(spark):
    import __spark_entry__ as E
    got = {r["doc_id"]: r["rouge_l"] for r in E.queries()["rouge_l_long"](spark, SF0001).collect()}
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        words = d["text"].split()
        pred = " ".join(w for i, w in enumerate(words) if i % 5 != 4)
        rt = _TOK.findall(d["text"].lower())
        pt = _TOK.findall(pred.lower())
        lcs = np_lcs(rt, pt)
        f = 0.0 if lcs == 0 else 2 * (lcs / len(pt)) * (lcs / len(rt)) / ((lcs / len(pt)) + (lcs / len(rt)))
        assert got[d["doc_id"]] == round(f, 6), d["doc_id"]


def test_partial_match_query_equals_difflib(spark):
    import difflib

    import __spark_entry__ as E
    from vqaspark.plans.fixtures import item_preds
    key = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    got = sorted((tuple(r[k] for k in key), r["partial_match"] if r["partial_match"] is not None else -1.0)
                 for r in E.queries()["partial_match_pairs"](spark, SF0001).collect())
    exp = []
    for r in item_preds(spark, SF0001).collect():
        if r["reference_answer"] is None:
            v = -1.0
        else:
            v = round(difflib.SequenceMatcher(None, str(r["student_answer"]).strip().lower(),
                                              r["reference_answer"].strip().lower()).ratio(), 6)
        exp.append((tuple(r[k] for k in key), v))
    assert got == sorted(exp)
