"""Weak-label quality classifier (operator 5).

1. Overlapping heuristic labellers vote on every document (no labels read).
2. EM over the counts of vote patterns estimates their accuracies (``weak``).
3. A hashed linear scorer is trained on the posterior labels of a bounded,
   hash-chosen sample (``SAMPLE_PER_CLASS`` documents of either class).
4. Every document is scored by that model; ``kept`` is score >= threshold.

The scorer generalises over what the labellers look at: its features are
hashed words, hashed word shapes (``Abc,`` -> ``Aa,``) and a few binned
statistics of the whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.llm import weak
from vqaspark.llm.base import LOWER, hash_binary, map_text, Words, write_scratch
from vqaspark.llm.quality_rules import statistics

DIMS = 1 << 16              # hashed feature space
SAMPLE_PER_CLASS = 4096     # bound of the training sample, per posterior class
ROUNDS = 150                # gradient steps of the scorer

# (statistic, good when at most, bad when beyond); between them a labeller
# abstains.  Short texts are not bad as such: no labeller looks at length.
LABELLERS = [
    ("symbols_per_word", 0.02, 0.10),
    ("mark_word_share", 0.20, 0.35),
    ("upper_share", 0.15, 0.40),
    ("dup_line_share", 0.20, 0.50),
    ("repeat_share", 0.20, 0.45),
    ("chars_per_word", 9.0, 14.0),
    ("echo_share", 0.05, 0.30),
]
_MIN_WORDS_TO_JUDGE = 30    # fewer words: labellers of shares abstain

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x61:0x7B] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[0x30:0x3A] = ord("0")


def _binary_parts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offs, data = arr.buffers()
    o = np.frombuffer(offs, np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]], o - o[0]


def _rebuild(buf: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(buf))])


def word_features(uniq: pa.Array) -> np.ndarray:
    """Two feature numbers for each distinct word: of the word without case,
    and of its shape with runs collapsed."""
    if not len(uniq):
        return np.zeros((0, 2), np.int64)
    buf, o = _binary_parts(uniq)
    lowered = hash_binary(_rebuild(LOWER[buf], o))
    shape = _SHAPE[buf]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[o[:-1]] = True
    so = np.concatenate([[0], np.cumsum(keep)])[o]
    shapes = hash_binary(_rebuild(shape[keep], so))
    half = np.uint64(DIMS // 2)
    return np.stack([(lowered % half), (shapes % half) + half], 1).astype(np.int64)


_BINNED = ["symbols_per_word", "upper_share", "dup_line_share", "repeat_share", "echo_share"]


def features(col: pa.Array, stats: dict | None = None):
    """Sparse rows (row, feature, value): word and shape frequencies, and one
    feature of value 1 for the tenth each binned statistic falls in."""
    w = Words(col)
    codes, uniq = w.codes()
    n = len(w.counts)
    f = word_features(uniq)
    doc = w.doc()
    share = 1.0 / np.maximum(w.counts, 1)
    rows, cols, vals = [], [], []
    for j in (0, 1):
        if len(codes):
            key, times = np.unique(doc * DIMS + f[codes, j], return_counts=True)
            rows.append(key // DIMS)
            cols.append(key % DIMS)
            vals.append(times * share[key // DIMS])
    stats = stats or statistics(col)
    for j, name in enumerate(_BINNED):
        b = np.minimum(stats[name] * 10, 10).astype(np.int64)
        rows.append(np.arange(n))
        cols.append((np.int64(7919) * (j * 11 + b) + 104729) % DIMS)
        vals.append(np.ones(n))
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    s = dict(stats, mark_word_share=np.where(stats["n_words"] > 0, 1 - stats["bare_word_share"], 0.0))
    out = np.full((len(s["n_words"]), len(LABELLERS)), -1, np.int64)
    few = s["n_words"] < _MIN_WORDS_TO_JUDGE
    for j, (name, good, bad) in enumerate(LABELLERS):
        out[:, j] = np.where(s[name] > bad, 0, np.where(s[name] <= good, 1, -1))
        out[few, j] = -1
    return out


def _sample_key(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def train(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, target: np.ndarray, rounds: int = ROUNDS,
          rate: float = 2.0, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by Adam; deterministic."""
    n = max(len(target), 1)
    weight = np.where(target >= 0.5, 0.5 * n / max((target >= 0.5).sum(), 1), 0.5 * n / max((target < 0.5).sum(), 1)) / n
    w, b = np.zeros(DIMS), 0.0
    m, v, mb, vb = np.zeros(DIMS), np.zeros(DIMS), 0.0, 0.0
    for t in range(1, rounds + 1 if len(target) else 1):
        z = np.bincount(rows, weights=vals * w[cols], minlength=len(target)) + b
        err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) * weight
        g = np.bincount(cols, weights=vals * err[rows], minlength=DIMS) + l2 * w
        gb = float(err.sum())
        step = rate * 0.1 * (1 - t / (rounds + 1))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        b -= step * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.99 ** t)) + 1e-8)
    return w, b


def fit_scorer(docs: DataFrame, id_col: str, text_col: str, per_class: int = SAMPLE_PER_CLASS):
    """Labeller model and scorer weights from all of ``docs``.

    The votes of every document are counted; only the linear scorer looks at
    a sample: the ``per_class`` documents with the smallest hash among those
    with posterior < 0.5, and as many among the rest."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).withColumn(
        "__key", _sample_key("__id", "__t"))

    def vote_codes(col):
        return [pa.array(weak.pattern_codes(votes(statistics(col))).astype(np.int32))]

    field = [T.StructField("pattern", T.IntegerType())]
    voted = write_scratch(map_text(slim.select("__key", "__t"), "__t", vote_codes, field).drop("__t"), "op5-votes")
    model = weak.fit_frame(voted, "pattern", len(LABELLERS))
    table = weak.posterior(model, np.arange(3 ** len(LABELLERS)))
    bad = [int(i) for i in np.flatnonzero(table < 0.5)]
    is_bad = F.array_contains(F.array(*[F.lit(i) for i in bad]), F.col("pattern")) if bad else F.lit(False)

    def cut(rows):
        top = rows.orderBy("__key").limit(per_class).agg(F.max("__key").alias("k")).first()["k"]
        return -(1 << 63) if top is None else int(top)

    cuts = (cut(voted.where(is_bad)), cut(voted.where(~is_bad)))
    picked = slim.where(F.col("__key") <= F.lit(max(cuts)))

    def sparse(col):
        s = statistics(col)
        p = table[weak.pattern_codes(votes(s))]
        r, c, v = features(col, s)
        order = np.argsort(r, kind="stable")
        at = np.searchsorted(r[order], np.arange(len(col) + 1))
        pack = [(c[order][a:b].astype("<i4").tobytes(), v[order][a:b].astype("<f4").tobytes())
                for a, b in zip(at[:-1], at[1:])]
        return [pa.array(p), pa.array([x for x, _ in pack], pa.binary()), pa.array([x for _, x in pack], pa.binary())]

    rows = map_text(picked, "__t", sparse, [T.StructField("p", T.DoubleType()), T.StructField("c", T.BinaryType()),
                                            T.StructField("v", T.BinaryType())]).drop("__t")
    rows = rows.where((F.col("p") < 0.5) & (F.col("__key") <= F.lit(cuts[0]))
                      | (F.col("p") >= 0.5) & (F.col("__key") <= F.lit(cuts[1])))
    got = rows.select("__key", "p", "c", "v").limit(2 * per_class).collect()      # the bounded sample
    got.sort(key=lambda r: (r["__key"], r["p"], r["c"]))
    target = np.array([r["p"] for r in got])
    cols = np.concatenate([np.frombuffer(r["c"], "<i4") for r in got] or [np.zeros(0, np.int32)]).astype(np.int64)
    vals = np.concatenate([np.frombuffer(r["v"], "<f4") for r in got] or [np.zeros(0, np.float32)]).astype(np.float64)
    index = np.repeat(np.arange(len(got)), [len(r["c"]) // 4 for r in got])
    del got
    w, b = train(index, cols, vals, target)
    return model, table, w.astype(np.float32), b


def score_rows(docs: DataFrame, text_col: str, table, w, b) -> DataFrame:
    """Append ``label_posterior`` and ``score`` (the linear model's probability)."""
    def score(col):
        s = statistics(col)
        r, c, v = features(col, s)
        z = np.bincount(r, weights=v * w[c], minlength=len(col)) + b
        return [pa.array(table[weak.pattern_codes(votes(s))]), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))]

    return map_text(docs, text_col, score, [T.StructField("label_posterior", T.DoubleType()),
                                            T.StructField("score", T.DoubleType())])


def quality_classifier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, ``label_posterior`` (labellers alone),
    ``score`` (the trained scorer) and ``kept``.

    Null and empty texts get no vote and no word feature: they score what the
    scorer says of an empty text (close to the prior).  Repeated ids and rows
    give a row each; an empty table gives an empty result; other columns are
    not read.  Results do not depend on partitioning."""
    _, table, w, b = fit_scorer(docs, id_col, text_col)
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    out = score_rows(slim, "__t", table, w, b)
    return out.select(F.col("__id").alias(id_col), "label_posterior", "score",
                      (F.col("score") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their own columns."""
    _, table, w, b = fit_scorer(docs, id_col, text_col)
    names = docs.columns
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(names)])
    out = score_rows(renamed, f"__c{names.index(text_col)}", table, w, b)
    return out.where(F.col("score") >= threshold).select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)])
