"""Quality rules by weak supervision (operator 7).

Rules over whole-text statistics vote good, bad or abstain.  EM over the
counts of vote patterns (``weak``) estimates how reliable every rule is; a
document is kept if its posterior probability of being good reaches 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.llm import weak
from vqaspark.llm.base import Words, map_text, mix64, per_text, write_scratch

MIN_WORDS = 50           # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50  # base rule: more words in repeated 3-word windows fail

# Each rule: (statistic, good when at most / at least, bad when beyond); the
# gap between the two thresholds abstains.  Thresholds are in units of the
# statistic and the same for every corpus.
RULES = [
    ("n_words", "high", 60, MIN_WORDS),
    ("symbols_per_word", "low", 0.02, 0.10),
    ("dup_line_share", "low", 0.20, 0.50),
    ("repeat_share", "low", 0.20, 0.45),
    ("upper_share", "low", 0.15, 0.40),
    ("bare_word_share", "high", 0.80, 0.65),
    ("chars_per_word", "low", 9.0, 14.0),
    ("echo_share", "low", 0.05, 0.30),
]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = True
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_CONTINUED = np.zeros(256, bool)
_CONTINUED[0x80:0xC0] = True


def repeated_words(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words per text in 3-word windows that occur twice or more in the text."""
    n = len(codes)
    if n < 3:
        return np.zeros(len(first) - 1, np.int64)
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    at = np.flatnonzero(doc[:-2] == doc[2:])
    a, b, c, d = a[at], b[at], c[at], doc[at]
    k = mix64(mix64(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64))
              ^ (c.astype(np.uint64) << np.uint64(32) | d.astype(np.uint64)))
    order = np.argsort(k)
    x, y = order[:-1], order[1:]
    same = (k[x] == k[y]) & (a[x] == a[y]) & (b[x] == b[y]) & (c[x] == c[y]) & (d[x] == d[y])
    again = np.zeros(n, bool)
    hit = np.concatenate([at[x[same]], at[y[same]]])
    again[hit] = True
    covered = again.copy()
    covered[1:] |= again[:-1]
    covered[2:] |= again[:-2]
    return per_text(covered, first)


def lines_of(w: Words):
    """Lines of the texts that hold a word: (text of each line, line code)."""
    buf, offsets = w.buf, w.offsets
    cut = buf == 0x0A
    ends = np.union1d(np.flatnonzero(cut), offsets[1:])          # a line ends at \n or at its text's end
    ends = ends[ends <= len(buf)]
    starts = np.concatenate([[0], ends[:-1]])
    starts = starts + ((starts < len(buf)) & (starts > 0) & cut[np.minimum(starts, max(len(buf) - 1, 0))]
                       if len(buf) else 0)
    with_word = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[with_word], ends[with_word]
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, doc


def duplicate_lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: lines with a word, those equal to an earlier one, and those
    of at most three words."""
    n = len(w.counts)
    starts, ends, doc = lines_of(w)
    if not len(starts):
        return (np.zeros(n, np.int64),) * 3
    lengths = ends - starts
    offs = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.repeat(starts - offs[:-1], lengths) + np.arange(offs[-1])
    arr = pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(w.buf[flat])])
    code = np.asarray(arr.dictionary_encode().indices).astype(np.int64)
    total = np.bincount(doc, minlength=n)
    distinct = np.unique(doc * (len(code) + 1) + code) // (len(code) + 1)
    few = np.searchsorted(w.starts, ends) - np.searchsorted(w.starts, starts) <= 3
    return total, total - np.bincount(distinct, minlength=n), np.bincount(doc[few], minlength=n)


def statistics(col: pa.Array) -> dict[str, np.ndarray]:
    """Whole-text statistics of a slice of texts."""
    w = Words(col)
    codes, uniq = w.codes()
    n_words = w.counts
    in_word = per_text(w.inside & ~_CONTINUED[w.buf], w.offsets)
    lines, dup, short = duplicate_lines(w)
    letters = per_text(_LETTER[w.buf] & ~_CONTINUED[w.buf], w.offsets)
    bare = _bare(uniq)
    at_least = np.maximum(n_words, 1)
    echo = np.zeros(len(codes), bool)            # the word just before, in the same text
    echo[1:] = codes[1:] == codes[:-1]
    echo[w.first[:-1][n_words > 0]] = False
    symbols = per_text(_SYMBOL[w.buf], w.offsets)
    repeat = repeated_words(codes, w.first)
    return {
        "n_words": n_words, "word_chars": in_word, "n_symbols": symbols,
        "n_dup_lines": dup, "n_repeat_words": repeat,
        "symbols_per_word": symbols / at_least,
        "dup_line_share": dup / np.maximum(lines, 1),
        "repeat_share": repeat / at_least,
        "upper_share": per_text(_UPPER[w.buf], w.offsets) / np.maximum(letters, 1),
        "bare_word_share": per_text(bare[codes] if len(codes) else np.zeros(0, bool), w.first) / at_least,
        "chars_per_word": in_word / at_least,
        "echo_share": per_text(echo, w.first) / at_least,
        "short_line_share": short / np.maximum(lines, 1),
    }


def _bare(uniq: pa.Array) -> np.ndarray:
    """Distinct words made of letters, with at most one mark at the end."""
    if not len(uniq):
        return np.zeros(0, bool)
    _, offs, data = uniq.buffers()
    o = np.frombuffer(offs, np.int32)[uniq.offset:uniq.offset + len(uniq) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)
    other = np.concatenate([[0], np.cumsum(~_LETTER[buf])])
    length = np.diff(o)
    body = other[o[1:]] - other[o[:-1]]
    tail = ~_LETTER[buf[np.maximum(o[1:] - 1, 0)]]
    return (body == 0) | ((body == 1) & tail & (length > 1))


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """The rules' votes, rows x rules; texts without words only get the length vote."""
    out = np.full((len(stats["n_words"]), len(RULES)), -1, np.int64)
    empty = stats["n_words"] == 0
    for j, (name, side, good, bad) in enumerate(RULES):
        v = stats[name]
        yes, no = (v >= good, v < bad) if side == "high" else (v <= good, v > bad)
        out[:, j] = np.where(no, 0, np.where(yes, 1, -1))
        if name != "n_words":
            out[empty, j] = -1
    return out


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def vote_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Append the five counts and ``rule_pattern`` (the votes as one number)."""
    def stats(col):
        s = statistics(col)
        return [pa.array(s[c].astype(np.int64)) for c in _COUNTS] + [
            pa.array(weak.pattern_codes(votes(s)).astype(np.int32))]

    return map_text(docs, text_col, stats,
                    [T.StructField(c, T.LongType()) for c in _COUNTS] + [T.StructField("rule_pattern", T.IntegerType())])


def judge(voted: DataFrame, min_posterior: float = 0.5) -> tuple[DataFrame, dict]:
    """Fit the rules' accuracies on ``voted`` (stored rows) and append
    ``quality`` (posterior), ``base_failed`` and ``kept``."""
    model = weak.fit_frame(voted, "rule_pattern", len(RULES))
    table = weak.posterior_frame(voted.sparkSession, model, "rule_pattern", "quality")
    base = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    out = (voted.drop("quality", "base_failed", "kept").join(F.broadcast(table), "rule_pattern")   # 3^8 rows
           .withColumn("base_failed", base)
           .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= min_posterior)))
    return out, model


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_posterior: float = 0.5) -> DataFrame:
    """One row per input row: id, the five counts, ``quality``, ``base_failed``
    and ``kept``.

    Null and empty texts have no words and fail the base rule; repeated ids
    and rows give a row each; an empty table gives an empty result; other
    columns are not read."""
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text_in"))
    voted = write_scratch(vote_rules(slim, "__text_in").drop("__text_in"), "op7-votes")
    out, _ = judge(voted, min_posterior)
    return out.select(F.col("__id").alias(id_col), *_COUNTS, "quality", "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", min_posterior: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only."""
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    t = f"__c{docs.columns.index(text_col)}"
    out, _ = judge(write_scratch(vote_rules(renamed, t), "rules"), min_posterior)
    return out.where("kept").select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
