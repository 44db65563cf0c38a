"""License scan (operator 9).

An Aho-Corasick automaton runs once over the words of every text (lower-cased
ASCII, one space between words) and finds notice phrases and identifier tags.
After a tag, the rest of the line is read as a licence expression: a
shunting-yard parser orders ``AND``, ``OR`` and ``WITH``, and the result says
which identifiers occur and whether a permissive choice satisfies it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.llm.base import ALNUM, Words, map_text

#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notice phrases: label, weight of the evidence.
NOTICES = {
    "licensed under the mit license": ("mit", 0.9),
    "released under the mit license": ("mit", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.8),
    "licensed under the apache license": ("apache", 0.9),
    "apache license version 2 0": ("apache-2.0", 0.9),
    "gnu general public license": ("gpl", 0.8),
    "general public license version 2": ("gpl-2.0", 0.9),
    "general public license version 3": ("gpl-3.0", 0.9),
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "bsd license": ("bsd", 0.7),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "isc license": ("isc", 0.7),
    "creative commons attribution": ("cc-by", 0.8),
    "licensed under cc by": ("cc-by", 0.8),
    "licensed under cc by sa": ("cc-by-sa", 0.9),
    "licensed under cc by nc": ("cc-by-nc", 0.9),
    "licensed under cc by nd": ("cc-by-nd", 0.9),
    "cc0 1 0 universal": ("cc0", 0.9),
    "all rights reserved": ("all-rights-reserved", 0.3),
}
TAG = "spdx license identifier"
BASE_WEIGHT, TAG_WEIGHT = 0.6, 0.95

#: Identifier prefixes and the family label they add, in order of trial.
FAMILIES = [("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"),
            ("bsd", "bsd"), ("isc", "isc"), ("mpl", "mpl"), ("epl", "epl"), ("cc0", "cc0"), ("cc-by", "cc-by")]
PERMISSIVE = {"mit", "apache", "bsd", "isc", "cc0", "cc-by"}

_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+\-:]+")
_RANK = {"OR": 1, "AND": 2, "WITH": 3}


def family(identifier: str) -> str | None:
    low = identifier.lower()
    return next((f for p, f in FAMILIES if low == p or low.startswith(p + "-")), None)


def to_postfix(text: str) -> list[str] | None:
    """Shunting-yard: tokens of an expression in postfix order.  Reading ends
    at the first token that cannot continue the expression; None if what came
    before is no expression."""
    out, stack, want = [], [], True
    for tok in _TOKEN.findall(text):
        op = tok.upper()
        if want and tok == "(":
            stack.append(tok)
        elif want and tok != ")" and op not in _RANK:
            out.append(tok)
            want = False
        elif not want and tok == ")":
            if "(" not in stack:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif not want and op in _RANK:
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[op]:
                out.append(stack.pop())
            stack.append(op)
            want = True
        else:
            break
    if want or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], bool]:
    """Identifiers of the licences, and whether a permissive choice satisfies
    the expression (an exception after WITH leaves its licence as it is)."""
    stack: list[tuple[set[str], bool]] = []
    for tok in postfix:
        if tok not in _RANK:
            stack.append(({tok}, family(tok) in PERMISSIVE))
            continue
        (right, r_ok), (left, l_ok) = stack.pop(), stack.pop()
        if tok == "WITH":
            stack.append((left, l_ok))
        else:
            stack.append((left | right, l_ok or r_ok if tok == "OR" else l_ok and r_ok))
    return stack[0]


def _expression(rest: str):
    """The expression that the rest of a tag's line begins with."""
    rest = rest.lstrip(" \t:\"'*")
    # Only the line's leading run of expression characters belongs to it.
    postfix = to_postfix(re.split(r"[^A-Za-z0-9.+\-:() \t]", rest, maxsplit=1)[0])
    if postfix is None:
        return None
    return evaluate(postfix)


_AUTOMATON = None


def _automaton():
    """(automaton, phrases): phrase numbers by pattern, built once per worker."""
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick
        phrases = [*BASE, *[p for p in NOTICES if p not in BASE], TAG]
        a = ahocorasick.Automaton()
        for i, p in enumerate(phrases):
            a.add_word(f" {p} ", (i, len(p) + 1))
        a.make_automaton()
        _AUTOMATON = a, phrases
    return _AUTOMATON


def matches(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(phrase number, index of its first word) of every match."""
    automaton, _ = _automaton()
    n = len(w)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # " word word ..." per text, with a line feed before each text: no match crosses it.
    length = w.ends - w.starts
    doc = w.doc()
    at = np.cumsum(length) - length + np.arange(n) + 2 * (doc + 1)
    out = np.full(int(at[-1] + length[-1] + 1), 0x20, np.uint8)
    out[at[w.first[:-1][w.counts > 0]] - 2] = 0x0A
    data = w.buf[w.inside]
    out[np.arange(len(data)) + np.repeat(at - (np.cumsum(length) - length), length)] = data
    text = out.tobytes().decode("latin-1")
    found = [(value[0], end - value[1]) for end, value in automaton.iter(text)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    f = np.array(found, np.int64)
    return f[:, 0], np.searchsorted(at, f[:, 1])


def scan_texts(col: pa.Array) -> list[pa.Array]:
    w = Words(col, ALNUM, lower=True)
    _, phrases = _automaton()
    which, word = matches(w)
    doc = np.searchsorted(w.first, word, side="right") - 1
    n = len(w.counts)
    n_base = np.zeros(n, np.int64)
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    base_labels, labels, score = [""] * n, [""] * n, np.zeros(n)
    expressions, permissive = [None] * n, [None] * n
    tag = phrases.index(TAG)
    order = np.argsort(doc, kind="stable")
    found_in = np.unique(doc)
    cuts = np.append(np.searchsorted(doc[order], found_in), len(order))
    for k, d in enumerate(found_in):
        here = order[cuts[k]:cuts[k + 1]]
        base, more, doubt, found, ok = set(), set(), 1.0, [], None
        seen = set()
        for j in here:
            p = phrases[which[j]]
            if p in BASE:
                base.add(BASE[p])
                n_base[d] += 1
                at = word[j] - w.first[d]
                first[d] = at if first[d] < 0 else min(first[d], at)
                last[d] = max(last[d], at)
            if which[j] == tag:
                begin = int(w.ends[word[j] + 2])              # the tag has three words
                stop = int(w.offsets[d + 1])
                got = _tag_value(col, d, begin - int(w.offsets[d]), stop - int(w.offsets[d]))
                if got is not None:
                    ids, good = got
                    found.append(" ".join(sorted(ids)))
                    ok = good if ok is None else ok and good
                    more |= {i.lower() for i in ids} | {family(i) for i in ids if family(i)}
                    doubt *= 1 - TAG_WEIGHT
            elif p not in seen:
                label, weight = NOTICES.get(p, (BASE.get(p), BASE_WEIGHT))
                more.add(label)
                doubt *= 1 - weight
            seen.add(p)
        base_labels[d] = ",".join(sorted(base))
        labels[d] = ",".join(sorted(base | more))
        score[d] = 1 - doubt
        expressions[d] = found or None
        permissive[d] = ok
    none = first < 0
    return [pa.array(w.counts.astype(np.int64)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
            pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), pa.array(score),
            pa.array(expressions, pa.list_(pa.string())), pa.array(permissive, pa.bool_())]


def _tag_value(col: pa.Array, d: int, begin: int, stop: int):
    """The expression after a tag, from the text as it was written."""
    raw = col[int(d)].as_py().encode("utf-8")[begin:stop]
    return _expression(raw.split(b"\n", 1)[0].decode("utf-8", "replace"))


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
          T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
          T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
          T.StructField("score", T.DoubleType()), T.StructField("expressions", T.ArrayType(T.StringType())),
          T.StructField("permissive", T.BooleanType())]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, word and match counts, labels, a score from 0
    (nothing found) to 1, the identifiers of each tagged expression, and
    whether all of these can be met by permissive licences (null without one).

    Null and empty texts have no words and no labels (empty strings); repeated
    ids and rows give a row each; an empty table gives an empty result; other
    columns are not read."""
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    out = map_text(slim, "__t", scan_texts, FIELDS).drop("__t")
    return out.select(F.col("__id").alias(id_col), *[f.name for f in FIELDS])
