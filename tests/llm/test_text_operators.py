"""Operators on single texts against brute force: tokens, files, rules,
classifier, licences."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vqaspark.llm import huffman, licenses, quality_classifier, quality_rules, tokens, weak
from vqaspark.llm.base import hash_binary, string_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_words_and_hashes():
    a = pa.array([b"", b"a", b"aaaaaaaa", b"aaaaaaaab", b"a"], pa.binary())
    h = hash_binary(a)
    assert h[1] == h[4] and len(set(h.tolist())) == 4
    assert hash_binary(a.slice(1, 2)).tolist() == h[1:3].tolist()


def test_bpe_matches_library(spark, edge, empty, texts):
    lib = library()
    got = sorted((tuple(r) for r in tokens.digests(edge).collect()), key=str)
    want = []
    for i, t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert tokens.digests(empty).count() == 0
    # A clashing column is replaced, others stay.
    out = tokens.encode(edge)
    assert out.columns.count("ids") == 1 and dict(out.dtypes)["ids"] == "binary" and "kept" in out.columns


@pytest.mark.parametrize("leaf", [5, 37, 1000])
def test_tree_concatenation(leaf):
    enc = tokens.encoder(tokens.tokenizer_path())
    one = lambda t: enc.encode(pa.array([t], pa.string()))[0]
    for t in ["", "abc", "a b  c", "x" * 300, "the quick brown fox's 12 jumps " * 20, "é" * 50 + " é" * 20, "ab" * 60 + " cd" * 40,
              "no<|endoftext|>space " * 9]:
        parts = [(p, one(p)) for p in tokens.halves(t, leaf)]
        assert tokens.concatenate(parts, enc, window=2)[1].tolist() == library().encode(t, add_special_tokens=False).ids


def test_tree_of_unsplit_text():
    """Windows stay small where no white space is near the cut, and ids are the library's."""
    import random
    enc, lib, r = tokens.encoder(tokens.tokenizer_path()), library(), random.Random(5)
    read = []

    class Counting:
        margin, ends_piece = enc.margin, enc.ends_piece

        def spans(self, text):
            read.append(len(text))
            return enc.spans(text)

    t = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400_000))
    leaves = [(p, enc.encode(pa.array([p]))[0]) for p in tokens.halves(t)]
    assert tokens.concatenate(leaves, Counting())[1].tolist() == lib.encode(t, add_special_tokens=False).ids
    assert len(leaves) == 8 and sum(read) < 20_000 and max(read) < 2_000


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnopqrstuvwxyz", "ab'srevl!", "aE\u0301\u0323\u0308eo", "1a2!'", "é日本のç\u3099か한",
                                      "İſKΣσς'a", "!?#-\"'", "\u1112\u1161\u11ab가a", " ab\u00a0\u2003c", "a\u0345\u0313αι"])
def test_tree_on_hard_alphabets(alphabet):
    import random
    enc, lib = tokens.encoder(tokens.tokenizer_path()), library()
    for seed in range(25):
        r = random.Random(seed)
        t = "".join(r.choice(["<|endoftext|>"] if r.random() < 0.01 else alphabet) for _ in range(r.randint(100, 1500)))
        leaves = [(p, enc.encode(pa.array([p], pa.string()))[0]) for p in tokens.halves(t, r.choice([60, 150, 400]))]
        assert tokens.concatenate(leaves, enc, window=r.choice([16, 40, 64]))[1].tolist() == lib.encode(t, add_special_tokens=False).ids


def test_tree_through_spark(spark, edge, texts):
    lib = library()
    got = {(r.doc_id, r.text): r.n_tokens for r in tokens.encode(edge, leaf=64).select("doc_id", "text", "n_tokens").collect()}
    for (i, t), n in got.items():
        assert n == len(lib.encode(t or "", add_special_tokens=False).ids)
    assert tokens.encode(edge, leaf=64).count() == len(texts)


@pytest.mark.parametrize("n,limit", [(1, 8), (2, 8), (3, 8), (200, 8), (200, 12), (3000, 14)])
def test_code_lengths(n, limit):
    counts = (np.random.default_rng(n).pareto(0.7, n) * 5).astype(int) + 1
    size = huffman.code_lengths(counts, limit)
    assert size.max() <= limit
    if n > 1:
        assert (2.0 ** -size.astype(float)).sum() == 1
    if limit == 12:                                   # not binding here: as good as plain Huffman
        import heapq
        heap, cost = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            s = heapq.heappop(heap) + heapq.heappop(heap)
            cost += s
            heapq.heappush(heap, s)
        assert (size * counts).sum() >= cost
        assert (huffman.code_lengths(counts, 30) * counts).sum() == cost


def test_huffman_files(spark, edge, empty, texts):
    lib = library()
    path = huffman.store_documents(edge)
    got = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in huffman.read_ids(spark, path).collect()]
    want = Counter()
    for i, t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids + [2]
        want[(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((a, c, d) for a, _, c, d in got) == want
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    assert huffman.read_ids(spark, huffman.store_documents(empty)).count() == 0


def rule_counts(t):
    ws = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    tri = Counter(zip(ws, ws[1:], ws[2:]))
    covered = {j for i in range(len(ws) - 2) if tri[tuple(ws[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_quality_rules(spark, edge, empty, texts):
    rows = quality_rules.quality_rules(edge).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    want = Counter()
    for i, t in texts:
        c = rule_counts(t)
        want[(i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert got == want
    assert not any(r.kept and r.base_failed for r in rows)
    verdict = {(r.doc_id, r.n_words): r.kept for r in rows}
    assert verdict[(1, 120)] and not verdict[(15, 300)]
    assert quality_rules.quality_rules(empty).count() == 0
    kept = quality_rules.keep_good(edge)
    assert kept.columns == edge.columns
    assert kept.count() == sum(r.kept for r in rows)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(5)
    good = rng.random(20_000) < 0.85
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.97])
    votes = np.where(rng.random((20_000, 5)) < right, good[:, None], ~good[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.3] = -1
    codes, n = np.unique(weak.pattern_codes(votes), return_counts=True)
    model = weak.fit(codes, n, 5)
    assert np.abs(model["accuracy"] - right).max() < 0.06
    post = weak.posterior(model, weak.pattern_codes(votes))
    assert ((post >= 0.5) == good).mean() > 0.93
    assert 0 < weak.posterior(weak.fit([], [], 5), [0])[0] < 1


def test_classifier_on_labels(spark):
    """Held-out accuracy: the labels are never read by the classifier."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_classifier.quality_classifier(docs)
    n = {(r.quality, r.kept): r["count"] for r in out.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[(1, True)]
    assert n.get((0, True), 0) <= 0.10 * n[(0, False)]


def test_classifier_edges(spark, edge, empty, texts):
    out = quality_classifier.quality_classifier(edge).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in texts)
    assert all(0 <= r.score <= 1 for r in out)
    same = {r.doc_id: r.score for r in out}
    assert same[1] == same[2] and same[5] == same[6]
    assert quality_classifier.quality_classifier(empty).count() == 0
    kept = quality_classifier.keep_good(edge)
    assert kept.columns == edge.columns and kept.count() == sum(r.kept for r in out)


def license_words(t):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_scan(spark, edge, empty, texts):
    rows = licenses.license_scan(edge).collect()
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
    assert got == Counter((i, *license_words(t)) for i, t in texts)
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
    assert licenses.license_scan(empty).count() == 0


@pytest.mark.parametrize("text,ids,permissive", [
    ("MIT", {"MIT"}, True), ("MIT OR GPL-2.0-only", {"MIT", "GPL-2.0-only"}, True),
    ("MIT AND GPL-2.0-only", {"MIT", "GPL-2.0-only"}, False), ("GPL-2.0 OR MIT AND BSD-2-Clause", {"GPL-2.0", "MIT", "BSD-2-Clause"}, True),
    ("(GPL-2.0 OR MIT) AND LGPL-2.1", {"GPL-2.0", "MIT", "LGPL-2.1"}, False),
    ("Apache-2.0 WITH LLVM-exception", {"Apache-2.0"}, True), ("MIT */ more", {"MIT"}, True), ("(MIT", None, None), ("AND", None, None),
    ("", None, None)])
def test_expressions(text, ids, permissive):
    assert licenses._expression(text) == (None if ids is None else (ids, permissive))
