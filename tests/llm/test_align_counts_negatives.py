"""Token alignment, token counts and hard negatives against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers as P
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vqaspark.llm import align, hard_negatives, queries, resync

BYTES = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
PLAIN = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
PLAIN.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
ODD = ["the ", " ", "\n", "  ", "a", "'s", "'", "<|endoftext|>", "<|endof", "日本", "é", "é ", "12", "!!", "x" * 9, "x" * 50, "\t", "<s>",
       " hello", "́", "\xa0 ", "　 x", "\x85 ", "\x1c ", " ñ", "🙂 ", "\x00", "word "]


def odd_texts(seed, n, most):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(1, most))) for _ in range(n)]


# -- token counts -------------------------------------------------------------

def count(t):
    return len(BYTES.encode(t or "", add_special_tokens=False).ids)


def test_counts_of_all_rows(spark, edge, empty):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit, r.kept) for r in resync.token_counts(edge).collect())
    want = sorted((str(r.doc_id), len((r.text or "").encode()), count(r.text), count(r.text) > 1024, "clash") for r in edge.collect())
    assert got == want
    assert resync.token_counts(empty).count() == 0


def test_counts_by_overlapping_chunks(spark):
    texts = odd_texts(5, 120, 400)
    texts += ["x" * 5000, "ab" * 3000, "日本語" * 700, " " * 3000, "!" * 2000, "1234567" * 300, "", None, texts[0], texts[0],
              "".join(random.Random(1).choice("abcdefgh") for _ in range(6000))]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r.n_tokens for r in resync.token_counts(df, chunk=300, overlap=16).collect()}
    assert got == {i: count(t) for i, t in enumerate(texts)}


def test_splice_proves_or_refuses():
    tok = resync.loaded(P.path("byte_bpe_50k.json"))
    text = "".join(random.Random(2).choice("abcdefgh") for _ in range(4000))     # one piece: no boundary of the pattern
    left, right = (resync.edges(tok, text[a:b], a, x, y, b, 4000) for a, b, x, y in ((0, 2100, 0, 2000), (1900, 4000, 2000, 4000)))
    excess = resync.splice(left["right"], left["before"], left["total"], left["limit"], right["left"], tok.bytes)
    assert excess is not None and left["total"] + right["total"] - excess == count(text)
    same = "x" * 4000
    left, right = (resync.edges(tok, same[a:b], a, x, y, b, 4000) for a, b, x, y in ((0, 2003, 0, 2000), (1997, 4000, 2000, 4000)))
    assert resync.splice(left["right"], left["before"], left["total"], left["limit"], right["left"], tok.bytes) is None
    with pytest.raises(ValueError):
        resync.loaded(P.path("word_bpe_49k.json"))


# -- alignment ----------------------------------------------------------------

OWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE = {chr(b): b for b in OWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in OWN)}


def spelled_b(i):
    p = PIECES.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if PIECES.is_byte(i) else p.replace("▁", " ").encode()


def brute_alignment(texts):
    found, docs = [], Counter()
    for t in texts:
        a = PLAIN.encode(" " + (t or ""), add_special_tokens=False)
        b = PIECES.encode(t or "")
        x, y = [bytes(BYTE[c] for c in s) for s in a.tokens], [spelled_b(i) for i in b]
        whole = (" " + (t or "")).encode()
        if not t or b"".join(x) != whole or b"".join(y) != whole:
            found.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(s) for s in x]).tolist(), np.cumsum([len(s) for s in y]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((a.ids[i:k], b[j:m]))
            i, j = k, m
        met = Counter((u, v) for g, h in groups for u in g for v in h)
        docs.update(met.keys())
        found.append((len(x), len(y), groups, met))
    top = defaultdict(int)
    for (u, _), n in docs.items():
        top[u] = max(top[u], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, "", ""))
            continue
        groups = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in f[2])
        out.append((f[0], f[1], len(f[2]), sum(f[3].values()), sum(n for p, n in f[3].items() if docs[p] == top[p[0]]),
                    sum(n * docs[p] for p, n in f[3].items()), hashlib.sha256(groups.encode()).hexdigest(), groups))
    return out


COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups_sha256 groups".split()


@pytest.mark.parametrize("block", [align.BLOCK_BYTES, 3000])
def test_alignment_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(align, "BLOCK_BYTES", block)
    texts = odd_texts(7, 400, 50)
    texts += ["x" * 5000, "日本語" * 700, "", " ", "  ", "a ", " a", None, "▁", "x ▁ y", "a▁b c", "\n", texts[3], texts[3], "x y " * 3000]
    df = spark.createDataFrame([(i, t, "c", "c") for i, t in enumerate(texts)], "doc_id long, text string, n_a string, block string")
    rows = align.align_documents(df.repartition(4)).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == dict(enumerate(brute_alignment(texts)))
    assert all(r.block == "c" and r.text == texts[r.doc_id] for r in rows)


def test_alignment_of_rows_with_clashing_names(spark, edge, empty):
    rows = align.align_documents(edge).collect()
    texts = [r.text for r in rows]
    want = brute_alignment(texts)
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == want and len(rows) == edge.count()
    assert align.align_documents(empty).count() == 0


def test_groups_are_spelled_at_once():
    r = np.random.default_rng(3)
    na, nb = r.integers(1, 4, 60), r.integers(1, 4, 60)
    i, j = np.cumsum(na), np.cumsum(nb)
    a, b = r.integers(0, 1000, i[-1]), r.integers(0, 1000, j[-1])
    data, ends = align.spell(a, b, i, j, align.Marks(1000))
    want = [",".join(map(str, a[x - n:x])) + "|" + ",".join(map(str, b[y - m:y])) + ";" for x, n, y, m in zip(i, na, j, nb)]
    assert data.tobytes().decode() == "".join(want)
    assert np.diff(ends[i + j], prepend=0).tolist() == [len(w) for w in want]
    none = np.zeros(0, np.int64)
    data, ends = align.spell(none, none, none, none, align.Marks(1000))
    assert len(data) == 0 and ends.tolist() == [0]


def test_many_links_of_one_group_are_counted():
    a, b = np.array([5, 5, 6] * 40), np.array([7, 8] * 60)
    group, pair, times = align.links(a, b, np.array([len(a)]), np.array([len(b)]))
    assert dict(zip(pair.tolist(), times.tolist())) == {5 << 32 | 7: 4800, 5 << 32 | 8: 4800, 6 << 32 | 7: 2400, 6 << 32 | 8: 2400}


# -- hard negatives -----------------------------------------------------------

def brute_negatives(rows, step):
    good = [(i, label, [math.floor(256 * float(x)) for x in v]) for i, v, label in rows
            if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, label, v) in enumerate(good):
        if i % step:
            continue
        scores = [(sum(x * y for x, y in zip(v, w)), j, m) for b, (j, m, w) in enumerate(good) if b != a and len(w) == len(v)]
        for s, j in [(-n, j) for n, j in sorted((-s, j) for s, j, m in scores if m == label)[:5]]:
            found = sorted((-t, n) for t, n, m in scores if m != label and 30 * s <= 100 * t <= 90 * s)[:10]
            out += [(i, j, r + 1, n, s, -t) for r, (t, n) in enumerate(found)]
    return sorted(out)


def vectors():
    r = random.Random(3)
    rows = []
    for i in range(500):
        d = 4 if i % 9 else 3
        rows.append((i - 100, [r.choice([r.gauss(0, 1), 0.5, -0.0, float(r.randint(-3, 3))]) * (1 + i % 5) for _ in range(d)], r.randint(0, 3)))
    rows += [(3000 + i, [1.0, 1.0, 2.0, 0.5], i % 3) for i in range(120)]
    return rows + [(None, [1.0] * 4, 1), (5000, None, 1), (5010, [1.0, None, 1.0, 1.0], 1), (5020, [math.nan] * 4, 2), (5030, [math.inf] * 4, 2),
                   (5040, [], 1), (5050, [0.0] * 4, 1), (5060, [1.0] * 4, None), rows[10], rows[10], rows[100]]


@pytest.mark.parametrize("small", [False, True])
def test_negatives_against_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 60)
        monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 16)
        monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 600)
    df = spark.createDataFrame([(*r, "clash") for r in vectors()], "vec_id long, embedding array<double>, label int, key string")
    rows = hard_negatives.hard_negatives(df, lambda i: i % 10 == 0).collect()
    assert sorted(tuple(r)[:6] for r in rows) == brute_negatives(vectors(), 10)


def test_feasible_ranges_lose_nothing():
    r = np.random.default_rng(1)
    vecs = np.floor(256 * r.normal(size=(2000, 6)) * r.choice([1, 3], (2000, 1)))
    b = hard_negatives.Bucket(np.arange(2000), np.arange(2000), np.zeros(2000, np.int64), vecs)
    pruned = 0
    for q in vecs[:50]:
        score = vecs @ q
        for theta in np.quantile(score, [0.5, 0.99, 0.999, 1.0]):
            rows = b.candidates(q, float(np.sqrt(q @ q)), float(theta))
            if rows is not None:
                pruned += 2000 - len(rows)
                assert set(np.flatnonzero(score >= theta)) <= set(rows.tolist())
    assert pruned > 0


def test_negatives_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert hard_negatives.hard_negatives(spark.createDataFrame([], schema), lambda i: i % 10 == 0).count() == 0
    only = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], schema)
    assert hard_negatives.hard_negatives(only, lambda i: i % 10 == 0).count() == 0     # no positive
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(spark.createDataFrame([(0, [1e30], 1)], schema), lambda i: i % 10 == 0)


def test_registered_queries(spark, tmp_path):
    r = random.Random(9)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)], r.randint(0, 9)) for i in range(400)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    as_float = [(i, np.float32(v).astype(float).tolist(), (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert sorted(tuple(x)[:6] for x in queries.op13(spark, str(tmp_path)).collect()) == brute_negatives(as_float, 100)
    texts = odd_texts(11, 40, 40) + [None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {x.doc_id: tuple(x)[1:] for x in queries.op11(spark, str(tmp_path)).collect()} == {
        i: w[:7] for i, w in enumerate(brute_alignment(texts))}
    got = queries.op12(spark, str(tmp_path)).where(F.col("n_tokens").isNotNull()).collect()
    assert {x.doc_id: x.n_tokens for x in got} == {i: count(t) for i, t in enumerate(texts)}
