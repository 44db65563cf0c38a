"""Operators over the whole corpus against brute force: language model, near
duplicates, mixing, URL filters, neighbours, pipeline."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vqaspark.llm import lm_score, mixing, near_dup, neighbours, queries, url_filters
from vqaspark.llm.registry import load_all

from .conftest import SCHEMA, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


# -- language model -----------------------------------------------------------

def test_lm_base_against_brute_force(spark, edge, texts):
    rows = lm_score.lm_scores(edge).collect()
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in texts}
    c, ends = Counter(), 0
    for i, t in texts:
        if not held[i]:
            c.update(words(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    want = sorted((str(i), held[i], len(words(t)) + 1, sum(c[w] > 0 for w in words(t)) + 1, n,
                   round(sum(math.log10((x + 1) / (n + v + 1)) for x in [*(c[w] for w in words(t)), ends]), 6)) for i, t in texts)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_lm_empty_and_untrained(spark, empty):
    assert lm_score.lm_scores(empty).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    one = lm_score.lm_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()[0]
    assert (one.n_tokens, one.n_known, one.train_tokens) == (3, 0, 0) and one.base_score == 0 and math.isfinite(one.score)


def test_lm_learns_and_holds_out(spark):
    """Copies of training texts get cheap, held-out copies teach nothing, and
    changing one held-out text leaves all other scores as they were."""
    ids = list(range(400))
    held = [i for i in ids if zlib.crc32(str(i).encode()) % 7 == 2]
    text = {i: prose(i, 60) for i in ids}
    def scores(t):
        return {r.doc_id: r.score for r in lm_score.lm_scores(spark.createDataFrame(list(t.items()), "doc_id long, text string")).collect()}
    a = scores(text)
    b = scores(text | {held[0]: "zzz qqq " * 50})
    assert all(abs(a[i] - b[i]) < 1e-9 for i in ids if i != held[0])
    mine = sum(a[i] for i in held) / sum(len(words(text[i])) + 1 for i in held)
    strange = scores(text | {held[0]: "Xqj zvk wqx " * 3})[held[0]] / 10
    assert strange < mine


def test_lm_learns_phrases(spark):
    """The order of words matters: a held-out text made of a passage that is
    frequent in training texts scores above the same words scrambled."""
    ids = list(range(140))
    held = [i for i in ids if zlib.crc32(str(i).encode()) % 7 == 2]
    passage = prose(1000, 40).split()
    text = {i: prose(i, 40) + " " + " ".join(passage) + " " + prose(i + 500, 40) for i in ids}
    text |= {held[0]: " ".join(passage), held[1]: " ".join(sorted(passage))}
    df = spark.createDataFrame(list(text.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm_score.lm_scores(df).collect()}
    assert abs(got[held[0]].base_score - got[held[1]].base_score) < 1e-9
    assert got[held[0]].score > got[held[1]].score / 3


def test_phrase_counts_against_brute_force(spark, edge, texts):
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    blocks = lm_score.pack_blocks(edge.select(F.col("doc_id").alias("doc"), F.col("text").alias("t"), held.alias("held"))).persist()
    want = Counter()
    for i, t in texts:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            s = [None, None, *words(t), 0]
            want.update(zip(s[1:], s[2:]))
            want.update(zip(s, s[1:], s[2:]))
    keys, counts, at = {}, {}, {}
    for r in blocks.collect():
        _, _, _, keys[r.block], own = lm_score._phrases_of(r.asDict(), 56)
        at[r.block] = own.astype(np.int64)
    for r in lm_score.phrase_counts(blocks, 5, 56).collect():
        cuts = lm_score._cuts(keys[r.block], 5, 56)
        shared = np.unpackbits(lm_score._u(r.shared, np.uint8), count=int(cuts[r.owner + 1] - cuts[r.owner]))
        at[r.block][cuts[r.owner] + np.flatnonzero(shared)] += lm_score._u(r.counts, "<u4")
    for block, n in at.items():
        for k, x in zip(keys[block].tolist(), n.tolist()):
            assert counts.setdefault(k, x) == x            # blocks agree on what they share
    assert sorted(n for n in counts.values() if n) == sorted(want.values())


def test_spelled_probabilities_sum_to_at_most_one():
    """All words of up to two letters of a three-letter alphabet, and the end."""
    counts = np.zeros(258, np.int64)
    counts[[97, 98, 99, 256, 257]] = 50
    sp = lm_score.Speller(counts)
    tables = np.random.default_rng(1).integers(0, 5, (len(lm_score.ORDERS), 2, lm_score.SLOTS)).astype(np.float32)
    ws = [bytes([x]) for x in range(256)] + [bytes([x, y]) for x in (97, 98, 99) for y in range(256)]
    data = np.frombuffer(b"".join(ws), np.uint8)
    s = lm_score.spell(sp, lm_score.Mixer(nodes=sp.nodes), tables, data, np.array([len(w) for w in ws]), 1)
    assert 0 < (10 ** s).sum() <= 1 + 1e-6



# -- near duplicates ----------------------------------------------------------

def brute_components(rows, k, num=80, den=100):
    """id -> (smallest reachable id, sizes of its sets)."""
    sets = defaultdict(list)
    for i, t in rows:
        w = words(t)
        s = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets[i].append(s)
    ids = [i for i in sets if i is not None]
    root = {i: i for i in ids}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}, sets


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_edges(spark, edge, empty, texts, k):
    rows = near_dup.near_duplicates(edge, k=k).collect()
    want, sets = brute_components(texts, k)
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (want[r.doc_id] == r.doc_id)
            assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
    assert near_dup.near_duplicates(empty, k=k).count() == 0


def drifted(groups, copies, seed):
    """Groups of copies that lost or replaced some words: some drift below the
    threshold, some are copies of copies."""
    r = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        own = [prose(1000 + seed * 100 + g, 60).split()]
        for _ in range(copies):
            w = list(r.choice(own[:3]))
            for _ in range(r.randint(0, 12)):
                j = r.randrange(len(w))
                if r.random() < 0.3:
                    del w[j]
                else:
                    w[j] = f"new{r.randrange(40)}"
            own.append(w)
        for w in own:
            rows.append((r.randrange(10 ** 6) * 1000 + i, " ".join(w)))
            i += 1
    return rows


@pytest.mark.parametrize("k,seed", [(1, 1), (2, 2), (2, 3)])
def test_near_duplicates_lose_no_component(spark, k, seed):
    rows = drifted(4, 45, seed)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=k).collect()
    want, _ = brute_components(rows, k)
    assert {r.doc_id: r.component_id for r in got} == want


def test_near_duplicates_large_clusters_list_links_only(spark, monkeypatch):
    """Copies of one text that drifted apart: what is left after the pivots is
    decided in tiles; no other pairs of a cluster than links are listed."""
    r, base, rows = random.Random(5), prose(77, 400).split(), []
    for i in range(120):
        w = list(base)
        for j in r.sample(range(len(w)), r.randint(13, 16)):
            w[j] = f"new{r.randrange(6)}"
        rows.append((i * 7 + 1, " ".join(w)))
    listed, verify = [], near_dup._verify

    def noted(pairs, *a):
        listed.append(pairs.count())
        return verify(pairs, *a)

    monkeypatch.setattr(near_dup, "_verify", noted)
    monkeypatch.setattr(near_dup, "FEW", 2)
    monkeypatch.setattr(near_dup, "TILE", 40, raising=False)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()
    want, _ = brute_components(rows, 2)
    assert {x.doc_id: x.component_id for x in got} == want and len(set(want.values())) > 20
    assert sum(listed[2:]) < len(rows), listed          # after two rounds of pivots


def test_links_of_a_cluster_against_brute_force(spark, monkeypatch):
    """All members of a cluster, some with two texts (also the centre), others without a shingle in common."""
    monkeypatch.setattr(near_dup, "TILE", 3)
    rows = drifted(1, 40, 7) + [(9, "a b c d"), (9, "e f"), (10, "e f"), (11, "e f g h i j"), (12, "a b c d e")]
    rows += [(rows[0][0], rows[5][1] + " tail"), (rows[3][0], rows[8][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids, o = sorted({i for i, _ in rows}), rows[0][0]
    pairs = near_dup.write_scratch(spark.createDataFrame([(o, i) for i in ids], "p long, x long"), "t")
    info = near_dup.write_scratch(near_dup._measured(pairs, docs, "doc_id", "text", 2, (80, 100)), "t")
    sets = defaultdict(list)
    for i, t in rows:
        w = words(t)
        sets[i].append({tuple(w[j:j + 2]) for j in range(max(1, len(w) - 1))})

    def linked(i, j):
        return any(100 * len(a & b) >= 80 * len(a | b) for a in sets[i] for b in sets[j])

    near = {x.x for x in info.where("linked").collect()}
    assert near == {i for i in ids if linked(o, i)} and info.count() == 2 * sum(len({frozenset(a) for a in sets[i]}) for i in ids)
    c = F.when(F.col("x").isin(*near), o).otherwise(F.col("x"))        # the others are still alone
    got = {(x.p, x.x) for x in near_dup._joining(info.withColumn("c", c), (80, 100)).collect()}
    want = {(i, j) for i in ids for j in ids if i < j and linked(i, j) and not (i in near and j in near)}
    as_components = lambda ps: {(min(a, b), max(a, b)) for a, b in ((o if i in near else i, o if j in near else j) for i, j in ps)}
    assert got <= want and as_components(got) == as_components(want) and len(want) > 5


def test_sequential_test_keeps_similar_pairs():
    need = near_dup.least_matches(0.8)
    assert [n for n, _ in need] == list(range(16, 97, 16)) and all(m < n * 0.8 for n, m in need)
    rng = np.random.default_rng(0)
    a = rng.integers(0, 60_000, (20_000, near_dup.CHECKED)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 60_000, a.shape)).astype(np.uint16)
    assert near_dup._survives(a, b, need).all()
    assert near_dup._survives(a, np.roll(a, 1, 0), need).sum() == 0


def test_keep_one(spark, edge):
    out = near_dup.keep_one(edge)
    assert out.columns == edge.columns
    ids = {r.doc_id for r in out.collect()}
    assert 1 in ids and not {2, 3} & ids


# -- mixing -------------------------------------------------------------------

def brute_targets(size):
    names = sorted([s for s in size if s is not None]) + ([None] if None in size else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, out, free = 1.5 * sum(size.values()), {}, set(names)
    while free:
        left, total = budget - sum(out.values()), sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > 2 * size[s]]
        if not over:
            break
        for s in over:
            out[s] = 2.0 * size[s]
            free.discard(s)
    return out | {s: (budget - sum(out.values())) * w[s] / sum(w[x] for x in free) for s in free}


@pytest.mark.parametrize("block", [7, 1024])
def test_mixing_counts(spark, edge, empty, block):
    rows = edge.collect()
    got = mixing.mix_counts(edge, block_words=block).collect()
    size, source_of = Counter(), defaultdict(set)
    for r in rows:
        size[r.source] += len(WORD.findall(r.text or ""))
        source_of[r.doc_id].add(r.source)
    target, taken = brute_targets(size), Counter()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows)
    by_target = {round(t, 6): s for s, t in target.items()}
    for r in got:
        s = by_target[round(r.target, 6)]
        assert s in source_of[r.doc_id] and r.source_size == size[s] and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    again = mixing.mix_counts(edge.repartition(5), block_words=block).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix_counts(empty).count() == 0


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 17, 1000):
        c = mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("s"), F.lit(0).cast("long"), 42)
        got = [r[0] for r in spark.range(n).select(c).collect()]
        assert sorted(got) == list(range(n)) and (n < 1000 or got != list(range(n)))


def test_mixed_documents(spark, edge):
    docs = edge.where("doc_id is not null").dropDuplicates(["doc_id"])
    counts = {r.doc_id: r.taken for r in mixing.mix_counts(docs, block_words=16).collect()}
    out = mixing.mix_documents(docs, block_words=16)
    assert out.columns == docs.columns
    got, text = Counter(), {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        ws = WORD.findall(r.text)
        got[r.doc_id] += len(ws)
        assert r.n_chars == len(r.text)
        assert all(line in " ".join(WORD.findall(text[r.doc_id])) for line in
                   (" ".join(WORD.findall(x)) for x in r.text.split("\n")))
    assert got == Counter({k: v for k, v in counts.items() if v})


def test_mixed_rows_of_one_id(spark):
    """Rows that share id, source and size each give their own words, none twice a pass."""
    a, b = " ".join(f"a{i}" for i in range(100)), " ".join(f"b{i}" for i in range(100))
    docs = spark.createDataFrame([(1, a, "s", 0), (1, b, "s", 0), (None, a + " z", "s", 0), (2, "c", "u", 0)],
                                 "doc_id long, text string, source string, n_chars int")
    per = mixing.mix_counts(docs, block_words=16)
    total = per.agg(F.sum("taken")).first()[0]
    out = mixing.mix_documents(docs, block_words=16).collect()
    seen = Counter(w for r in out for w in WORD.findall(r.text))
    assert sum(seen.values()) == total and all(n <= 4 for n in seen.values())
    assert all(1 <= seen[f"{x}{i}"] <= 2 for x in "b" for i in range(100))


@pytest.mark.parametrize("block,shard", [(16, 200), (1024, 1 << 20)])
def test_mixed_blocks_add_up(spark, edge, empty, tmp_path, block, shard):
    """Blocks, shard counts and taken words agree, and blocks hold the texts' words in order."""
    blocks, counts = mixing.mix_blocks(edge, str(tmp_path / "mix"), block_words=block, shard_words=shard)
    rows = blocks.collect()
    drawn = {(r.shard, r.source): (r.slots, r.words) for r in counts.collect()}
    got = {}
    for r in rows:
        n, w = got.get((r.shard, r.source), (0, 0))
        got[r.shard, r.source] = n + 1, w + r.n_words
        assert len(WORD.findall(r.text)) == r.n_words <= block and len(r.docs) >= 1
    assert got == drawn and len({(r.source, r.slot) for r in rows}) == len(rows)
    if shard == 200:
        assert len({r.shard for r in rows}) > 5
    taken, target = Counter(), {}
    for r in mixing.mix_counts(edge, block_words=block).select("taken", "target", "source_size").collect():
        target[r.source_size, r.target] = 0
    for r in rows:
        taken[r.source] += r.n_words
    assert sorted(taken.values()) == sorted(math.floor(t + 0.5) for s, t in target if s)
    text = Counter(w for r in edge.collect() for w in WORD.findall(r.text or ""))
    assert set(w for r in rows for w in WORD.findall(r.text)) <= set(text)
    counted = Counter(w for r in rows for w in WORD.findall(r.text))
    assert all(counted[w] <= 2 * n for w, n in text.items())
    none = mixing.mix_blocks(empty, str(tmp_path / "none"))
    assert none[0].count() == none[1].count() == 0


def test_place_of_undoes_the_permutation(spark):
    for n in (1, 2, 3, 17, 1000):
        size, key, turn = F.lit(n).cast("long"), F.lit("s"), F.lit(1).cast("long")
        got = spark.range(n).select("id", mixing.permuted(F.col("id"), size, key, turn, 42).alias("b"))
        assert got.where(mixing.place_of(F.col("b"), size, key, turn, 42) != F.col("id")).count() == 0


# -- URL filters --------------------------------------------------------------

def test_url_filters_over_time(spark):
    entries = spark.createDataFrame(
        [("a.org", "block", 10), ("a.org", "allow", 20), ("b.a.org", "allow", 5), ("b.a.org", "block", 15),
         ("c.net/x", "block", 0), ("c.net", "allow", 0), ("d.io", "allow", 3), ("d.io", "block", 3),
         (None, "block", 1), ("a.org", None, 1), ("a.org", "block", None)], "pattern string, action string, day int")
    urls = [(1, "http://a.org/", 9), (2, "http://a.org/", 10), (3, "https://u@A.org:80/q?x#y", 19), (4, "http://a.org", 20),
            (5, "http://z.b.a.org/", 12), (6, "http://b.a.org/", 15), (7, "http://c.net/x/y", 1), (8, "http://c.net/xy", 1),
            (9, "http://d.io", 3), (10, None, 3), (11, "not a url", 3), (12, "http://a.org/", None), (2, "http://a.org/", 10),
            (None, "http://a.org/", 11), (14, "http://a.org/", 500)]
    caps = spark.createDataFrame([(*u, "clash") for u in urls], "page_id long, url string, fetch_day int, pattern string")
    out = url_filters.filter_urls(caps, entries, bucket_days=4)
    got = sorted((str(r.page_id), r.n_active, r.n_block, r.rule, r.blocked) for r in out.collect())
    want = [(1, 0, 0, None, False), (2, 1, 1, "a.org", True), (3, 1, 1, "a.org", True), (4, 1, 0, "a.org", False),
            (5, 2, 1, "b.a.org", False), (6, 2, 2, "b.a.org", True), (7, 2, 1, "c.net/x", True), (8, 1, 0, "c.net", False),
            (9, 1, 1, "d.io", True), (10, 0, 0, None, False), (11, 0, 0, None, False), (12, 0, 0, None, False), (2, 1, 1, "a.org", True),
            (None, 1, 1, "a.org", True), (14, 1, 0, "a.org", False)]
    assert got == sorted((str(w[0]), *w[1:]) for w in want)
    assert url_filters.filter_urls(caps, entries.limit(0)).where("blocked or n_active > 0").count() == 0
    assert url_filters.filter_urls(caps.limit(0), entries).count() == 0


def test_url_filters_long_hosts_and_deep_paths(spark):
    host, path = "a.b.c.d.e.f.org", "g.org/1/2/3/4/5"
    entries = spark.createDataFrame([(host, "block", 10), (path, "block", 10), ("g.org/1/2/3/4", "allow", 10), ("e.f.org", "allow", 10)],
                                    "pattern string, action string, day int")
    urls = [(1, f"http://{host}/x"), (2, f"http://z.{host}"), (3, "http://b.c.d.e.f.org"), (4, f"http://{path}"), (5, f"http://{path}/6/7?q"),
            (6, "http://g.org/1/2/3/4/x"), (7, "http://g.org/1/2/3")]
    out = url_filters.filter_urls(spark.createDataFrame([(*u, 12) for u in urls], "page_id long, url string, fetch_day int"), entries)
    assert sorted((r.page_id, r.n_active, r.rule, r.blocked) for r in out.collect()) == [
        (1, 2, host, True), (2, 2, host, True), (3, 1, "e.f.org", False), (4, 2, path, True), (5, 2, path, True),
        (6, 1, "g.org/1/2/3/4", False), (7, 0, None, False)]


def test_url_filters_spellings(spark):
    entries = spark.createDataFrame([(p, "block", 10) for p in ("ru", "Example.com", "a.com/x/", "b.com/", ".c.com", "d.com.", "/x", "", "E.com//P/")],
                                    "pattern string, action string, day int")
    urls = ["http://foo.ru./", "http://EXAMPLE.com", "http://a.com/x", "http://a.com//x/y", "http://b.com/z", "http://w.c.com", "http://d.com./q",
            "http://e.com/P/1", "http://e.com/p", "http://ru/", "http://.../", "http://nothing.org/x"]
    out = url_filters.filter_urls(spark.createDataFrame([(i, u, 12) for i, u in enumerate(urls)], "page_id long, url string, fetch_day int"), entries)
    assert [(r.n_active, r.rule) for r in sorted(out.collect())] == [
        (1, "ru"), (1, "example.com"), (1, "a.com/x"), (1, "a.com/x"), (1, "b.com"), (1, "c.com"), (1, "d.com"), (1, "e.com/P"), (0, None),
        (1, "ru"), (0, None), (0, None)]
    mixed = spark.createDataFrame([("A.org/", "block", 10), ("a.org", "allow", 10), ("a.org.", "allow", 20)], "pattern string, action string, day int")
    assert sorted((r.pattern, r.action, r.valid_from, r.valid_to) for r in url_filters.intervals(mixed).collect()) == [
        ("a.org", "allow", 20, None), ("a.org", "block", 10, 20)]


def test_url_filters_against_oracle(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    want = sorted(map(str, con.sql(url_filters.ORACLE).fetchall()))
    got = sorted(str(tuple(r)) for r in queries.op6(spark, sf).collect())
    assert got == want


# -- neighbours ---------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 16)).astype(np.float32)
    rows = [(int(i), [float(v) for v in r], "clash") for i, r in enumerate(x)]
    out = neighbours.nearest(vectors(spark, rows), lambda i: i % 20 == 0).collect()
    s = x.astype(np.float64) @ x.astype(np.float64).T
    found, ranks = defaultdict(set), defaultdict(list)
    for r in out:
        assert abs(r.score - s[r.query_id, r.vec_id]) < 1e-9
        found[r.query_id].add(r.vec_id)
        ranks[r.query_id].append(r["rank"])
    assert set(found) == set(range(0, 4000, 20)) and all(sorted(v) == list(range(1, 21)) for v in ranks.values())
    recall = []
    for q, f in found.items():
        s[q, q] = -np.inf
        recall.append(len(f & set(np.argsort(-s[q])[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.9


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "c"), (20, [1.0, 0.0], "c"), (1, [1.0, 0.0], "c"), (2, [1.0, -0.0], "c"), (3, [0.5, 1.0], "c"),
            (4, None, "c"), (40, [0.0, 0.0], "c"), (5, [nan, 1.0], "c"), (6, [inf, 1.0], "c"), (7, [None, 1.0], "c"), (8, [], "c"),
            (-20, [0.0, 2.0], "c"), (None, [1.0, 1.0], "c"), (3, [0.5, 1.0], "c")]
    out = neighbours.nearest(vectors(spark, rows), lambda i: i % 20 == 0).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    assert got == {0: [(1, 1.0), (2, 1.0), (20, 1.0), (3, 0.5), (-20, 0.0)], 20: [(0, 1.0), (1, 1.0), (2, 1.0), (3, 0.5), (-20, 0.0)],
                   -20: [(3, 2.0), (0, 0.0), (1, 0.0), (2, 0.0), (20, 0.0)]}
    assert neighbours.nearest(vectors(spark, []), lambda i: i % 20 == 0).count() == 0
    one = neighbours.nearest(vectors(spark, [(0, [1.0], "c")]), lambda i: i % 20 == 0)
    assert one.count() == 0 and one.columns == ["query_id", "rank", "vec_id", "score"]


def test_neighbours_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 2.0], "c") for i in range(60)]
    out = neighbours.nearest(vectors(spark, rows), lambda i: i == 40).orderBy("rank").collect()
    assert [r.vec_id for r in out] == list(range(20))


def test_neighbours_ties_of_distinct_vectors(spark):
    rows = [(i, [1.0, math.cos(i), math.sin(i)], "c") for i in range(36)] + [(99, [1.0, 0.0, 0.0], "c")]
    out = neighbours.nearest(vectors(spark, rows), lambda i: i == 99).orderBy("rank").collect()
    assert [r.vec_id for r in out] == list(range(20))


# -- pipeline and registry ----------------------------------------------------

def test_pipeline_stages_on_edges(spark, edge, empty):
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for start in (edge.where("doc_id is not null"), empty):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, None)
            if name != "bpe_encode":
                assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert {"doc_id", "n_tokens", "ids"} <= set(docs.columns)


def test_registry_has_each_operator():
    found, sql = load_all()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in found) == list(range(1, 14))
    assert set(sql) <= set(found) and len(SCHEMA) == 9
