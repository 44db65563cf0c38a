"""Near-duplicate removal with sequential Bayesian verification (operator 10).

Documents with the same shingle set form a class at once (grouped by a digest
of the set); the rest works on one representative per class.

Candidates share a band of MinHash values.  A candidate's signatures are
compared batch by batch; after each batch, the pair is dropped once the
posterior probability that its similarity reaches the threshold is below
``MISS``.  Survivors are verified exactly on full shingle sets.

Each bucket first tests its members against one pivot (its smallest id), which
connects groups of copies.  Of buckets that still hold several components,
those of up to ``FEW`` members test their unconnected pairs.  Larger ones,
together with the buckets they share members with, measure their members
exactly against one centre (the best linked of them all) and keep what each
member x differs in, D(x): the shingles that only one of x and the centre has.
Two members differ in D(x) ^ D(y) (symmetric difference) and are linked if

    (1 + t) * |D(x) ^ D(y)| <= (1 - t) * (|x| + |y|).

So pairs are decided inside tiles of two blocks of members without their full
sets: by size, by the parities of D(x) in a short bitmap (the exclusive or of
two bitmaps has at most |D(x) ^ D(y)| bits), and what is left exactly.  Members
linked with the centre are in one component and only meet the others.  No link
that could join two components goes untested; only links leave a tile, at most
one for two components.  The pairs of a cluster still grow with the square of
its members, at some nanoseconds each.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.llm.base import SLICE_BYTES, Words, give_back, hash_binary, map_text, mix64, slices, text_bytes, write_scratch

BANDS, ROWS = 36, 5      # a pair of similarity 0.8 shares no band with probability 6e-7
CHECKED = 96             # MinHash values kept (16 bits each) for the sequential test
BATCH = 16
FEW = 16                 # members of a bucket whose unconnected pairs are simply tested
TILE = 4096              # members in a block of a tile, about
TILE_BYTES = 16 << 20    # and bytes of what they differ in
TILE_PAIRS = 1 << 16     # pairs of a tile handled at once
MISS = 1e-7              # chosen probability of dropping a true pair after a batch

_A = (mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))


def shingle_sets(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed k-word shingles of each text, ascending, and offsets.
    Fewer than k words: the whole sequence is one shingle; no words: none."""
    w = Words(col, lower=True)
    codes, uniq = w.codes()
    n = w.counts
    docs = len(n)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    h = hash_binary(uniq)[codes]
    size = np.minimum(n, k)                               # words in this text's shingles
    many = np.where(n > 0, n - size + 1, 0)
    offs = np.concatenate([[0], np.cumsum(many)])
    doc = np.repeat(np.arange(docs), many)
    at = w.first[:-1][doc] + np.arange(offs[-1]) - offs[:-1][doc]
    length = size[doc]
    out = mix64(length.astype(np.uint64))
    for j in range(k):
        live = slice(None) if (length > j).all() else np.flatnonzero(length > j)
        out[live] = mix64(out[live] * np.uint64(0x9E3779B97F4A7C15) + h[at[live] + j])
    order = np.argsort(out)
    small = doc[order].astype(np.uint16 if docs < 65536 else np.int64)
    order = order[np.argsort(small, kind="stable")]
    out, doc = out[order], doc[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=docs))])


def signatures(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values, texts x (BANDS * ROWS); empty sets give zeros."""
    n = np.diff(offsets)
    full = np.flatnonzero(n)
    out = np.zeros((len(n), BANDS * ROWS), np.uint32)
    if len(full):
        starts = offsets[:-1][full]
        for lo, hi in slices(n[full] * 8, 1 << 20):       # pieces that stay in the cache
            a, b = starts[lo], offsets[full[hi - 1] + 1]
            part, cuts = sets[a:b], starts[lo:hi] - a
            for p in range(BANDS * ROWS):
                out[full[lo:hi], p] = np.minimum.reduceat((part * _A[p] >> np.uint64(32)).astype(np.uint32), cuts)
    return out


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared, matches needed to go on) after each batch.

    With a uniform prior and m of n values equal, the posterior probability of
    a similarity of at least t is P(Binomial(n + 1, t) <= m)."""
    need = []
    for n in range(BATCH, CHECKED + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        need.append((n, m))
    return need


def _survives(a: np.ndarray, b: np.ndarray, need) -> np.ndarray:
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    done = 0
    for n, m in need:
        matches[alive] += (a[alive, done:n] == b[alive, done:n]).sum(1)
        alive = alive[matches[alive] >= m]
        done = n
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


# -- connected components -----------------------------------------------------

def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(u, component) for every node of ``edges`` (u, v): the smallest node it
    reaches, by alternating large-star and small-star steps.  Every round is
    written; hot nodes only meet map-side combined minima and joins."""
    spark = edges.sparkSession
    cur = write_scratch(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "cc")
    state = None
    for _ in range(rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        m2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(m2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(m2.select("u", F.col("m").alias("v"))).distinct())
        cur = write_scratch(small, "cc")
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    del spark
    return cur.select("u", F.col("v").alias("component"))


# -- the operator ---------------------------------------------------------------

def shingle_table(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(doc, n_shingles, d, sig, keys): set size, set digest, short signature
    and band keys of every row."""
    def sketch(col):
        sets, offsets = shingle_sets(col, k)
        n = np.diff(offsets)
        sig = signatures(sets, offsets)
        salt = np.uint64(0xD1B54A32D192ED03)
        two = []
        for s in (np.uint64(0), salt):                    # 128 bits: sums of two bijections of the members
            cum = np.concatenate([[np.uint64(0)], np.cumsum(mix64(sets ^ s), dtype=np.uint64)])
            two.append(mix64(cum[offsets[1:]] - cum[offsets[:-1]] + n.astype(np.uint64)))
        digest = np.stack(two, 1)
        keys = np.empty((len(n), BANDS), np.uint64)
        for b in range(BANDS):
            x = np.full(len(n), b + 1, np.uint64)
            for r in range(ROWS):
                x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * ROWS + r].astype(np.uint64))
            keys[:, b] = x
        kept = sig[:, :CHECKED].astype(np.uint16)
        return [pa.array(n.astype(np.int64)), _rows(digest), _rows(kept),
                pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))]

    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("__t"))
    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("d", T.BinaryType()),
              T.StructField("sig", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    return map_text(slim, "__t", sketch, fields, SLICE_BYTES // 4).drop("__t")


def _rows(a: np.ndarray) -> pa.Array:
    width = a.shape[1] * a.dtype.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(a), [None, pa.py_buffer(np.ascontiguousarray(a).tobytes())]).cast(pa.binary())


def _verify(pairs: DataFrame, reps: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int,
            threshold: tuple[int, int]) -> DataFrame:
    """The (p, x) pairs with 100 * common >= threshold * union, and ``shared``,
    their similarity: sequential test on signatures, then full sets."""
    num, den = threshold
    need = least_matches(num / den)
    sig = reps.select(F.col("rep"), "sig")
    with_sig = (pairs.join(sig.withColumnRenamed("rep", "p").withColumnRenamed("sig", "sp"), "p")
                .join(sig.withColumnRenamed("rep", "x").withColumnRenamed("sig", "sx"), "x").select("p", "x", "sp", "sx"))

    def test(batches):
        for b in batches:
            if b.num_rows:
                s = [np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, CHECKED) for i in (2, 3)]
                keep = pa.array(_survives(s[0], s[1], need))
                yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["p", "x"])
        give_back()

    left = write_scratch(with_sig.mapInArrow(test, "p long, x long"), "op10-pairs")

    both = _with_sets(left, docs, id_col, text_col, k)

    def exact(batches):
        for b in batches:
            keep, score = [], []
            for s, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                a, c = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                common = len(np.intersect1d(a, c, assume_unique=True))
                union = len(a) + len(c) - common
                keep.append(den * common >= num * union)
                score.append(common / max(union, 1))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep),
                                              pa.array(score, pa.float64()).filter(keep)], names=["p", "x", "shared"])
        give_back()

    return both.mapInArrow(exact, "p long, x long, shared double")


def _with_sets(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(p, x, sp, sx): the pairs (stored) with their full sets, made from the
    texts of the documents that are in a pair.  A repeated id brings a row for
    each of its texts."""
    wanted = pairs.select(F.col("p").alias("rep")).unionByName(pairs.select(F.col("x").alias("rep"))).distinct()
    text = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("__t")).join(wanted, "rep")

    def full(col):
        sets, offsets = shingle_sets(col, k)
        data = np.ascontiguousarray(sets).view(np.uint8)
        return [pa.Array.from_buffers(pa.binary(), len(col), [
            None, pa.py_buffer((offsets * 8).astype(np.int32)), pa.py_buffer(data)])]

    sets = map_text(text, "__t", full, [T.StructField("s", T.BinaryType())],
                    SLICE_BYTES // 4).drop("__t").dropDuplicates(["rep", "s"])
    return (pairs.select("p", "x").join(sets.withColumnRenamed("rep", "p").withColumnRenamed("s", "sp"), "p")
            .join(sets.withColumnRenamed("rep", "x").withColumnRenamed("s", "sx"), "x").select("p", "x", "sp", "sx"))


def _measured(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, threshold: tuple[int, int]) -> DataFrame:
    """(o, variant, x, size, linked, diff) for centres p = o: a hash of the
    centre's set (a repeated id has several), the size of x, and the shingles
    that only one of both has, ascending."""
    num, den = threshold

    def measure(batches):
        for b in batches:
            size, linked, diff = [], [], []
            for s, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                o, v = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                d = np.setxor1d(o, v, assume_unique=True)
                size.append(len(v))
                linked.append((num + den) * len(d) <= (den - num) * (len(o) + len(v)))
                diff.append(d.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(4), b.column(1), pa.array(size, pa.int64()), pa.array(linked, pa.bool_()),
                                              pa.array(diff, pa.binary())], names=["o", "variant", "x", "size", "linked", "diff"])
        give_back()

    return _with_sets(pairs, docs, id_col, text_col, k).withColumn("variant", F.xxhash64("sp")).mapInArrow(
        measure, "o long, variant long, x long, size long, linked boolean, diff binary")


def _joining(info: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(p, x): links between members of one centre in different components
    ``c``, at least one for any two components that have one.  Members meet in
    tiles: blocks of those not linked with the centre, and of these with the
    linked ones."""
    def blocks(own):
        rows, size = F.count(F.when(own, 1)) / TILE, F.sum(F.when(own, F.length("diff"))) / TILE_BYTES
        return F.ceil(F.greatest(rows, size, F.lit(1))).cast("long")

    split = (info.groupBy("o").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), blocks(~F.col("linked")).alias("n_far"),
                                   blocks(F.col("linked")).alias("n_near")).where("lo <> hi").select("o", "n_far", "n_near"))
    hashed = F.xxhash64("x", F.lit(1))
    rows = (info.join(split, "o")
            .withColumn("block", F.when(F.col("linked"), F.col("n_far") + F.pmod(hashed, "n_near")).otherwise(F.pmod(hashed, "n_far")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("linked"), F.col("n_far") - 1)
                                                      .otherwise(F.col("n_far") + F.col("n_near") - 1))))
            .select("o", "variant", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
                    "block", "x", "c", "size", "diff"))

    def links(tile):
        p, x = _tile_links(tile, threshold)
        out = pa.table({"p": pa.array(np.minimum(p, x), pa.int64()), "x": pa.array(np.maximum(p, x), pa.int64())})
        if tile.nbytes > 1 << 20:
            give_back()
        return out

    return rows.groupBy("o", "variant", "one", "two").applyInArrow(links, "p long, x long").distinct()


def _tile_links(tile: pa.Table, threshold: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of linked members of a tile's two blocks, one pair for two components."""
    num, den = threshold
    more, less = num + den, den - num                     # linked: more * differing <= less * sizes
    tile = tile.take(pa.array(np.argsort(np.asarray(tile["size"]), kind="stable")))
    x, c, size, block = (np.asarray(tile[n]) for n in ("x", "c", "size", "block"))
    one, two = tile["one"][0].as_py(), tile["two"][0].as_py()
    data, offs = text_bytes(tile["diff"].combine_chunks().cast(pa.binary()))
    codes, offs = np.ascontiguousarray(data).view(np.uint64), offs // 8
    count = np.diff(offs)
    row = np.repeat(np.arange(len(x)), count)

    words = max(2, int(6 * less * 2 * size.mean() / more) // 64 + 1)
    bit = codes % np.uint64(64 * words)
    parity = np.zeros((words, len(x)), np.uint64)
    np.bitwise_xor.at(parity, ((bit >> np.uint64(6)).astype(np.int64), row), np.uint64(1) << (bit & np.uint64(63)))
    uniq, code = np.unique(codes, return_inverse=True)
    held = row * len(uniq) + code                         # ascending: of each member, what it differs in

    def differing(i, j):
        """Exact sizes of the symmetric differences of members i and j."""
        out = count[i] + count[j]
        i, j = np.where(count[i] <= count[j], i, j), np.where(count[i] <= count[j], j, i)
        for lo, hi in slices(count[i] * 8, 8 << 20):
            n = count[i[lo:hi]]
            pair = np.repeat(np.arange(hi - lo), n)
            at = np.repeat(offs[i[lo:hi]] - np.cumsum(n) + n, n) + np.arange(len(pair))
            want = j[lo:hi][pair] * len(uniq) + code[at]
            pos = np.searchsorted(held, want)
            hit = held[np.minimum(pos, len(held) - 1)] == want
            out[lo:hi] -= 2 * np.bincount(pair[hit], minlength=hi - lo)
        return out

    a, b = np.flatnonzero(block == one), np.flatnonzero(block == two)
    found = [np.zeros((0, 2), np.int64)]
    mine, theirs, sb = np.ascontiguousarray(parity[:, a]), np.ascontiguousarray(parity[:, b]), size[b]
    lo = 0
    while lo < len(a) and len(b):
        first = int(np.searchsorted(sb * den, size[a[lo]] * num))          # sizes that a link allows
        if one == two:
            first = max(first, lo)
        hi = min(len(a), lo + max(1, TILE_PAIRS // max(1, len(b) - first)))
        last = int(np.searchsorted(sb * num, size[a[hi - 1]] * den, side="right"))
        i, j = a[lo:hi], b[first:last]
        bits = np.zeros((len(i), len(j)), np.uint16 if words < 1000 else np.uint32)
        for w in range(words):
            bits += np.bitwise_count(mine[w, lo:hi, None] ^ theirs[w, None, first:last])
        may = bits <= less * (size[i][:, None] + size[j]) // more
        may &= c[i][:, None] != c[j]
        if one == two:
            may &= i[:, None] < j
        p, q = np.nonzero(may)
        p, q = i[p], j[q]
        is_link = more * differing(p, q) <= less * (size[p] + size[q])
        found.append(np.stack([p[is_link], q[is_link]], 1))
        lo = hi
    p, q = np.concatenate(found).T
    both = np.stack([np.minimum(c[p], c[q]), np.maximum(c[p], c[q])], 1)
    keep = np.unique(both, axis=0, return_index=True)[1]
    return x[p[keep]], x[q[keep]]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id
    reachable over links) and ``kept`` (id = component_id).

    Links join documents whose sets of k-word shingles have
    ``den * common >= num * union``.  Null and empty texts have no shingles and
    link with nothing.  Rows of one id count as one document, linked through
    any of its texts; rows with a null id take no part and are kept under a
    null component.  An empty table gives an empty result; other columns are
    not read."""
    sets = write_scratch(shingle_table(docs, id_col, text_col, k), "op10-sets")
    alive = sets.where("n_shingles > 0 and doc is not null")
    classes = write_scratch(alive.groupBy("d").agg(F.min("doc").alias("rep"), F.first("sig").alias("sig"),
                                                   F.first("keys").alias("keys")), "op10-classes")
    reps = classes.dropDuplicates(["d"]).select("rep", "sig", "d")
    band = classes.select("rep", F.explode("keys").alias("key"))
    buckets = band.groupBy("key").agg(F.min("rep").alias("p"), F.max("rep").alias("q")).where("p <> q").select("key", "p")
    inside = write_scratch(band.join(buckets, "key"), "op10-bands")      # rows of buckets with two or more

    def verified(pairs):
        return write_scratch(_verify(pairs, reps, docs, id_col, text_col, k, threshold), "op10-links")

    # Texts of one repeated id count as one document.
    same_id = (alive.select("doc", "d").distinct().groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
               .join(alive.select("doc", "d").distinct(), "doc").join(classes.select("d", "rep"), "d")
               .select(F.col("doc").alias("u"), F.col("rep").alias("v")))

    # A member is first tested against the pivot it shares most buckets with; its other pivots
    # only matter if they are still in another component then.
    tried = write_scratch(inside.where("rep <> p").groupBy("p", F.col("rep").alias("x")).agg(F.count(F.lit(1)).alias("n")),
                          "op10-tried")
    first = tried.groupBy("x").agg(F.max_by("p", F.struct("n", -F.col("p"))).alias("p")).select("p", "x")
    links = verified(first)
    edges = links.select(F.col("p").alias("u"), F.col("x").alias("v")).unionByName(same_id)
    comp = components(edges)
    cp, cx = (comp.select(F.col("u").alias(n), F.col("component").alias(f"c{n}")) for n in ("p", "x"))
    second = (tried.select("p", "x").join(first, ["p", "x"], "left_anti").join(cp, "p", "left").join(cx, "x", "left")
              .where(F.coalesce("cp", "p") != F.coalesce("cx", "x")).select("p", "x"))
    second = write_scratch(second, "op10-tried")
    if second.limit(1).count():
        links = links.unionByName(verified(second))
        edges = edges.unionByName(links.select(F.col("p").alias("u"), F.col("x").alias("v")))
        comp = components(edges)

    c = F.coalesce("component", "rep")
    rows = inside.join(comp.withColumnRenamed("u", "rep"), "rep", "left").select("key", "p", "rep", c.alias("c"))
    mixed = (rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m"))
             .where("lo <> hi and m > 2").select("key", "m"))        # of two members, the pair was tested
    rest = write_scratch(rows.join(mixed, "key"), "op10-mixed")
    seen = tried.select(F.least("p", "x").alias("p"), F.greatest("p", "x").alias("x"))
    few = rest.where(F.col("m") <= FEW)
    other = few.select("key", F.col("rep").alias("y"), F.col("c").alias("cy"))
    pairs = (few.join(other, "key").where("c < cy").select(F.least("rep", "y").alias("p"), F.greatest("rep", "y").alias("x"))
             .distinct().join(seen, ["p", "x"], "left_anti"))
    # Large buckets that share members form a cluster; its centre is the member with most links.
    many = rest.where(F.col("m") > FEW)
    cluster = components(many.select(F.col("p").alias("u"), F.col("rep").alias("v")))
    ends = links.select(F.col("p").alias("u")).unionByName(links.select(F.col("x").alias("u")))
    degree = cluster.join(ends.groupBy("u").agg(F.count(F.lit(1)).alias("n")), "u", "left")
    centres = degree.groupBy("component").agg(F.max_by("u", F.struct(F.coalesce("n", F.lit(0)), -F.col("u"))).alias("o"))
    members = write_scratch(cluster.join(centres, "component").select(F.col("o").alias("p"), F.col("u").alias("x")), "op10-tried")
    more = [pairs]
    if members.limit(1).count():
        info = write_scratch(_measured(members, docs, id_col, text_col, k, threshold), "op10-centres")
        edges = edges.unionByName(info.where("linked").select(F.col("o").alias("u"), F.col("x").alias("v")))
        comp = components(edges)
        of = info.join(comp.withColumnRenamed("u", "x"), "x", "left").select(*info.columns, F.coalesce("component", "x").alias("c"))
        more.append(_joining(of, threshold))
    last = more[0] if len(more) == 1 else more[0].unionByName(more[1]).distinct()
    last = write_scratch(last, "op10-tried")
    if last.limit(1).count():
        edges = edges.unionByName(verified(last).select(F.col("p").alias("u"), F.col("x").alias("v")))
        comp = components(edges)

    named = (classes.select("d", "rep").join(comp.withColumnRenamed("u", "rep"), "rep", "left")
             .select("d", F.coalesce("component", "rep").alias("component_id")))
    out = sets.select("doc", "n_shingles", "d").join(named, "d", "left")
    alone = F.col("n_shingles") == 0
    if id_col in ("n_shingles", "component_id", "kept"):
        raise ValueError(f"the id column may not be named {id_col}")
    component = F.when(alone | F.col("doc").isNull(), F.col("doc")).otherwise(F.col("component_id"))
    return out.select(F.col("doc").alias(id_col), "n_shingles", component.alias("component_id"),
                      component.eqNullSafe(F.col("doc")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
             threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``docs`` that stay: of each group, the document with the
    smallest id; columns as they were."""
    gone = (near_duplicates(docs, id_col, text_col, k, threshold).where(~F.col("kept"))
            .select(F.col(id_col).alias("__gone")).distinct())
    return docs.join(gone, docs[id_col].cast("long") == F.col("__gone"), "left_anti")
