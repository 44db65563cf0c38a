"""Hard negatives by length buckets and coordinate pruning (operator 13).

Rows are dealt into groups by vector length, longest first.  A task holds one
group in *buckets* of similar length; each bucket keeps, for every coordinate,
its unit vectors' values as a sorted list.  For an anchor q and a score to
reach, a bucket whose longest vector cannot reach it is skipped; otherwise the
Cauchy-Schwarz inequality gives, for each of the anchor's largest coordinates,
the range of values that a vector of the bucket can have there, binary search
cuts it out of the sorted list, and only rows in all ranges are verified by
their exact integer product.

Two passes: the first finds each anchor's best rows of its own label, the
second, for each of these, the best rows of other labels whose score lies in
the wanted window.  The score to reach begins at the window's lower end and
rises with what is found; a first look at one group gives it a start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vqaspark.llm.base import write_scratch

GROUP_BYTES = 32 << 20   # vectors of one group (a task's resident side)
ANCHOR_BYTES = 32 << 20  # anchors met with a group at once
GROUP_ROWS = 4_096       # rows of a group where all cores have one
BUCKET_ROWS = 1_024      # rows of one length bucket
FOCUS = 4                # focus coordinates of an anchor
LENGTH_CUTS = 256        # length ranges told apart between groups; larger ranges are split by hash
SLACK = 1e-7             # rounding of unit vectors


class Bucket:
    """Rows of similar length with a sorted list per coordinate."""

    def __init__(self, key, ids, labels, vecs):
        self.key, self.ids, self.labels, self.vecs = key, ids, labels, vecs
        length = np.sqrt((vecs * vecs).sum(1))
        self.longest = float(length.max(initial=0))
        unit = vecs / np.where(length > 0, length, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(unit, self.order, 0)

    def candidates(self, q: np.ndarray, norm: float, theta: float) -> np.ndarray | None:
        """Rows that may reach the score ``theta`` (None: all)."""
        if theta <= 0 or norm == 0:
            return np.zeros(0, np.int64) if norm == 0 and theta > 0 else None
        if norm * self.longest < theta * (1 - 1e-12):
            return np.zeros(0, np.int64)
        # The least cosine of a row that reaches theta; a little less, for the roots below.
        cos = min(theta / (norm * self.longest) * (1 - 1e-12), 1.0)
        unit = q / norm
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        hits = np.zeros(len(self.ids), np.int8)
        used = 0
        for f in focus:
            x = float(unit[f])
            spread = float(np.sqrt(max(1 - x * x, 0.0) * max(1 - cos * cos, 0.0)))
            # With x = cos a and the value cos b, |a - b| is at most the angle of cos.
            lo = x * cos - spread if x > -cos else -1.0
            hi = x * cos + spread if x < cos else 1.0
            col = self.sorted[:, f]
            a, b = np.searchsorted(col, lo - SLACK, "left"), np.searchsorted(col, hi + SLACK, "right")
            if b - a == len(col):
                continue
            used += 1
            hits[self.order[a:b, f]] += 1
        return np.flatnonzero(hits == used) if used else None


def _matrix(col, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<i8").reshape(len(col), dim).astype(np.float64)


def _keep(score, ids, k: int) -> np.ndarray:
    """The first k by score, ties by smaller id."""
    if len(score) > 4 * k:
        cut = -np.partition(-score, k - 1)[k - 1]
        near = np.flatnonzero(score >= cut)
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


class Best:
    """The first k (score, id, key) found of each window [lo, hi]."""

    def __init__(self, lo, hi, k: int, floor):
        self.lo, self.hi, self.k, self.floor = lo, hi, k, floor
        self.score = [np.zeros(0)] * len(lo)
        self.ids = [np.zeros(0, np.int64)] * len(lo)

    def reach(self) -> float:
        """The least score that can still change a window."""
        return min((max(lo, f, s[-1] if len(s) >= self.k else lo) for lo, f, s in zip(self.lo, self.floor, self.score)), default=np.inf)

    def add(self, score, ids) -> None:
        for w in range(len(self.lo)):
            fit = np.flatnonzero((score >= max(self.lo[w], self.floor[w])) & (score <= self.hi[w]))
            if len(fit):
                s, i = np.concatenate([self.score[w], score[fit]]), np.concatenate([self.ids[w], ids[fit]])
                first = _keep(s, i, self.k)
                self.score[w], self.ids[w] = s[first], i[first]


def buckets_of(t: pa.Table, dim: int) -> tuple[list[Bucket], dict]:
    """The group's rows by length, longest first, in buckets; label codes."""
    key, ids = t.column("key").to_numpy(), t.column("vec_id").to_numpy()
    coded = t.column("label").combine_chunks().dictionary_encode()
    labels, vecs = np.asarray(coded.indices), _matrix(t.column("v"), dim)
    order = np.lexsort((key, -(vecs * vecs).sum(1)))
    cut = [order[i:i + BUCKET_ROWS] for i in range(0, len(order), BUCKET_ROWS)]
    return [Bucket(key[o], ids[o], labels[o], vecs[o]) for o in cut], {v: i for i, v in enumerate(coded.dictionary.to_pylist())}


def search(buckets: list[Bucket], key: int, label: int, q: np.ndarray, same: bool, best: Best) -> None:
    """Adds to ``best`` what the buckets have for one anchor: rows of its own
    label (``same``, without itself) or of the other labels."""
    norm = float(np.sqrt(q @ q))
    for b in buckets:
        rows = b.candidates(q, norm, best.reach())
        if rows is None:
            rows = np.arange(len(b.ids))
        fit = (b.labels[rows] == label) & (b.key[rows] != key) if same else b.labels[rows] != label
        rows = rows[fit]
        if len(rows):
            best.add(b.vecs[rows] @ q, b.ids[rows])      # exact: integers below 2^53


def usable(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v): rows with an id, a label and a vector of finite
    components, quantised to floor(256 * x)."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ints = F.transform("x", lambda x: F.floor(x * F.lit(256.0)).cast("long"))
    return (rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"), v.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(fine)
            .select("vec_id", "label", ints.alias("v")))


TILE = ["dim", "range", "split"]


def _packed(rows: DataFrame) -> DataFrame:
    """Vectors as little-endian 64-bit integers, their number ``dim``, squared
    length and largest component; ``key`` tells rows apart."""
    schema = pa.schema([("key", pa.int64()), ("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()),
                        ("l2", pa.float64()), ("peak", pa.float64()), ("v", pa.binary())])

    def run(batches):
        for b in batches:
            vs = [np.asarray(x, "<i8") for x in b.column(3).to_pylist()]
            fs = [x.astype(np.float64) for x in vs]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), b.column(2), pa.array([len(x) for x in vs], pa.int32()),
                pa.array([float(x @ x) for x in fs], pa.float64()), pa.array([float(np.abs(x).max(initial=0)) for x in fs], pa.float64()),
                pa.array([x.tobytes() for x in vs], pa.binary())], schema=schema)

    return rows.withColumn("key", F.monotonically_increasing_id()).select("key", "vec_id", "label", "v").mapInArrow(
        run, "key long, vec_id long, label string, dim int, l2 double, peak double, v binary")


def _grouped(packed: DataFrame, n: int, dim: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their group (dim, range, split), and the groups.

    A range holds rows of similar length, the longest in range 0; where it has
    more rows than a group takes, they are split by hash."""
    cores = packed.sparkSession.sparkContext.defaultParallelism
    rows = max(min(max(GROUP_ROWS, -(-n // (2 * cores))), GROUP_BYTES // (8 * max(dim, 1))), 1)
    cuts = min(-(-n // rows), LENGTH_CUTS)
    edges = packed.groupBy("dim").agg(F.percentile_approx("l2", [i / cuts for i in range(cuts)], 10_000).alias("edges"))
    ranged = packed.join(edges, "dim").withColumn("range", F.size(F.filter(F.array_distinct("edges"), lambda e: F.col("l2") < e)))
    groups = ranged.groupBy("dim", "range").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).alias("splits"))
    dealt = (ranged.join(groups, ["dim", "range"]).withColumn("split", F.pmod(F.xxhash64("key"), F.col("splits")))
             .select("key", "vec_id", "label", "v", *TILE))
    return dealt, groups.select("dim", "range", F.explode(F.sequence(F.lit(0).cast("long"), F.col("splits") - 1)).alias("split"))


def _tiles(anchors: DataFrame, dealt: DataFrame, groups: DataFrame, blocks: int, same: bool, k: int) -> DataFrame:
    """The first k rows that each group has for each anchor and window:
    (akey, reference, vec_id, score).  Anchors come as (key, label, v, dim, refs)
    with refs: (reference, lo, hi, floor)."""
    schema = pa.schema([("akey", pa.int64()), ("reference", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def meet(key, data: pa.Table, asked: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        if not data.num_rows or not asked.num_rows:
            return schema.empty_table()
        buckets, codes = buckets_of(data, dim)
        out = []
        for akey, label, q, refs in zip(asked.column("akey").to_pylist(), asked.column("alabel").to_pylist(),
                                        _matrix(asked.column("av"), dim), asked.column("refs").to_pylist()):
            best = Best([r["lo"] for r in refs], [r["hi"] for r in refs], k, [r["floor"] for r in refs])
            search(buckets, akey, codes.get(label, -1), q, same, best)
            for r, s, i in zip(refs, best.score, best.ids):
                if len(s):
                    out.append((np.full(len(s), akey), np.full(len(s), r["reference"]), i, s.astype(np.int64)))
        if not out:
            return schema.empty_table()
        return pa.table([np.concatenate([o[i] for o in out]) for i in range(4)], schema=schema)

    block = F.pmod(F.xxhash64("akey"), F.lit(blocks).cast("long"))
    asked = (anchors.select("dim", F.col("key").alias("akey"), F.col("label").alias("alabel"), F.col("v").alias("av"), "refs")
             .withColumn("block", block).join(groups, "dim"))
    data = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = [*TILE, "block"]
    # Anchors that no group can serve leave no rows; groups without anchors neither.
    return data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, "akey long, reference long, vec_id long, score long")


def hard_negatives(rows: DataFrame, is_anchor, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90)) -> DataFrame:
    """For each anchor row and each of its ``positives`` best other rows of its
    label, the ``negatives`` best rows of other labels whose score is between
    ``window`` percent of the positive's: ``anchor_id``, ``positive_id``,
    ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``
    and ``positive_rank``.

    Scores are integer inner products of the vectors' components floor(256 x);
    higher come first, ties by smaller id.  ``is_anchor`` maps the id column to
    a condition.  Rows with a null id, label or vector, or with any null or
    non-finite component take no part; vectors meet those of their own number
    of components only.  Repeated rows are rows of their own: an anchor is
    never its own positive, a copy of it is.  Vectors so large that a score
    could pass 2^53 raise ``ValueError``.  Other columns are not read; a table
    without such rows gives an empty result."""
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"
    spark = rows.sparkSession
    packed = write_scratch(_packed(usable(rows, id_col, vec_col, label_col)), "op13-rows")
    anchor = is_anchor(F.col("vec_id"))
    size = packed.agg(F.count(F.lit(1)).alias("n"), F.count_if(anchor).alias("anchors"), F.max("dim").alias("dim"),
                      F.max("peak").alias("peak")).first()
    if not size["n"] or not size["anchors"]:
        return spark.createDataFrame([], schema)
    if size["peak"] ** 2 * max(size["dim"], 1) >= 2 ** 53:
        raise ValueError("vectors too large for exact scores")
    dealt, groups = _grouped(packed, size["n"], size["dim"])
    dealt, groups = write_scratch(dealt, "op13-dealt"), write_scratch(groups, "op13-groups")
    anchors = packed.where(anchor).select("key", "vec_id", "label", "dim", "v")
    blocks = -(-size["anchors"] * 8 * max(size["dim"], 1) // ANCHOR_BYTES)

    low = F.lit(-(1 << 62)).cast("long")
    any_score = F.array(F.struct(F.lit(0).cast("long").alias("reference"), low.alias("lo"), (-low).alias("hi"), low.alias("floor")))
    found = _tiles(anchors.withColumn("refs", any_score), dealt, groups, blocks, True, positives)
    best = Window.partitionBy("akey").orderBy(F.desc("score"), "vec_id")
    pos = write_scratch(found.withColumn("positive_rank", F.row_number().over(best)).where(F.col("positive_rank") <= positives)
                        .select("akey", "positive_rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("reference")),
                        "op13-positives")

    lo_pct, hi_pct = window
    lo = F.expr(f"-((-{lo_pct} * reference) - pmod(-{lo_pct} * reference, 100L)) div 100")
    hi = F.expr(f"({hi_pct} * reference - pmod({hi_pct} * reference, 100L)) div 100")
    windows = (pos.select("akey", "reference").distinct().withColumn("lo", lo).withColumn("hi", hi).where("lo <= hi"))

    def asked(w: DataFrame) -> DataFrame:
        refs = w.groupBy(F.col("akey").alias("key")).agg(F.sort_array(F.collect_list(F.struct("reference", "lo", "hi", "floor"))).alias("refs"))
        return anchors.join(refs, "key")

    # A first look at the longest vectors' group gives each window a score that its last negative reaches.
    last = Window.partitionBy("akey", "reference").orderBy(F.desc("score"), "vec_id")
    head = groups.where("range = 0 and split = 0")
    seen = _tiles(asked(windows.withColumn("floor", F.col("lo"))), dealt.where("range = 0 and split = 0"), head, blocks, False, negatives)
    floors = (seen.withColumn("r", F.row_number().over(last)).where(F.col("r") == negatives)
              .select("akey", "reference", F.col("score").alias("reached")))
    windows = windows.join(floors, ["akey", "reference"], "left").select(
        "akey", "reference", "lo", "hi", F.greatest("lo", F.coalesce("reached", "lo")).alias("floor"))
    neg = _tiles(asked(write_scratch(windows, "op13-windows")), dealt, groups, blocks, False, negatives)
    top = neg.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= negatives)
    names = anchors.select(F.col("key").alias("akey"), F.col("vec_id").alias("anchor_id"))
    return (pos.join(top.select("akey", "reference", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")),
                     ["akey", "reference"]).join(names, "akey")
            .select("anchor_id", "positive_id", "rank", "negative_id", F.col("reference").alias("positive_score"), "negative_score", "positive_rank"))
