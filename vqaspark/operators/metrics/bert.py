"""BERTScore-style greedy matching F1 (A6) over token vectors.

Input: ``(sample_id, side in {pred, ref}, pos, vector)``.  For every pred
token the best cosine against the sample's ref tokens (mean = precision),
for every ref token the best against the pred tokens (mean = recall).

The all-pairs similarity is computed in tiles, never emitted as rows: each
side of a sample is cut into blocks of at most ``block`` tokens; a pred block
meets each ref block of its sample once, and one NumPy matrix product per
tile yields the per-token maxima.  Output of a tile is linear in its tokens,
and a large sample is spread over many tiles (many tasks) instead of one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TILE_OUT = "sample_id {}, side string, pos bigint, best double"


def _unit(rows):
    m = np.asarray([np.asarray(v, dtype=np.float64) for v in rows], dtype=np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return m / n


def _tiles(batches):
    for pdf in batches:
        outs = []
        for sid, ppos, pvec, rpos, rvec in zip(pdf["sample_id"], pdf["ppos"], pdf["pvec"],
                                               pdf["rpos"], pdf["rvec"]):
            p = _unit(pvec)
            r = _unit(rvec)
            sim = p @ r.T
            outs.append(pd.DataFrame({"sample_id": sid, "side": "pred",
                                      "pos": np.asarray(ppos, dtype=np.int64), "best": sim.max(axis=1)}))
            outs.append(pd.DataFrame({"sample_id": sid, "side": "ref",
                                      "pos": np.asarray(rpos, dtype=np.int64), "best": sim.max(axis=0)}))
        if outs:
            yield pd.concat(outs, ignore_index=True)


def token_best_matches(vectors: DataFrame, block: int = 256, sample_col: str = "sample_id",
                       side_col: str = "side", pos_col: str = "pos", vec_col: str = "vector") -> DataFrame:
    """Best cosine per token (``sample_id, side, pos, best``)."""
    v = vectors.select(F.col(sample_col).alias("sample_id"), F.col(side_col).alias("side"),
                       F.col(pos_col).cast("bigint").alias("pos"),
                       F.col(vec_col).cast("array<double>").alias("vec"))
    # ceil(tokens / block) hash blocks per (sample, side): dense, about
    # ``block`` tokens each, whatever the positions look like
    n = v.groupBy("sample_id").agg(
        F.ceil(F.count_if(F.col("side") == "pred") / F.lit(block)).alias("_npb"),
        F.ceil(F.count_if(F.col("side") == "ref") / F.lit(block)).alias("_nrb"))
    # a one-sided sample has no tile (``bertscore_samples`` scores it 0)
    v = (v.join(n.where("_npb > 0 and _nrb > 0"), "sample_id")
          .withColumn("blk", F.pmod(F.xxhash64("pos"),
                                    F.when(F.col("side") == "pred", F.col("_npb")).otherwise(F.col("_nrb")))))
    blocks = v.groupBy("sample_id", "side", "blk", "_npb", "_nrb").agg(
        F.collect_list("pos").alias("poss"), F.collect_list("vec").alias("vecs"))
    # every (pred block, ref block) tile gets its own join key, so one large
    # sample becomes many independent, evenly hashed tiles (no skewed key)
    pred = blocks.where(F.col("side") == "pred").select(
        "sample_id", F.col("blk").alias("pb"), F.explode(F.sequence(F.lit(0), F.col("_nrb") - 1)).alias("rb"),
        F.col("poss").alias("ppos"), F.col("vecs").alias("pvec"))
    ref = blocks.where(F.col("side") == "ref").select(
        "sample_id", F.col("blk").alias("rb"), F.explode(F.sequence(F.lit(0), F.col("_npb") - 1)).alias("pb"),
        F.col("poss").alias("rpos"), F.col("vecs").alias("rvec"))
    tiles = pred.join(ref, ["sample_id", "pb", "rb"]).select("sample_id", "ppos", "pvec", "rpos", "rvec")
    best = tiles.mapInPandas(_tiles, _TILE_OUT.format(v.schema["sample_id"].dataType.simpleString()))
    return best.groupBy("sample_id", "side", "pos").agg(F.max("best").alias("best"))


def bertscore_samples(vectors: DataFrame, block: int = 256, digits: int | None = 6, **cols) -> DataFrame:
    """Per sample precision, recall and F1; a sample with an empty side scores
    0, as an empty answer does in the other metrics.  Sample ids may have any
    type."""
    best = token_best_matches(vectors, block, **cols)
    s = best.groupBy("sample_id").agg(
        F.avg(F.when(F.col("side") == "pred", F.col("best"))).alias("precision"),
        F.avg(F.when(F.col("side") == "ref", F.col("best"))).alias("recall"))
    ids = vectors.select(F.col(cols.get("sample_col", "sample_id")).alias("sample_id")).where(
        "sample_id is not null").distinct()
    s = ids.join(s, "sample_id", "left").select(
        "sample_id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("precision", "recall")])
    f1 = F.when((F.col("precision") + F.col("recall")) == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    s = s.withColumn("f1", f1)
    if digits is not None:
        s = s.select("sample_id", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")])
    return s


def bertscore(vectors: DataFrame, block: int = 256, group_by: str | None = None, **cols) -> DataFrame:
    """Mean F1 over samples (plus mean P and R), optionally per value of a
    column of ``vectors`` that is constant within a sample."""
    s = bertscore_samples(vectors, block, digits=None, **cols)
    if group_by is not None:
        of = vectors.groupBy(F.col(cols.get("sample_col", "sample_id")).alias("sample_id")).agg(
            F.first(group_by).alias(group_by))
        s = s.join(of, "sample_id")
    return (s.groupBy() if group_by is None else s.groupBy(group_by)).agg(F.count(F.lit(1)).alias("num_samples"),
                 F.round(F.avg("precision"), 6).alias("bertscore_precision"),
                 F.round(F.avg("recall"), 6).alias("bertscore_recall"),
                 F.round(F.avg("f1"), 6).alias("bertscore_f1"))


def idf_weights(vectors: DataFrame, token_col: str = "token", sample_col: str = "sample_id", side_col: str = "side") -> DataFrame:
    """(token, idf): log((N + 1) / (d + 1)) of N references, of which d hold
    the token; tokens of predictions alone have d = 0.  One row per distinct
    token; counts are combined before the shuffle."""
    is_ref = F.col(side_col) == "ref"
    held = (vectors.where(F.col(token_col).isNotNull()).groupBy(F.col(token_col).alias("token"), F.col(sample_col).alias("s"))
            .agg(F.max(is_ref).alias("in_ref")).groupBy("token").agg(F.count_if("in_ref").alias("d")))
    n = vectors.where(is_ref).select(F.count_distinct(sample_col)).first()[0]
    return held.select("token", F.log((F.lit(n) + 1) / (F.col("d") + 1)).alias("idf"))


def bertscore_weighted(vectors: DataFrame, token_col: str = "token", block: int = 256, digits: int | None = 6,
                       baseline: tuple[float, float, float] | None = None, **cols) -> DataFrame:
    """Per sample precision, recall and F1 with every token's best match
    weighted by its inverse document frequency among the references.

    ``baseline`` (precision, recall, F1) rescales x to (x - b) / (1 - b).
    Tokens without a text weigh nothing; a side whose tokens weigh nothing
    scores 0 before rescaling, as an empty one does.  Sample ids may have any
    type, but not be null."""
    sample, side, pos = (F.col(cols.get(k, d)) for k, d in (("sample_col", "sample_id"), ("side_col", "side"), ("pos_col", "pos")))
    best = token_best_matches(vectors, block, **cols)
    tokens = vectors.select(sample.alias("sample_id"), side.alias("side"), pos.cast("bigint").alias("pos"), F.col(token_col).alias("token"))
    idf = idf_weights(vectors, token_col, cols.get("sample_col", "sample_id"), cols.get("side_col", "side"))
    w = best.join(tokens, ["sample_id", "side", "pos"]).join(idf, "token")

    def mean(name):
        mine = F.col("side") == name
        return F.sum(F.when(mine, F.col("idf") * F.col("best"))) / F.nullif(F.sum(F.when(mine, F.col("idf"))), F.lit(0.0))
    s = w.groupBy("sample_id").agg(mean("pred").alias("precision"), mean("ref").alias("recall"))
    ids = vectors.select(sample.alias("sample_id")).where("sample_id is not null").distinct()
    s = ids.join(s, "sample_id", "left").select("sample_id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("precision", "recall")])
    total = F.col("precision") + F.col("recall")
    s = s.withColumn("f1", F.when(total == 0, F.lit(0.0)).otherwise(F.lit(2.0) * F.col("precision") * F.col("recall") / total))
    for c, b in zip(("precision", "recall", "f1"), baseline or (0.0, 0.0, 0.0)):
        s = s.withColumn(c, (F.col(c) - F.lit(b)) / F.lit(1.0 - b))
    return s if digits is None else s.select("sample_id", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")])


# ------------------------------------------------------------ text -> vectors

class HashingEncoder:
    """Deterministic stand-in for a contextual encoder: lower-cased word
    tokens, each mapped to a fixed pseudo-random unit vector made from the
    word's BLAKE2b digest.  Real use passes a factory that loads a BERT-style model with
    the same interface: ``encoder(list[str]) -> list[(tokens, matrix)]``."""

    def __init__(self, dim: int = 64):
        self.dim = dim
        self.cache_key = f"hashing-encoder:{dim}"

    def __call__(self):
        import hashlib
        import re

        dim = self.dim
        tok = re.compile(r"[^\W_]+")

        memo: dict = {}

        def vec(word):
            v = memo.get(word)
            if v is None:
                raw = b"".join(hashlib.blake2b(word.encode("utf-8"), digest_size=64,
                                               salt=i.to_bytes(16, "little")).digest()
                               for i in range(-(-dim // 64)))
                v = np.frombuffer(raw, dtype=np.uint8)[:dim].astype(np.float64) - 127.5
                v = v / np.linalg.norm(v)
                if len(memo) < 1 << 16:
                    memo[word] = v
            return v

        def encode(texts):
            out = []
            for t in texts:
                words = tok.findall((t or "").lower())
                out.append((words, np.array([vec(w) for w in words]).reshape(len(words), dim)))
            return out
        return encode

    def __repr__(self):
        return self.cache_key


TEXT_BYTES = 1 << 18     # text given to the encoder at once; one longer row is given alone


def _text_slices(batches, texts: list[int]):
    """Batches cut so that the texts in columns ``texts`` hold at most
    ``TEXT_BYTES``: token vectors take a hundred times the room of their text."""
    for b in batches:
        ends = np.cumsum(sum(pc.fill_null(pc.binary_length(b.column(c).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
                             for c in texts))
        lo = 0
        while lo < b.num_rows:
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + TEXT_BYTES, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def text_token_vectors(df: DataFrame, encoder_factory, id_col: str = "sample_id",
                       pred_col: str = "prediction", ref_col: str = "reference") -> DataFrame:
    """Encode predictions and references into the token-vector table that
    ``bertscore`` reads (one row per token).  The encoder is built once per
    Python worker and sees slices of Arrow batches, bounded in bytes of text.
    Ids keep their type."""
    from vqaspark.operators.predict import _factory_key, _load
    key = _factory_key(encoder_factory)
    texts = df.select(F.col(id_col).alias("sample_id"),
                      F.explode(F.array(F.struct(F.lit("pred").alias("side"), F.col(pred_col).alias("text")),
                                        F.struct(F.lit("ref").alias("side"), F.col(ref_col).alias("text"))))
                       .alias("t")).select("sample_id", "t.side", "t.text")
    out = T.StructType([texts.schema["sample_id"], T.StructField("side", T.StringType()), T.StructField("pos", T.LongType()),
                        T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def run(batches):
        enc = _load(encoder_factory, key)
        for b in _text_slices(batches, [2]):
            found = enc(b.column(2).to_pylist())
            n = np.array([len(words) for words, _ in found], np.int64)
            of = np.repeat(np.arange(len(n)), n)
            pos = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            vectors = [v for words, mat in found for v in mat[:len(words)].tolist()]
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(pos, pa.int64()),
                                              pa.array(vectors, pa.list_(pa.float64()))], names=out.names)
    return texts.mapInArrow(run, out)


def _greedy_prf(p: np.ndarray, r: np.ndarray, chunk: int):
    """Greedy-matching P/R/F1 of two token matrices, in tiles so the
    similarity matrix never exceeds ``chunk x chunk``."""
    if len(p) == 0 or len(r) == 0:
        return 0.0, 0.0, 0.0
    p = p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-300)
    r = r / np.maximum(np.linalg.norm(r, axis=1, keepdims=True), 1e-300)
    best_p = np.full(len(p), -np.inf)
    best_r = np.full(len(r), -np.inf)
    for s in range(0, len(p), chunk):
        for t in range(0, len(r), chunk):
            sim = p[s:s + chunk] @ r[t:t + chunk].T
            np.maximum(best_p[s:s + chunk], sim.max(axis=1), out=best_p[s:s + chunk])
            np.maximum(best_r[t:t + chunk], sim.max(axis=0), out=best_r[t:t + chunk])
    prec, rec = float(best_p.mean()), float(best_r.mean())
    f1 = 0.0 if prec + rec == 0 else 2 * prec * rec / (prec + rec)
    return prec, rec, f1


def bertscore_from_text(df: DataFrame, encoder_factory, id_col: str = "sample_id",
                        pred_col: str = "prediction", ref_col: str = "reference",
                        chunk: int = 2048, digits: int | None = 6) -> DataFrame:
    """Per-pair BERTScore from text: each row is encoded (the encoder sees
    slices of the batch, bounded in bytes of text) and matched in place -- no
    token table, no shuffle.  Pairs with an empty side score 0; ids of any type, null ones too,
    come out as they are."""
    from vqaspark.operators.predict import _factory_key, _load
    key = _factory_key(encoder_factory)
    src = df.select(F.col(id_col).alias("sample_id"), F.col(pred_col).alias("_p"), F.col(ref_col).alias("_r"))
    names = ["precision", "recall", "f1"]
    out = T.StructType([src.schema["sample_id"], *[T.StructField(c, T.DoubleType()) for c in names]])

    def run(batches):
        enc = _load(encoder_factory, key)
        for b in _text_slices(batches, [1, 2]):
            pairs = zip(enc(b.column(1).to_pylist()), enc(b.column(2).to_pylist()))
            res = np.array([_greedy_prf(x[1], y[1], chunk) for x, y in pairs], np.float64).reshape(-1, 3)
            if digits is not None:
                res = res.round(digits)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(res[:, i]) for i in range(3)]], names=out.names)
    return src.mapInArrow(run, out)
