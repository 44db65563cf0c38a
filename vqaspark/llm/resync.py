"""Exact token counts of documents of any length (operator 12).

Texts of up to ``CHUNK_CHARS`` are encoded whole.  Longer ones are cut into
chunks that overlap their neighbours; chunks are rows that Spark deals to all
executors, each is encoded by itself with byte offsets, and neighbours are
spliced where their overlap proves that both agree with the whole text:

* at a position where both start a piece of the tokenizer's splitting pattern.
  The pattern looks at nothing before a piece, so from there on the right chunk
  splits as the whole text does, and up to there the left one does;
* or, where one unbroken piece spans the whole overlap, at a token that both
  have at the same bytes.  A sequence of tokens is the byte-pair encoding of its
  bytes if every two neighbours are the encoding of theirs, and each
  neighbourhood of the spliced sequence is one of the left or the right chunk.

Where neither is found the overlap at this boundary is widened and the text's
chunks are encoded again; a boundary whose overlap reaches half a chunk goes,
so that at last the text is encoded as one.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.llm.base import map_text, parts, write_scratch
from vqaspark.llm.tokens import tokenizer_path

CHUNK_CHARS = 65_536
OVERLAP_CHARS = 256      # on each side of a boundary, at first
WIDER = 8                # times, when neighbours do not agree
BATCH_BYTES = 1 << 20    # text encoded at once: the library keeps some 100 bytes a token

_LOADED: dict[str, "ByteLevel"] = {}


class ByteLevel:
    """A byte-level tokenizer file and the bytes of each of its tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(self.tok.to_str())
        if (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer") or spec["model"]["type"] != "BPE":
            raise ValueError(f"{path}: only byte-level BPE files without a normaliser")
        names = dict(spec["model"]["vocab"])
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = np.zeros(max([*names.values(), *added.values()]) + 1, np.int64)
        for token, i in names.items():
            self.bytes[i] = len(token)                       # one character of the vocabulary stands for one byte
        for token, i in added.items():
            self.bytes[i] = len(token.encode())
        #: A piece is settled if so many bytes after it are in view: the pattern looks one character
        #: ahead, and a special token that begins there must be seen whole.
        self.margin = max([8, *(len(t.encode()) + 4 for t in added)])

    def count(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, n + 1 byte offsets, and whether each token starts a piece."""
        e = self.tok.encode(text, add_special_tokens=False)
        ids = np.asarray(e.ids, np.int64)
        word = np.asarray([-1 if w is None else w for w in e.word_ids], np.int64)
        first = np.ones(len(ids), bool)
        first[1:] = word[1:] != word[:-1]
        return ids, np.concatenate([[0], np.cumsum(self.bytes[ids])]), first


def loaded(path: str) -> ByteLevel:
    if path not in _LOADED:
        _LOADED[path] = ByteLevel(path)
    return _LOADED[path]


def _pack(at, ids, first) -> bytes:
    return np.stack([at, ids, first]).astype("<i8").tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, ids, first = np.frombuffer(data, "<i8").reshape(3, -1)
    return at, ids, first.astype(bool)


def edges(tok: ByteLevel, part: str, lo: int, start: int, end: int, hi: int, n: int) -> dict:
    """One chunk encoded: its number of tokens, and the tokens of both overlaps
    with their bytes counted from the boundary.

    The chunk owns characters ``start`` to ``end`` of a text of ``n``; ``part``
    is the text from ``lo`` to ``hi``."""
    ids, offs, first = tok.encode(part)
    out = {"total": len(ids), "left": None, "right": None, "before": 0, "limit": 0}
    if start > 0:
        head = len(part[:start - lo].encode())
        m = int(np.searchsorted(offs[:-1], len(part[:2 * (start - lo)].encode())))
        out["left"] = _pack(offs[:m] - head, ids[:m], first[:m])
    if end < n:
        here = len(part[:end - lo].encode())
        back = len(part[:max(end - (hi - end) - lo, 0)].encode())
        m = int(np.searchsorted(offs[1:], back, side="right"))
        out["before"] = m
        out["right"] = _pack(offs[m:-1] - here, ids[m:], first[m:])
        out["limit"] = int(offs[-1]) - here - (0 if hi == n else tok.margin)
    return out


def splice(left: bytes, before: int, total: int, limit: int, right: bytes, lengths: np.ndarray) -> int | None:
    """Tokens that two neighbouring chunks count beyond the whole text's, or
    None where their overlap proves no common boundary.

    ``left``: the left chunk's tokens in the overlap, ``before`` of its
    ``total`` come earlier; ``right``: the right chunk's first tokens."""
    a_at, a_id, a_first = _unpack(left)
    b_at, b_id, b_first = _unpack(right)
    if not len(b_at):
        return None
    a_in = (a_at > b_at[0]) & (a_at <= limit)
    b_in = (b_at > b_at[0]) & (b_at <= limit)
    a_cut, b_cut = np.flatnonzero(a_in & a_first), np.flatnonzero(b_in & b_first)
    both, i, j = np.intersect1d(a_at[a_cut], b_at[b_cut], return_indices=True)
    if len(both):
        return total - before - int(a_cut[i[0]]) + int(b_cut[j[0]])
    if len(a_cut) or len(b_cut):
        return None
    # One piece spans the overlap: a token at the same bytes in both.
    a_in &= a_at + lengths[a_id] <= limit
    b_in &= b_at + lengths[b_id] <= limit
    a_at, b_at = np.where(a_in, a_at, limit + 1), np.where(b_in, b_at, limit + 2)
    both, i, j = np.intersect1d(a_at, b_at, return_indices=True)
    same = np.flatnonzero(a_id[i] == b_id[j])
    return total - before - int(i[same[0]]) + int(j[same[0]]) if len(same) else None


def _batched(rows, schema: pa.Schema, size, limit: int = 4 << 20):
    """Rows (tuples) as record batches of about ``limit`` by ``size``."""
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += size(r) + 64
        if total >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _cut():
    """Rows (digest, text, boundaries, overlaps) to chunk rows."""
    schema = pa.schema([("d", pa.string()), ("n", pa.int64()), ("lo", pa.int64()), ("start", pa.int64()),
                        ("end", pa.int64()), ("hi", pa.int64()), ("part", pa.string())])

    def rows_of(batches):
        for b in batches:
            for k in range(b.num_rows):
                d, text, bounds, wide = (b.column(i)[k].as_py() for i in range(4))
                n, at = len(text), [0, *bounds, len(text)]
                for i in range(len(at) - 1):
                    lo = max(at[i] - wide[i - 1], 0) if i else 0
                    hi = min(at[i + 1] + wide[i], n) if i < len(bounds) else n
                    yield d, n, lo, at[i], at[i + 1], hi, text[lo:hi]

    def run(batches):
        return _batched(rows_of(batches), schema, lambda r: len(r[-1]))

    return run, "d string, n long, lo long, start long, end long, hi long, part string"


def _encode(path: str):
    schema = pa.schema([("d", pa.string()), ("n", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("wide", pa.int64()),
                        ("total", pa.int64()), ("before", pa.int64()), ("limit", pa.int64()),
                        ("left", pa.binary()), ("right", pa.binary())])

    def rows_of(batches):
        for b in batches:
            for r in range(b.num_rows):
                d, n, lo, start, end, hi, part = (b.column(i)[r].as_py() for i in range(7))
                e = edges(loaded(path), part, lo, start, end, hi, n)
                yield d, n, start, end, hi - end, e["total"], e["before"], e["limit"], e["left"], e["right"]

    def run(batches):
        return _batched(rows_of(batches), schema, lambda r: len(r[-1] or b"") + len(r[-2] or b""))

    return run, "d string, n long, start long, end long, wide long, total long, before long, limit long, left binary, right binary"


def _splice(path: str):
    schema = pa.schema([("d", pa.string()), ("at", pa.int64()), ("wide", pa.int64()), ("excess", pa.int64())])

    def run(batches):
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(8)))
            out = [(d, at, wide, splice(left, before, total, limit, right, loaded(path).bytes))
                   for d, at, wide, left, before, total, limit, right in rows]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(schema.types)], schema=schema)

    return run, "d string, at long, wide long, excess long"


def _long_counts(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(d, n_tokens) of distinct long texts (d, text)."""
    spark = texts.sparkSession
    cut, cut_schema = _cut()
    enc, enc_schema = _encode(path)
    spl, spl_schema = _splice(path)
    bounds = F.sequence(F.lit(chunk).cast("long"), F.length("text").cast("long") - 1, F.lit(chunk).cast("long"))
    todo = texts.select("d", "text", bounds.alias("bounds"), F.transform(bounds, lambda _: F.lit(overlap).cast("long")).alias("wide"))
    done = []
    while True:
        chunks = (todo.mapInArrow(cut, cut_schema).dropDuplicates(["d", "start"])     # copies of a long text: once
                  .repartition(parts(spark, 0, 1), "d", "start"))
        coded = write_scratch(chunks.mapInArrow(enc, enc_schema), "op12-chunks")
        left = coded.where("end < n").select("d", F.col("end").alias("at"), "wide", F.col("right").alias("l"), "before", "total", "limit")
        right = coded.where("start > 0").select("d", F.col("start").alias("at"), F.col("left").alias("r"))
        met = left.join(right, ["d", "at"]).select("d", "at", "wide", "l", "before", "total", "limit", "r")
        joins = write_scratch(met.mapInArrow(spl, spl_schema), "op12-boundaries")
        open_ = joins.where("excess is null").select("d").distinct()
        totals = coded.groupBy("d").agg(F.sum("total").alias("total"))
        excess = joins.groupBy("d").agg(F.sum("excess").alias("excess"))
        done.append(totals.join(open_, "d", "left_anti").join(excess, "d", "left")
                    .select("d", (F.col("total") - F.coalesce("excess", F.lit(0))).alias("n_tokens")))
        if open_.isEmpty():
            break
        # Widen the overlaps without agreement; at half a chunk the boundary goes.
        half = F.lit(chunk // 2).cast("long")
        failed = F.col("excess").isNull()
        kept = joins.join(open_, "d", "left_semi").groupBy("d").agg(F.sort_array(F.collect_list(F.when(
            ~failed | (F.col("wide") < half), F.struct("at", F.when(failed, F.least(F.col("wide") * WIDER, half)).otherwise(
                F.col("wide")).alias("wide"))))).alias("b"))
        plan = kept.select("d", F.col("b.at").alias("bounds"), F.col("b.wide").alias("wide"))
        todo = texts.join(plan, "d").select("d", "text", "bounds", "wide")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def token_counts(docs: DataFrame, text_col: str = "text", path: str | None = None, limit: int = 1024,
                 chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Append ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than
    ``limit`` tokens), as the tokenizer file at ``path`` counts the whole text:
    no added, begin or end tokens; strings of special tokens count as those.

    Null and empty texts have no bytes and no tokens.  All rows and other
    columns stay; an input column named as a result is replaced.  Equal long
    texts are encoded once and joined back by their SHA-256."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    if not 0 < overlap <= chunk // 2:
        raise ValueError("overlap must be between 1 and half a chunk")
    new = ("n_bytes", "n_tokens", "over_limit")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    text = F.col(f"`{text_col}`")
    base = docs.select(*kept, text.alias("__t"))
    size = F.coalesce(F.length("__t"), F.lit(0))

    def whole(col):
        return [pa.array(loaded(path).count(col.to_pylist()), pa.int64())]

    n = [T.StructField("__n", T.LongType())]
    short = map_text(base.where(size <= chunk), "__t", whole, n, BATCH_BYTES)
    long = base.where(size > chunk).withColumn("__d", F.sha2("__t", 256))
    counts = _long_counts(long.select(F.col("__d").alias("d"), F.col("__t").alias("text")), path, chunk, overlap)
    long = long.join(counts.select(F.col("d").alias("__d"), F.col("n_tokens").alias("__n")), "__d").drop("__d")
    out = short.unionByName(long)
    return out.select(*kept, F.coalesce(F.octet_length("__t"), F.lit(0)).cast("long").alias("n_bytes"),
                      F.col("__n").alias("n_tokens"), (F.col("__n") > limit).alias("over_limit"))
