"""Token-id files with canonical, length-limited Huffman codes (operator 4).

Counts of all ids give one code for the whole corpus (package-merge keeps
every length within ``MAX_BITS``).  Documents are stored in ascending id order
in blocks that can be read alone; a block holds its documents' ids and sizes,
their bit streams (each begins at a 32-bit word) and a bit offset for every
``CHECKPOINT`` tokens.  Decoding looks up ``MAX_BITS`` bits at a time in one
table and walks all checkpoints of a block side by side.

A stored corpus is a folder of two Parquet tables, ``blocks`` and ``code``
(symbol, bits); Spark's commit protocol makes them appear whole or not at all.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.llm.base import parts, slices, small, write_scratch
from vqaspark.session import scratch_path

MAX_BITS = 18            # longest code; 2^18 decoding entries
CHECKPOINT = 128         # tokens between bit offsets
BLOCK_TOKENS = 1 << 20   # tokens after which a block is closed


# -- the code -----------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); symbols
    that never occur get 0.  One symbol alone gets one bit."""
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return out
    if n == 1:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order]
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([coins, packages])
        at = np.argsort(both, kind="stable")            # symbols before packages among equals
        levels.append(at < n)
        merged = both[at]
        packages = merged[0:len(merged) // 2 * 2:2] + merged[1:len(merged) // 2 * 2:2]
    take = 2 * n - 2
    bits = np.zeros(n, np.int64)
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        bits[:symbols] += 1                             # the lightest symbols are chosen first
        take = 2 * (take - symbols)
    out[order] = bits
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code words by (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        size = lengths[order].astype(np.int64)
        top = int(size.max())
        step = np.int64(1) << (top - size)
        codes[order] = ((np.cumsum(step) - step) >> (top - size)).astype(np.uint32)
    return codes


class Code:
    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint8)
        self.words = canonical(self.lengths)
        self._table = None

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length for every ``MAX_BITS``-bit prefix."""
        if self._table is None:
            order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
            order = order[self.lengths[order] > 0]
            span = np.int64(1) << (MAX_BITS - self.lengths[order].astype(np.int64))
            sym, size = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.uint8)
            sym[:span.sum()] = np.repeat(order, span)
            size[:span.sum()] = np.repeat(self.lengths[order], span)
            self._table = sym, size
        return self._table

    def encode(self, ids: np.ndarray, offsets: np.ndarray):
        """Bit streams of several documents: 32-bit words, word offsets of the
        documents, and the checkpoints (bit offsets from the document's start)
        with their offsets."""
        n = np.diff(offsets)
        size = self.lengths[ids].astype(np.int64)
        cum = np.concatenate([[0], np.cumsum(size)])
        bits = cum[offsets[1:]] - cum[offsets[:-1]]
        word0 = np.concatenate([[0], np.cumsum((bits + 31) // 32)])
        within = cum[:-1] - np.repeat(cum[offsets[:-1]], n)          # bit offset in the document
        first = np.repeat(offsets[:-1], n)
        checks = within[(np.arange(len(ids)) - first) % CHECKPOINT == 0].astype(np.uint32)
        check0 = np.concatenate([[0], np.cumsum((n + CHECKPOINT - 1) // CHECKPOINT)])
        out = np.zeros(word0[-1] + 1, np.uint64)
        if len(ids):
            at = within + 32 * np.repeat(word0[:-1], n)
            word = at >> 5
            v = self.words[ids].astype(np.uint64) << (64 - (at & 31) - size).astype(np.uint64)
            runs = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
            w = word[runs]
            out[w] += np.add.reduceat(v >> np.uint64(32), runs)
            out[w + 1] += np.add.reduceat(v & np.uint64(0xFFFFFFFF), runs)
        return out[:-1].astype(">u4"), word0, checks, check0

    def decode(self, words: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of segments that start at bit ``starts`` and hold ``counts`` tokens."""
        sym, size = self.table()
        w = np.concatenate([words.astype(np.uint64), np.zeros(2, np.uint64)])
        out0 = np.cumsum(counts) - counts
        ids = np.zeros(int(counts.sum()), np.uint32)
        order = np.argsort(-counts, kind="stable")
        pos, n, to = starts[order].astype(np.int64), counts[order], out0[order]
        alive = len(order)
        for step in range(int(n[0]) if alive else 0):
            alive = int(np.searchsorted(-n[:alive], -step, side="left"))
            p = pos[:alive]
            i = p >> 5
            window = ((w[i] << np.uint64(32)) | w[i + 1]) << (p & 31).astype(np.uint64)
            entry = (window >> np.uint64(64 - MAX_BITS)).astype(np.int64)
            ids[to[:alive] + step] = sym[entry]
            pos[:alive] = p + size[entry]
        return ids


# -- tables -------------------------------------------------------------------

def count_ids(ids: DataFrame, ids_col: str = "ids") -> np.ndarray:
    """How often each id occurs.  Collects a row per distinct id: at most the
    tokenizer's vocabulary."""
    def count(batches):
        for b in batches:
            data = b"".join(pc.drop_null(b.column(0)).to_pylist())
            n = np.bincount(np.frombuffer(data, "<u4").astype(np.int64))
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(n[at].astype(np.int64))],
                                             names=["id", "n"])

    rows = (ids.select(ids_col).mapInArrow(count, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(max([r["id"] for r in rows], default=-1) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


_DOC = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc", T.LongType()), T.StructField("n_tokens", T.LongType()),
                     T.StructField("bits", T.BinaryType()), T.StructField("checks", T.BinaryType())])
_BLOCK = ("part int, seq int, before long, n_docs int, n_tokens long, docs binary, no_id binary, counts binary, "
          "word_offsets binary, check_offsets binary, checks binary, bits binary")


def _cut(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    item = data.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer((offsets * item).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def write_ids(ids: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> None:
    """Store documents (an integer id, packed ids) in ascending id order.

    Null ids sort first; repeated ids are ordered by their tokens; null token
    lists count as empty.  ``ids`` is read several times: pass stored rows."""
    spark = ids.sparkSession
    lengths = code_lengths(count_ids(ids, ids_col))
    code = Code(lengths)
    # Parts are ranges of ids.  Their bounds come from the ids alone, so that rows
    # are coded once; null ids are in the first part.
    n_parts = parts(spark, 0, 1)
    bounds = ids.agg(F.percentile_approx(F.col(id_col).cast("long"), [i / n_parts for i in range(1, n_parts)],
                                         50 * n_parts)).first()[0] if n_parts > 1 else None
    bounds = np.unique(np.array(bounds or [], np.int64))

    def part_of(docs):
        p = np.searchsorted(bounds, docs.fill_null(0).to_numpy(), side="right")
        return pa.array(np.where(np.asarray(docs.is_null()), 0, p).astype(np.int32))

    def bits(batches):
        for b in batches:
            col = pc.fill_null(b.column(1), b"")
            size = pc.binary_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in slices(size):
                flat = np.frombuffer(b"".join(col.slice(lo, hi - lo).to_pylist()), "<u4").astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(size[lo:hi] // 4)])
                words, word0, checks, check0 = code.encode(flat, offsets)
                yield pa.RecordBatch.from_arrays(
                    [part_of(b.column(0).slice(lo, hi - lo)), b.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets)),
                     _cut(words, word0), _cut(checks, check0)], names=_DOC.names)

    coded = ids.select(F.col(id_col).cast("long").alias("doc"), F.col(ids_col).alias("ids")).mapInArrow(bits, _DOC)
    ordered = coded.repartition(n_parts, "part").sortWithinPartitions("part", "doc", "n_tokens", "bits")

    def blocks(batches):
        part, seq, before, held, n = None, 0, 0, [], 0

        def close():
            docs = pa.concat_arrays([h.column(1) for h in held])
            counts = np.concatenate([h.column(2).to_numpy() for h in held])
            size = np.concatenate([pc.binary_length(h.column(3)).to_numpy() for h in held]).astype(np.int64)
            n_checks = np.concatenate([pc.binary_length(h.column(4)).to_numpy() for h in held]).astype(np.int64)
            row = [part, seq, before, len(docs), int(counts.sum()),
                   pc.fill_null(docs, 0).to_numpy().astype("<i8").tobytes(),
                   np.asarray(docs.is_null()).astype(np.uint8).tobytes(), counts.astype("<i8").tobytes(),
                   np.cumsum(size // 4).astype("<i8").tobytes(), np.cumsum(n_checks // 4).astype("<i8").tobytes(),
                   b"".join(x for h in held for x in h.column(4).to_pylist()),
                   b"".join(x for h in held for x in h.column(3).to_pylist())]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema=schema)

        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int32()), ("n_tokens", pa.int64())]
                           + [(c, pa.binary()) for c in ("docs", "no_id", "counts", "word_offsets", "check_offsets",
                                                         "checks", "bits")])
        for b in batches:
            p = b.column(0).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(p)) + 1, [len(p)]]) if len(p) else [0]
            for a, z in zip(edges[:-1], edges[1:]):
                if part != p[a]:
                    if held:
                        yield close()
                    part, seq, before, held, n = int(p[a]), 0, 0, [], 0
                for lo, hi in slices(b.column(2).to_numpy()[a:z], BLOCK_TOKENS):
                    held.append(b.slice(a + lo, hi - lo))
                    n += int(pc.sum(held[-1].column(2)).as_py() or 0)
                    if n >= BLOCK_TOKENS:
                        yield close()
                        seq, before, held, n = seq + 1, before + n, [], 0
        if held:
            yield close()

    ordered.mapInArrow(blocks, _BLOCK).write.option("compression", "uncompressed").parquet(os.path.join(path, "blocks"))
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "symbol int, bits int").coalesce(1).write.parquet(
        os.path.join(path, "code"))


def read_ids(spark, path: str, out_id: str = "doc_id") -> DataFrame:
    """The stored documents: id, ``start`` (tokens of all documents before),
    ``n_tokens`` and ``ids``, every block decoded alone."""
    blocks = spark.read.parquet(os.path.join(path, "blocks"))
    code_rows = spark.read.parquet(os.path.join(path, "code")).collect()     # at most the vocabulary
    lengths = np.zeros(max([r["symbol"] for r in code_rows], default=-1) + 1, np.uint8)
    for r in code_rows:
        lengths[r["symbol"]] = r["bits"]
    code = Code(lengths)
    # Each block holds the tokens before it in its part; those of earlier parts are a row per part,
    # summed in one window (a part is a task's share of the ids, so these rows are few).
    all_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_part = write_scratch(blocks.groupBy("part").agg(F.sum("n_tokens").alias("t")).select(
        "part", F.coalesce(F.sum("t").over(all_before), F.lit(0)).alias("of_part")), "op4-parts")

    def decode(batches):
        for b in batches:
            for r in b.to_pylist():
                n = np.frombuffer(r["counts"], "<i8")
                word0 = np.concatenate([[0], np.frombuffer(r["word_offsets"], "<i8")])[:-1]
                check0 = np.concatenate([[0], np.frombuffer(r["check_offsets"], "<i8")])
                checks = np.frombuffer(r["checks"], "<u4").astype(np.int64)
                doc = np.repeat(np.arange(len(n)), np.diff(check0))
                nth = np.arange(len(checks)) - check0[doc]
                counts = np.minimum(CHECKPOINT, n[doc] - nth * CHECKPOINT)
                ids = code.decode(np.frombuffer(r["bits"], ">u4"), checks + 32 * word0[doc], counts)
                offsets = np.concatenate([[0], np.cumsum(n)])
                docs = pa.array(np.frombuffer(r["docs"], "<i8"), mask=np.frombuffer(r["no_id"], np.uint8).astype(bool))
                for lo, hi in slices(n * 4, 8 << 20):
                    part = ids[offsets[lo]:offsets[hi]].astype("<u4")
                    yield pa.RecordBatch.from_arrays(
                        [docs.slice(lo, hi - lo), pa.array(r["first"] + offsets[lo:hi]), pa.array(n[lo:hi]),
                         _cut(part, offsets[lo:hi + 1] - offsets[lo])], names=[out_id, "start", "n_tokens", "ids"])

    placed = blocks.join(small(of_part), "part").withColumn("first", F.col("before") + F.col("of_part"))
    return placed.select("counts", "word_offsets", "check_offsets", "checks", "bits", "docs", "no_id", "first").mapInArrow(
        decode, f"{out_id} long, start long, n_tokens long, ids binary")


def store_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                    tokenizer: str | None = None, end_id: int = 2) -> str:
    """Encode whole texts, end each with ``end_id``, and store them; returns the
    folder.  Null texts give the end id alone."""
    from vqaspark.llm import tokens
    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("__t"))
    end = F.lit(int(end_id).to_bytes(4, "little"))
    ids = tokens.encode(slim, "__t", tokenizer).select("doc", F.concat("ids", end).alias("ids"))
    stored = write_scratch(ids, "op4-ids", compression="zstd")
    path = path or scratch_path(docs.sparkSession, "op4-files")
    write_ids(stored, path, "doc", "ids")
    return path
