"""Helpers shared by the text operators: Arrow batches cut by size, byte-level
word splitting with numpy, and scratch tables in the cluster's shared folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.session import scratch_path

# Bytes of text handled at once inside a task; one longer text is one slice.
SLICE_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of words `[^\x20\x09-\x0D]+`.
NOT_SPACE = ~_SPACE
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def string_array(col) -> pa.Array:
    """One contiguous string array without nulls (null counts as empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and n + 1 offsets into them, from 0."""
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, o - o[0]


def slices(lengths: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one longer row is alone)."""
    lo, n = 0, len(lengths)
    ends = np.cumsum(lengths)
    while lo < n:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield lo, hi
        lo = hi


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    col = string_array(col)
    lengths = np.diff(text_bytes(col)[1])
    for lo, hi in slices(lengths, limit):
        yield lo, col.slice(lo, hi - lo)


class Words:
    """The words of a slice of texts, found byte-wise.

    ``buf`` bytes (A-Z lowered if asked), ``offsets`` of texts in it, word
    ``starts``/``ends`` in it, and ``first``: index of each text's first word
    (n + 1 values)."""

    def __init__(self, col: pa.Array, word_bytes: np.ndarray = NOT_SPACE, lower: bool = False):
        buf, self.offsets = text_bytes(col)
        self.buf = LOWER[buf] if lower else buf
        self.inside = word_bytes[self.buf]
        st = self.inside.copy()
        if len(st):
            st[1:] &= ~self.inside[:-1]
            heads = self.offsets[:-1]
            heads = heads[heads < len(buf)]
            st[heads] = self.inside[heads]
        self.starts = np.flatnonzero(st)
        self._cum = np.cumsum(self.inside, dtype=np.int64)
        o = np.append(self._cum[self.starts] - 1, self._cum[-1] if len(buf) else 0)
        self._packed = o
        self.ends = self.starts + np.diff(o)
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts), dtype=np.int64), self.counts)

    def array(self) -> pa.Array:
        """The words as an Arrow binary array (no copy of single words)."""
        data = self.buf[self.inside]
        return pa.Array.from_buffers(pa.binary(), len(self), [
            None, pa.py_buffer(self._packed.astype(np.int32)), pa.py_buffer(data)])

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """Each word's code and the distinct words."""
        if not len(self):
            return np.zeros(0, np.int64), pa.array([], pa.binary())
        d = self.array().dictionary_encode()
        return np.asarray(d.indices).astype(np.int64), d.dictionary


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets (empty ranges: 0)."""
    cum = np.concatenate([np.zeros(1, np.int64 if values.dtype.kind in "bui" else np.float64),
                          np.cumsum(values, dtype=np.int64 if values.dtype.kind in "bui" else np.float64)])
    return cum[offsets[1:]] - cum[offsets[:-1]]


def hash_binary(arr: pa.Array) -> np.ndarray:
    """64-bit hashes of binary values: a polynomial over the bytes, finalised."""
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint64)
    _, offs, data = arr.buffers()
    o = np.frombuffer(offs, np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    o = o - o[0]
    length = np.diff(o)
    out = mix64(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(-length, kind="stable")
    starts, lens = o[:-1][order], length[order]
    state = out[order]
    alive, k = len(order), 0
    while True:                                  # eight bytes of all long enough words at a time
        alive = int(np.searchsorted(-lens[:alive], -8 * k, side="left"))
        if alive == 0:
            break
        word = np.zeros(alive, np.uint64)
        for j in range(8):
            pos = starts[:alive] + 8 * k + j
            ok = 8 * k + j < lens[:alive]
            live = int(np.count_nonzero(ok))     # lens are descending, so ok is a prefix
            word[:live] |= buf[pos[:live]].astype(np.uint64) << np.uint64(8 * j)
        state[:alive] = mix64(state[:alive] ^ (word * np.uint64(0x9E3779B97F4A7C15)))
        k += 1
    res = np.empty(n, np.uint64)
    res[order] = state
    return res


def give_back() -> None:
    """Return freed memory to the system.  Python workers outlive their tasks,
    and what the allocators keep would add up beside the next task's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # not the GNU C library
        pass


def map_text(df: DataFrame, text_col: str, fn: Callable[[pa.Array], list], fields: list[T.StructField],
             limit: int = SLICE_BYTES) -> DataFrame:
    """Append columns computed from the text of each row.

    ``fn`` gets a slice of texts (nulls as empty) and returns one Arrow array
    or numpy array per field.  All other columns stay as they are; an input
    column with the name of a result is replaced by the result."""
    names = {f.name for f in fields}
    keep = [c for c in df.columns if c not in names]
    base = df.select(*[F.col(f"`{c}`") for c in keep]) if text_col in keep else df.select(
        *[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__text"))
    source = text_col if text_col in keep else "__text"
    out = T.StructType([f for f in base.schema.fields if f.name != "__text"] + fields)

    def run(batches):
        for b in batches:
            col = b.column(b.schema.get_field_index(source))
            for lo, part in text_slices(col, limit):
                cols = [b.column(i).slice(lo, len(part)) for i, nm in enumerate(b.schema.names) if nm != "__text"]
                res = [x if isinstance(x, pa.Array) else pa.array(x) for x in fn(part)]
                yield pa.RecordBatch.from_arrays(cols + res, names=[f.name for f in out.fields])
                del cols, res
        give_back()

    return base.mapInArrow(run, out)


def write_scratch(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and reread
    it: later jobs start from the files, whatever executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SMALL_ROWS = 1 << 20     # rows of a few numbers that may be broadcast (some tens of MB)


def small(stored: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A stored table of a few numbers a row, marked for broadcast if it has at
    most so many rows (counted from the files); beyond, Spark picks the join."""
    return F.broadcast(stored) if stored.count() <= rows else stored


@contextmanager
def arrow_rows(spark, rows: int):
    """Hand at most ``rows`` rows to Python at once in the jobs run inside:
    with long texts, the session's default of 10,000 is a lot of memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def parts(spark, rows_or_bytes: float, per_part: float, least: int | None = None) -> int:
    """Partitions for an amount of work; at least the session's shuffle count."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least or n, int(rows_or_bytes // per_part) + 1)
