"""Splittable reader of large JSON files that are one object or one list
(S4, S5): many tasks read one file, and records keep their place in it.

The text source cuts a file into byte ranges at a byte that is not the escape
character, so a range begins outside any escape, but maybe inside a string and
at any depth.  A first pass sums up every range: whether it flips the string
state, and how it changes the depth if it begins outside or inside a string; one
row per range is combined in file order into each range's true start.  The
second pass then cuts the ranges at the separators of the wanted level.  An
entry that spans ranges comes in pieces, which are joined by its number: the
separators before it.
"""

from __future__ import annotations

import re
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vqaspark.session import scratch_path

_KEY = re.compile(rb'("(?:[^"\\]|\\.)*")\s*:\s*$', re.S)


def _structure(buf: np.ndarray, in_string: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Of some bytes: +1/-1 at opening and closing brackets and the commas,
    both outside strings only, and the number of quotes that are not escaped."""
    slash = buf == 0x5C
    quote = np.flatnonzero(buf == 0x22)
    if slash.any():
        at = np.arange(len(buf))
        plain = np.maximum.accumulate(np.where(slash, -1, at))        # the last byte that is no backslash
        run = quote - 1 - np.where(quote > 0, plain[quote - 1], -1)
        quote = quote[run % 2 == 0]
    flips = np.zeros(len(buf), np.int8)
    flips[quote] = 1
    outside = (np.cumsum(flips, dtype=np.int64) + in_string) % 2 == 0
    step = ((buf == 0x7B) | (buf == 0x5B)).astype(np.int8) - ((buf == 0x7D) | (buf == 0x5D)).astype(np.int8)
    return np.where(outside, step, 0), (buf == 0x2C) & outside, len(quote)


def _ranges(batches, cut: bytes):
    """((file, start of the byte range), bytes) of consecutive fragments."""
    for b in batches:
        rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())
        for key, part in groupby(rows, key=lambda r: (r[0], r[1])):
            yield key, b"".join(r[2].encode() + cut for r in part)


_SUMMARY = "file string, block long, flips boolean, outside long, inside long, top string, bytes long"


def _summaries(cut: bytes):
    def run(batches):
        key, state = None, None
        for k, data in _ranges(batches, cut):
            if k != key:
                if key is not None:
                    yield _summary(key, state)
                key, state = k, [0, 0, 0, None, 0]
            buf = np.frombuffer(data, np.uint8)
            if state[3] is None:
                head = data.lstrip(b"\xef\xbb\xbf \t\r\n")[:1]
                state[3] = head.decode("latin-1") if head else None
            state[4] += len(data)
            flipped = state[0] % 2 == 1
            out, _, quotes = _structure(buf, flipped)
            ins, _, _ = _structure(buf, not flipped)
            state[0], state[1], state[2] = state[0] + quotes, state[1] + int(out.sum()), state[2] + int(ins.sum())
        if key is not None:
            yield _summary(key, state)

    def _summary(key, s):
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([s[0] % 2 == 1]),
                                           pa.array([s[1]], pa.int64()), pa.array([s[2]], pa.int64()), pa.array([s[3]], pa.string()),
                                           pa.array([s[4]], pa.int64())], names=["file", "block", "flips", "outside", "inside", "top", "bytes"])

    return run


_PIECES = "file string, block long, i long, first boolean, last boolean, section string, section_i long, text binary"
_PIECE_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.int64(), pa.binary()]
_PIECE_NAMES = ["file", "block", "i", "first", "last", "section", "section_i", "text"]


class _Cutter:
    """Cuts one byte range, given in parts, at the separators of a level."""

    def __init__(self, key, in_string: bool, depth: int, level: int):
        self.key, self.in_string, self.depth, self.level = key, in_string, depth, level
        self.i, self.held, self.inside = 0, [], depth >= level
        self.section = self.section_i = None
        self.rows: list[tuple] = []

    def add(self, data: bytes) -> None:
        buf = np.frombuffer(data, np.uint8)
        step, comma, quotes = _structure(buf, self.in_string)
        depth = self.depth + np.cumsum(step, dtype=np.int64)
        cut = np.flatnonzero((comma & (depth == self.level)) | ((step == 1) & (depth == self.level)) | ((step == -1) & (depth == self.level - 1)))
        lo = 0
        for p, s, d in zip(cut.tolist(), step[cut].tolist(), depth[cut].tolist()):
            self.held.append(data[lo:p])
            self._end(opening=s == 1, last=False)
            self.inside = d == self.level
            lo = p + 1
        self.held.append(data[lo:])
        self.in_string ^= quotes % 2 == 1
        self.depth = int(depth[-1]) if len(depth) else self.depth

    def _end(self, opening: bool, last: bool) -> None:
        text = b"".join(self.held)
        if opening:
            key = _KEY.search(text)
            self.section, self.section_i = (key.group(1)[1:-1].decode() if key else ""), self.i
        elif self.inside:
            self.rows.append((*self.key, self.i, self.i == 0, last, self.section, self.section_i, text))
        self.i, self.held = self.i + (not last), []

    def close(self) -> list[tuple]:
        """The rest of the range is the last piece; with it goes a row with the
        number of separators (``text`` null)."""
        self._end(opening=False, last=True)
        return self.rows + [(*self.key, self.i, None, None, self.section, self.section_i, None)]


def _pieces(cut: bytes, starts: dict):
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_PIECE_TYPES)], names=_PIECE_NAMES)

    def run(batches):
        cutter = None
        for key, data in _ranges(batches, cut):
            if cutter is None or cutter.key != key:
                if cutter is not None:
                    yield batch(cutter.close())
                if key not in starts:
                    raise RuntimeError(f"{key}: the file's byte ranges changed between two passes; run again")
                cutter = _Cutter(key, *starts[key])
            cutter.add(data)
            if cutter.rows:
                rows, cutter.rows = cutter.rows, []
                yield batch(rows)
        if cutter is not None:
            yield batch(cutter.close())

    return run


def read_entries(spark: SparkSession, path: str, split_at: str = "}") -> DataFrame:
    """The entries of JSON files that are one list, or one object of lists and
    maps: ``file``, ``section`` (the object's key; '' for a list), ``position``
    in the section (from 0) and ``text``: an element of a list, or ``"key":
    value`` of a map.  Other values of an object are left out.

    ``split_at``: the byte at which the files may be cut; not a backslash or a
    quote.  A file is read by as many tasks as its length gives (by
    ``spark.sql.files.maxPartitionBytes``); fragments without that byte are not
    cut.  A file that ends before its brackets are closed raises; other broken
    JSON gives entries that do not parse, on which the callers' parsers fail."""
    cut = split_at.encode()
    if len(cut) != 1 or cut in b'\\"':
        raise ValueError("split_at must be one byte, not a backslash or a quote")
    files = spark.read.option("lineSep", split_at).text(path)
    raw = files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    summary = raw.mapInArrow(_summaries(cut), _SUMMARY).collect()          # a row per byte range
    sizes = {r["file"]: r["size"] for r in files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
             .groupBy("file").agg(F.first("size").alias("size")).collect()} if summary else {}
    starts: dict[tuple, tuple] = {}
    for file, rows in groupby(sorted(summary, key=lambda r: (r["file"], r["block"])), key=lambda r: r["file"]):
        in_string, depth, level, total = False, 0, None, 0
        for r in rows:
            total += r["bytes"]
            if level is None and r["top"] is not None:
                if r["top"] not in ("{", "[", split_at):      # the cut byte alone ends a blank file
                    raise ValueError(f"{r['file']}: neither an object nor a list")
                level = 1 if r["top"] == "[" else 2
            starts[r["file"], r["block"]] = (in_string, depth, level or 1)
            depth += r["inside"] if in_string else r["outside"]
            in_string ^= r["flips"]
        # The last fragment was given the cut byte too, whether or not the file ends with it.
        added = 1 if cut in (b"}", b"]") and not in_string and (total > sizes[file] or total == sizes[file] - 2) else 0
        if in_string or depth + added != 0:
            raise ValueError(f"MALFORMED JSON: {file} ends inside {'a string' if in_string else f'{depth + added} open values'}")
    where = scratch_path(spark, "json-pieces")
    raw.mapInArrow(_pieces(cut, starts), _PIECES).write.parquet(where)
    pieces = spark.read.parquet(where)

    # Per byte range, in file order: separators before it, and the section it begins in.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = pieces.where("text is null").select("file", "block", F.col("i").alias("n"), "section", "section_i")
    ranges = ranges.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
    opened = F.when(F.col("section").isNotNull(), F.struct("section", (F.col("base") + F.col("section_i")).alias("at")))
    ranges = ranges.withColumn("carried", F.last(opened, ignorenulls=True).over(before)).select("file", "block", "base", "carried")
    own = F.when(F.col("section").isNotNull(), F.struct("section", (F.col("base") + F.col("section_i")).alias("at")))
    placed = (pieces.where("text is not null").join(ranges, ["file", "block"])
              .select("file", "block", "first", "last", (F.col("base") + F.col("i")).alias("number"), F.coalesce(own, "carried").alias("s"), "text"))
    whole = placed.where("not first and not last").select("file", "number", "s", "text")
    joined = (placed.where("first or last").groupBy("file", "number")
              .agg(F.first("s", ignorenulls=True).alias("s"), F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
              .select("file", "number", "s", F.aggregate("parts.text", F.lit(b""), lambda a, b: F.concat(a, b)).alias("text")))
    out = whole.unionByName(joined).select("file", F.col("s.section").alias("section"), (F.col("number") - F.col("s.at") - 1).alias("position"),
                                           F.col("text").cast("string").alias("text"))
    return out.where(F.regexp_replace("text", r"[\s]+", "") != "")
