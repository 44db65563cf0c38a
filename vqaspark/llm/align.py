"""Alignment of two tokenizers' tokens of the same texts (operator 11).

Both tokenizers see a space and the text.  Where a token of each ends at the
same byte, both id lists are cut: the cumulative ends of each list are a
dictionary from end to index, the common keys are an intersection of hash sets,
and in sorted order they slice both lists into groups.  All pairs of tokens
within a group are linked.

Neither tokenizer ever joins a byte before a space to that space (checked on
the files), so a text is cut there first and each distinct segment of a block
of texts is encoded and aligned once; a text's groups are its segments' groups
in a row.

How often a pair of ids is linked is counted over the corpus in documents.  A
block of texts counts its pairs and asks for each of them once: blocks are
rows with their distinct pairs, joined with the summed counts.
"""

from __future__ import annotations

import hashlib
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vqaspark.llm.base import arrow_rows, give_back, per_text, slices, text_bytes, text_slices, write_scratch
from vqaspark.llm.tokens import tokenizer_path

BLOCK_BYTES = 8 << 20    # text of one block; one longer text is a block
ENCODE_AT_ONCE = 4_096   # segments given to a library, and aligned, in one call
ARROW_ROWS = 1_000       # documents handed to a task at once
MANY = 4_096             # links of one group from which equal ones are counted together

SPACE = "▁"         # a space in the pieces of the second tokenizer


class ByteTokens:
    """A byte-level BPE file; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = True
        spec = json.loads(self.tok.to_str())
        if (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path}: not a byte-level file")
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
        names = {t["content"]: t["id"] for t in spec["added_tokens"]} | spec["model"]["vocab"]
        spelled = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            spelled[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.bytes, self.length = pa.array(spelled, pa.binary()), np.asarray([len(x) for x in spelled])

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments, each with its leading space."""
        return [e.ids for e in self.tok.encode_batch_fast(segments, add_special_tokens=False)]

    def encode_joined(self, segments: str) -> list[int]:
        return self.tok.encode_batch_fast([segments], add_special_tokens=False)[0].ids


class PieceTokens:
    """A sentence-piece file, which adds the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError(f"{path}: pieces with a space after another character; texts cannot be cut at spaces")
        spelled = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.bytes, self.length = pa.array(spelled, pa.binary()), np.asarray([len(x) for x in spelled])
        self.space = [self.sp.piece_to_id(SPACE)]

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments, each with its leading space."""
        out = self.sp.encode([s[1:] for s in segments], num_threads=1)
        return [ids if len(s) > 1 else self.space for s, ids in zip(segments, out)]

    def encode_joined(self, segments: str) -> list[int]:
        return self.sp.encode(segments[1:])


_LOADED: dict[tuple, tuple] = {}


def loaded(paths: tuple[str, str]) -> tuple[ByteTokens, PieceTokens, "Marks"]:
    if paths not in _LOADED:
        left, right = ByteTokens(paths[0]), PieceTokens(paths[1])
        _LOADED[paths] = left, right, Marks(max(len(left.length), len(right.length)))
    return _LOADED[paths]


def ends_of(ids: np.ndarray, lengths: np.ndarray) -> dict[int, int]:
    """Cumulative byte end -> number of tokens up to there (of tokens without
    bytes, the last counts)."""
    return dict(zip(np.cumsum(lengths[ids]).tolist(), range(1, len(ids) + 1)))


def align(a: np.ndarray, b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray):
    """Where two id lists over the same bytes are cut: their common ends in
    order, and the number of tokens of each list up to them."""
    x, y = ends_of(a, a_lengths), ends_of(b, b_lengths)
    ends = sorted(x.keys() & y.keys())
    return (np.asarray(ends, np.int64), np.fromiter(map(x.__getitem__, ends), np.int64, len(ends)),
            np.fromiter(map(y.__getitem__, ends), np.int64, len(ends)))


def links(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of tokens within the groups that end at ``i`` and ``j``: the
    group, the pair (A id * 2^32 + B id) and how often it stands for a link.
    Groups of many pairs give each pair of ids once, with its number."""
    i0, j0 = np.append(0, i[:-1]).astype(np.int64), np.append(0, j[:-1]).astype(np.int64)
    na, nb = i - i0, j - j0
    many = na * nb > MANY
    n = np.where(many, 0, na * nb)
    group = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    pair = a[i0[group] + k // nb[group]] << 32 | b[j0[group] + k % nb[group]]
    times = np.ones(len(pair), np.int64)
    for g in np.flatnonzero(many):
        x, nx = np.unique(a[i0[g]:i[g]], return_counts=True)
        y, ny = np.unique(b[j0[g]:j[g]], return_counts=True)
        group = np.append(group, np.full(len(x) * len(y), g))
        pair = np.append(pair, (x[:, None] << 32 | y[None]).ravel())
        times = np.append(times, (nx[:, None] * ny[None]).ravel())
    if many.any():
        order = np.argsort(group, kind="stable")
        group, pair, times = group[order], pair[order], times[order]
    return group, pair, times


def spell(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, marks: "Marks") -> tuple[np.ndarray, np.ndarray]:
    """The groups as bytes, each ``a1,a2|b1;``, and where each token's id and
    the mark behind it end (A ids and B ids group by group)."""
    i0, j0 = np.append(0, i)[:-1].astype(np.int64), np.append(0, j)[:-1].astype(np.int64)
    x, y = a + marks.comma, b + marks.comma
    x[i - 1] += marks.bar - marks.comma
    y[j - 1] += marks.end - marks.comma
    item = np.empty(len(a) + len(b), np.int64)
    item[np.arange(len(a)) + np.repeat(j0, i - i0)] = x
    item[np.arange(len(b)) + np.repeat(i, j - j0)] = y
    return _large_bytes(marks.text.take(pa.array(item)))


class Marks:
    """Ids in decimal, each with a comma, a bar and a semicolon behind it."""

    def __init__(self, size: int):
        self.text = pa.array([f"{x}{m}" for m in ",|;" for x in range(size)], pa.large_binary())
        self.comma, self.bar, self.end = 0, size, 2 * size


def _large_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large binary array and n + 1 offsets into them, from 0."""
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = arr.buffers()
    o = np.frombuffer(offs, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    return (np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)), o - o[0]


# -- segments -----------------------------------------------------------------

def _closed(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the byte before each place certainly ends no white space."""
    last = buf[at - 1]
    safe = (last > 0x20) & (last < 0x7F)
    wide = np.flatnonzero((last >= 0x80) & (at >= 3))
    two, three = buf[at[wide] - 2], buf[at[wide] - 3]
    # White space beyond ASCII is U+0085, U+00A0 and characters that begin with the bytes
    # E1 9A, E2 80, E2 81 or E3 80; all that begin so are left alone.
    safe[wide] = ~((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3) & np.isin(two, (0x9A, 0x80, 0x81))))
    return safe


def segments(col: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Segments of a space and each text: their codes in order, n + 1 offsets
    of texts into them, and the distinct segments.  Empty texts have none."""
    joined = pc.binary_join_element_wise(pa.scalar(""), col, pa.scalar(" "))
    buf, offs = text_bytes(joined)
    empty = np.diff(offs) == 1
    spaces = np.flatnonzero(buf[1:] == 0x20) + 1
    start = np.zeros(len(buf), bool)
    start[spaces[_closed(buf, spaces)]] = True
    start[offs[:-1]] = True
    starts = np.flatnonzero(start)
    arr = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(np.append(starts, len(buf)).astype(np.int32)),
                                                           pa.py_buffer(np.ascontiguousarray(buf))])
    first = np.append(np.searchsorted(starts, offs[:-1]), len(starts))
    if empty.any():
        keep = np.ones(len(starts), bool)
        keep[first[:-1][empty]] = False
        arr, first = arr.filter(pa.array(keep)), np.concatenate([[0], np.cumsum(keep)])[first]
    if not len(arr):
        return np.zeros(0, np.int64), first, pa.array([], pa.string())
    d = arr.dictionary_encode()
    return np.asarray(d.indices).astype(np.int64), first, d.dictionary


def _spells(texts: pa.Array, ids: list[list[int]], token: pa.Array) -> np.ndarray:
    """Whether the tokens' bytes, joined, are each text's."""
    want, at = text_bytes(texts)
    flat = np.fromiter(chain.from_iterable(ids), np.int64)
    got = token.take(pa.array(flat))
    got_bytes, ends = text_bytes(got)
    per = ends[np.concatenate([[0], np.cumsum([len(x) for x in ids])])]
    out = np.diff(per) == np.diff(at)
    if out.all():
        differ = np.flatnonzero(want != got_bytes)
        out[np.searchsorted(at, differ, side="right") - 1] = False
        return out
    for k in np.flatnonzero(out):
        out[k] = np.array_equal(want[at[k]:at[k + 1]], got_bytes[per[k]:per[k + 1]])
    return out


def _in_one(texts: pa.Array, tokens, ids: list[int]) -> np.ndarray | None:
    """Ids of texts encoded as one string, or None if they do not spell it or
    a token spans two texts."""
    want, at = text_bytes(texts)
    flat = np.asarray(ids, np.int64)
    got, ends = text_bytes(tokens.bytes.take(pa.array(flat)))
    cut = np.searchsorted(ends, at)
    return flat if np.array_equal(want, got) and np.array_equal(ends[np.minimum(cut, len(ends) - 1)], at) else None


def _distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in order (by sorting: no hash table beside them)."""
    v = np.sort(values)
    keep = np.ones(len(v), bool)
    keep[1:] = v[1:] != v[:-1]
    return v[keep]


class Block:
    """Texts of one block, aligned through their distinct segments."""

    def __init__(self, col: pa.Array, paths: tuple[str, str]):
        self.codes, self.first, uniq = segments(col)
        buf, at = text_bytes(uniq)
        closed = _closed(buf, at[1:]) if len(uniq) else np.zeros(0, bool)
        # Segments that end in white space (a text's last) go to the end: they are encoded one by one.
        order = np.argsort(~closed, kind="stable")
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        self.codes, uniq, alone = back[self.codes], uniq.take(pa.array(order)), int(closed.sum())
        n = len(uniq)
        self.n_a, self.n_b, self.n_groups = (np.zeros(n, np.int64) for _ in range(3))
        self.good = np.ones(n, bool)
        self._parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._spelled: list[np.ndarray] = []
        size = np.zeros(n + 1, np.int64)                       # bytes of each segment's spelled groups
        for lo, hi, joined in [(0, alone, True), (alone, n, False)]:
            for x in range(lo, hi, ENCODE_AT_ONCE):
                m = min(ENCODE_AT_ONCE, hi - x)
                size[x + 1:x + m + 1] = self._add(uniq.slice(x, m), x, joined, *loaded(paths))
        self.spelled = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.cumsum(size)), pa.py_buffer(
            np.concatenate([np.zeros(0, np.uint8), *self._spelled]))])
        owner, pair, self.mult = (np.concatenate([np.zeros(0, np.int64), *(p[i] for p in self._parts)]) for i in range(3))
        del self._parts, self._spelled
        self.at = np.searchsorted(owner, np.arange(n + 1))
        self.n_links = per_text(self.mult, self.at)
        self.pairs = _distinct(pair)
        self.pair_at = np.searchsorted(self.pairs, pair).astype(np.int32)

    def _add(self, part: pa.Array, lo: int, joined: bool, left: ByteTokens, right: PieceTokens, marks: Marks) -> np.ndarray:
        """Encode and align some segments, in one string if they allow it.
        Returns the bytes of each one's spelled groups (0: not spelled by both)."""
        buf, at = text_bytes(part)
        good = np.ones(len(part), bool)
        whole = buf.tobytes().decode() if joined else ""
        ids = [_in_one(part, t, t.encode_joined(whole)) if joined else None for t in (left, right)]
        if any(x is None for x in ids):
            text = part.to_pylist()
            ids = [t.encode(text) for t in (left, right)]
            good = _spells(part, ids[0], left.bytes) & _spells(part, ids[1], right.bytes)
            ids = [np.fromiter(chain.from_iterable([i for i, g in zip(x, good) if g]), np.int64) for x in ids]
        a, b = ids
        own = lo + np.flatnonzero(good)
        self.good[lo:lo + len(part)] = good
        ends, i, j = align(a, b, left.length, right.length)
        close = np.cumsum(np.diff(at)[good])                                  # where segments end
        owner = np.searchsorted(close, ends, side="left")
        last = np.searchsorted(ends, close)                                   # a segment's end ends a group
        self.n_a[own], self.n_b[own] = np.diff(i[last], prepend=0), np.diff(j[last], prepend=0)
        self.n_groups[own] = np.bincount(owner, minlength=len(own))
        group, pair, times = links(a, b, i, j)
        self._parts.append((own[owner[group]], pair, times))
        data, ends = spell(a, b, i, j, marks)
        self._spelled.append(data)
        size = np.zeros(len(part), np.int64)
        size[good] = np.diff(ends[i[last] + j[last]], prepend=0)
        return size

    def valid(self) -> np.ndarray:
        """Texts with tokens: not empty, and spelled by both tokenizers."""
        bad = np.concatenate([[0], np.cumsum(~self.good[self.codes])])
        return (np.diff(self.first) > 0) & (bad[self.first[1:]] == bad[self.first[:-1]])

    def total(self, per_segment: np.ndarray, valid: np.ndarray) -> np.ndarray:
        cum = np.concatenate([[0], np.cumsum(per_segment[self.codes])])
        return np.where(valid, cum[self.first[1:]] - cum[self.first[:-1]], 0)

    def groups(self, valid: np.ndarray):
        """Each text's groups, one text at a time."""
        size = np.diff(_large_bytes(self.spelled)[1])
        size = per_text(size[self.codes], self.first)
        for lo, hi in slices(size):
            data = _large_bytes(self.spelled.take(pa.array(self.codes[self.first[lo]:self.first[hi]])))[0]
            ends = np.cumsum(size[lo:hi])
            for x, y, ok in zip((ends - size[lo:hi]).tolist(), ends.tolist(), valid[lo:hi]):
                yield data[x:y - 1].tobytes() if ok else b""        # without the last semicolon

    def distinct(self, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each valid text's distinct segments: text, segment, times."""
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        n = max(len(self.good), 1)
        keys = np.sort((doc * n + self.codes)[valid[doc]])
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first] // n, keys[first] % n, np.diff(first, append=len(keys))

    def documents(self, doc: np.ndarray, seg: np.ndarray) -> np.ndarray:
        """In how many texts each pair is linked."""
        n = self.at[seg + 1] - self.at[seg]
        ends = np.cumsum(n)
        at = np.repeat(self.at[seg] - (ends - n), n) + np.arange(n.sum())
        width = max(len(self.pairs), 1)
        once = _distinct(np.repeat(doc, n) * width + self.pair_at[at])
        return np.bincount(once % width, minlength=len(self.pairs))


def _bytes(x, kind: str) -> bytes:
    return np.ascontiguousarray(x, dtype=kind).tobytes()


DOC = [("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long"), ("groups_sha256", "string"), ("groups", "binary")]
OWN = [("block", "long"), ("segs", "binary"), ("times", "binary"),
       ("pairs", "binary"), ("docs", "binary"), ("seg_at", "binary"), ("seg_pairs", "binary"), ("seg_mult", "binary")]
_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _aligned(docs: DataFrame, paths: tuple[str, str], keep_groups: bool) -> DataFrame:
    """Rows of two kinds: a row per document with its counts and its distinct
    segments (as differences) and times; a row per block with its pairs, the
    number of its documents that have them, and each segment's links."""
    others = [f for f in docs.schema.fields if f.name != "__text"]
    plain = DOC + OWN

    def one(cols: list, text: pa.Array, number: int):
        k = Block(text, paths)
        ok = k.valid()
        spelled = [(hashlib.sha256(g).hexdigest() if v else "", g if keep_groups else None) for g, v in zip(k.groups(ok), ok)]
        doc, seg, times = k.distinct(ok)
        first = np.searchsorted(doc, np.arange(len(ok) + 1))
        step = np.diff(seg, prepend=0)
        step[first[:-1][np.diff(first) > 0]] = seg[first[:-1][np.diff(first) > 0]]
        cut = [(x, y) for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
        n = len(ok)
        values = {
            "n_a": k.total(k.n_a, ok), "n_b": k.total(k.n_b, ok), "n_groups": k.total(k.n_groups, ok), "n_links": k.total(k.n_links, ok),
            "groups_sha256": [d for d, _ in spelled], "groups": [g for _, g in spelled], "block": np.full(n, number),
            "segs": [_bytes(step[x:y], "<i4") for x, y in cut], "times": [_bytes(times[x:y], "<i4") for x, y in cut]}
        res = [pa.array(values[c], _ARROW[t]) if c in values else pa.nulls(n, _ARROW[t]) for c, t in plain]
        names = [f.name for f in others] + [c for c, _ in plain]
        yield pa.RecordBatch.from_arrays(cols + res, names=names)
        own = {"block": [number], "pairs": [_bytes(k.pairs, "<i8")], "docs": [_bytes(k.documents(doc, seg), "<i4")],
               "seg_at": [_bytes(np.diff(k.at), "<i4")], "seg_pairs": [_bytes(k.pair_at, "<i4")], "seg_mult": [_bytes(k.mult, "<i8")]}
        yield pa.RecordBatch.from_arrays([pa.nulls(1, c.type) for c in cols] + [
            pa.array(own[c], _ARROW[t]) if c in own else pa.nulls(1, _ARROW[t]) for c, t in plain], names=names)

    def run(batches):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            at = b.schema.get_field_index("__text")
            for lo, text in text_slices(b.column(at), BLOCK_BYTES // 4):
                cols = [b.column(i).slice(lo, len(text)) for i in range(b.num_columns) if i != at]
                held.append((cols, text))
                size += int(text_bytes(text)[1][-1])
                if size >= BLOCK_BYTES * 3 // 4:
                    cols, text = _merged(held)
                    held, size = [], 0
                    yield from one(cols, text, number)
                    number += 1
                    give_back()
        if held:
            yield from one(*_merged(held), number)
        held.clear()
        give_back()

    def _merged(held):
        return [pa.concat_arrays([c[i] for c, _ in held]) for i in range(len(held[0][0]))], pa.concat_arrays([t for _, t in held])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + [f"{c} {t}" for c, t in plain])
    return docs.mapInArrow(run, schema)


def _pairs(blocks: DataFrame) -> DataFrame:
    """(block, at, a, b, docs): a block's distinct pairs, numbered."""
    def run(batches):
        for t in batches:
            for r in range(t.num_rows):
                p = np.frombuffer(t.column(1)[r].as_py(), "<i8")
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(p), t.column(0)[r].as_py())), pa.array(np.arange(len(p), dtype=np.int32)),
                    pa.array((p >> 32).astype(np.int32)), pa.array((p & 0xFFFFFFFF).astype(np.int32)),
                    pa.array(np.frombuffer(t.column(2)[r].as_py(), "<i4").astype(np.int64))], names=["block", "at", "a", "b", "docs"])

    return blocks.select("block", "pairs", "docs").mapInArrow(run, "block long, at int, a int, b int, docs long")


def pair_counts(asked: DataFrame) -> DataFrame:
    """(a, b, n, best): documents that hold the pair linked, and whether no
    other pair of its A id is in more."""
    n = asked.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    top = n.groupBy("a").agg(F.max("n").alias("top"))       # at most a row per id of the first vocabulary
    return n.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def align_documents(docs: DataFrame, text_col: str = "text", a_path: str | None = None, b_path: str | None = None,
                    keep_groups: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Append ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best``
    (links whose pair is in the most documents of its A id's pairs, ties
    included), ``count_sum`` (documents of the linked pairs, summed over links),
    ``groups_sha256`` and ``groups`` (``a1,a2|b1;a3|b2,b3``; left out unless
    ``keep_groups``).

    A text that is null, empty or not spelled by both tokenizers has no
    tokens: zeros, and '' for the groups.  All rows and other columns (or those
    named in ``keep``, which saves writing the texts) stay, repeated rows count as documents of their own, and an input column named
    as a result is replaced; an empty table gives an empty one."""
    paths = (a_path or tokenizer_path("byte_bpe_50k.json"), b_path or tokenizer_path("piece_bpe_32k.model"))
    results = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in results]
    # The caller's columns travel as one struct: no name can clash.
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row") if kept else F.lit(0).alias("__row"),
                       F.col(f"`{text_col}`").alias("__text"))
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        table = write_scratch(_aligned(slim, paths, keep_groups), "op11-aligned")
    blocks = table.where("pairs is not null")
    asked = _pairs(blocks)
    replies = (asked.select("block", "at", "a", "b").join(pair_counts(asked), ["a", "b"]).select("block", "at", "n", "best"))
    texts = table.where("pairs is null")

    out_fields = [f for f in texts.schema.fields if f.name in ("__row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")]
    names = [f.name for f in out_fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out_fields] + ["n_best long", "count_sum long"])

    def score(key, own: pa.Table, got: pa.Table) -> pa.Table:
        is_block = np.asarray(own.column("pairs").is_valid())
        b = own.filter(pa.array(is_block)).to_pylist()[0] if is_block.any() else None
        docs_ = own.filter(pa.array(~is_block))
        if b is None or not docs_.num_rows:
            return docs_.select(names).append_column("n_best", pa.nulls(docs_.num_rows, pa.int64())).append_column(
                "count_sum", pa.nulls(docs_.num_rows, pa.int64()))
        m = len(b["pairs"]) // 8
        n, best = np.zeros(m, np.int64), np.zeros(m, np.int64)
        at = got.column("at").to_numpy()
        n[at], best[at] = got.column("n").to_numpy(), got.column("best").to_numpy(zero_copy_only=False)
        size = np.frombuffer(b["seg_at"], "<i4").astype(np.int64)
        pair, mult = np.frombuffer(b["seg_pairs"], "<i4"), np.frombuffer(b["seg_mult"], "<i8")
        edge = np.concatenate([[0], np.cumsum(size)])
        def per_segment(x):
            cum = np.concatenate([[0], np.cumsum(x[pair] * mult)])
            return cum[edge[1:]] - cum[edge[:-1]]
        seg_n, seg_best = per_segment(n), per_segment(best)
        sums, bests = [], []
        for segs, times in zip(docs_.column("segs").to_pylist(), docs_.column("times").to_pylist()):
            s, t = np.cumsum(np.frombuffer(segs, "<i4")), np.frombuffer(times, "<i4").astype(np.int64)
            sums.append(int(seg_n[s] @ t) if len(s) else 0)
            bests.append(int(seg_best[s] @ t) if len(s) else 0)
        return docs_.select(names).append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    wanted = table.select("block", "segs", "times", "seg_at", "seg_pairs", "seg_mult", "pairs", *names)
    done = wanted.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, schema)
    return done.select(*[F.col(f"__row.`{c}`").alias(c) for c in kept], "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       "groups_sha256", *([F.col("groups").cast("string").alias("groups")] if keep_groups else []))
