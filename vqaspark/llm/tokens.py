"""Exact BPE encoding and decoding with a public tokenizer file (operator 2).

Inside a task, texts are cut at ASCII white space, where this tokenizer's
normaliser and splitter never join anything, and every distinct word of a
slice is encoded once (with a bounded cache per Python worker).

Texts of more than ``LEAF_CHARS`` are encoded by *tree concatenation*: the
text is halved until the leaves are short, leaves are rows that Spark deals to
all executors, and neighbours are joined by re-encoding a window around the
cut.  The window grows until it shares a token at the same place with either
half (``_anchors``); white space is not needed.  Inner nodes of the tree are
rows too, ``FAN`` children each, so the joins of one text run in many tasks.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.llm.base import Words, map_text, parts, slices, text_bytes

LEAF_CHARS = 65_536      # longer texts are halved
WINDOW_CHARS = 64        # first window on each side of a cut; doubles until both sides agree
FAN = 64                 # neighbours joined into one row of the tree's next level
CACHE_PIECES = 300_000   # pieces remembered per Python worker (some 60 MB)

# Fixed value: the splitting pattern of the tokenizer file.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Pieces the model takes as they are: lower-case ASCII and Latin-1 letters, or
# digits, or marks but for the apostrophe.  Others go through the library.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")

_LETTER, _DIGIT, _MARK, _ODD = 1, 2, 3, 4
_CLASS = np.full(256, _ODD, np.uint8)          # odd: the word is left whole for the library
_CLASS[0x21:0x7F] = _MARK
_CLASS[0x27] = _ODD
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[0x80:0xC0] = _CLASS[0xC3] = _LETTER     # U+00C0 to U+00FF but for two, see Pieces
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0


class Pieces(Words):
    """Runs of letters, single digits and runs of marks, in lower case.  Words
    with any other character stay whole."""

    def __init__(self, col: pa.Array):
        buf, _ = text_bytes(col)
        special = _has(buf, 0x3C, 0x7C)        # special tokens are matched before lower-casing
        super().__init__(col, lower=not special)
        if not len(self):
            return
        kind = _CLASS[self.buf]
        if special:
            kind[self.buf == 0x3C] = _ODD
        after = np.flatnonzero(self.buf[:-1] == 0xC3) + 1 if len(self.buf) else np.zeros(0, np.int64)
        second = self.buf[after]
        kind[after[(second == 0x97) | (second == 0xB7)]] = _ODD           # multiplication and division signs
        upper = after[(second >= 0x80) & (second < 0x9F) & (second != 0x97)]
        if special:
            kind[upper] = _ODD
        else:
            if not self.buf.flags.writeable:
                self.buf = self.buf.copy()
            self.buf[upper] += 0x20
        cut = np.zeros(len(kind), bool)
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        cut &= self.inside
        cut[self.starts] = True
        odd = np.flatnonzero(kind == _ODD)
        if len(odd):
            words = np.unique(np.searchsorted(self.starts, odd, side="right") - 1)
            n = self.ends[words] - self.starts[words] - 1
            cut[np.repeat(self.starts[words] + 1 - (np.cumsum(n) - n), n) + np.arange(n.sum())] = False
        self.starts = np.flatnonzero(cut)
        self._packed = np.append(self._cum[self.starts] - 1, self._cum[-1])
        self.ends = self.starts + np.diff(self._packed)
        self.first = np.searchsorted(self.starts, self.offsets)


_ENCODERS: dict[str, "WordEncoder"] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str) -> "WordEncoder":
    """This worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class WordEncoder:
    """Encodes whole texts through their distinct white-space separated words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        # Only files that split as ``Pieces`` does may skip the library's own splitter.
        spec = json.loads(self.tok.to_str())
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.split = next((p["pattern"]["Regex"] for p in steps if p["type"] == "Split"), None)
        if self.split != SPLIT or [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])] != [
                "NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: not a tokenizer that lowers case and splits words from marks")
        self.byte_char = _byte_chars()
        self.ends_piece = np.zeros(self.tok.get_vocab_size(), bool)
        for token, i in self.tok.get_vocab().items():
            self.ends_piece[i] = token.endswith("</w>")
        #: Characters beside a cut or a window's end that may split otherwise in the whole text:
        #: a contraction or a special token may lie across.
        self.margin = max([4, *(len(t.content) + 4 for t in self.tok.get_added_tokens_decoder().values())])
        self.known: dict[bytes, bytes] = {}

    def _piece(self, piece: bytes) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        if self.split is None or not _PLAIN.fullmatch(piece):
            out = self.tok.encode(piece.decode("utf-8"), add_special_tokens=False).ids
        else:
            s = piece.decode() if piece.isascii() else "".join([self.byte_char[b] for b in piece])
            out = [t.id for t in self.model.tokenize(s)]
        return array("I", out).tobytes()

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of one text, and the characters where each token starts and ends."""
        e = self.tok.encode(text, add_special_tokens=False)
        at = np.asarray(e.offsets, np.int64).reshape(-1, 2)
        return np.asarray(e.ids, np.uint32), at[:, 0], at[:, 1]

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and each text's n + 1 offsets."""
        w = Pieces(col)
        codes, uniq = w.codes()
        if not len(w):
            return np.zeros(0, np.uint32), np.zeros(len(w.first), np.int64)
        ids = []
        known = self.known
        for piece in uniq.to_pylist():
            got = known.get(piece)
            if got is None:
                got = self._piece(piece)
                if len(known) < CACHE_PIECES:
                    known[piece] = got
            ids.append(got)
        length = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        start = np.cumsum(length, dtype=np.int32) - length
        n = length[codes]
        ends = np.cumsum(n, dtype=np.int64)
        at = np.repeat((start[codes] - (ends - n)).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        return flat[at], np.concatenate([[0], ends])[w.first]


class Decoder:
    """Token strings by id.  Only these are kept: a worker that decodes does
    not load the merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("decoder") is not None:
            raise ValueError(f"{path}: only files without a decoder (tokens joined by spaces)")
        names = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [None] * (max(names.values()) + 1)
        for token, i in names.items():
            tokens[i] = token
        self.tokens = pa.array(tokens, pa.string())

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The tokens of each text joined by single spaces, as the library's
        ``decode`` does for a file without decoder."""
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                         self.tokens.take(pa.array(ids.astype(np.int32))))
        return pc.binary_join(lists, " ")


_DECODERS: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def _has(buf: np.ndarray, a: int, b: int) -> bool:
    return bool(((buf[:-1] == a) & (buf[1:] == b)).any())


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def pack(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Ids of each text as one binary value."""
    data = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(data)])


# -- tree concatenation -------------------------------------------------------

def halves(text: str, leaf: int = LEAF_CHARS) -> list[str]:
    """Leaves of the halving tree, in text order."""
    if len(text) <= leaf:
        return [text]
    mid = len(text) // 2
    return halves(text[:mid], leaf) + halves(text[mid:], leaf)


def _stands(c: str) -> bool:
    """Whether normalisation joins nothing before this character to it: ASCII,
    letters of Latin, Greek and Cyrillic, kana, CJK ideographs, Hangul syllables."""
    return c < "\x7f" or (c < "\u0530" or "\u3041" <= c < "\ud7a4") and unicodedata.category(c)[0] == "L"


def _one_run(text: str) -> bool:
    """Letters alone, or ASCII marks alone, before and after normalisation."""
    low = unicodedata.normalize("NFC", text).lower()
    return low.isalpha() or text.isascii() and low.isprintable() and not any(c.isalnum() or c == " " for c in low)


def _anchors(half, window, shift: int, text: str, lo: int, hi: int, enc: "WordEncoder") -> np.ndarray:
    """Pairs (token of the half's part, token of the window) that prove that
    both sequences may be spliced there.

    ``half`` and ``window`` are ``spans``; the half's part begins ``shift``
    characters into ``text``, the window's.  Both have the same token at the same characters, between
    ``lo`` and ``hi``, and nothing composes over its ends.  Where the token
    ends a piece, the next one starts at the same character in both, and
    the splitting pattern looks at nothing before a piece.  Inside a piece of
    letters (or of marks), the piece ends alike in both, and a sequence of
    tokens is the byte-pair encoding of a piece if every two neighbours are the
    encoding of theirs: those up to the token are so in one, those after it in
    the other.  An apostrophe near by may be a contraction; such tokens do not
    count."""
    ids, a, z = half[0], half[1] + shift, half[2] + shift
    whole = np.ones(len(ids), bool)                    # not a part of a character
    whole[1:] &= a[1:] >= z[:-1]
    whole[:-1] &= z[:-1] <= a[1:]
    ok = np.flatnonzero(whole & (a >= lo) & (z <= hi) & (z > a))
    place = {(int(s), int(e)): (k, int(i)) for k, (i, s, e) in enumerate(zip(*window))}
    found = []
    for k in ok.tolist():
        s, e = int(a[k]), int(z[k])
        at, i = place.get((s, e), (-1, -1))
        if i != int(ids[k]) or not _stands(text[s]) or e < len(text) and not _stands(text[e]):
            continue
        if enc.ends_piece[i] or _one_run(text[s:e]) and "'" not in text[max(s - 3, 0):e + 1]:
            found.append((k, at))
    return np.asarray(found, np.int64).reshape(-1, 2)


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


def join_halves(left: tuple[str, np.ndarray], right: tuple[str, np.ndarray], enc: "WordEncoder",
                window: int = WINDOW_CHARS) -> tuple[str, np.ndarray]:
    """Ids of left + right text from the ids of both.

    The window around the cut is encoded as it stands in the joined text, and
    its part in each half alone; the tokens that this part shares with the
    half's own ids, counted from the cut's far side, have known places.  The
    window is accepted if it has an anchor (``_anchors``) among them on either
    side, or reaches that half's end; else it doubles, at last to both halves."""
    (lt, li), (rt, ri) = left, right
    w = window
    while True:
        a, b = max(len(lt) - w, 0), min(w, len(rt))
        text, cut = lt[a:] + rt[:b], len(lt) - a
        mid = enc.spans(text)
        before, first, last, after = li[:0], 0, len(mid[0]), ri[:0]
        good = True
        if a:
            tail = enc.spans(lt[a:])
            n = len(tail[0])
            known = _agree(tail[0][::-1], li[::-1])
            got = _anchors(tail, mid, 0, text, enc.margin, cut - enc.margin, enc)
            got = got[got[:, 0] >= n - known]
            good = len(got) > 0
            if good:
                before, first = li[:len(li) - (n - int(got[0, 0]))], int(got[0, 1])
        if good and b < len(rt):
            head = enc.spans(rt[:b])
            known = _agree(head[0], ri)
            got = _anchors(head, mid, cut, text, cut + enc.margin, len(text) - enc.margin, enc)
            got = got[got[:, 0] < known]
            good = len(got) > 0
            if good:
                after, last = ri[int(got[-1, 0]) + 1:], int(got[-1, 1]) + 1
        if good:
            return lt + rt, np.concatenate([before, mid[0][first:last], after]).astype(np.uint32)
        w *= 2


def concatenate(leaves: list[tuple[str, np.ndarray]], enc: "WordEncoder", window: int = WINDOW_CHARS) -> tuple[str, np.ndarray]:
    """Join neighbours level by level: the whole text and its ids."""
    while len(leaves) > 1:
        pairs = [join_halves(leaves[i], leaves[i + 1], enc, window) for i in range(0, len(leaves) - 1, 2)]
        leaves = pairs + ([leaves[-1]] if len(leaves) % 2 else [])
    return leaves[0]


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None, leaf: int = LEAF_CHARS) -> DataFrame:
    """Append ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers).

    Null texts count as empty (no ids).  Rows keep their other columns; an
    input column named ``n_tokens`` or ``ids`` is replaced.  Equal long texts
    are encoded once and joined back by their digest, so repeated rows stay."""
    path = path or tokenizer_path()
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]

    def whole(col):
        ids, offsets = encoder(path).encode(col)
        return [pa.array(np.diff(offsets)), pack(ids, offsets)]

    size = F.coalesce(F.length(F.col(text_col)), F.lit(0))
    short = map_text(docs.where(size <= leaf), text_col, whole, fields)

    kept = [c for c in docs.columns if c not in ("n_tokens", "ids")]
    digest = F.sha2(F.col(text_col), 256)
    long_rows = docs.where(size > leaf)
    texts = long_rows.select(digest.alias("__d"), F.col(text_col).alias("__t"))

    def cut(batches):
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ls = halves(t, leaf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(ls)), pa.array(range(len(ls)), pa.int32()), pa.array(ls, pa.string())],
                    names=["__d", "leaf", "part"])

    spark = docs.sparkSession
    leaves = (texts.mapInArrow(cut, "__d string, leaf int, part string")
              .dropDuplicates(["__d", "leaf"])                      # copies of a long text: once
              .repartition(parts(spark, 0, 1), "__d", "leaf"))      # leaves in parallel on all executors
    encoded = map_text(leaves, "part", whole, fields).drop("n_tokens")

    def join_nodes(key, table):
        table = table.sort_by("leaf")
        text, ids = concatenate([(t, np.frombuffer(i, "<u4")) for t, i in zip(
            table.column("part").to_pylist(), table.column("ids").to_pylist())], encoder(path))
        return pa.table({"__d": [key[0].as_py()], "leaf": pa.array([key[1].as_py()], pa.int32()), "part": pa.array([text], pa.string()),
                         "ids": pa.array([ids.astype("<u4").tobytes()], pa.binary())})

    # A string of Spark has under 2^31 bytes, so under 2^16 leaves of the default length: two levels, then the root.
    for wide in (FAN, FAN, None):
        node = F.floor(F.col("leaf") / wide).cast("int") if wide else F.lit(0)
        encoded = encoded.withColumn("node", node).groupBy("__d", "node").applyInArrow(
            join_nodes, "__d string, leaf int, part string, ids binary")
    joined = encoded.select("__d", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")
    long = (long_rows.select(*[F.col(f"`{c}`") for c in kept], digest.alias("__d"))
            .join(joined, "__d").select(*[F.col(f"`{c}`") for c in kept], "n_tokens", "ids"))
    return short.unionByName(long) if kept else short.union(long)


def decode(encoded: DataFrame, ids_col: str = "ids", path: str | None = None, out: str = "decoded") -> DataFrame:
    """Append the decoded text of packed ids (null ids: null)."""
    path = path or tokenizer_path()
    base = encoded.drop(out)
    schema = T.StructType(base.schema.fields + [T.StructField(out, T.StringType())])
    at = base.columns.index(ids_col)

    def run(batches):
        for b in batches:
            col = b.column(at)
            length = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in slices(length):
                part = pc.fill_null(col.slice(lo, hi - lo), b"")
                ids = np.frombuffer(b"".join(part.to_pylist()), "<u4")
                offsets = np.concatenate([[0], np.cumsum(length[lo:hi] // 4)])
                text = decoder(path).decode(ids, offsets)
                if col.slice(lo, hi - lo).null_count:
                    text = pc.if_else(col.slice(lo, hi - lo).is_null(), pa.scalar(None, pa.string()), text)
                yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo) for c in b.columns] + [text],
                                                 names=schema.names)

    return base.mapInArrow(run, schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per row: id, ``n_tokens`` and the SHA-256 of the packed ids and of the
    decoded text, both made from the operator's own outputs."""
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text_in"))
    out = decode(encode(slim, "__text_in", path).drop("__text_in"), path=path)
    return out.select(F.col("__id").alias(id_col), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
