"""Language-model scoring by online logistic context mixing (operator 1).

A text is a sequence of tokens: its lower-cased words, then one end.  A token
is spelled in binary decisions: its bytes and a terminator, each byte along
its path in a Huffman tree of the corpus.  Hashed-context predictors (the last
one to five bytes of the word, and the whole word so far) each know from the
training documents how often a decision went either way.  Their log-odds are
combined by weights that a gate selects (how many contexts are known, and the
position in the word); the weights are learned online by gradient steps, each
prediction made without the occurrence it predicts.  A secondary estimation
table refines the mix adaptively.  The product over decisions is the spelled
probability of the token.

Two more predictors look across words: how often the word followed the last
word, and the last two words, in the training documents (for a training
document, without the occurrence predicted).  Along the token sequence of each
text a gate (how often both contexts were seen) selects their weights, which
start alike in every text and are learned online from its tokens so far.  The
remaining weight goes to three experts, mixed per document by Bayes' rule: the
spelled probability, the corpus frequency of the word, and the document's own
past words.  ``score`` is the log10 of the whole text's probability; divided by the
text's bytes (and log10 2) it is bits per byte.

How the data move: each task packs its texts into blocks (token numbers and
the block's distinct words).  Blocks send their distinct words to the words'
owners (by hash), which count and spell each distinct word once, and answer.
Likewise the block's distinct phrases (hashed pairs and triples of tokens) go
to the phrases' owners, which add up their training counts and answer.
Counts grow with the corpus; what is broadcast (context tables, weights) has a
fixed size.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vqaspark.llm.base import Words, hash_binary, mix64, slices, text_slices, write_scratch
from vqaspark.llm.huffman import canonical, code_lengths
from vqaspark.session import scratch_path

TRAIN_MODULUS, HELD_OUT = 7, 2
BLOCK_BYTES = 16 << 20       # text of a block
OWNED = 1 << 18              # (block, word) pairs an owner gets, about
ORDERS = (1, 2, 3, 4, 5, 0)  # bytes of context; 0: the whole word so far
SLOTS = 1 << 20              # counters of each context table
TERMINATOR, END = 256, 257   # symbols besides the 256 bytes
SPELL_SLICE = 16_384         # distinct words spelled at once
STEP = 8192                  # decisions between two online steps
RATE = 0.02
# Experts: shares of the spelled, the corpus and the document's own words.
EXPERTS = np.array([[0.50, 0.48, 0.02], [0.30, 0.60, 0.10], [0.20, 0.75, 0.05], [0.70, 0.25, 0.05],
                    [0.25, 0.45, 0.30], [0.10, 0.20, 0.70], [0.02, 0.03, 0.95]])

OWNED_PHRASES = 1 << 20      # (block, phrase) pairs an owner gets, at most about
SPARE_BITS = 10              # of a phrase's hash beyond the logarithm of their number: 1 in 1,024 meets another
SCORE_SLICE = 1 << 18        # tokens scored at once
PRIOR = 8.0                  # tokens that the weights a text starts with count for

_GATES = (len(ORDERS) + 1) * 4
_REFINE = 33                 # steps of log-odds in the refinement table


def _z(a: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes())


def _u(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


# -- blocks -------------------------------------------------------------------

_BLOCK = ("block long, n_types long, n_train long, n_words long, docs binary, no_id binary, held binary, counts binary, tokens binary, "
          "hashes binary, words binary, lengths binary, train binary")
_BLOCK_PA = pa.schema([("block", pa.int64()), ("n_types", pa.int64()), ("n_train", pa.int64()), ("n_words", pa.int64())]
                      + [(c, pa.binary()) for c in ("docs", "no_id", "held", "counts", "tokens", "hashes", "words", "lengths", "train")])


def pack_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of (doc, text, held) rows.  ``tokens`` number the block's types;
    ``train`` counts each type in the block's training documents.  The end of
    a text is not stored: every text has one."""
    def run(batches):
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            uniq = pa.concat_arrays([h["uniq"] for h in held])
            hashes = np.concatenate([h["hash"] for h in held])
            order, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            words = uniq.take(pa.array(first))
            base, tokens = 0, []
            for h in held:
                tokens.append(inverse[base + h["codes"]].astype("<u4"))
                base += len(h["hash"])
            tokens = np.concatenate(tokens)
            counts = np.concatenate([h["counts"] for h in held])
            out = np.concatenate([h["held"] for h in held])
            train = np.bincount(tokens[~np.repeat(out, counts)], minlength=len(order))
            docs_col = pa.concat_arrays([h["doc"] for h in held])
            lengths = np.asarray(pa.compute.binary_length(words)).astype("<i4") if len(words) else np.zeros(0, "<i4")
            data = b"".join(words.to_pylist())
            row = {"block": (part << 20) + seq, "n_types": len(order), "n_train": int((~out).sum()), "n_words": len(tokens),
                   "docs": docs_col.fill_null(0).to_numpy().astype("<i8").tobytes(),
                   "no_id": np.asarray(docs_col.is_null()).astype(np.uint8).tobytes(), "held": out.astype(np.uint8).tobytes(),
                   "counts": counts.astype("<i8").tobytes(), "tokens": _z(tokens), "hashes": _ascending(order),
                   "words": _z(data), "lengths": _z(lengths), "train": _z(train.astype("<u4"))}
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_PA)

        for b in batches:
            out = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for lo, col in text_slices(b.column(1)):
                w = Words(col, lower=True)
                codes, uniq = w.codes()
                held.append({"doc": b.column(0).slice(lo, len(col)), "held": out[lo:lo + len(col)], "counts": w.counts,
                             "codes": codes, "uniq": uniq, "hash": hash_binary(uniq)})
                size += len(w.buf) + 64 * len(col)
                if size >= BLOCK_BYTES:
                    yield close()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield close()

    return docs.mapInArrow(run, _BLOCK)


def store_blocks(blocks: DataFrame) -> DataFrame:
    """Write the blocks dealt by their number: what comes back for a block
    meets it where it lies, and the blocks themselves are never shuffled."""
    spark = blocks.sparkSession
    name = f"op1_blocks_{uuid.uuid4().hex[:12]}"
    (blocks.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").option("compression", "uncompressed")
           .option("path", scratch_path(spark, "op1-blocks")).saveAsTable(name))
    return spark.table(name)


def _cuts(keys: np.ndarray, owners: int, bits: int) -> np.ndarray:
    """Where sorted keys pass from one owner to the next (owners have ranges)."""
    step = -(-(1 << bits) // owners)
    return np.append(np.searchsorted(keys, np.array([o * step for o in range(owners)], np.uint64)), len(keys))


def _planes(a: np.ndarray) -> bytes:
    return _z(np.ascontiguousarray(a.astype("<u8")).view(np.uint8).reshape(-1, 8).T)


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(_u(b, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _ascending(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _keys(b: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(b), dtype=np.uint64)


def _ragged(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


_SENT = pa.schema([("owner", pa.int64()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("hashes", "words", "lengths", "train")])
_OWNED = "owner long, hashes binary, words binary, lengths binary, counts binary, n_known long, n_tokens long"
_OWNED_PA = pa.schema([("owner", pa.int64())] + [(c, pa.binary()) for c in ("hashes", "words", "lengths", "counts")]
                      + [("n_known", pa.int64()), ("n_tokens", pa.int64())])


def count_types(blocks: DataFrame, owners: int) -> DataFrame:
    """Every distinct word of the corpus once, at its owner, with its count in
    training documents."""
    def send(batches):
        for b in batches:
            for r in b.to_pylist():
                h, length, train = _keys(r["hashes"]), _u(r["lengths"], "<i4").astype(np.int64), _u(r["train"], "<u4")
                data = _u(r["words"], np.uint8)
                at = np.concatenate([[0], np.cumsum(length)])
                cuts = _cuts(h, owners, 64)
                for o in np.flatnonzero(np.diff(cuts)):
                    i = slice(cuts[o], cuts[o + 1])
                    yield pa.RecordBatch.from_pylist([{
                        "owner": int(o), "block": r["block"], "hashes": _ascending(h[i]), "words": _z(data[at[i.start]:at[i.stop]]),
                        "lengths": _z(length[i].astype("<i4")), "train": _z(train[i])}], schema=_SENT)

    def merge(key, t):
        hs, ls, ts, ds = [], [], [], []
        for m in t.to_pylist():
            hs.append(_keys(m["hashes"]))
            ls.append(_u(m["lengths"], "<i4").astype(np.int64))
            ts.append(_u(m["train"], "<u4"))
            ds.append(_u(m["words"], np.uint8))
        h, length, train, data = (np.concatenate(x) for x in (hs, ls, ts, ds))
        u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights=train).astype("<i8")
        start = np.cumsum(length) - length
        return pa.Table.from_pylist([{
            "owner": key[0].as_py(), "hashes": u.tobytes(), "words": _z(_ragged(data, start[first], length[first])),
            "lengths": _z(length[first].astype("<i4")), "counts": _z(counts), "n_known": int((counts > 0).sum()),
            "n_tokens": int(counts.sum())}], schema=_OWNED_PA)

    sent = blocks.select("block", "hashes", "words", "lengths", "train").mapInArrow(
        send, "owner long, block long, hashes binary, words binary, lengths binary, train binary")
    return sent.groupBy("owner").applyInArrow(merge, _OWNED)


# -- spelling -----------------------------------------------------------------

class Speller:
    """Words as binary decisions and the hashed contexts of each decision."""

    def __init__(self, symbol_counts: np.ndarray):
        self.size = code_lengths(symbol_counts.astype(np.int64) + 1, 24).astype(np.int64)
        self.code = canonical(self.size).astype(np.int64)
        # A tree node is its path from the root; numbered in any fixed order.
        paths = sorted({(d, int(c) >> (int(s) - d)) for s, c in zip(self.size, self.code) for d in range(int(s))})
        number = {p: i for i, p in enumerate(paths)}
        top = int(self.size.max())
        self.node = np.zeros((len(self.size), top), np.int64)
        self.bit = np.zeros((len(self.size), top), bool)
        for s, (n, c) in enumerate(zip(self.size, self.code)):
            for d in range(int(n)):
                self.node[s, d] = number[d, int(c) >> (int(n) - d)]
                self.bit[s, d] = (int(c) >> (int(n) - d - 1)) & 1
        self.nodes = len(paths)

    def decisions(self, data: np.ndarray, lengths: np.ndarray, ends: int = 0):
        """(word of each decision, bit, node, position class, slots [order]) for
        words given as bytes, and ``ends`` end tokens after them."""
        n = len(lengths)
        m = lengths + 1
        total = int(m.sum())
        sym = np.full(total + ends, TERMINATOR, np.int64)
        start = np.cumsum(m) - m
        inner = np.ones(total, bool)
        inner[start + lengths] = False
        sym[:total][inner] = data
        sym[total:] = END
        word = np.concatenate([np.repeat(np.arange(n), m), n + np.arange(ends)])
        pos = np.concatenate([np.arange(total) - np.repeat(start, m), np.zeros(ends, np.int64)])
        # Contexts: hash of the last k symbols of the word (0 before its start).
        ctx = []
        prev = np.zeros((max(ORDERS), total + ends), np.uint64)
        for k in range(max(ORDERS)):
            ok = pos > k
            prev[k, ok] = (sym[np.flatnonzero(ok) - k - 1] + 1).astype(np.uint64)
        for k in ORDERS:
            if k:
                x = np.full(total + ends, k, np.uint64)
                for j in range(k):
                    x = x * np.uint64(0x9E3779B97F4A7C15) + prev[j]
                ctx.append(mix64(x))
            else:
                ctx.append(self._prefix(sym, pos))
        d = self.size[sym]
        at = np.repeat(np.arange(len(sym)), d)
        step = np.arange(int(d.sum())) - np.repeat(np.cumsum(d) - d, d)
        node, bit = self.node[sym[at], step], self.bit[sym[at], step]
        salt = node.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        slots = []
        for c in ctx:
            x = c[at] + salt
            x ^= x >> np.uint64(31)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            slots.append((x >> np.uint64(44)).astype(np.int32))        # 20 bits: SLOTS
        return word[at], bit, node, np.minimum(pos[at], 3), slots

    @staticmethod
    def _prefix(sym: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Hash of all symbols of the word before each position."""
        x = np.zeros(len(sym), np.uint64)
        alive = np.flatnonzero(pos > 0)
        depth = 1
        while len(alive):
            now = alive[pos[alive] == depth]
            x[now] = mix64(x[now - 1] * np.uint64(0x9E3779B97F4A7C15) + (sym[now - 1] + 1).astype(np.uint64) + np.uint64(depth))
            alive = alive[pos[alive] > depth]
            depth += 1
        return x + np.uint64(77)


assert SLOTS == 1 << 20


def _odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(0.4)) / (n0 + np.float32(0.4)))


class Mixer:
    """Gated logistic mixing and the refinement table."""

    def __init__(self, weights=None, refine=None, nodes: int = 0):
        self.w = np.full((_GATES, len(ORDERS)), 0.3, np.float32) if weights is None else weights
        self.refine = np.zeros((nodes, _REFINE, 2), np.float32) if refine is None else refine

    def inputs(self, tables, slots, bit, leave_out: np.ndarray | None):
        x = np.empty((len(ORDERS), len(bit)), np.float32)
        known = np.zeros(len(bit), np.int64)
        for k in range(len(ORDERS)):
            n0, n1 = tables[k, 0][slots[k]], tables[k, 1][slots[k]]
            if leave_out is not None:
                n1 = n1 - (leave_out & bit)
                n0 = n0 - (leave_out & ~bit)
            x[k] = _odds(n0, n1)
            known += n0 + n1 >= 2
        return x, known

    def mix(self, x, gate):
        w = self.w[gate]
        return np.clip(np.einsum("kn,nk->n", x, w), -16, 16)

    def refined(self, z, node):
        """Mean of the mix and of what happened before at this node and odds."""
        p = 1 / (1 + np.exp(-z))
        at = np.clip(np.rint((z + 16) * ((_REFINE - 1) / 32)), 0, _REFINE - 1).astype(np.int64)
        n0, n1 = self.refine[node, at, 0], self.refine[node, at, 1]
        q = (n1 + 4 * p) / (n0 + n1 + 4)
        return np.clip((p + q) / 2, 1e-7, 1 - 1e-7)

    def learn(self, x, gate, z, bit, weight, node):
        """An online step on a slice of decisions."""
        err = (bit - 1 / (1 + np.exp(-z))) * weight
        total = np.bincount(gate, weights=weight, minlength=_GATES)
        for k in range(len(ORDERS)):
            g = np.bincount(gate, weights=err * np.clip(x[k], -8, 8), minlength=_GATES)
            self.w[:, k] += (RATE * g / np.maximum(total, 1e-9)).astype(np.float32)
        at = np.clip(np.rint((z + 16) * ((_REFINE - 1) / 32)), 0, _REFINE - 1).astype(np.int64)
        key = (node * _REFINE + at) * 2 + bit
        self.refine += np.bincount(key, weights=weight, minlength=self.refine.size).reshape(self.refine.shape).astype(np.float32)


def _gate(known: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return known * 4 + pos


def _words_of(r: dict, only_trained: bool):
    """Slices (index, bytes, lengths, counts) of an owner's words."""
    length, counts, data = _u(r["lengths"], "<i4").astype(np.int64), _u(r["counts"], "<i8"), _u(r["words"], np.uint8)
    start = np.cumsum(length) - length
    index = np.flatnonzero(counts > 0) if only_trained else np.arange(len(counts))
    for lo in range(0, len(index), SPELL_SLICE):
        i = index[lo:lo + SPELL_SLICE]
        yield i, _ragged(data, start[i], length[i]), length[i], counts[i]


def symbol_counts(owned: DataFrame, ends: int) -> np.ndarray:
    def count(batches):
        out = np.zeros(258)
        for b in batches:
            for r in b.to_pylist():
                for _, data, length, counts in _words_of(r, True):
                    out[:256] += np.bincount(data, weights=np.repeat(counts, length), minlength=256)
                    out[TERMINATOR] += counts.sum()
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(out[at].astype(np.int64))], names=["s", "n"])

    got = owned.select("lengths", "counts", "words").mapInArrow(count, "s int, n long").groupBy("s").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(258, np.int64)
    for r in got:                                              # at most 258 rows
        out[r["s"]] = r["n"]
    out[END] = ends
    return out


_CHUNK = 1 << 16


def context_tables(owned: DataFrame, speller: Speller, ends: int) -> np.ndarray:
    """Counts [order, bit, slot] over all training tokens.  Each task sums its
    words; chunks of the tables are then added up on the executors."""
    tasks = owned.sparkSession.sparkContext.defaultParallelism

    def count(batches):
        t = np.zeros((len(ORDERS), 2, SLOTS), np.float32)
        for b in batches:
            for r in b.to_pylist():
                for _, data, length, counts in _words_of(r, True):
                    word, bit, _, _, slots = speller.decisions(data, length)
                    weight = counts[word].astype(np.float64)
                    for k in range(len(ORDERS)):
                        key = slots[k].astype(np.int64) + SLOTS * bit
                        t[k] += np.bincount(key, weights=weight, minlength=2 * SLOTS).reshape(2, SLOTS)
        flat = t.reshape(-1, _CHUNK)
        for c in range(len(flat)):
            if flat[c].any():
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([_z(flat[c])], pa.binary())], names=["c", "t"])

    def add(key, t):
        total = np.zeros(_CHUNK)
        for x in t.column("t").to_pylist():
            total += _u(x, np.float32)
        return pa.table({"c": [key[0]], "t": [_z(total.astype(np.float32))]}, schema=pa.schema([("c", pa.int32()), ("t", pa.binary())]))

    got = (owned.select("lengths", "counts", "words").coalesce(tasks).mapInArrow(count, "c int, t binary")
           .groupBy("c").applyInArrow(add, "c int, t binary").collect())        # fixed size: the tables
    out = np.zeros((len(ORDERS) * 2 * SLOTS // _CHUNK, _CHUNK), np.float32)
    for r in got:
        out[r["c"]] = _u(r["t"], np.float32)
    out = out.reshape(len(ORDERS), 2, SLOTS)
    if ends:
        _, bit, _, _, slots = speller.decisions(np.zeros(0, np.uint8), np.zeros(0, np.int64), 1)
        for k in range(len(ORDERS)):
            np.add.at(out[k], (bit.astype(np.int64), slots[k]), np.float32(ends))
    return out


def train_mixer(owned: DataFrame, speller: Speller, tables) -> Mixer:
    """Online learning in every task, from the same start; weights are
    averaged by the decisions seen, refinement counts are added."""
    tasks = owned.sparkSession.sparkContext.defaultParallelism

    def learn(batches):
        mixer, seen = Mixer(nodes=speller.nodes), 0.0
        for b in batches:
            for r in b.to_pylist():
                for _, data, length, counts in _words_of(r, True):
                    word, bit, node, pos, slots = speller.decisions(data, length)
                    weight = counts[word].astype(np.float64)
                    x, known = mixer.inputs(tables.value, slots, bit, np.ones(len(bit), bool))
                    gate = _gate(known, pos)
                    for lo in range(0, len(bit), STEP):
                        i = slice(lo, lo + STEP)
                        z = mixer.mix(x[:, i], gate[i])
                        mixer.learn(x[:, i], gate[i], z, bit[i], weight[i], node[i])
                    seen += float(weight.sum())
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([mixer.w.tobytes()], pa.binary()),
                                              pa.array([_z(mixer.refine)], pa.binary())], names=["n", "w", "r"])

    parts = owned.select("lengths", "counts", "words").coalesce(tasks).mapInArrow(learn, "n double, w binary, r binary")

    def add(_, t):
        n = t.column("n").to_numpy()
        w = sum(k * np.frombuffer(x, np.float32).astype(np.float64) for k, x in zip(n, t.column("w").to_pylist()))
        r = sum(_u(x, np.float32).astype(np.float64) for x in t.column("r").to_pylist())
        return pa.table({"g": [0], "n": [float(n.sum())], "w": [w.tobytes()], "r": [_z(r)]},
                        schema=pa.schema([("g", pa.int64()), ("n", pa.float64()), ("w", pa.binary()), ("r", pa.binary())]))

    # A few small rows for each core of the cluster, summed by hundreds before one task sums the rest.
    first = (parts.withColumn("g", F.spark_partition_id() % 64).groupBy("g").applyInArrow(add, "g long, n double, w binary, r binary"))
    got = first.collect()
    mixer = Mixer(nodes=speller.nodes)
    if got:
        total = sum(r["n"] for r in got)
        mixer.w = (sum(np.frombuffer(r["w"], np.float64) for r in got) / total).reshape(mixer.w.shape).astype(np.float32)
        mixer.refine = sum(_u(r["r"], np.float64) for r in got).reshape(mixer.refine.shape).astype(np.float32)
    return mixer


def spell(speller: Speller, mixer: Mixer, tables, data, lengths, ends: int = 0) -> np.ndarray:
    """log10 of the spelled probability of each word (and end)."""
    word, bit, node, pos, slots = speller.decisions(data, lengths, ends)
    x, known = mixer.inputs(tables, slots, bit, None)
    p = mixer.refined(mixer.mix(x, _gate(known, pos)), node)
    return np.bincount(word, weights=np.log10(np.where(bit, p, 1 - p)), minlength=len(lengths) + ends)


# -- phrases ------------------------------------------------------------------

_START_KEY, _END_KEY = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)


def phrase_bits(n_tokens: int) -> int:
    """Bits of the phrases' hashes in a corpus; they grow with it."""
    return min((2 * n_tokens).bit_length() + SPARE_BITS, 63)


def phrase_keys(hashes: np.ndarray, tokens: np.ndarray, counts: np.ndarray, bits: int):
    """Hashes of (last word, token) and (last two words, token) at every token
    of the texts, their ends included, and the first position of each text."""
    last = np.cumsum(counts + 1) - 1
    first = last - counts
    h = np.full(len(tokens) + len(counts), _END_KEY)
    inner = np.ones(len(h), bool)
    inner[last] = False
    h[inner] = hashes[tokens]

    def follow(before, salt):
        x = np.empty_like(h)
        x[1:] = before[:-1]
        x[first] = _START_KEY
        return mix64(x * np.uint64(0x9E3779B97F4A7C15) + (h ^ np.uint64(salt)))

    one = follow(h, 1)
    two = follow(one, 2)
    shift = np.uint64(64 - bits)
    return one >> shift, two >> shift, first


def _phrases_of(r: dict, bits: int):
    """The numbers of the pair and of the triple at each of a block's tokens,
    the first position of each text, the distinct phrases in order, and how
    often the block's own training texts have each."""
    one, two, first = phrase_keys(_keys(r["hashes"]), _u(r["tokens"], "<u4"), np.frombuffer(r["counts"], "<i8"), bits)
    trained = np.repeat(np.frombuffer(r["held"], np.uint8) == 0, np.diff(np.append(first, len(one))))
    keys, at = _numbered(np.concatenate([one, two]), bits)
    return at[:len(one)], at[len(one):], first, keys, np.bincount(at[np.concatenate([trained, trained])], minlength=len(keys))


def _numbered(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ``bits`` bits in order, and the number of each value
    among them.  Where value and place fit in one word, one plain sort does."""
    place = max(len(values) - 1, 1).bit_length()
    if bits + place > 64:
        return np.unique(values, return_inverse=True)
    both = values << np.uint64(place)
    both |= np.arange(len(values), dtype=np.uint64)
    both.sort()
    key = both >> np.uint64(place)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.empty(len(key), np.int32 if len(key) < 1 << 31 else np.int64)
    both &= np.uint64((1 << place) - 1)
    at[both.view(np.int64)] = np.cumsum(new) - 1
    return key[new], at


def phrase_counts(blocks: DataFrame, owners: int, bits: int) -> DataFrame:
    """(block, owner, shared, counts): of the block's distinct phrases in the
    owner's range, in the order of their hashes, which are also in training
    texts of other blocks (a bit each), and how often there.  The block knows
    its own, so nothing is sent back for the others."""
    sent_pa = pa.schema([("owner", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("train", pa.binary())])
    out_pa = pa.schema([("block", pa.int64()), ("owner", pa.int64()), ("shared", pa.binary()), ("counts", pa.binary())])

    def send(batches):
        for b in batches:
            for r in b.to_pylist():
                _, _, _, keys, train = _phrases_of(r, bits)
                cuts = _cuts(keys, owners, bits)
                for o in np.flatnonzero(np.diff(cuts)):
                    i = slice(cuts[o], cuts[o + 1])
                    yield pa.RecordBatch.from_pylist([{
                        "owner": int(o), "block": r["block"], "keys": _ascending(keys[i]), "train": _z(train[i].astype("<u4"))}], schema=sent_pa)

    def merge(key, t):
        sent = t.select(["block", "keys", "train"]).to_pylist()
        keys = [_keys(m["keys"]) for m in sent]
        train = [_u(m["train"], "<u4").astype(np.int64) for m in sent]
        _, inverse = _numbered(np.concatenate(keys), bits)
        total = np.bincount(inverse, weights=np.concatenate(train)).astype(np.int64)
        mine = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])
        rows = []
        for m, i, own in zip(sent, mine, train):
            more = total[i] - own
            if more.any():
                rows.append({"block": m["block"], "owner": key[0].as_py(), "shared": _z(np.packbits(more > 0)),
                             "counts": _z(more[more > 0].astype("<u4"))})
        return pa.Table.from_pylist(rows, schema=out_pa)

    sent = blocks.select("block", "hashes", "tokens", "counts", "held").mapInArrow(
        send, "owner long, block long, keys binary, train binary")
    return sent.groupBy("owner").applyInArrow(merge, "block long, owner long, shared binary, counts binary")


def _start_weights() -> np.ndarray:
    """[gate, (two words, one word, neither)]: the weights every text starts
    with; a context that was never seen has none."""
    seen = np.where(np.arange(16) > 0, 2.0 ** (np.arange(16) - 1), 0)
    two = np.repeat(0.6 * seen / (seen + 2), 16)
    one = (1 - two) * np.tile(0.6 * seen / (seen + 16), 16)
    return np.stack([two, one, 1 - two - one], 1)


_START_WEIGHTS = _start_weights()


def _seen_gate(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(n.astype(np.float64))[1], 15)


def sequence_weights(p: np.ndarray, gate: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Weights [predictor, token] of the predictors' probabilities ``p``: the
    gate's start and the shares that the predictors had in the tokens before
    it, of the same text and gate."""
    start = _START_WEIGHTS[gate].T
    share = start * p
    share /= np.maximum(share.sum(0), 1e-300)
    key = doc.astype(np.int64) * len(_START_WEIGHTS) + gate
    order = np.argsort(key, kind="stable")
    k = key[order]
    head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    size = np.diff(np.append(head, len(k)))
    out = np.empty_like(share)
    for j in range(len(share)):
        cum = np.cumsum(share[j][order]) - share[j][order]
        out[j, order] = np.maximum(cum - np.repeat(cum[head], size), 0)
    out += PRIOR * start
    return out / out.sum(0)


# -- scoring ------------------------------------------------------------------

def _answers(owned: DataFrame, blocks: DataFrame, owners: int, speller, mixer, tables) -> DataFrame:
    """(block, owner, counts, spelled) of the block's words in the owner's
    range, in the order of their hashes."""
    asks_pa = pa.schema([("owner", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary())])

    def ask(batches):
        for b in batches:
            for r in b.to_pylist():
                h = _keys(r["hashes"])
                cuts = _cuts(h, owners, 64)
                for o in np.flatnonzero(np.diff(cuts)):
                    yield pa.RecordBatch.from_pylist([{"owner": int(o), "block": r["block"], "hashes": _ascending(h[cuts[o]:cuts[o + 1]])}],
                                                     schema=asks_pa)

    out_pa = pa.schema([("block", pa.int64()), ("owner", pa.int64()), ("counts", pa.binary()), ("spelled", pa.binary())])

    def answer(key, own, asked):
        if not own.num_rows:
            return pa.Table.from_pylist([], schema=out_pa)
        r = own.to_pylist()[0]
        h, counts = np.frombuffer(r["hashes"], "<u8"), _u(r["counts"], "<i8")
        s = np.zeros(len(h), np.float32)
        for i, data, length, _ in _words_of(r, False):
            s[i] = spell(speller, mixer.value, tables.value, data, length)
        rows = []
        for q in asked.to_pylist():
            at = np.searchsorted(h, _keys(q["hashes"]))
            rows.append({"block": q["block"], "owner": key[0].as_py(), "counts": _z(counts[at]), "spelled": s[at].tobytes()})
        return pa.Table.from_pylist(rows, schema=out_pa)

    asks = blocks.select("block", "hashes").mapInArrow(ask, "owner long, block long, hashes binary")
    return owned.select("owner", "hashes", "words", "lengths", "counts").groupBy("owner").cogroup(
        asks.groupBy("owner")).applyInArrow(answer, "block long, owner long, counts binary, spelled binary")


def past_share(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each token, the share of its document's tokens before it that equal it."""
    n = len(tokens)
    first = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(n) - np.repeat(first, counts)
    order = np.argsort((doc.astype(np.uint64) << np.uint64(32)) | tokens.astype(np.uint64), kind="stable")
    d, t = doc[order], tokens[order]
    head = np.ones(n, bool)
    head[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1])
    start = np.flatnonzero(head)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
    return rank / np.maximum(at, 1)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (add-one word frequencies), ``score``
    (log10 probability of the text) and ``bits_per_byte``.

    Training documents are those whose crc32 of the id as text modulo 7 is not
    2; a null id counts as an empty string.  Null texts count as empty: one
    token, the end.  Repeated ids and rows give a row each and count as often;
    with no training document all counts are 0; an empty table gives an empty
    result; other columns are not read.  Held-out texts influence nothing but
    their own row."""
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("t"),
                       (crc % TRAIN_MODULUS == HELD_OUT).alias("held"))
    blocks = store_blocks(pack_blocks(slim))
    sums = blocks.agg(F.sum("n_types").alias("types"), F.sum("n_train").alias("ends"),
                      F.sum(F.col("n_words") + F.length("held")).alias("tokens")).first()
    ends = int(sums["ends"] or 0)
    owners = int((sums["types"] or 0) // OWNED) + 1
    phrase_owners = int(2 * (sums["tokens"] or 0) // OWNED_PHRASES) + 1
    bits = phrase_bits(int(sums["tokens"] or 0))
    owned = write_scratch(count_types(blocks, owners), "op1-words", compression="uncompressed")
    sums = owned.agg(F.sum("n_known").alias("v"), F.sum("n_tokens").alias("n")).first()
    n_all = int(sums["n"] or 0) + ends
    v_all = int(sums["v"] or 0) + (1 if ends else 0)
    speller = Speller(symbol_counts(owned, ends))
    tables = context_tables(owned, speller, ends)
    shared = spark.sparkContext.broadcast(tables)
    trained = train_mixer(owned, speller, shared)
    mixer = spark.sparkContext.broadcast(trained)
    end_spelled = float(spell(speller, trained, tables, np.zeros(0, np.uint8), np.zeros(0, np.int64), 1)[0])
    answers = _answers(owned, blocks, owners, speller, mixer, shared).unionByName(
        phrase_counts(blocks, phrase_owners, bits), allowMissingColumns=True)
    whole = n_all + v_all + 1

    schema = (f"{id_col} long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double, bits_per_byte double")
    names = [c.split()[0] for c in schema.split(", ")]
    out_pa = pa.schema(list(zip(names, [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()])))

    def score(_, own, got):
        if not own.num_rows:
            return pa.Table.from_pylist([], schema=out_pa)
        r = own.to_pylist()[0]
        h, n = _keys(r["hashes"]), np.frombuffer(r["counts"], "<i8")
        c, s = np.zeros(len(h), np.int64), np.zeros(len(h), np.float32)
        lengths = _u(r["lengths"], "<i4")
        tokens = _u(r["tokens"], "<u4")
        one, two, first, keys, followed = _phrases_of(r, bits)
        cuts, word_cuts = _cuts(keys, phrase_owners, bits), _cuts(h, owners, 64)
        for m in got.to_pylist():
            o = m["owner"]
            if m["spelled"] is not None:
                i = slice(word_cuts[o], word_cuts[o + 1])
                c[i], s[i] = _u(m["counts"], "<i8"), _f4(m["spelled"])
            else:
                shared = np.flatnonzero(np.unpackbits(_u(m["shared"], np.uint8), count=int(cuts[o + 1] - cuts[o])))
                followed[cuts[o] + shared] += _u(m["counts"], "<u4")
        n_one, n_two = followed[one], followed[two]
        trained = np.frombuffer(r["held"], np.uint8) == 0
        del one, two, keys, followed
        base = np.log10((c + 1) / whole)
        # The corpus expert: known words by count, the rest shares what one unseen word would get.
        spelled = 10.0 ** np.maximum(s.astype(np.float64), -280)
        corpus = np.where(c > 0, (c + 1) / whole, spelled / whole)
        offsets = np.concatenate([[0], np.cumsum(n)])
        end_p = 10.0 ** end_spelled
        logs = np.empty((len(EXPERTS), len(n)))
        for lo, hi in slices(n + 1, SCORE_SLICE):
            m, words = n[lo:hi], tokens[offsets[lo]:offsets[hi]]
            begin = first[lo:hi] - first[lo]
            size = len(words) + len(m)
            inner = np.ones(size, bool)
            inner[begin + m] = False
            own_1, own_2 = n_one[first[lo]:first[lo] + size], n_two[first[lo]:first[lo] + size]
            doc = np.repeat(np.arange(len(m)), m + 1)
            out = trained[lo:hi][doc].astype(np.int64)             # the occurrence itself does not count
            before = np.zeros((2, size), np.int64)
            known = np.zeros(size, np.int64)
            known[inner] = c[words]
            before[0, 1:], before[1, 1:] = own_1[:-1], known[:-1]
            before[:, begin] = ends
            before -= out
            low = np.empty((len(EXPERTS), size))
            past = past_share(words, m)
            for j, (a, b, d) in enumerate(EXPERTS):
                low[j, inner] = (a * spelled + b * corpus)[words] + d * past
                low[j, ~inner] = a * end_p + b * (ends + 1) / whole
            p = np.stack([(own_2 - out) / np.maximum(before[0], 1), (own_1 - out) / np.maximum(before[1], 1), low.mean(0)])
            w = sequence_weights(p, _seen_gate(before[0]) * 16 + _seen_gate(before[1]), doc)
            across = w[0] * p[0] + w[1] * p[1]
            for j in range(len(EXPERTS)):
                logs[j, lo:hi] = np.add.reduceat(np.log10(np.maximum(across + w[2] * low[j], 1e-290)), begin)
        top = logs.max(0)
        total = top + np.log10((10.0 ** (logs - top)).mean(0)) if len(n) else top
        b_cum = np.concatenate([[0.0], np.cumsum(base[tokens])])
        k_cum = np.concatenate([[0], np.cumsum(c[tokens] > 0)])
        l_cum = np.concatenate([[0], np.cumsum(lengths[tokens] + 1)])
        bytes_ = l_cum[offsets[1:]] - l_cum[offsets[:-1]] + 1
        ids = pa.array(np.frombuffer(r["docs"], "<i8"), mask=np.frombuffer(r["no_id"], np.uint8).astype(bool))
        return pa.table([ids, pa.array(np.frombuffer(r["held"], np.uint8).astype(bool)), pa.array(n + 1),
                         pa.array(k_cum[offsets[1:]] - k_cum[offsets[:-1]] + (1 if ends else 0)),
                         pa.array(np.full(len(n), n_all)), pa.array(b_cum[offsets[1:]] - b_cum[offsets[:-1]] + np.log10((ends + 1) / whole)),
                         pa.array(total), pa.array(-total / np.log10(2) / bytes_)], schema=out_pa)

    own = blocks.select("block", "docs", "no_id", "held", "counts", "tokens", "hashes", "lengths")
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)


def _f4(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<f4")
