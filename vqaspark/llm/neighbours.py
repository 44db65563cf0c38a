"""Approximate nearest neighbours by NN-descent (operator 3).

The index is a graph: every distinct vector keeps its ``K`` best neighbours by
inner product.  It starts from groups that share hyperplane signs and improves
by joining neighbours of neighbours: in each round, the members of a vector's
list and of its reverse list are compared with one another, and every pair
that improves a list is sent there.  Queries walk the graph greedily from
their own node.

Vectors are spread by hash over blocks of about ``BLOCK`` vectors; every round
is a few equi-joins (cogroups) of blocks with messages for them.  A message
names each vector once per asking block, so hot vectors do not multiply, and a
block never holds more than its own lists and the vectors these name.

Rows with equal vectors share one node (its first ``TOP + 1`` ids are kept with
it: more can never be needed, and the window's limit is applied before the
shuffle).  The graph and the walk use 8-bit vectors; the candidates they find
are measured in double precision on the original ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.llm.base import mix64, write_scratch

K = 50              # neighbours kept in the graph
REVERSE = 40        # reverse neighbours joined per vector and round
ROUNDS = 5
TABLES = 3          # hyperplane groupings that start the graph
GROUP = 1024        # vectors of a starting group, about
BLOCK = 2048        # vectors of a block, about
BEAM = 96           # best nodes whose neighbours a query looks at, per hop
HOPS = 4
RESCORED = 64       # best nodes of a query measured exactly
QUERY_BLOCK = 256

_EMIT = "block long, u binary, w binary, s binary"
_STATE = "block long, ids binary, nbr binary, sc binary"
_VECS = "block long, ids binary, vec binary, scale binary"


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (mix64(ids.view(np.uint64) if ids.dtype == np.int64 else ids.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def _i8(x) -> np.ndarray:
    return np.frombuffer(x, "<i8")


def _f4(x) -> np.ndarray:
    return np.frombuffer(x, "<f4")


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


_EMIT_PA = pa.schema([("block", pa.int64()), ("u", pa.binary()), ("w", pa.binary()), ("s", pa.binary())])


def _by_block(target: np.ndarray, *arrays) -> list[tuple]:
    """Arrays split by target block."""
    order = np.argsort(target, kind="stable")
    t = target[order]
    cuts = np.flatnonzero(np.diff(t)) + 1
    ends = np.append(cuts, len(t))
    out, lo = [], 0
    for hi in ends if len(t) else []:
        out.append((int(t[lo]), *[a[order[lo:hi]] for a in arrays]))
        lo = hi
    return out


def _best(u: np.ndarray, w: np.ndarray, s: np.ndarray, k: int):
    """Of each u, its k distinct best w; equal scores in pseudorandom order, so
    that no vector collects all of its equals."""
    order = np.lexsort((w, u))
    u, w, s = u[order], w[order], s[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
    u, w, s = u[new], w[new], s[new]
    order = np.lexsort((mix64(u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ w.astype(np.uint64)), -s, u))
    u, w, s = u[order], w[order], s[order]
    head = np.ones(len(u), bool)
    head[1:] = u[1:] != u[:-1]
    start = np.flatnonzero(head)
    rank = np.arange(len(u)) - np.repeat(start, np.diff(np.append(start, len(u))))
    keep = rank < k
    return u[keep], w[keep], s[keep], rank[keep]


def _emissions(u, w, s, blocks: int, k: int = K) -> list[dict]:
    u, w, s, _ = _best(u, w, s, k)
    return [{"block": b, "u": x.astype("<i8").tobytes(), "w": y.astype("<i8").tobytes(), "s": z.astype("<f4").tobytes()}
            for b, x, y, z in _by_block(block_of(u, blocks), u, w, s)]


# -- nodes --------------------------------------------------------------------

def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): vectors that take part: with an id, not null or empty, all
    components finite, not all zero.  -0 counts as 0."""
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))
    r = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return r.where(fine & F.exists("v", lambda x: x != 0))


def _vector_blocks(nodes: DataFrame, blocks: int) -> DataFrame:
    """8-bit vectors, a packed row per block."""
    def spread(batches):
        for b in batches:
            if b.num_rows:
                ids = b.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(block_of(ids, blocks)), b.column(0), b.column(1)],
                                                 names=["block", "vec_id", "v"])

    def pack(key, t):
        t = t.sort_by("vec_id")
        x = _matrix(t.column("v"))
        scale = np.abs(x).max(1) / 127
        q = np.rint(x / scale[:, None]).astype(np.int8)
        return pa.table({"block": [key[0].as_py()], "ids": [t.column("vec_id").to_numpy().astype("<i8").tobytes()],
                         "vec": [q.tobytes()], "scale": [scale.astype("<f4").tobytes()]},
                        schema=pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("vec", pa.binary()), ("scale", pa.binary())]))

    return nodes.mapInArrow(spread, "block long, vec_id long, v array<double>").groupBy("block").applyInArrow(pack, _VECS)


def _matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def _start(nodes: DataFrame, n: int, blocks: int, dim: int, seed: int) -> DataFrame:
    """First candidates: brute force within groups of equal hyperplane signs,
    cut by hash to about GROUP vectors however many share the signs."""
    bits = max(int(np.ceil(np.log2(max(n / GROUP, 1)))), 0)
    planes = np.random.default_rng(seed).standard_normal((TABLES, dim, max(bits, 1)))

    def code(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1))
            for t in range(TABLES):
                signs = (x @ planes[t] > 0).astype(np.int64)[:, :bits]
                key = (signs << np.arange(bits)).sum(1) * TABLES + t
                yield pa.RecordBatch.from_arrays([pa.array(key), b.column(0), b.column(1)], names=["g", "vec_id", "v"])

    coded = nodes.mapInArrow(code, "g long, vec_id long, v array<double>")
    sizes = coded.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.greatest(F.floor(F.col("n") / GROUP), F.lit(1))
    cut = coded.join(sizes, "g").select("g", F.pmod(F.xxhash64("vec_id", "g"), pieces).alias("part"), "vec_id", "v")

    def near(_, t):
        ids, x = t.column("vec_id").to_numpy(), _matrix(t.column("v")).astype(np.float32)
        out = []
        k = min(K, len(ids) - 1)
        for lo in range(0, len(ids) if k > 0 else 0, 512):
            s = x[lo:lo + 512] @ x.T
            s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
            at = np.argpartition(-s, k - 1, axis=1)[:, :k]
            out += _emissions(np.repeat(ids[lo:lo + 512], k), ids[at].ravel(), np.take_along_axis(s, at, 1).ravel(), blocks)
        return _table(out, _EMIT_PA)

    return cut.groupBy("g", "part").applyInArrow(near, _EMIT)


# -- rounds -------------------------------------------------------------------

def _merge(key, own: pa.Table, sent: pa.Table) -> pa.Table:
    """New lists of a block from its lists and the pairs sent to it."""
    schema = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("nbr", pa.binary()), ("sc", pa.binary())])
    if not own.num_rows:
        return _table([], schema)
    r = own.to_pylist()[0]
    ids = _i8(r["ids"])
    us, ws, ss = [], [], []
    if "nbr" in r:
        nbr, sc = _i8(r["nbr"]), _f4(r["sc"])
        ok = np.isfinite(sc)
        us.append(np.repeat(ids, K)[ok])
        ws.append(nbr[ok])
        ss.append(sc[ok])
    for m in sent.to_pylist():
        us.append(_i8(m["u"]))
        ws.append(_i8(m["w"]))
        ss.append(_f4(m["s"]))
    nbr, sc = np.full((len(ids), K), -1, "<i8"), np.full((len(ids), K), -np.inf, "<f4")
    if us:
        u, w, s, rank = _best(np.concatenate(us), np.concatenate(ws), np.concatenate(ss), K)
        at = np.searchsorted(ids, u)
        nbr[at, rank], sc[at, rank] = w, s
    return _table([{"block": key[0].as_py(), "ids": r["ids"], "nbr": nbr.tobytes(), "sc": sc.tobytes()}], schema)


def _lists(state: DataFrame, blocks: int, salt: int) -> DataFrame:
    """(block, ids, members, thr): each vector's list and a sample of its
    reverse list, and the score that a new neighbour must beat."""
    def back(batches):
        for b in batches:
            for r in b.to_pylist():
                ids, nbr, ok = _i8(r["ids"]), _i8(r["nbr"]), np.isfinite(_f4(r["sc"]))
                u, v = np.repeat(ids, K)[ok], nbr[ok]
                chance = (mix64(u.view(np.uint64) ^ mix64(v.view(np.uint64) + np.uint64(salt))) >> np.uint64(40)).astype(np.float64)
                v, u, _, _ = _best(v, u, chance, REVERSE)
                rows = [{"block": t, "u": x.astype("<i8").tobytes(), "w": y.astype("<i8").tobytes(), "s": b""}
                        for t, x, y in _by_block(block_of(v, blocks), v, u)]
                yield from _table(rows, _EMIT_PA).to_batches()

    schema = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("members", pa.binary()), ("thr", pa.binary())])

    def gather(key, own, sent):
        if not own.num_rows:
            return _table([], schema)
        r = own.to_pylist()[0]
        ids = _i8(r["ids"])
        out = np.full((len(ids), K + REVERSE), -1, "<i8")
        out[:, :K] = _i8(r["nbr"]).reshape(-1, K)
        sc = _f4(r["sc"]).reshape(-1, K)
        out[:, :K][~np.isfinite(sc)] = -1
        got = sent.to_pylist()
        if got:
            v, u = np.concatenate([_i8(m["u"]) for m in got]), np.concatenate([_i8(m["w"]) for m in got])
            chance = (mix64(u.view(np.uint64) ^ mix64(v.view(np.uint64) + np.uint64(salt))) >> np.uint64(40)).astype(np.float64)
            v, u, _, rank = _best(v, u, chance, REVERSE)
            out[np.searchsorted(ids, v), K + rank] = u
        return _table([{"block": key[0].as_py(), "ids": r["ids"], "members": out.tobytes(),
                        "thr": np.ascontiguousarray(sc[:, -1]).astype("<f4").tobytes()}], schema)

    sent = state.mapInArrow(back, _EMIT)
    return state.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(
        gather, "block long, ids binary, members binary, thr binary")


def _fetch(asked: DataFrame, owned: DataFrame, blocks: int, answer, schema: str) -> DataFrame:
    """Answers to (block that asks, ids): one message per asking block and owner.

    ``answer(owner row, ids)`` gives the columns of a message."""
    need = pa.schema([("block", pa.int64()), ("to", pa.int64()), ("ids", pa.binary())])

    def ask(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = np.unique(_i8(r["wanted"]))
                ids = ids[ids >= 0]                      # -1 fills short lists
                rows = [{"block": t, "to": r["block"], "ids": x.astype("<i8").tobytes()}
                        for t, x in _by_block(block_of(ids, blocks), ids)]
                yield from _table(rows, need).to_batches()

    asks = asked.mapInArrow(ask, "block long, to long, ids binary")
    names = pa.schema([("block", pa.int64())] + [(c.split()[0], pa.binary()) for c in schema.split(", ")])

    def reply(_, own, requests):
        if not own.num_rows:
            return _table([], names)
        r = own.to_pylist()[0]
        mine = _i8(r["ids"])
        return _table([{"block": q["to"]} | answer(r, np.searchsorted(mine, _i8(q["ids"]))) | {"ids": q["ids"]}
                       for q in requests.to_pylist()], names)

    return owned.groupBy("block").cogroup(asks.groupBy("block")).applyInArrow(reply, "block long, " + schema)


def _vec_answer(r: dict, at: np.ndarray) -> dict:
    scale = _f4(r["scale"])
    q = np.frombuffer(r["vec"], np.int8).reshape(len(scale), -1)
    out = {"vec": q[at].tobytes(), "scale": scale[at].tobytes()}
    if "thr" in r:
        out["thr"] = _f4(r["thr"])[at].tobytes()
    return out


def _known(messages: list[dict]):
    """Ids, vectors (float32) and thresholds that a block was sent, by id."""
    ids = np.concatenate([_i8(m["ids"]) for m in messages])
    scale = np.concatenate([_f4(m["scale"]) for m in messages])
    x = np.concatenate([np.frombuffer(m["vec"], np.int8) for m in messages]).reshape(len(ids), -1)
    order = np.argsort(ids)
    thr = np.concatenate([_f4(m["thr"]) for m in messages])[order] if "thr" in messages[0] else None
    return ids[order], x[order].astype(np.float32) * scale[order, None], thr


def _round(state: DataFrame, vectors: DataFrame, blocks: int, salt: int) -> DataFrame:
    lists = write_scratch(_lists(state, blocks, salt), "op3-lists")
    owned = vectors.join(lists.select("block", "thr"), "block")
    asked = lists.select("block", F.col("members").alias("wanted"))
    sent = _fetch(asked, owned, blocks, _vec_answer, "ids binary, vec binary, scale binary, thr binary")

    def join(_, own, got):
        if not own.num_rows or not got.num_rows:
            return _table([], _EMIT_PA)
        ids, x, thr = _known(got.to_pylist())
        us, ws, ss = [], [], []
        for row in _i8(own.to_pylist()[0]["members"]).reshape(-1, K + REVERSE):
            m = np.unique(row)
            m = m[m >= 0]
            if len(m) < 2:
                continue
            at = np.searchsorted(ids, m)
            s = x[at] @ x[at].T
            np.fill_diagonal(s, -np.inf)
            a, b = np.nonzero(s > thr[at][:, None])
            us.append(m[a])
            ws.append(m[b])
            ss.append(s[a, b])
        if not us:
            return _table([], _EMIT_PA)
        return _table(_emissions(np.concatenate(us), np.concatenate(ws), np.concatenate(ss), blocks), _EMIT_PA)

    found = lists.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(join, _EMIT)
    return write_scratch(state.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_merge, _STATE), "op3-graph")


def build(nodes: DataFrame, n: int, dim: int, rounds: int = ROUNDS, seed: int = 1) -> tuple[DataFrame, DataFrame, int]:
    """(graph, 8-bit vectors, blocks) of the nodes (vec_id >= 0, v)."""
    blocks = max(n // BLOCK, 1)
    vectors = write_scratch(_vector_blocks(nodes, blocks), "op3-vectors")
    first = _start(nodes, n, blocks, dim, seed)
    state = write_scratch(vectors.select("block", "ids").groupBy("block").cogroup(first.groupBy("block"))
                          .applyInArrow(_merge, _STATE), "op3-graph")
    for i in range(rounds):
        state = _round(state, vectors, blocks, seed + i)
    return state, vectors, blocks


# -- search -------------------------------------------------------------------

def walk(starts: DataFrame, graph: DataFrame, vectors: DataFrame, blocks: int, salt: int = 99) -> DataFrame:
    """(q, node): the RESCORED best nodes found from each start node (vec_id).

    Hop by hop, the neighbours of each query's best BEAM nodes that were not
    looked at yet are measured."""
    edges = write_scratch(_lists(graph, blocks, salt), "op3-edges").select("block", "ids", "members")
    n = starts.count()
    query_blocks = max(n // QUERY_BLOCK, 1)
    schema = "block long, q binary, found binary, score binary, looked binary, wanted binary"
    pas = pa.schema([("block", pa.int64())] + [(c, pa.binary()) for c in ("q", "found", "score", "looked", "wanted")])

    def begin(_, t):
        ids = np.unique(t.column("vec_id").to_numpy())
        return _table([{"block": t.column("block")[0].as_py(), "q": ids.astype("<i8").tobytes(), "found": ids.astype("<i8").tobytes(),
                        "score": np.full(len(ids), np.inf, "<f4").tobytes(), "looked": b"", "wanted": ids.astype("<i8").tobytes()}], pas)

    def spread(batches):
        for b in batches:
            if b.num_rows:
                ids = b.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(block_of(ids, query_blocks)), b.column(0)], names=["block", "vec_id"])

    at = starts.select("vec_id").distinct().mapInArrow(spread, "block long, vec_id long").groupBy("block").applyInArrow(begin, schema)
    at = write_scratch(at, "op3-walk")

    def edge_answer(r, i):
        return {"members": _i8(r["members"]).reshape(-1, K + REVERSE)[i].tobytes()}

    for hop in range(HOPS):
        asked = at.select("block", "wanted")
        near = _fetch(asked, edges, blocks, edge_answer, "ids binary, members binary")

        def widen(key, own, got):
            """Nodes to measure: neighbours of the wanted ones."""
            if not own.num_rows:
                return _table([], pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("members", pa.binary()), ("wanted", pa.binary())]))
            got = got.to_pylist()
            ids = np.concatenate([_i8(m["ids"]) for m in got]) if got else np.zeros(0, np.int64)
            members = (np.concatenate([_i8(m["members"]) for m in got]) if got else np.zeros(0, np.int64)).reshape(len(ids), K + REVERSE)
            order = np.argsort(ids)
            q = _i8(own.to_pylist()[0]["q"])
            want = np.unique(np.concatenate([members.ravel(), q]))
            return _table([{"block": key[0].as_py(), "ids": ids[order].tobytes(), "members": members[order].tobytes(),
                            "wanted": want[want >= 0].tobytes()}],
                          pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("members", pa.binary()), ("wanted", pa.binary())]))

        wide = write_scratch(at.groupBy("block").cogroup(near.groupBy("block")).applyInArrow(
            widen, "block long, ids binary, members binary, wanted binary"), "op3-walk")
        sent = _fetch(wide.select("block", "wanted"), vectors, blocks, _vec_answer,
                      "ids binary, vec binary, scale binary")
        both = at.join(wide.select("block", F.col("ids").alias("eids"), F.col("members").alias("emem")), "block")

        def step(key, own, got):
            if not own.num_rows or not got.num_rows:
                return _table([], pas)
            r = own.to_pylist()[0]
            ids, x, _ = _known(got.to_pylist())
            eids = _i8(r["eids"])
            mem = _i8(r["emem"]).reshape(len(eids), K + REVERSE)
            q, found, score, looked = _i8(r["q"]), _i8(r["found"]), _f4(r["score"]), _i8(r["looked"])
            # found and looked hold pairs (query number, node) after the first hop.
            if not len(looked):
                pairs, old_s, done = np.zeros((0, 2), np.int64), np.zeros(0, np.float32), np.zeros((0, 2), np.int64)
                front = np.stack([np.arange(len(q)), q], 1)
            else:
                pairs, old_s, done = found.reshape(-1, 2), score, looked.reshape(-1, 2)
                front = _front(pairs, old_s, done)
            done = np.concatenate([done, front])
            cand_q = np.repeat(front[:, 0], mem.shape[1]) if len(eids) else np.zeros(0, np.int64)
            cand = mem[np.searchsorted(eids, front[:, 1])].ravel() if len(eids) else np.zeros(0, np.int64)
            ok = cand >= 0
            cand_q, cand = cand_q[ok], cand[ok]
            order = np.lexsort((cand, cand_q))
            cand_q, cand = cand_q[order], cand[order]
            new = np.ones(len(cand), bool)
            new[1:] = (cand_q[1:] != cand_q[:-1]) | (cand[1:] != cand[:-1])
            cand_q, cand = cand_q[new], cand[new]
            s = np.zeros(len(cand), np.float32)
            mine = np.searchsorted(ids, q)
            cuts = np.searchsorted(cand_q, np.arange(len(q) + 1))
            where = np.searchsorted(ids, cand)
            for i in range(len(q)):
                lo, hi = cuts[i], cuts[i + 1]
                s[lo:hi] = x[where[lo:hi]] @ x[mine[i]]
            u, w, s2, _ = _best(np.concatenate([pairs[:, 0], cand_q]), np.concatenate([pairs[:, 1], cand]),
                                np.concatenate([old_s, s]), max(BEAM, RESCORED))
            pairs = np.stack([u, w], 1)
            nxt = _front(pairs, s2, done)
            return _table([{"block": key[0].as_py(), "q": r["q"], "found": pairs.astype("<i8").tobytes(), "score": s2.astype("<f4").tobytes(),
                            "looked": done.astype("<i8").tobytes(), "wanted": np.unique(nxt[:, 1]).astype("<i8").tobytes()}], pas)

        at = write_scratch(both.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(step, schema), "op3-walk")

    def unpack(batches):
        for b in batches:
            for r in b.to_pylist():
                q, pairs, s = _i8(r["q"]), _i8(r["found"]), _f4(r["score"])
                if not len(_i8(r["looked"])):
                    continue
                pairs = pairs.reshape(-1, 2)
                u, w, _, _ = _best(pairs[:, 0], pairs[:, 1], s, RESCORED)
                yield pa.RecordBatch.from_arrays([pa.array(q[u]), pa.array(w)], names=["q", "node"])

    return at.mapInArrow(unpack, "q long, node long")


def _front(pairs: np.ndarray, s: np.ndarray, done: np.ndarray) -> np.ndarray:
    """Each query's best BEAM nodes without those already looked at."""
    u, w, _, _ = _best(pairs[:, 0], pairs[:, 1], s, BEAM)
    if not len(u):
        return np.zeros((0, 2), np.int64)
    both = np.concatenate([done, np.stack([u, w], 1)])
    old = np.concatenate([np.zeros(len(done), np.int8), np.ones(len(u), np.int8)])
    order = np.lexsort((old, both[:, 1], both[:, 0]))
    b, o = both[order], old[order]
    first = np.ones(len(b), bool)
    first[1:] = (b[1:] != b[:-1]).any(1)
    return b[first & (o == 1)]


def nearest(rows: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", top: int = 20) -> DataFrame:
    """For each query row, its ``top`` nearest other rows found: ``query_id``,
    ``rank`` (from 1), the id and ``score`` (inner product in double precision).

    ``is_query`` maps the id column to a condition.  Rows with a null id, or a
    null, empty, zero or not wholly finite vector take no part; vectors of the
    table must have one length.  Repeated ids are rows of their own (a row is
    never its own neighbour, nor are other rows of its id); ties go to the
    smaller id.  A table without such rows gives an empty result; other
    columns are not read."""
    schema = "query_id long, rank int, vec_id long, score double"
    spark = rows.sparkSession
    good = write_scratch(usable(rows, id_col, vec_col).distinct(), "op3-rows")
    firsts = Window.partitionBy("v").orderBy("vec_id")
    members = write_scratch(good.withColumn("r", F.row_number().over(firsts)).where(F.col("r") <= top + 1), "op3-members")
    # Nodes carry numbers that are never negative, whatever the ids.
    nodes = write_scratch(members.where("r = 1").select(F.col("vec_id").alias("first_id"), "v")
                          .withColumn("vec_id", F.xxhash64("v").bitwiseAND(F.lit((1 << 63) - 1))), "op3-nodes")
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("a"), F.max(F.size("v")).alias("b")).first()
    if not size["n"]:
        return spark.createDataFrame([], schema)
    if size["a"] != size["b"]:
        raise ValueError(f"vectors of {size['a']} to {size['b']} components in one table")
    graph, vectors, blocks = build(nodes.select("vec_id", "v"), size["n"], size["a"])
    asked = good.where(is_query(F.col("vec_id"))).join(nodes.select("v", F.col("vec_id").alias("q")), "v").select(
        F.col("vec_id").alias("query_id"), "q", F.col("v").alias("qv"))
    asked = write_scratch(asked, "op3-queries")
    found = walk(asked.select(F.col("q").alias("vec_id")), graph, vectors, blocks)
    found = found.unionByName(asked.select("q", F.col("q").alias("node"))).distinct()     # a query's equals are candidates too
    own = members.join(nodes.select("v", F.col("vec_id").alias("node")), "v").select("node", "vec_id", "v")
    cand = found.join(nodes.select(F.col("vec_id").alias("node"), "first_id", "v"), "node").select("q", "node", "first_id", "v")
    product = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    scored = asked.join(cand, "q").select("query_id", "node", "first_id", product.alias("score"))
    # Only nodes that can be among the best are expanded to their rows; of equal ones, those with the smallest ids.
    best = scored.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "first_id")))
    listed = (best.where(F.col("r") <= top + 1).select("query_id", "node", "score")
              .join(own.select("node", "vec_id"), "node").where("vec_id <> query_id").groupBy("query_id", "vec_id")
              .agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return listed.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
