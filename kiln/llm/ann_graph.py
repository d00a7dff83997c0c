"""Approximate nearest neighbours by inner product on robust-pruned graphs.

Equal vectors are one node with the smallest ids of its members, so a vector
that a third of all rows share is one node.  Nodes are dealt by hash to
shards of about ``shard_rows``; each shard is indexed on its own.  For largest
inner products vectors get one more component that gives all of them the
shard's greatest norm; then nearest and largest inner product are the same.

A shard's graph starts at random.  Two passes visit all nodes in batches: a
greedy search from the shard's centre proposes the nodes it has expanded, and
relaxed pruning keeps of these and the present neighbours the nearest, drops
each that lies by the factor ``alpha`` nearer to the kept one than to the
node, and goes on to the next nearest.  Edges are added back and an
overfull neighbour is pruned the same way.  A tight cluster can keep all its
edges to itself, so searches begin at ``ENTRIES`` nodes: one half chosen each
farthest from those before, the other half at random.

The index (a row a shard) is written to the shared folder.  Queries go to
every shard in blocks; a beam search gives the nearest nodes, their exact
inner products are taken in double precision on the original vectors, and the
shards' best are ranked together.

Defined results: vectors that are null, zero, contain null or non-finite
components or have another length than most take no part, neither as query
nor as candidate; of rows that repeat a ``vec_id`` the smallest vector counts
and a null ``vec_id`` takes no part; ties go to the smaller ``vec_id``; with
fewer than ``k`` candidates all are returned; an empty table gives no rows;
other columns are neither read nor returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from kiln.session import materialize

DEGREE, BEAM, EXPAND, ALPHA, BATCH, ENTRIES = 32, 64, 4, 1.2, 512, 128


class Graph:
    """A shard's vectors (unit-like: equal norms) and out-edges (-1: none)."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, entries: np.ndarray):
        self.vectors, self.edges, self.entries = vectors, edges, entries

    def search(self, queries: np.ndarray, beam: int, keep_expanded: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beam search of a block of queries: node and closeness (inner
        product) of the beam, closest first, and the expanded nodes."""
        b = len(queries)
        nodes = np.full((b, beam), -1, np.int64)
        close = np.full((b, beam), -np.inf, np.float32)
        open_ = np.zeros((b, beam), bool)
        expanded = []
        rows = np.arange(b)[:, None]
        first = queries @ self.vectors[self.entries].T
        best = np.argsort(-first, axis=1, kind="stable")[:, :beam]
        width = best.shape[1]
        nodes[:, :width], close[:, :width], open_[:, :width] = self.entries[best], first[rows, best], True
        while open_.any():
            at = np.argsort(~open_, axis=1, kind="stable")[:, :EXPAND]  # the beam is sorted: the closest open ones
            chosen = np.where(open_[rows, at], nodes[rows, at], -1)
            open_[rows, at] = False
            if keep_expanded:
                expanded.append(chosen)
            found = np.where(chosen[:, :, None] >= 0, self.edges[chosen], -1).reshape(b, -1)
            found.sort(axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            found[(found[:, :, None] == nodes[:, None, :]).any(2)] = -1
            used = np.flatnonzero((found >= 0).any(0))
            if not len(used):
                continue
            found = found[:, used[0]:]
            score = np.einsum("bd,brd->br", queries, self.vectors[found])
            score[found < 0] = -np.inf
            nodes, close, open_ = (np.concatenate(x, 1) for x in ((nodes, found), (close, score), (open_, found >= 0)))
            best = np.argsort(-close, axis=1, kind="stable")[:, :beam]
            nodes, close, open_ = nodes[rows, best], close[rows, best], open_[rows, best]
            open_ &= nodes >= 0
        return nodes, close, np.concatenate(expanded, 1) if expanded else np.zeros((b, 0), np.int64)


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Out-edges of ``nodes`` from ``candidates`` (rows, -1: none)."""
    b, m = candidates.shape
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    candidates[candidates == nodes[:, None]] = -1
    own = vectors[candidates]
    norm = float(vectors[0] @ vectors[0])
    distance = norm - np.einsum("bd,bmd->bm", vectors[nodes], own)  # half the squared distance
    distance[candidates < 0] = np.inf
    order = np.argsort(distance, axis=1, kind="stable")
    rows = np.arange(b)[:, None]
    candidates, distance, own = candidates[rows, order], distance[rows, order], own[rows, order]
    between = norm - own @ own.transpose(0, 2, 1)
    alive = candidates >= 0
    out = np.full((b, degree), -1, np.int64)
    line = np.arange(b)
    for k in range(degree):
        first = alive.argmax(1)
        some = alive[line, first]
        if not some.any():
            break
        out[some, k] = candidates[line, first][some]
        alive &= (alpha ** 2) * between[line, first] > distance
        alive[line, first] = False
    return out


def _entries(vectors: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    n = len(vectors)
    far = [int(np.argmax(vectors @ vectors.mean(0)))]
    closest = vectors @ vectors[far[0]]
    while len(far) < min(ENTRIES // 2, n):
        far.append(int(np.argmin(closest)))
        closest = np.maximum(closest, vectors @ vectors[far[-1]])
    return np.unique(np.append(far, rng.permutation(n)[:ENTRIES // 2]))


def build(vectors: np.ndarray, seed: int, degree: int = DEGREE, beam: int = BEAM) -> Graph:
    """A graph over ``vectors`` of equal norm."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    edges = np.full((n, degree), -1, np.int64)
    if n > 1:
        width = min(degree // 2, n - 1)
        edges[:, :width] = (np.arange(n)[:, None] + rng.integers(1, n, (n, width))) % n
    graph = Graph(vectors, edges, _entries(vectors, rng))
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for lo in range(0, n, BATCH):
            nodes = order[lo:lo + BATCH]
            beam_nodes, _, expanded = graph.search(vectors[nodes], beam, keep_expanded=True)
            edges[nodes] = robust_prune(vectors, nodes, np.concatenate((expanded, beam_nodes, edges[nodes]), 1), alpha, degree)
            _add_back(vectors, edges, nodes, alpha)
    return graph


def _add_back(vectors: np.ndarray, edges: np.ndarray, nodes: np.ndarray, alpha: float) -> None:
    """Edges to ``nodes`` from their new neighbours."""
    degree = edges.shape[1]
    to = edges[nodes].reshape(-1)
    frm = np.repeat(nodes, degree)[to >= 0]
    to = to[to >= 0]
    closeness = np.einsum("ed,ed->e", vectors[to], vectors[frm])
    order = np.lexsort((-closeness, to))
    to, frm = to[order], frm[order]
    targets, first, number = np.unique(to, return_index=True, return_counts=True)
    place = np.arange(len(to)) - np.repeat(first, number)
    near = place < degree  # of more than ``degree`` new ones the nearest
    new = np.full((len(targets), min(degree, int(number.max())) if len(targets) else 0), -1, np.int64)
    new[np.repeat(np.arange(len(targets)), number)[near], place[near]] = frm[near]
    present = (new[:, :, None] == edges[targets][:, None, :]).any(2)
    new[present] = -1
    have, more = (edges[targets] >= 0).sum(1), (new >= 0).sum(1)
    for rows in np.array_split(np.arange(len(targets)), max(1, len(targets) // 1024)):
        fits = rows[(have[rows] + more[rows] <= degree) & (more[rows] > 0)]
        both = np.concatenate((edges[targets[fits]], new[fits]), 1)
        edges[targets[fits]] = -np.sort(-both, axis=1)[:, :degree]
        full = rows[have[rows] + more[rows] > degree]
        if len(full):
            edges[targets[full]] = robust_prune(vectors, targets[full], np.concatenate((edges[targets[full]], new[full]), 1), alpha, degree)


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    values = lists.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """One more component: all norms become the greatest."""
    square = np.einsum("nd,nd->n", vectors, vectors)
    return np.concatenate((vectors, np.sqrt(np.maximum(square.max() - square, 0))[:, None]), 1).astype(np.float32)


def _indexed(table: pa.Table) -> pa.Table:
    """A shard's rows as one row: vectors, member ids, edges, entries."""
    table = table.sort_by("node")
    vectors = _matrix(table.column("vector"))
    graph = build(lifted(vectors.astype(np.float64)), int(table.column("shard")[0].as_py()))
    return pa.table({"shard": table.column("shard")[:1], "dims": pa.array([vectors.shape[1]], pa.int32()), "vectors": pa.array([vectors.tobytes()], pa.binary()),
                     "members": pa.array([table.column("members").to_pylist()], pa.list_(pa.list_(pa.int64()))),
                     "edges": pa.array([graph.edges.astype(np.int32).tobytes()], pa.binary()), "entries": pa.array([graph.entries.astype(np.int32)], pa.list_(pa.int32()))})


def usable(vector: Column) -> Column:
    """Not null, all components finite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_vectors(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    rows = frame.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    most = rows.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").limit(1).collect()
    if most:
        rows = rows.filter(F.size("vector") == most[0]["dims"])
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def build_index(vectors: DataFrame, k: int, shard_rows: int = 8192) -> DataFrame:
    """The written index of ``vec_id, vector``: a row a shard, with up to
    ``k + 1`` members of each node (no result can hold more)."""
    within = Window.partitionBy("vector").orderBy("vec_id")
    nodes = (vectors.withColumn("place", F.row_number().over(within)).filter(F.col("place") <= k + 1)
             .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members")))
    nodes = materialize(nodes.withColumn("node", F.col("members")[0]), "vector-nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int"))
    return materialize(dealt.groupBy("shard").applyInArrow(
        _indexed, "shard int, dims int, vectors binary, members array<array<long>>, edges binary, entries array<int>"), "vector-index")


def _searched(queries: pa.Table, index: pa.Table, k: int, beam: int) -> pa.Table:
    names = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
    if not index.num_rows or not queries.num_rows:
        return pa.table({c: pa.array([], t) for c, t in names.items()})
    row = index.slice(0, 1).to_pylist()[0]
    asked = _matrix(queries.column("vector"))
    vectors = np.frombuffer(row["vectors"], asked.dtype).reshape(-1, row["dims"])
    graph = Graph(lifted(vectors.astype(np.float64)), np.frombuffer(row["edges"], np.int32).reshape(len(vectors), -1).astype(np.int64), np.array(row["entries"], np.int64))
    ids, out = queries.column("query_id").to_numpy(), []
    for lo in range(0, len(ids), BATCH):
        part = asked[lo:lo + BATCH]
        nodes, _, _ = graph.search(np.concatenate((part, np.zeros((len(part), 1))), 1).astype(np.float32), beam)
        score = np.einsum("bd,brd->br", part.astype(np.float64), vectors[nodes].astype(np.float64))
        for query, own, close in zip(ids[lo:lo + BATCH].tolist(), nodes, score):
            found = [(-s, m) for n, s in zip(own.tolist(), close.tolist()) if n >= 0 for m in row["members"][n] if m != query]
            out += [(query, m, -s) for s, m in sorted(found)[:k]]
    return pa.table({c: pa.array(x, t) for (c, t), x in zip(names.items(), zip(*out) if out else ([], [], []))})


def nearest(queries: DataFrame, index: DataFrame, k: int, beam: int = 2 * BEAM, block_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each of
    ``queries`` (``vec_id, vector``), its own row left out."""
    shards = index.select("shard").count()
    blocks = max(1, -(-queries.count() // block_rows))
    asked = (queries.select(F.col("vec_id").alias("query_id"), "vector", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))) if shards else queries.select(
                 F.col("vec_id").alias("query_id"), "vector", F.lit(0).alias("block"), F.lit(0).alias("shard")))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        return _searched(left, right, k, beam)

    found = asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInArrow(searched, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(frame: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = 8192) -> DataFrame:
    """The ``k`` nearest of every row whose id is divisible by ``every``."""
    vectors = materialize(usable_vectors(frame, id_col, vector_col), "vectors")
    index = build_index(vectors, k, shard_rows)
    return nearest(vectors.filter(F.pmod("vec_id", F.lit(every)) == 0), index, k)
