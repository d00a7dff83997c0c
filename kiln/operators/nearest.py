"""Exact cosine nearest neighbours of many queries by a tree of pivots.

Vectors belong to the cell of the nearest leaf pivot, and leaves to the nearest
top pivot; the number of leaves grows with the collection (``CELL_ROWS`` vectors a
leaf) as far as the tree stays under ``TREE_BYTES``, so that its broadcast has
a bound.  A cell's centre, radius and size bound the distance of everything in
it.  Queries are blocks of neighbouring cells, those of one top pivot; a block
visits the cells that can still hold one of the k nearest of a query in it:
first the top pivots whose whole subtree is too far are ruled out, then single
leaves.  The visited (block, cell) pairs are a table of their own, and both
queries and members are joined to it, so a member moves to the blocks that
visit its cell and to no others.  A block's cells are dealt into tiles; a task
scores one block against one tile, and k rows a query leave it.  A block and a
tile have thousands of rows where a cell has hundreds: on data without clusters,
where nearly every block visits nearly every cell, what is moved that way is a
member a block, a query a tile and k rows a query and tile: it grows with the
product of both tables.

So where members would move to more than ``MOVES`` blocks on average, they are
not moved.  Both sides are packed into rows of thousands of vectors, written
once, and a task reads one block of queries and passes the tiles of the members
by it (a Cartesian product of packed rows, which is read and never shuffled).
It keeps the k nearest so far of each query, looks at the cells a query's
neighbours visit only, and scores in single precision what can still come
nearer, exactly what may.  What leaves a task is k rows a query; the members are
dealt over a few tasks where there are fewer blocks than the cluster can run.

Of equal vectors only the k with the smallest ids can be among the k nearest;
the others are left out before anything is compared, so a vector that a third
of the collection has is no more than k members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.vectors import norm
from ..session import forget, materialize_wide, rows_a_batch
from ..session import materialize_passing as materialize

#: Vectors a leaf is made for, and the largest tree.
CELL_ROWS, TREE_BYTES = 256, 64 << 20
#: Distances a task holds at once, and the largest block or tile.
TILE_CELLS, TILE_BYTES = 2 << 20, 32 << 20
#: Blocks a member moves to on average at most; beyond that tiles pass by blocks.
MOVES = 4
#: Of such tiles the largest, the tasks for each core, and the queries that look at the same cells.
PASS_ROWS, PASS_TASKS, PASS_CHUNK = 4096, 3, 1024
#: Distances held at once there, exact ones among them, and members that give a first bound.
PASS_CELLS, PASS_EXACT, PASS_FIRST = 1 << 20, 1 << 16, 1024


def directed(vector: Column) -> Column:
    """Whether a vector has a direction: not null and not of length zero."""
    return F.coalesce(norm(vector) > 0, F.lit(False))


def _units(vectors: pa.Array) -> np.ndarray:
    m = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(np.float64)
    return m / np.linalg.norm(m, axis=1)[:, None]


def _far(close: np.ndarray) -> np.ndarray:
    """Distances on the unit sphere from products of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * close, 0))


class PivotTree:
    """Leaf pivots under top pivots; after ``fill`` also what the cells hold."""

    def __init__(self, pivots: np.ndarray):
        self.leaves = pivots / np.linalg.norm(pivots, axis=1)[:, None]
        tops = self.leaves[:math.ceil(math.sqrt(len(pivots)))]
        own = (self.leaves @ tops.T).argmax(1)
        used = np.unique(own)
        self.tops = tops[used]
        self.under = [np.flatnonzero(own == t) for t in used]

    def nearest(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest leaf of each vector, and how far it is.  All leaves are
        compared: by way of the nearest top a close leaf can be missed, and
        one far member makes a whole cell wide."""
        close = units @ self.leaves.T
        leaf = close.argmax(1)
        return leaf, _far(close[np.arange(len(leaf)), leaf])

    def fill(self, size: np.ndarray, radius: np.ndarray) -> None:
        """Members and radius of each leaf's cell; ``reach`` of a top pivot is
        how far from it any member below lies."""
        self.size, self.radius = size, radius
        self.under = [u[size[u] > 0] for u in self.under]
        self.reach = np.array([(_far(self.leaves[u] @ top) + radius[u]).max() if len(u) else -np.inf for top, u in zip(self.tops, self.under)])

    def _bounds(self, units: np.ndarray, leaves: np.ndarray, k: int) -> np.ndarray:
        """For each query a distance within which these leaves hold k vectors,
        or infinity."""
        if self.size[leaves].sum() < k:
            return np.full(len(units), np.inf)
        upper = _far(units @ self.leaves[leaves].T) + self.radius[leaves]
        order = np.argsort(upper, axis=1, kind="stable")
        enough = (np.cumsum(self.size[leaves][order], axis=1) >= k).argmax(1)
        return np.take_along_axis(upper, np.take_along_axis(order, enough[:, None], 1), 1)[:, 0]

    def visits(self, units: np.ndarray, k: int) -> np.ndarray:
        """The leaves that can hold one of the k nearest of any of the queries."""
        k = min(k, int(self.size.sum()))
        held = np.flatnonzero(self.size)
        to_top = _far(units @ self.tops.T)
        around = np.unique(np.concatenate([self.under[t] for t in np.unique(to_top.argmin(1))]))
        bound = self._bounds(units, around, k)
        if not np.isfinite(bound).all():
            bound = self._bounds(units, held, k)
        # in cosine distance, with room for rounding
        limit = bound[:, None] ** 2 / 2 + 1e-9
        tops = np.flatnonzero((np.maximum(to_top - self.reach, 0) ** 2 / 2 <= limit).any(0))
        leaves = np.concatenate([np.zeros(0, np.int64), *(self.under[t] for t in tops)])
        lower = np.maximum(_far(units @ self.leaves[leaves].T) - self.radius[leaves], 0)
        return leaves[(lower ** 2 / 2 <= limit).any(0)]


def _assigned(frame: DataFrame, key: str, tree: PivotTree) -> DataFrame:
    """``key, vec, cell, far``."""
    shared = frame.sparkSession.sparkContext.broadcast(tree)  # bounded by TREE_BYTES

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                cell, far = shared.value.nearest(_units(b.column("vec")))
                yield pa.RecordBatch.from_arrays([b.column(key), b.column("vec"), pa.array(cell.astype(np.int32)), pa.array(far)], [key, "vec", "cell", "far"])

    given = frame.select(key, "vec")
    return given.mapInArrow(assign, T.StructType([*given.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())]))


def _blocks(under_tops: list[np.ndarray], counts: dict[int, int], most: int) -> list[tuple[int, int, int]]:
    """``cell, block_cell, parts`` of the cells that have queries: neighbours
    under one top pivot go together while they have at most ``most`` queries,
    and are named by the first of them; a cell with more is cut into parts."""
    out = []
    for under in under_tops:
        first, held = None, 0
        for cell in (int(c) for c in under if int(c) in counts):
            n = counts[cell]
            if first is None or held + n > most:
                first, held = cell, 0
            held += n
            out.append((cell, first, -(-n // most)))
    return out


def _visited(blocks: DataFrame, tree: PivotTree, parts: np.ndarray, k: int, most: int) -> DataFrame:
    """``block_cell, block, cell, part, tile``: the parts of cells that each
    block of queries visits, dealt into tiles of about ``most`` members; a block
    is looked at as a whole, so a pair comes once."""
    shared = blocks.sparkSession.sparkContext.broadcast((tree, parts))  # bounded by TREE_BYTES

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, parts = shared.value
        open_, seen = None, np.zeros(0, np.int64)

        def pairs() -> pa.RecordBatch:
            cells = np.unique(seen)
            times = parts[cells]
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            cells = np.repeat(cells, times)
            rows = tree.size[cells] / parts[cells]
            tile = (np.cumsum(rows) - rows) // most
            own = [pa.array(np.full(len(cells), x, np.int32)) for x in open_]
            return pa.RecordBatch.from_arrays([*own, *(pa.array(x.astype(np.int32)) for x in (cells, part, tile))], ["block_cell", "block", "cell", "part", "tile"])

        for batch in batches:
            cell, block = (batch.column(c).to_numpy() for c in ("block_cell", "block"))
            cuts = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]))[:len(cell)]).tolist()
            for lo, hi in zip(cuts, [*cuts[1:], len(cell)]):
                if (cell[lo], block[lo]) != open_:
                    if open_ is not None:
                        yield pairs()
                    open_, seen = (cell[lo], block[lo]), np.zeros(0, np.int64)
                for at in range(lo, hi, 256):
                    units = _units(batch.column("vec").slice(at, min(256, hi - at)))
                    seen = np.union1d(seen, tree.visits(units, k))
        if open_ is not None:
            yield pairs()

    given = blocks.select("block_cell", "block", "vec").repartition("block_cell", "block").sortWithinPartitions("block_cell", "block")
    return given.mapInArrow(visit, "block_cell int, block int, cell int, part int, tile int")


def _tile(queries: pa.Table, members: pa.Table, k: int, decimals: int, schema: pa.Schema) -> pa.Table:
    """The k nearest members of each query; ties go to the smaller id."""
    if not queries.num_rows or not members.num_rows:
        return schema.empty_table()
    members = members.sort_by("id").combine_chunks()
    queries = queries.combine_chunks()
    own = _units(members.column("vec").combine_chunks())
    asked = _units(queries.column("vec").combine_chunks())
    rows, places, far = [], [], []
    step = max(1, TILE_CELLS // len(own))
    for lo in range(0, len(asked), step):
        distance = 1.0 - asked[lo:lo + step] @ own.T
        # what rounding can bring among the first k, then those in order
        bound = np.partition(distance, min(k, len(own)) - 1, axis=1)[:, min(k, len(own)) - 1]
        row, place = np.nonzero(~(distance > bound[:, None] + 2 * 10.0 ** -decimals))  # not a number comes last
        near = np.round(distance[row, place], decimals)
        order = np.lexsort((place, near, row))
        row, place, near = row[order], place[order], near[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        rows.append(row[best] + lo)
        places.append(place[best])
        far.append(near[best])
    return pa.table([queries.column("query").take(pa.array(np.concatenate(rows))), members.column("id").take(pa.array(np.concatenate(places))), pa.array(np.concatenate(far))], schema=schema)


def _packed(columns: dict[str, pa.Array], units: np.ndarray) -> bytes:
    """Columns and vectors of one side in a few bytes; single precision where
    that is the same."""
    low = units.astype(np.float32)
    vec = low if np.array_equal(low, units, equal_nan=True) else units
    flat = pa.FixedSizeListArray.from_arrays(pa.array(vec.reshape(-1)), vec.shape[1])
    batch = pa.RecordBatch.from_arrays([*columns.values(), flat], [*columns, "vec"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as to:
        to.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: pa.Buffer) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """The columns, the unit vectors, and these in single precision."""
    batch = pa.ipc.open_stream(data).read_next_batch()
    units = _units(batch.column("vec"))
    return batch, units, units.astype(np.float32)


def _raw(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(np.float64)


def _tiles(members: DataFrame, most: int) -> DataFrame:
    """``tile``: the members of a partition, packed, at most ``most`` in a row,
    those of a row in the order of their ids."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in (b for whole in batches for b in [whole.slice(lo, most) for lo in range(0, whole.num_rows, most)]):
            held.append(batch)
            while sum(b.num_rows for b in held) >= most:
                table = pa.Table.from_batches(held)
                held = table.slice(most).combine_chunks().to_batches()
                yield row(table.slice(0, most))
        if held:
            yield row(pa.Table.from_batches(held))

    def row(table: pa.Table) -> pa.RecordBatch:
        table = table.sort_by("id").combine_chunks()
        columns = {c: table.column(c).combine_chunks() for c in ("id", "cell")}
        return pa.RecordBatch.from_arrays([pa.array([_packed(columns, _raw(table.column("vec").combine_chunks()))], pa.binary())], ["tile"])

    return members.select("id", "cell", "vec").mapInArrow(pack, "tile binary")


def _asked_blocks(placed: DataFrame, tree: PivotTree, groups: int, k: int, most: int) -> DataFrame:
    """``block, piece, asked, seen``: the queries of a block, packed, and for
    each ``PASS_CHUNK`` of them, a bit a leaf, the cells they visit.  More
    than ``most`` queries, which only equal ids can be, are several pieces."""
    shared = placed.sparkSession.sparkContext.broadcast(tree)  # bounded by TREE_BYTES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, held, piece = None, [], 0
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1])[:len(block)]).tolist()
            for lo, hi in zip(cuts, [*cuts[1:], len(block)]):
                for at in range(lo, hi, most):
                    part = batch.slice(at, min(most, hi - at))
                    if held and (block[lo] != open_ or sum(b.num_rows for b in held) + part.num_rows > most):
                        yield row(open_, piece, held)
                        held, piece = [], piece + 1 if block[lo] == open_ else 0
                    open_ = block[lo]
                    held.append(part)
        if held:
            yield row(open_, piece, held)

    def row(block: int, piece: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        vectors = table.column("vec").combine_chunks()
        seen = np.zeros((-(-len(table) // PASS_CHUNK), len(shared.value.leaves)), bool)
        for lo in range(0, len(table), 256):
            seen[lo // PASS_CHUNK, shared.value.visits(_units(vectors.slice(lo, 256)), k)] = True
        asked = _packed({"query": table.column("query").combine_chunks()}, _raw(vectors))
        own = [pa.array([block], pa.int32()), pa.array([piece], pa.int32()), pa.array([asked], pa.binary()), pa.array([np.packbits(seen, axis=1).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(own, ["block", "piece", "asked", "seen"])

    given = placed.select("query", "vec", "block", "cell").repartition(groups, "block").sortWithinPartitions("block", "cell")
    return given.mapInArrow(pack, "block int, piece int, asked binary, seen binary")


class _Passing:
    """A block of queries that tiles of members pass by, and the k nearest so far."""

    def __init__(self, asked: pa.Buffer, seen: bytes, k: int, decimals: int, id_type: pa.DataType):
        batch, self.units, self.low = _unpacked(asked)
        self.queries, self.k, self.decimals = batch.column("query"), k, decimals
        bits = np.frombuffer(seen, np.uint8).reshape(-(-len(self.units) // PASS_CHUNK), -1)
        self.seen = np.unpackbits(bits, axis=1).astype(bool)
        # what single precision can be off by, and what rounding can bring
        self.slack = (self.units.shape[1] + 4) * 2.0 ** -23 + 10.0 ** -decimals
        self.least = np.full(len(self.units), -np.inf, np.float32)
        self.best = pa.table([pa.array([], pa.int64()), pa.array([], pa.float64()), pa.array([], id_type)], names=["row", "near", "id"])

    def meet(self, tile: tuple[pa.RecordBatch, np.ndarray, np.ndarray]) -> None:
        batch, units, low = tile
        cell, found = batch.column("cell").to_numpy(), []
        for chunk, seen in enumerate(self.seen):
            keep = np.flatnonzero(seen[cell])
            if len(keep):
                lo, hi = chunk * PASS_CHUNK, min(len(self.units), (chunk + 1) * PASS_CHUNK)
                some = low if len(keep) == len(low) else low[keep]
                step = max(1, PASS_CELLS // len(some))
                found += [self._near(at, min(hi, at + step), units, some, keep) for at in range(lo, hi, step)]
        if any(len(x[0]) for x in found):
            self._keep(*(np.concatenate(x) for x in zip(*found)), batch.column("id"))

    def _near(self, lo: int, hi: int, units: np.ndarray, low: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of these queries: row, member and distance of what can be among the k nearest."""
        close, least = self.low[lo:hi] @ low.T, self.least[lo:hi]
        first = min(len(keep), max(PASS_FIRST, self.k))
        if first >= self.k and np.isneginf(least).any():
            bound = np.partition(close[:, :first], first - self.k, axis=1)[:, first - self.k]
            least = np.maximum(least, bound - np.float32(2 * self.slack))
        some = np.flatnonzero(~(close.max(1) < least))  # not a number comes last
        row, place = np.nonzero(~(close[some] < least[some, None]))
        del close
        row, place = some[row] + lo, keep[place]
        cuts = range(0, len(row), PASS_EXACT)
        dots = [np.einsum("ij,ij->i", self.units[row[at:at + PASS_EXACT]], units[place[at:at + PASS_EXACT]]) for at in cuts]
        near = np.round(1.0 - np.concatenate([np.zeros(0), *dots]), self.decimals)
        order = np.lexsort((place, near, row))
        row, place, near = row[order], place[order], near[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        return row[best], place[best], near[best]

    def _keep(self, row: np.ndarray, place: np.ndarray, near: np.ndarray, ids: pa.Array) -> None:
        touched = np.zeros(len(self.units), bool)
        touched[row] = True
        again = touched[self.best.column("row").to_numpy()]
        new = pa.table([pa.array(row), pa.array(near), ids.take(pa.array(place))], schema=self.best.schema)
        both = pa.concat_tables([self.best.filter(pa.array(again)), new])
        both = both.sort_by([("row", "ascending"), ("near", "ascending"), ("id", "ascending")])
        row = both.column("row").to_numpy()
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        last = nth == self.k - 1
        self.least[row[last]] = (1.0 - both.column("near").to_numpy()[last] - self.slack).astype(np.float32)
        self.best = pa.concat_tables([self.best.filter(pa.array(~again)), both.filter(pa.array(nth < self.k))]).combine_chunks()

    def result(self, schema: pa.Schema) -> list[pa.RecordBatch]:
        found = [self.queries.take(self.best.column("row").combine_chunks()), self.best.column("id"), self.best.column("near")]
        return pa.table(found, schema=schema).to_batches(max_chunksize=10_000)


def _passed(placed: DataFrame, members: DataFrame, tree: PivotTree, under: list[np.ndarray], in_cell: dict[int, int],
            k: int, most: int, decimals: int, out: T.StructType) -> DataFrame:
    """Every query's k nearest members in each share of the members.  Both
    frames are deleted when they are packed."""
    spark = placed.sparkSession
    want = PASS_TASKS * spark.sparkContext.defaultParallelism
    rows = min(most, max(PASS_CHUNK, -(-sum(in_cell.values()) // want)))
    first, groups, dealt = {}, 0, []
    for cell, name, parts in _blocks([np.concatenate(under)], in_cell, rows):
        if name not in first:
            first[name], groups = groups, groups + parts
        dealt.append((cell, first[name], parts))
    of_cell = spark.createDataFrame(dealt, "cell int, first int, parts int")
    number = (F.col("first") + F.pmod(F.xxhash64("query"), F.col("parts"))).cast("int")
    grouped = placed.join(F.broadcast(of_cell), "cell").select("query", "vec", "cell", number.alias("block"))  # a row a leaf
    tiles = materialize_wide(_tiles(members, min(most, PASS_ROWS)), "tiles")
    blocks = materialize_wide(_asked_blocks(grouped, tree, groups, k, max(rows, 2 * PASS_CHUNK)), "blocks")
    forget(members)
    forget(placed)
    arrow = to_arrow_schema(out)
    id_type = arrow.field("id").type

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: dict[tuple[int, int], _Passing] = {}  # one, or the pieces of one
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column("block")[i].as_py(), batch.column("piece")[i].as_py()
                if key not in here:
                    here[key] = _Passing(batch.column("asked")[i].as_buffer(), batch.column("seen")[i].as_py(), k, decimals, id_type)
                here[key].meet(_unpacked(batch.column("tile")[i].as_buffer()))
        for block in here.values():
            yield from block.result(arrow)

    with rows_a_batch(spark, 1):
        pairs = tiles.coalesce(max(1, want // groups)).crossJoin(blocks.repartitionByRange(groups, "block").hint("shuffle_replicate_nl"))
        found = materialize(pairs.mapInArrow(passing, out), "found")
    forget(tiles)
    forget(blocks)
    return found


def _hash_part(key: str, counts: dict[int, int], of: str, most: int) -> Column:
    """A row's part of its cell, by hash: one for each ``most`` rows of it."""
    parts = F.lit(1)
    many = [x for cell, n in sorted(counts.items()) if n > most for x in (F.lit(cell), F.lit(-(-n // most)))]
    if many:
        parts = F.coalesce(F.create_map(*many)[F.col(of)], parts)
    return F.pmod(F.xxhash64(key), parts).cast("int")


def knn_join(queries: DataFrame, collection: DataFrame, k: int = 5,
             query_id: str = "query_id", query_vec: str = "embedding",
             id_col: str = "id", vec_col: str = "embedding",
             cells: int | None = None, block_rows: int = 16_384, decimals: int = 12) -> DataFrame:
    """Exact cosine k nearest neighbours for every query:
    (query_id, rank, <id>, distance).  Ties are broken by id.

    Distances are rounded to ``decimals`` digits before ranking so that
    equal vectors rank equally whatever the floating-point path.  ``cells``
    is the number of leaves, by default one for ``CELL_ROWS`` vectors; a tile
    is at most about ``block_rows`` members against ``block_rows`` queries.
    """
    spark = queries.sparkSession
    out, held, asked = _given(queries, collection, query_id, query_vec, id_col, vec_col, k)
    n, width = held.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n:
        return _none(spark, out, query_id, id_col)
    leaves = min(cells or -(-n // CELL_ROWS), max(1, TREE_BYTES // (8 * width)))
    block_rows = min(block_rows, max(256, TILE_BYTES // (8 * width)))
    tree = PivotTree(_pivots(held, n, leaves))
    members = materialize(_assigned(held, "id", tree), "cells")
    forget(held)
    stats = {r["cell"]: r for r in members.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}  # a row a leaf
    size, radius = np.zeros(len(tree.leaves), np.int64), np.zeros(len(tree.leaves))
    for cell, r in stats.items():
        size[cell], radius[cell] = r["n"], r["radius"]
    under = tree.under  # also of the leaves that hold nothing
    tree.fill(size, radius)

    placed = materialize(_assigned(asked, "query", tree).select("query", "vec", "cell"), "queries")
    in_cell = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row a leaf
    of_cell = spark.createDataFrame(_blocks(under, in_cell, block_rows), "cell int, block_cell int, parts int")
    blocks = placed.join(F.broadcast(of_cell), "cell")  # a row a leaf
    blocks = blocks.select("query", "vec", "block_cell", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int").alias("block"))
    # pairs of ints are small as a file and large in memory: never broadcast
    parts = np.maximum(1, -(-size // block_rows))
    visited = materialize(_visited(blocks, tree, parts, k, block_rows), "visits")
    visits = visited.groupBy("cell").count().collect()  # a row a leaf
    if sum(r["count"] * size[r["cell"]] / parts[r["cell"]] for r in visits) > MOVES * n:
        return _best(_passed(placed, members, tree, under, in_cell, k, block_rows, decimals, out), k, query_id, id_col)
    visited = visited.hint("merge")

    keys = ["block_cell", "block", "tile"]
    tiles = visited.select(*(F.col(c).alias(c) for c in keys)).distinct().hint("merge")  # named anew: both sides hold them
    left = blocks.join(tiles, ["block_cell", "block"]).select(*keys, "query", "vec")
    right = members.withColumn("part", _hash_part("id", {c: r["n"] for c, r in stats.items()}, "cell", block_rows))
    right = right.join(visited, ["cell", "part"]).select(*keys, "id", "vec")
    arrow = to_arrow_schema(out)

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        return _tile(left, right, k, decimals, arrow)

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, out)
    return _best(found, k, query_id, id_col)


def _pivots(held: DataFrame, n: int, leaves: int) -> np.ndarray:
    """The vectors with the smallest hashes.  Of a large table only the rows
    under a cut are ordered, as every partition sends ``leaves`` rows of them
    to the driver."""
    key = F.xxhash64("id", "vec")
    share = 4 * leaves / n
    few = held.where(F.pmod(key, F.lit(1 << 20)) < math.ceil(share * (1 << 20))) if share < 1 and leaves >= 64 else held
    return np.array([r["vec"] for r in few.orderBy(key).limit(leaves).collect()])


def _given(queries: DataFrame, collection: DataFrame, query_id: str, query_vec: str, id_col: str, vec_col: str, k: int):
    """The schema of found pairs, the members that can be found (of equal
    vectors k), written, and the queries that have a direction."""
    out = T.StructType([T.StructField("query", queries.schema[query_id].dataType), T.StructField("id", collection.schema[id_col].dataType), T.StructField("distance", T.DoubleType())])
    given = collection.where(directed(F.col(vec_col))).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    asked = queries.where(directed(F.col(query_vec))).select(F.col(query_id).alias("query"), F.col(query_vec).cast("array<double>").alias("vec"))
    first = Window.partitionBy("vec").orderBy(F.col("id").asc_nulls_last())
    return out, materialize(given.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= k).drop("_nth"), "members"), asked


def _none(spark, out: T.StructType, query_id: str, id_col: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(query_id, out["query"].dataType), T.StructField("rank", T.IntegerType()),
                                                   T.StructField(id_col, out["id"].dataType), T.StructField("distance", T.DoubleType())]))


def _best(found: DataFrame, k: int, query_id: str, id_col: str) -> DataFrame:
    w = Window.partitionBy("query").orderBy("distance", "id")
    top = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select(F.col("query").alias(query_id), "rank", F.col("id").alias(id_col), "distance")


# --------------------------------------------------------------------------
# Approximate search by random hyperplanes
# --------------------------------------------------------------------------

def _hashed(frame: DataFrame, key: str, planes: np.ndarray, probes: int) -> DataFrame:
    """``key, vec, table, bucket``: the side of each hyperplane a vector lies
    on, a bit each; with ``probes`` also the buckets beyond the nearest ones."""
    shared = frame.sparkSession.sparkContext.broadcast(planes)  # tables x bits vectors
    tables, bits, _ = planes.shape

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = shared.value.reshape(tables * bits, -1)
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                b = batch.slice(lo, 1024)
                side = (_units(b.column("vec")) @ flat.T).reshape(-1, tables, bits)
                own = ((side > 0) * weights).sum(2)
                buckets = [own]
                for j in np.argsort(np.abs(side), axis=2)[:, :, :probes].transpose(2, 0, 1):
                    buckets.append(own ^ weights[j])
                buckets = np.stack(buckets, 2)
                per_row = buckets.shape[1] * buckets.shape[2]
                rows = pa.array(np.repeat(np.arange(b.num_rows), per_row))
                table = np.tile(np.repeat(np.arange(tables, dtype=np.int32), buckets.shape[2]), b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column(key).take(rows), b.column("vec").take(rows), pa.array(table), pa.array(buckets.reshape(-1))], [key, "vec", "table", "bucket"])

    given = frame.select(key, "vec")
    return given.mapInArrow(sign, T.StructType([*given.schema.fields, T.StructField("table", T.IntegerType()), T.StructField("bucket", T.LongType())]))


def knn_lsh(queries: DataFrame, collection: DataFrame, k: int = 5, query_id: str = "query_id", query_vec: str = "embedding",
            id_col: str = "id", vec_col: str = "embedding", tables: int = 12, probes: int = 4, bucket_rows: int = 128,
            block_rows: int = 4096, decimals: int = 12, seed: int = 1) -> DataFrame:
    """Approximate cosine nearest neighbours, columns as ``knn_join``: the k
    best by exact distance among the vectors that share a bucket with the
    query in one of ``tables`` random-hyperplane tables, or lie across one of
    the ``probes`` hyperplanes nearest to it.  The bits of a signature grow
    with the collection, so that a bucket has about ``bucket_rows`` vectors;
    one that has more than ``block_rows``, or as many queries, is split by
    hash on that side and every part meets every part of the other."""
    spark = queries.sparkSession
    out, held, asked = _given(queries, collection, query_id, query_vec, id_col, vec_col, k)
    n, width = held.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n:
        return _none(spark, out, query_id, id_col)
    bits = max(1, min(40, round(math.log2(max(2.0, n / bucket_rows)))))
    planes = np.random.default_rng(seed).normal(size=(tables, bits, width))
    keys = ["table", "bucket"]
    members = _hashed(held, "id", planes, 0)
    visits = _hashed(asked, "query", planes, min(probes, bits))
    parts = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.count("*") / block_rows).cast("int").alias(name))
    sizes = materialize(parts(members, "m_parts").join(parts(visits, "q_parts"), keys), "bucket-parts")
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    own = lambda key, c: F.pmod(F.xxhash64(key), F.col(c)).cast("int")
    left = visits.join(sizes, keys).select(*keys, own("query", "q_parts").alias("q_part"), F.explode(every("m_parts")).alias("m_part"), "query", "vec")
    right = members.join(sizes, keys).select(*keys, F.explode(every("q_parts")).alias("q_part"), own("id", "m_parts").alias("m_part"), "id", "vec")
    arrow = to_arrow_schema(out)

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        return _tile(left, right, k, decimals, arrow)

    group = [*keys, "q_part", "m_part"]
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(tile, out)
    return _best(found.groupBy("query", "id").agg(F.min("distance").alias("distance")), k, query_id, id_col)
