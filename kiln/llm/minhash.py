"""Near-duplicate documents by circulant MinHash and exact verification.

A document's set is its distinct word shingles as 64-bit hashes.  Two
permutations of the 64-bit ring make the whole signature: the first scatters
the set, the second is taken circularly shifted by k for coordinate k, whose
minimum is the coordinate.  Signatures are cut into bands; two sets that
agree in a band are candidates.

1. Documents with equal sets form a class; only its first row goes on, so a
   group of copies of any size is one row from here on.
2. Buckets (equal bands) link classes to the bucket's smallest member; the
   connected components of these unverified links are candidate groups.
   Documents of different groups share no band.
3. Links are confirmed on full sets within candidate groups.  A group of up
   to ``block`` members is compared in one task.  In a larger group every
   member is first compared with the group's hub, the member that meets most
   others in buckets, block by block; those that it links are one component.
   The others are compared, again block by block, with each other and with
   the linked ones.  A task sends out only links that join two components of
   what it holds, never all pairs.
4. Connected components of the confirmed links, smallest ``doc_id`` first.

With 40 bands of 5 coordinates a pair of similarity 0.85 shares no band with
probability 1e-10, one of 0.8 with 1e-7.

Defined results: a text without words, or null, has an empty set and is
linked with nothing, also not with another empty one; repeated rows are
linked as equal texts are; a null ``doc_id`` counts as larger than any other;
an empty table gives no rows; other columns are neither read nor returned by
``near_duplicates`` and are carried through unchanged by ``near_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kiln.llm.components import connected_components
from kiln.llm.memo import tidied
from kiln.llm.rows import TEXTS_A_BATCH, numbered
from kiln.llm.shingles import mix, sets_of
from kiln.session import materialize, rows_a_batch

BANDS, ROWS = 40, 5
_SCATTER, _SHIFT, _ODD = np.uint64(0x2545F4914F6CDD1D), 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def circulant_minhash(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Signatures (a row for each coordinate) of non-empty sets."""
    begins = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    scattered = mix(np.concatenate(sets) * _SCATTER)
    out = np.empty((size, len(sets)), np.uint64)
    for k in range(size):
        x = scattered + np.uint64(k * _SHIFT % 2 ** 64)  # the shift, then one permutation for all k
        x ^= x >> np.uint64(32)
        x *= _ODD
        x ^= x >> np.uint64(29)
        out[k] = np.minimum.reduceat(x, begins)
    return out


def _signed(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes, two hashes of each whole set, and band keys."""
    n = np.zeros(len(texts), np.int64)
    keys, bands = np.zeros((2, len(texts)), np.uint64), np.zeros((len(texts), BANDS), np.uint64)
    for first, sets in sets_of(texts, width):
        for lo in range(0, len(sets), 200):
            at = np.array([first + lo + i for i, s in enumerate(sets[lo:lo + 200]) if len(s)], np.int64)
            some = [s for s in sets[lo:lo + 200] if len(s)]
            if not some:
                continue
            n[at] = [len(s) for s in some]
            signature = circulant_minhash(some, BANDS * ROWS)
            for b in range(BANDS):
                bands[at, b] = reduce(lambda h, r: mix(h + r), signature[b * ROWS:(b + 1) * ROWS], np.full(len(some), b + 1, np.uint64))
            keys[0, at] = [mix(s).sum(dtype=np.uint64) for s in some]
            keys[1, at] = [mix(s ^ _SCATTER).sum(dtype=np.uint64) for s in some]
    return n, keys, bands


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    @tidied
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, bands = _signed(batch.column("text"), width)
            flat = pa.array(bands.reshape(-1).view(np.int64))
            offsets = pa.array(np.concatenate(([0], np.cumsum(np.where(n > 0, BANDS, 0)))).astype(np.int32))
            if (n == 0).any():
                flat = pa.array(bands[n > 0].reshape(-1).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n), *(pa.array(k.view(np.int64)) for k in keys), pa.ListArray.from_arrays(offsets, flat)],
                ["row", "doc_id", "n", "key", "key2", "bands"])

    return docs.select("row", "doc_id", "text").mapInArrow(
        signed, "row long, doc_id long, n long, key long, key2 long, bands array<long>")


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


class _Forest:
    """Components of what one task holds."""

    def __init__(self, n: int):
        self._up = list(range(n))

    def root(self, i: int) -> int:
        while self._up[i] != i:
            self._up[i] = i = self._up[self._up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self._up[self.root(j)] = self.root(i)


def _links(left: list, right: list, percent: int) -> Iterator[tuple[int, int]]:
    """Confirmed links between members (node, set) of two blocks, or within
    one (``right is left``), that join two components of them."""
    same = right is left
    members = left if same else left + right
    forest = _Forest(len(members))
    for i, (node, own) in enumerate(left):
        for j in range(i + 1 if same else len(left), len(members)):
            if forest.root(i) != forest.root(j) and alike(own, members[j][1], percent):
                forest.join(i, j)
                yield node, members[j][0]


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal ``keys`` of sorted batches: the key and the
    other columns of each row."""
    open_, rows = None, []
    for batch in batches:
        names = [c for c in batch.schema.names if c not in keys]
        own = zip(*(batch.column(c).to_pylist() for c in keys))
        for key, row in zip(own, zip(*(batch.column(c).to_pylist() for c in names))):
            if key != open_:
                if rows:
                    yield open_, rows
                open_, rows = key, []
            rows.append(row)
    if rows:
        yield open_, rows


def _in_tasks(frame: DataFrame, keys: list[str], order: list[str], compare) -> DataFrame:
    """Edges ``u, v`` of ``compare(rows)`` for each group of ``keys``."""
    @tidied
    def run(batches):
        found = []
        for _, rows in _grouped(batches, keys):
            found += compare(rows)
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["u", "v"])
                found = []
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["u", "v"])

    return frame.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, "u long, v long")


def _set(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _candidates(reps: DataFrame) -> DataFrame:
    """``node, part, size, hub``: the candidate group of each class that
    shares a bucket, and whether it is the group's hub."""
    member = reps.select(F.col("row").alias("node"), F.explode("bands").alias("bucket"))
    buckets = member.groupBy("bucket").agg(F.count("*").alias("met"), F.min("node").alias("first")).filter("met > 1")
    # both sides grow with the documents: neither may be broadcast
    met = materialize(member.hint("merge").join(buckets, "bucket").groupBy("node", "first").agg(F.sum("met").alias("met")), "bucket-links")
    groups = connected_components(met.select(F.col("node").alias("u"), F.col("first").alias("v")))
    degree = met.groupBy("node").agg(F.sum("met").alias("degree")).join(groups, "node")
    of_group = degree.groupBy("root").agg(F.count("*").alias("size"), F.max(F.struct("degree", -F.col("node"))).alias("best"))
    return (degree.join(of_group, "root")
            .select("node", F.col("root").alias("part"), "size", (-F.col("best.col2") == F.col("node")).alias("hub")))


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``wanted`` with the shingle set of each of its rows (``node``)."""
    names = wanted.columns
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema)

    @tidied
    def shingled(batches):
        for batch in batches:
            found = [s.tobytes() for _, sets in sets_of(batch.column("text"), width) for s in sets]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.binary())], [*names, "set"])

    texts = docs.select(F.col("row").alias("node"), "text")
    return texts.hint("merge").join(wanted, "node").select(*names, "text").mapInArrow(shingled, f"{fields}, set binary")


def _confirmed(docs: DataFrame, candidates: DataFrame, width: int, percent: int, block: int) -> DataFrame:
    """Edges whose components are those of all confirmed links."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    wanted = candidates.select("node", "part", "hub", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    sets = materialize(_sets(docs, wanted, width), "candidate-sets")

    # the hub is held against each block; a group of one block is compared whole
    hubs = sets.filter("hub").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    first = sets.filter("NOT hub").unionByName(hubs).select("part", "block", F.when(F.col("hub"), 0).otherwise(1).alias("place"), "node", "blocks", "set")

    def with_hub(rows):
        members = [(node, _set(data)) for _, node, _, data in rows]
        if rows[0][2] == 1:
            return _links(members, members, percent)
        return _links(members[:1], members[1:], percent)

    edges = materialize(_in_tasks(first, ["part", "block"], ["place", "node"], with_hub), "hub-links")

    # what the hub of a large group has not linked is held against the rest
    linked = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("linked", F.lit(True))
    rest = (sets.filter("blocks > 1 AND NOT hub").select("node", "part").join(linked, "node", "left")
            .select("node", "part", F.coalesce("linked", F.lit(False)).alias("linked")))
    counts = rest.groupBy("part").agg(F.count_if(F.col("linked")).alias("n_linked"), F.count_if(~F.col("linked")).alias("n_open")).filter("n_open > 0")
    counts = counts.select("part", F.ceil(F.col("n_linked") / block).cast("int").alias("b_linked"), F.ceil(F.col("n_open") / block).cast("int").alias("b_open"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("linked"), F.col("b_linked")).otherwise(F.col("b_open"))).cast("int")
    placed = rest.join(counts, "part").withColumn("own", own)
    # a pair of blocks is (open i, open j >= i), or (open i, linked j) with j numbered on
    open_at = F.concat(F.transform(F.sequence(F.lit(0), F.col("b_open") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j"))),
                       F.when(F.col("b_linked") > 0, F.transform(F.sequence(F.lit(0), F.col("b_linked") - 1), lambda j: F.struct(F.col("own").alias("i"), (j + F.col("b_open")).alias("j"))))
                       .otherwise(F.array().cast("array<struct<i:int,j:int>>")))
    linked_at = F.transform(F.sequence(F.lit(0), F.col("b_open") - 1), lambda i: F.struct(i.alias("i"), (F.col("own") + F.col("b_open")).alias("j")))
    at = placed.select("node", "part", "own", "linked", "b_open", F.explode(F.when(F.col("linked"), linked_at).otherwise(open_at)).alias("pair"))
    at = at.select("node", "part", "pair.i", "pair.j", (F.col("linked") | (F.col("own") != F.col("pair.i"))).alias("right"))
    second = sets.filter("blocks > 1").select("node", "set").join(at, "node").select("part", "i", "j", "right", "node", "set")

    def with_rest(rows):
        left, right = ([(node, _set(data)) for side, node, data in rows if side is wanted_side] for wanted_side in (False, True))
        return [*_links(left, left, percent)] if not right else [*_links(left, right, percent)]

    return edges.unionByName(_in_tasks(second, ["part", "i", "j"], ["right", "node"], with_rest))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, block: int = 256) -> DataFrame:
    """``doc_id, row, n_shingles, component_id, keep_row, kept`` of every row:
    ``component_id`` is the smallest ``doc_id`` among the documents reachable
    by links, ``keep_row`` that document's row.  ``row`` tells rows of this
    result apart; another scan of the input may number them otherwise."""
    return _near_duplicates(numbered(docs.select("doc_id", "text"), "numbered-rows").select("row", "doc.*"), width, percent, block)


def _near_duplicates(docs: DataFrame, width: int, percent: int, block: int = 256) -> DataFrame:
    """``near_duplicates`` of written rows that have their number (``row``)."""
    with rows_a_batch(docs.sparkSession, TEXTS_A_BATCH):
        signed = materialize(_signatures(docs, width), "signatures")
        sets = signed.filter("n > 0")
        place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
        classes = materialize(sets.groupBy("key", "key2", "n").agg(F.min("row").alias("node"), F.min(place).alias("first"), F.count("*").alias("rows")), "set-classes")
        reps = sets.hint("merge").join(classes.select(F.col("node").alias("row")), "row", "left_semi")
        edges = _confirmed(docs, _candidates(reps), width, percent, block)
        roots = connected_components(edges)
    grouped = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = grouped.groupBy("root").agg(F.min("first").alias("best"), F.sum("rows").alias("members")).filter("members > 1")
    decided = grouped.join(best, "root").select("key", "key2", "n", "best")
    out = signed.join(decided, ["key", "key2", "n"], "left")
    alone = F.col("best").isNull()
    keep_row = F.when(alone, F.col("row")).otherwise(F.col("best.row"))
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id"))
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), component.alias("component_id"), keep_row.alias("keep_row"),
                      (keep_row == F.col("row")).alias("kept"))


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates."""
    whole = numbered(docs, "numbered-rows")
    found = _near_duplicates(whole.select("row", "doc.doc_id", "doc.text"), width, percent)
    dropped = found.filter("NOT kept").select(F.col("row").alias("dropped"))
    return whole.join(dropped, whole["row"] == F.col("dropped"), "left_anti").select("doc.*")
