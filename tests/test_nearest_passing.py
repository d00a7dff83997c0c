"""Exact neighbours and contexts on data without clusters: what goes to disk."""
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.operators import collection, nearest
from kiln.operators import retrieval as R
from kiln.session import materialize, materialize_passing, scratch_folders


def _nearest(asked, held, ids, k):
    unit = lambda m: m.astype(np.float64) / np.linalg.norm(m.astype(np.float64), axis=1)[:, None]
    near = np.argsort(np.round(1 - unit(asked) @ unit(held).T, 12), axis=1, kind="stable")[:, :k]
    return sorted((i, j + 1, ids[x]) for i, row in enumerate(near) for j, x in enumerate(row))


@pytest.mark.parametrize("kind", ["double", "float"])
def test_members_are_not_moved_where_most_cells_are_visited(spark, kind, monkeypatch):
    """16 blocks and more would each take nearly all members; instead each
    member is written once, and k rows a query and share of the members."""
    m = np.random.default_rng(2).normal(size=(640, 24)).astype(np.float32 if kind == "float" else np.float64)
    m[600:] = m[100:140]  # equal vectors: the smaller id
    ids = [f"v{i:04d}" for i in range(640)]
    coll = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, m)], f"id string, embedding array<{kind}>").repartition(3)
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"query_id long, embedding array<{kind}>")
    written = {}

    def keep(df, name):
        out = materialize(df, name)
        written[name] = out, out.count()
        return out

    monkeypatch.setattr(nearest, "materialize", keep)
    monkeypatch.setattr(nearest, "materialize_wide", keep)
    found = nearest.knn_join(asked, coll, 3, cells=64, block_rows=40)
    assert sorted((r.query_id, r["rank"], r.id) for r in found.collect()) == _nearest(m, m, ids, 3)
    blocks = written["visits"][0].select("block_cell", "block").distinct().count()
    assert blocks >= 16 and written["found"][1] == 640 * 3
    assert "CoGroup" not in found._jdf.queryExecution().sparkPlan().toString()
    # what is packed is not kept twice
    assert not [p for p in scratch_folders(spark) if p.rsplit("/", 1)[1].startswith(("members-", "cells-", "tiles-", "blocks-"))
                and any(p.rsplit("/", 1)[1] in f for n in ("members", "cells", "tiles", "blocks") for f in written[n][0].inputFiles())]


def test_a_block_keeps_the_nearest_of_all_tiles():
    """Single precision rules out only what cannot come near: nearly equal
    vectors, ties across tiles, fewer members than k, cells not visited."""
    rng = np.random.default_rng(4)
    held = np.repeat(rng.normal(size=(12, 8)), 40, axis=0)
    held[::3] += rng.normal(size=(160, 8)) * 1e-7
    asked = held[::7] + rng.normal(size=held[::7].shape) * 1e-9
    ids = [f"v{i:03d}" for i in rng.permutation(480)]
    order = np.argsort(ids)
    block = nearest._packed({"query": pa.array(range(len(asked)))}, asked)
    seen = np.packbits(np.array([[True, False]]), axis=1).tobytes()
    for k, cut in ((5, 480), (5, 37), (3, 2), (1000, 90)):
        p = nearest._Passing(pa.py_buffer(block), seen, k, 12, pa.string())
        for lo in range(0, 480, cut):
            part = sorted(range(lo, min(480, lo + cut)), key=lambda i: ids[i])
            columns = {"id": pa.array([ids[i] for i in part]), "cell": pa.array(np.zeros(len(part), np.int32))}
            p.meet(nearest._unpacked(pa.py_buffer(nearest._packed(columns, held[part]))))
            other = {"id": pa.array(["x"]), "cell": pa.array([1], pa.int32())}
            p.meet(nearest._unpacked(pa.py_buffer(nearest._packed(other, asked[:1]))))
        got = p.best.to_pandas().sort_values(["row", "near", "id"])
        got["rank"] = got.groupby("row").cumcount() + 1
        assert sorted(zip(got["row"], got["rank"], got["id"])) == _nearest(asked, held[order], [ids[i] for i in order], k)


def test_a_block_of_equal_ids_is_cut(spark):
    tree = nearest.PivotTree(np.eye(4))
    tree.fill(np.full(4, 9), np.full(4, 2.0))
    rows = [("same", np.eye(4)[i % 4].tolist(), i % 4, 0) for i in range(12)] + [("other", [1.0, 2.0, 0.0, 0.0], 1, 1)]
    placed = spark.createDataFrame(rows, "query string, vec array<double>, cell int, block int")
    out = nearest._asked_blocks(placed, tree, 2, 3, 5).collect()
    sizes = {(r.block, r.piece): nearest._unpacked(pa.py_buffer(bytes(r.asked)))[0].num_rows for r in out}
    assert sizes.pop((1, 0)) == 1 and sum(sizes.values()) == 12 and max(sizes.values()) <= 5
    assert sorted(sizes) == [(0, i) for i in range(len(sizes))]


def _vector(i, document="d"):
    return (i, [1.0], document, 1, "s", None, "text")


def test_documents_are_stored_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Only ids are compared; rows move where their id comes twice."""
    write, plans = collection._write, []

    def spy(rows, path):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(rows, path)

    monkeypatch.setattr(collection, "_write", spy)
    path = str(tmp_path / "coll")
    given = spark.createDataFrame([_vector(f"v{i}") for i in range(9)] + [_vector(None)], R.COLLECTION)
    assert R.add_to_collection(given, path).count() == 10
    assert len(plans) == 1 and "Exchange" not in plans[0]
    more = given.unionByName(spark.createDataFrame([_vector("w", "b"), _vector("w", "a"), _vector(None, "c"), _vector("x")], R.COLLECTION))
    stored = R.add_to_collection(more.where("id = 'v1' or id is null or id in ('w', 'x')"), path).collect()
    assert len(plans) == 3
    # as ever: an id is stored once, and a null one is never found stored
    assert sorted((str(r.id), r.document) for r in stored) == sorted([(f"v{i}", "d") for i in range(9)] + [("None", "c"), ("None", "d"), ("w", "a"), ("x", "d")])


def test_shuffles_go_when_a_frame_is_written(spark):
    def files():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        found = env.blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if "/shuffle_" in f}

    before = files()
    out = materialize_passing(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and out.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_results_are_read_once(spark):
    """No second pass over the found documents says who has results, and what
    a budget keeps out is not moved as text."""
    res = spark.createDataFrame([("q", 1, "text", 1, 0.1, "abc"), ("q", 2, "text", 2, 0.2, "y" * 90), ("q", 3, "text", 3, 0.3, "z"), ("r", 1, "text", 1, 0.1, "y" * 90),
                                 ("s", 1, "text", 1, 0.1, None), ("s", 2, "text", 1, 0.1, "abc")], "query_id string, rank int, type string, page int, distance double, document string")
    res, qs = materialize(res, "results"), materialize(spark.createDataFrame([(x,) for x in "qrst"], "query_id string"), "asked")
    for budget in (None, 60):
        ctx = R.rag_context(qs, res, "query_id", budget)
        assert ctx._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2
    one = "[Text from page 1, relevance: 0.90]\nabc\n"
    assert {r.query_id: r.context for r in ctx.collect()} == {"q": one, "r": "", "s": one, "t": R.NO_CONTEXT}
