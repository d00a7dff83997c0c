"""Exact neighbours on data without clusters: what is moved, and how."""
import numpy as np
from pyspark.sql import functions as F

from kiln.operators import nearest
from kiln.session import materialize


def _found(spark, m, **how):
    coll = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, embedding array<double>")
    written = {}

    def keep(df, name):
        written[name] = materialize(df, name)
        return written[name]

    nearest.materialize, before = keep, nearest.materialize
    try:
        return nearest.knn_join(coll.withColumnRenamed("id", "query_id"), coll, 3, **how), written
    finally:
        nearest.materialize = before


def test_blocks_take_in_neighbouring_cells(spark):
    """A block is as many cells as fit, so a member moves a few times and a
    query has few tiles, where each visits all cells."""
    m = np.random.default_rng(2).normal(size=(640, 24))
    found, written = _found(spark, m, cells=64)
    blocks = written["visits"].select("block_cell", "block").distinct().count()
    tiles = written["visits"].select("block_cell", "block", "tile").distinct().count()
    assert written["visits"].count() > blocks * 40 and blocks <= 8 and tiles <= 8
    units = m / np.linalg.norm(m, axis=1)[:, None]
    near = np.argsort(np.round(1 - units @ units.T, 12), axis=1, kind="stable")[:, :3]
    assert sorted((r.query_id, r["rank"], r.id) for r in found.collect()) == [(i, j + 1, int(x)) for i, row in enumerate(near) for j, x in enumerate(row)]


def test_visits_are_never_broadcast(spark):
    """Millions of pairs are a few megabytes as a file."""
    found, _ = _found(spark, np.random.default_rng(3).normal(size=(60, 4)), cells=8)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("BroadcastHashJoin") == 1  # a row a leaf


def test_pivots_of_a_large_table(spark):
    """Every partition sends its smallest hashes only from under a cut."""
    held = spark.range(40_000).select(F.lit(None).cast("long").alias("id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vec"))
    assert len(nearest._pivots(held, 40_000, 156)) == 156
