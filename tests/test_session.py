"""Scratch folders: where they are, and that they go."""
import os
from types import SimpleNamespace

import pytest

from kiln import session as S
from kiln.operators.ranking import global_rank


def test_scratch_is_cleared(spark):
    kept = dict(S._written)
    S._written.clear()
    df = S.materialize(spark.range(10), "test")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert df.count() == 10 and os.path.isdir(path)
    assert S.clear_scratch(spark) == 1 and not os.path.exists(path) and S.clear_scratch(spark) == 0
    S._written.update(kept)


def test_a_cluster_without_a_shared_folder_is_an_error():
    fake = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app-x", master="spark://host:7077"),
                           conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(fake)


def test_materialize_keeps_an_empty_schema(spark):
    df = S.materialize(spark.createDataFrame([], "a int, b string"), "empty")
    assert df.columns == ["a", "b"] and df.count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_global_rank(spark, parts):
    df = spark.range(1000).selectExpr("id", "id % 7 AS g").repartition(parts)
    got = [r["id"] for r in global_rank(df, ["g", "id"], "rank").orderBy("rank").collect()]
    ranks = sorted(r["rank"] for r in global_rank(df, ["g", "id"], "rank").collect())
    assert ranks == list(range(1, 1001)) and got == sorted(range(1000), key=lambda i: (i % 7, i))
