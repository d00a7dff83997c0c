"""The registered queries and the pipeline on the given tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from kiln.llm import queries
from kiln.session import clear_scratch, scratch_folders

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for view in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {view} AS SELECT * FROM '{SF}/{view}.parquet'")
    expected = con.sql(queries.ORACLE[name]).df()
    found = queries.QUERIES[name](spark, SF).toPandas()
    columns = sorted(expected.columns)
    assert columns == sorted(found.columns)
    by = lambda x: x[columns].sort_values(columns).reset_index(drop=True)
    assert by(found).equals(by(expected))


def test_every_operator_has_its_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns and out.schema == docs.schema
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    expected = {tuple(r) for r in packed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()}
    run = corpus_pipeline.run(spark, SF)
    assert {tuple(r) for r in run.select("doc_id", "piece", "start", "length", "ids_crc32").collect()} == expected
    assert {e[0] for e in expected} == ids


def test_a_run_leaves_its_result_only(spark):
    before = scratch_folders(spark)
    found = corpus_pipeline.run(spark, SF)
    (left,) = [p for p in scratch_folders(spark) if p not in before]
    assert all(f"/{os.path.basename(left)}/" in f for f in found.inputFiles()) and found.count() > 0
    clear_scratch(spark, [left])


def test_a_stage_deletes_what_the_one_before_left(spark, tmp_path):
    docs, ours = spark.read.parquet(f"{SF}/documents.parquet"), set(scratch_folders(spark))
    exact = corpus_pipeline.exact_duplicates(spark, docs, SF)
    left = [p for p in scratch_folders(spark) if p not in ours]
    near = corpus_pipeline.near_duplicates(spark, exact, SF)  # still reads them
    assert left and set(left) <= set(scratch_folders(spark)) and near.count() > 0
    exact = corpus_pipeline.exact_duplicates(spark, docs, SF)
    left = [p for p in scratch_folders(spark) if p not in ours]
    exact.write.parquet(str(tmp_path / "exact"))
    corpus_pipeline.near_duplicates(spark, spark.read.parquet(str(tmp_path / "exact")), SF)
    assert not set(left[-1:]) & set(scratch_folders(spark))


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS row", "'x' AS doc", "2 AS score", "'y' AS lang_pred", "3L AS node", "true AS kept", "array(1) AS spans")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema == docs.schema
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.where("row = 1 AND doc = 'x' AND score = 2 AND lang_pred = 'y' AND node = 3 AND kept AND spans[0] = 1").count() == docs.count() > 0


def test_stages_take_rows_with_nulls(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "the words of a text", "en", "s", 19), (1, "the words of a text", "en", "s", 19), (2, "", None, None, 0), (3, "THE words of a text", "en", None, None)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for n, given in enumerate((rows, [])):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.write.parquet(str(tmp_path / f"{n}{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}{name}"))
        assert [r.doc_id for r in docs.collect()] == ([3] if given else [])
