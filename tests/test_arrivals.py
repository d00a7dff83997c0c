"""Streams whose documents have a null lang."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL


@pytest.mark.parametrize("name", ["stream_classify", "stream_prevalence"])
def test_rows_without_lang_arrive(spark, tmp_path, name):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("lang", F.when(F.col("doc_id") % 3 != 0, F.col("lang")))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    found = E.queries()[name](spark, str(tmp_path))
    expected = con.sql(E.oracle_sql()[name])
    assert sorted(map(tuple, found.select(*expected.columns).collect())) == sorted(expected.fetchall())
