"""Ranks over a whole table without a one-task window."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def global_rank(df: DataFrame, order: Sequence, name: str) -> DataFrame:
    """Adds ``name``: the 1-based position of each row in ``order``.

    Rows are dealt by range, so each partition holds a stretch of the order,
    and written (the ranges come from a sample and must not be drawn twice).
    Counts by partition, one row each, give the offsets; inside a partition
    a window numbers the rows.  ``order`` should end in a unique key; a value
    that very many rows share needs that key to be spread."""
    dealt = materialize(df.repartitionByRange(*order).withColumn("_stretch", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("_stretch").agg(F.count("*").alias("_n"))  # a row a partition
    before = counts.select("_stretch", (F.sum("_n").over(Window.orderBy("_stretch")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_stretch").orderBy(*order))
    return (dealt.join(F.broadcast(before), "_stretch").withColumn(name, F.col("_before") + place)
            .drop("_stretch", "_before"))
