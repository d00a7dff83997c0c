"""Rows that keep their number."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kiln.session import materialize

#: Whole texts handed to Python at a time: a batch is held by the JVM, and
#: again by the worker, in every running task.
TEXTS_A_BATCH = 1024


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``row, doc``: the rows of ``df`` as structs, each with a number that is
    written with it.  Later steps read that number: a second scan may be split
    otherwise and would number the rows anew."""
    return materialize(df.select(F.monotonically_increasing_id().alias("row"), F.struct(*[df[c] for c in df.columns]).alias("doc")), name)
