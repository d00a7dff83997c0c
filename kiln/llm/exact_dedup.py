"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition becomes a run: its digests in sorted order, equal ones
merged into one entry with the member that stays and the number of rows.  In
each binomial round ``FAN`` neighbouring runs exchange their entries and are
merged into one run, so a digest meets itself at most ``FAN`` times in a
node; a group of copies with a third of all rows is already one entry a run
after the first merge and never lands whole in one task.  The way back goes
down the same tree: the root's decision is joined to the entries of each
level and last to the rows, each join again bounded by ``FAN`` entries or by
the rows of one run.

An entry is identified by the SHA-256 of the normalised text together with
its byte length and an independent 64-bit hash.  All three must agree at
every level before entries are merged, so what stays is verified against
each digest that it stands for.

Only DataFrame functions are used.

Defined results: a null text counts as empty and empty texts are equal to
each other; a null ``doc_id`` is smaller than any other; of rows that repeat
both ``doc_id`` and text one stays; an empty table gives no rows; other
columns are neither read nor returned by ``duplicate_classes`` and are
carried through unchanged by ``exact_dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kiln.llm.rows import numbered
from kiln.session import materialize

#: Runs merged into one in each round.
FAN = 16
_KEY = ("sha", "size", "check")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; ``lower`` does the same, faster, where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _runs(docs: DataFrame) -> DataFrame:
    """One row a document (``row, doc_id, text``): its number, its run and its
    digest, each run sorted by digest.  Written, as the texts are read only here."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return materialize(
        docs.select("doc_id", "row", F.spark_partition_id().alias("run"),
                    F.octet_length(text).alias("size"), ascii_lower(text).alias("norm"))
            .select("doc_id", "row", "run", "size", F.unhex(F.sha2("norm", 256)).alias("sha"), F.xxhash64("norm").alias("check"))
            .sortWithinPartitions("sha"), "digest-runs")


def _merge(runs: DataFrame) -> DataFrame:
    """Merges the entries of a digest within each run; the member with the
    largest (doc_id, row) stays, a null id being smallest."""
    return runs.groupBy(*_KEY, "run").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"))


def duplicate_classes(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """``doc_id, row, keep_id, keep_row, group_size, kept, sha`` for each row
    of ``docs`` (needs ``doc_id`` and ``text``).  ``row`` tells rows of this
    result apart; another scan of the input may number them otherwise."""
    return _classes(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), fan)


def _classes(docs: DataFrame, fan: int) -> DataFrame:
    """``duplicate_classes`` of rows that have their number (``row``)."""
    rows = _runs(docs)
    n_runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    levels = [_merge(rows.select(*_KEY, "run", F.struct("doc_id", "row").alias("keep"), F.lit(1).cast("long").alias("n")))]
    while n_runs > 1:
        n_runs = -(-n_runs // fan)
        levels.append(_merge(levels[-1].withColumn("run", F.floor(F.col("run") / fan).cast("int"))))
    # down again, with the classes of more than one row only
    found = levels[-1].filter("n > 1")
    for level in reversed(levels[:-1]):
        node = level.select(*_KEY, F.col("run").alias("below"), F.floor(F.col("run") / fan).cast("int").alias("run"))
        found = node.join(found, [*_KEY, "run"]).drop("run").withColumnRenamed("below", "run")
    out = rows.join(found, [*_KEY, "run"], "left")
    alone = F.col("n").isNull()
    keep_row = F.when(alone, F.col("row")).otherwise(F.col("keep.row"))
    return out.select("doc_id", "row", F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
                      keep_row.alias("keep_row"), F.coalesce("n", F.lit(1)).alias("group_size"),
                      (keep_row == F.col("row")).alias("kept"), "sha")


def exact_dedup(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """``docs`` without the rows whose text another row keeps."""
    whole = numbered(docs, "numbered-rows")
    dropped = _classes(whole.select("row", "doc.doc_id", "doc.text"), fan).filter("NOT kept").select(F.col("row").alias("dropped"))
    return whole.join(dropped, whole["row"] == F.col("dropped"), "left_anti").select("doc.*")
