"""Corpus preparation from documents to packed training sequences.

Each stage is one operator of ``kiln.llm`` over all rows that the stage
before has kept.  It takes ``(spark, docs, sf_dir)``; all but the last return
the columns of ``docs``.  Between stages the documents are written to the
shared folder and read again.

Defined results: documents without text, without a letter or of unclear
language go at the first stage; of equal texts the row with the largest
``doc_id`` stays; of near-duplicates (five-word shingles, similarity 0.8) the
one with the smallest; bytes covered by a repeated window of 200 bytes are
taken out of all texts, which may leave a text empty, but no row goes; the last
stage returns where each piece of each document lies.  An empty table gives
an empty result.

Disk: a stage deletes the scratch folders that the stage before it has left
(its result is written by then), unless its input still reads them; ``run``
also deletes each stage's result when the next one stands, and leaves its own
result only.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.exact_dedup import exact_dedup
from kiln.llm.langid import in_known_language
from kiln.llm.minhash import near_dedup
from kiln.llm.packing import Capacity, pack
from kiln.llm.queries import vocabulary
from kiln.llm.suffix_dedup import cut_repeats
from kiln.session import clear_scratch, materialize, scratch_folders
from kiln.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


_left: dict[str, list[str]] = {}  # application -> scratch folders of its last stage


def clearing(stage: Stage) -> Stage:
    """The stage, which first deletes what the stage before has left."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        if left := _left.pop(app, []):
            read = docs.inputFiles()
            clear_scratch(spark, [p for p in left if not any(f"/{os.path.basename(p)}/" in f for f in read)])
        before = set(scratch_folders(spark))
        out = stage(spark, docs, sf_dir)
        _left[app] = [p for p in scratch_folders(spark) if p not in before]
        return out
    return run_stage


@clearing
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_known_language(docs)


@clearing
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


@clearing
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs, width=5, percent=80)


@clearing
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cut_repeats(docs, length=200)


@clearing
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary("word_bpe_49k.json"), Capacity(tokens=4096), end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("packing", packing),
]
#: Near duplicates, repeated passages and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), set(scratch_folders(spark))
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        *gone, _ = [p for p in scratch_folders(spark) if p not in before]  # the last is this stage's result
        clear_scratch(spark, gone)
    return docs
