"""The rare-name rule over arriving files.

A row is flagged while one of its capitalised non-initial words is rare, that
is occurs in at most ``max_df`` rows seen so far.  The number of rows of each
word is keyed state, with the candidates of the word as long as it is rare;
when it becomes common, the flags it gave are taken back and only its count is
kept.  Every change is a row (id, word, +1 or -1) appended to the output, so
the flags at any time are the ids with a positive sum.

Scale: the words of a task are counted before the shuffle (a common word is
one row a task and batch) with at most ``max_df + 1`` candidates each, as more
cannot matter; a state holds at most ``max_df`` ids a word and lies in RocksDB, so
the vocabulary may outgrow the memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators import curation as C

#: Words a task counts before it sends them on.
HELD_WORDS = 200_000
#: Input of a micro-batch: each commits every partition of the state, whatever
#: it holds, so a batch is by bytes and not by files, which may be many and small.
BATCH_BYTES = 1 << 30
#: Keys of the state: a call of the state function costs a thousand times what a
#: word in it costs, so words share keys by hash.  Fixed for a checkpoint.
WORD_BUCKETS = 1 << 12


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, with changes only
    written at each commit, and run no batches without data (a stream with
    timers would never end); the session's own settings come back after."""
    settings = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
                "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def word_counts(feat: DataFrame, id_col: str, max_df: int) -> DataFrame:
    """``word, n, ids`` by task from rows with ``_caps`` and ``_cands``: rows
    that hold the capitalised word, and of those that have it as a candidate
    up to ``max_df + 1``."""
    kind = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(feat.schema[id_col].dataType))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        ids: dict[str, list] = {}
        id_type = None

        def flush() -> pa.RecordBatch:
            words = list(counts)
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64()),
                                              pa.array([ids.get(w, []) for w in words], pa.list_(id_type))], ["word", "n", "ids"])
            counts.clear()
            ids.clear()
            return out

        for batch in batches:
            id_type = batch.schema.field(0).type
            for own, caps, cands in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for word in caps or ():
                    counts[word] = counts.get(word, 0) + 1
                for word in cands or ():
                    held = ids.setdefault(word, [])
                    if len(held) <= max_df:
                        held.append(own)
            if len(counts) > HELD_WORDS:
                yield flush()
        if counts:
            yield flush()

    return feat.select(id_col, "_caps", "_cands").mapInArrow(count, kind)


def merged(n: int, flagged: list, new_n: int, new_ids: list, max_df: int) -> tuple[int, list, list[tuple[object, int]]]:
    """A word's state after more rows: (rows, flagged ids, changes)."""
    n += new_n
    if n > max_df:
        return n, [], [(i, -1) for i in flagged]
    return n, flagged + new_ids, [(i, 1) for i in new_ids]


def stream_rare_names(spark: SparkSession, src: str, schema: T.StructType, out: str, ckpt: str, id_col: str = "doc_id",
                      text_col: str = "text", max_df: int = 2, files_per_batch: int | None = None) -> None:
    """Processes the files of ``src`` that are new since the last run and
    appends the changes of flags to ``out``."""
    from .streams import _source

    caps, cands = C.name_words(F.col(text_col))
    given = _source(spark, src, schema, files_per_batch, BATCH_BYTES)
    feat = given.where(F.col(id_col).isNotNull()).select(id_col, caps.alias("_caps"), cands.alias("_cands"))
    id_type = schema[id_col].dataType
    changes = _changes(schema[id_col])
    state = T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("n", T.ArrayType(T.LongType())),
                          T.StructField("ids", T.ArrayType(T.ArrayType(id_type)))])

    def update(key, frames, group):
        held = {w: (n, ids) for w, n, ids in zip(*group.get)} if group.exists else {}
        more: dict[str, tuple[int, list]] = {}
        for frame in frames:
            for word, n, ids in zip(frame["word"].tolist(), frame["n"].tolist(), frame["ids"]):
                known, own = more.get(word, (0, []))
                more[word] = known + n, own + ids.tolist()
        out_rows = []
        for word, (n, ids) in more.items():
            before, flagged = held.get(word, (0, []))
            total, flagged, changed = merged(before, list(flagged), n, ids, max_df)
            held[word] = total, flagged
            out_rows += [(i, word, d) for i, d in changed]
        group.update((list(held), [n for n, _ in held.values()], [ids for _, ids in held.values()]))
        if out_rows:
            yield pd.DataFrame(out_rows, columns=[id_col, "word", "delta"])

    bucket = F.pmod(F.xxhash64("word"), F.lit(WORD_BUCKETS)).cast("int")
    counts = word_counts(feat, id_col, max_df).withColumn("bucket", bucket)
    found = counts.groupBy("bucket").applyInPandasWithState(update, changes, state, "append", GroupStateTimeout.NoTimeout)
    with rocksdb(spark):
        q = (found.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()


def _changes(id_field: T.StructField) -> T.StructType:
    return T.StructType([id_field, T.StructField("word", T.StringType()), T.StructField("delta", T.IntegerType())])


def rare_name_ids(spark: SparkSession, out: str, id_field: T.StructField) -> DataFrame:
    """The ids flagged now."""
    changes = spark.read.schema(_changes(id_field)).parquet(out)
    return changes.groupBy(id_field.name).agg(F.sum("delta").alias("_rare")).where(F.col("_rare") > 0).select(id_field.name)
