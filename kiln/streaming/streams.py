"""Incremental runs with Structured Streaming.

All three read a folder of parquet files with a fixed schema, run with
``trigger(availableNow=True)`` and keep their progress in a checkpoint
folder under the shared ``spark.checkpoint.dir``; a restart processes only
files it has not seen.
"""

from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators import curation as C
from ..operators import retrieval as R
from .names import BATCH_BYTES, rare_name_ids, rocksdb, stream_rare_names


def _source(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None, batch_bytes: int | None = None) -> DataFrame:
    """A micro-batch takes ``files_per_batch`` files, without that as many as
    ``batch_bytes`` hold, without both all there are."""
    r = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    elif batch_bytes:
        r = r.option("maxBytesPerTrigger", batch_bytes)
    return r.load(path)


def stream_classify(spark: SparkSession, src: str, schema: T.StructType, out: str, ckpt: str,
                    id_col: str = "doc_id", text_col: str = "text", files_per_batch: int | None = None) -> None:
    """The rule flags of every arriving row: those that the row alone tells
    are appended to ``out/flags``, the changes of the rare-name flag, which
    later rows may take back, to ``out/names`` (both exactly once through
    their checkpoints).  ``read_classified`` joins them."""
    s = _source(spark, src, schema, files_per_batch, BATCH_BYTES)
    flags = s.select(id_col, C.rule_has_numbers(F.col(text_col)).alias(C.FLAGS[0]),
                     C.rule_has_non_english(F.col(text_col)).alias(C.FLAGS[1]))
    q = (flags.writeStream.format("parquet").option("path", f"{out}/flags").option("checkpointLocation", f"{ckpt}/flags")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    stream_rare_names(spark, src, schema, f"{out}/names", f"{ckpt}/names", id_col, text_col, files_per_batch=files_per_batch)


def read_classified(spark: SparkSession, out: str, id_field: T.StructField) -> DataFrame:
    """(id, three flags) of all rows so far."""
    flags = spark.read.schema(T.StructType([id_field, *(T.StructField(c, T.BooleanType()) for c in C.FLAGS[:2])])).parquet(f"{out}/flags")
    rare = rare_name_ids(spark, f"{out}/names", id_field).withColumn("_rare", F.lit(True))
    return flags.join(rare, id_field.name, "left").withColumn(C.FLAGS[2], F.col("_rare").isNotNull()).drop("_rare")


def stream_prevalence(spark: SparkSession, src: str, schema: T.StructType, out: str, ckpt: str,
                      answered: DataFrame, id_col: str = "doc_id", text_col: str = "text", files_per_batch: int | None = None) -> None:
    """Running quality and prevalence kept as streaming aggregation state:
    rows, rows with an answer (their id is in ``answered``, joined as it is
    at each micro-batch), and of these the rows with numbers and non-English
    letters.  Every micro-batch writes the current figures to a folder of its
    own, ``figures/epoch=N``, so that a reader never sees a half-written one.
    Rare names, whose flags later rows may take back, are kept as in
    ``stream_classify``, in ``names``; ``read_prevalence`` counts them."""
    s = _source(spark, src, schema, files_per_batch, BATCH_BYTES)
    valid = F.col("_answered").isNotNull()
    agg = (s.join(answered.select(id_col).distinct().withColumn("_answered", F.lit(True)), id_col, "left")
           .agg(F.count("*").alias("total"), F.count_if(valid).alias("successful"),
                F.count_if(valid & C.rule_has_numbers(F.col(text_col))).alias("numbers"),
                F.count_if(valid & C.rule_has_non_english(F.col(text_col))).alias("non_english")))

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/figures/epoch={epoch}")

    q = (agg.writeStream.outputMode("complete").foreachBatch(publish).option("checkpointLocation", f"{ckpt}/figures")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    stream_rare_names(spark, src, schema, f"{out}/names", f"{ckpt}/names", id_col, text_col, files_per_batch=files_per_batch)


def read_prevalence(spark: SparkSession, out: str, answered: DataFrame, id_field: T.StructField) -> DataFrame:
    """The figures of the last finished micro-batch, with the answered ids that
    have a rare name now."""
    figures = spark.read.parquet(f"{out}/figures").orderBy(F.desc("epoch")).limit(1).drop("epoch")
    rare = rare_name_ids(spark, f"{out}/names", id_field).join(answered.select(id_field.name).distinct(), id_field.name, "left_semi")
    return figures.join(F.broadcast(rare.agg(F.count("*").alias("unusual_proper_nouns"))))  # one row


class ChatHistory(StatefulProcessor):
    """Per conversation the turns so far, a list that grows by appending: a
    new turn is one write, whatever the conversation's length.  Each new turn,
    and each earlier one that comes after a late turn, gets its history.  With
    ``idle_ms`` the turns of a conversation that has had none for so long are
    dropped; a later turn begins a new history."""

    TURNS = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    OUTPUT = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("n_messages", T.IntegerType()),
                           T.StructField("text", T.StringType())])

    def __init__(self, idle_ms: int | None = None):
        self._idle_ms = idle_ms

    def init(self, handle) -> None:
        self._handle = handle
        self._turns = handle.getListState("turns", self.TURNS)

    def handleInputRows(self, key, rows, timerValues):
        new = [(int(r.turn), r.role, r.text) for frame in rows for r in frame.itertuples(index=False)]
        known = sorted([(t, r, x) for t, r, x in self._turns.get()] + new, key=lambda m: m[0])
        self._turns.appendList(new)
        if self._idle_ms:
            for old in list(self._handle.listTimers()):
                self._handle.deleteTimer(old)
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._idle_ms)
        first, text, out = min((m[0] for m in new), default=0), io.StringIO(), []
        for i, (turn, role, said) in enumerate(known):
            text.write(f"{R.IM_START}{role}\n{said}{R.IM_END}\n")
            if turn >= first:
                out.append((int(key[0]), turn, i + 1, text.getvalue()))
        yield pd.DataFrame(out, columns=self.OUTPUT.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._turns.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_chat_history(spark: SparkSession, src: str, schema: T.StructType, out: str, ckpt: str,
                        files_per_batch: int | None = 1, idle_ms: int | None = None) -> None:
    """Growing chat history per conversation with keyed state
    (``ChatHistory``, in RocksDB).  A late turn writes the later turns anew;
    ``read_chat_history`` takes the row of each turn that knows the most
    messages."""
    s = _source(spark, src, schema, files_per_batch)
    hist = s.groupBy("conv_id").transformWithStateInPandas(
        statefulProcessor=ChatHistory(idle_ms), outputStructType=ChatHistory.OUTPUT, outputMode="append", timeMode="processingTime" if idle_ms else "none")
    with rocksdb(spark):
        q = (hist.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()


def read_chat_history(spark: SparkSession, out: str) -> DataFrame:
    """(conv_id, turn, text), the same as the batch ``chat_history`` gives."""
    return spark.read.parquet(out).groupBy("conv_id", "turn").agg(F.max_by("text", "n_messages").alias("text"))
