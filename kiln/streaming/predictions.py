"""A caller's model over arriving files.

The stream reads two folders, the input and a retry folder, and hands each
micro-batch to the model once (batches of ``batch_size`` prompts a call).  A
micro-batch's answers are one folder, ``epoch=N``, put in place by a single
rename; the records whose batch failed go to the retry folder the same way and
are input of the next run.  A micro-batch that is run again after a kill finds
its folder and asks nothing, so a stored answer is never paid for twice; what
a kill in the middle of a micro-batch loses is that micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.curation import FLAGS
from ..operators.model import Predictor, classify_with_model, rule_predictor
from .streams import _source


class _Folders:
    """Existence, renames and new folders on any storage Spark reads."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def make(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def put(self, df: DataFrame, folder: str, name: str) -> None:
        """Writes ``df`` where readers do not look and renames it to ``name``."""
        if self.exists(f"{folder}/{name}"):
            return
        df.write.mode("overwrite").parquet(f"{folder}/.{name}")
        fs, p = self._at(f"{folder}/.{name}")
        if not fs.rename(p, self._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")):
            raise OSError(f"cannot rename {folder}/.{name}")


def stream_predictions(spark: SparkSession, src: str, schema: T.StructType, out: str, retry: str, ckpt: str, key: str = "doc_id",
                       predict: Predictor = rule_predictor, batch_size: int = 256, files_per_batch: int | None = 1) -> None:
    """Classifies the question records (``key, category, question, answer``)
    of the files in ``src`` and ``retry`` that no run has taken yet."""
    folders = _Folders(spark)
    for folder in (out, retry):
        folders.make(folder)
    records = [key, "category", "question", "answer"]
    again = spark.readStream.schema(T.StructType([schema[c] for c in records])).option("recursiveFileLookup", "true")
    if files_per_batch:
        again = again.option("maxFilesPerTrigger", files_per_batch)
    given = _source(spark, src, schema, files_per_batch).select(*records).unionByName(again.parquet(retry))

    def classify(batch: DataFrame, epoch: int) -> None:
        if not folders.exists(f"{out}/epoch={epoch}"):
            folders.put(classify_with_model(batch, key, predict, batch_size, keep=records[1:]), out, f"epoch={epoch}")
        stored = spark.read.schema(_stored_schema(schema, key)).parquet(f"{out}/epoch={epoch}")
        failed = stored.where(F.col("error").isNotNull()).select(*records)
        if not failed.isEmpty():
            folders.put(failed, retry, f"epoch-{epoch}")

    q = given.writeStream.foreachBatch(classify).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()


def _stored_schema(schema: T.StructType, key: str) -> T.StructType:
    return T.StructType([schema[key], *(T.StructField(c, T.BooleanType()) for c in FLAGS), T.StructField("error", T.StringType()),
                         *(schema[c] for c in ("category", "question", "answer"))])


def read_predictions(spark: SparkSession, out: str, schema: T.StructType, key: str = "doc_id") -> DataFrame:
    """(key, three flags, error): each key's answer, or its last failure."""
    stored = spark.read.schema(_stored_schema(schema, key).add("epoch", T.LongType())).parquet(out)
    best = F.max_by(F.struct(*FLAGS, "error"), F.struct(F.col("error").isNull(), "epoch"))
    return stored.groupBy(key).agg(best.alias("_best")).select(key, "_best.*")
