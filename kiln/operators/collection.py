"""The stored vector collection: numbered snapshots, each id once.

A collection is a folder with ``data`` (a folder ``part=...`` for each commit,
inside it ``type=...``) and ``snapshots`` (small text files ``1``, ``2``, ...,
each the list of the parts of one snapshot).  A writer puts its rows into a
new part, which nobody reads yet, and then its snapshot file in place by one
rename that fails if that number is taken.  The writer that comes second looks
at the newer snapshot, drops the ids that it has meanwhile, and tries the next
number.  Readers take the highest number, so they see whole commits only; a
writer that dies leaves a part that no snapshot lists.

The rows are written once, as they come, and ids alone are compared then: where
none comes twice and none is stored, that is the part.  Else a second part is
made of the first, in which only rows whose id comes twice are moved.

Of rows with one id the stored one stays; within a call the first in the order
of document, source, page, image index and type (null first) is stored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import passing_shuffles

COLLECTION = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("document", T.StringType()), T.StructField("page", T.IntegerType()),
    T.StructField("source", T.StringType()), T.StructField("image_index", T.IntegerType()),
    T.StructField("type", T.StringType())])
#: What decides between rows of one id in a call.
ORDER = ("document", "source", "page", "image_index", "type")


class Conflict(RuntimeError):
    """Other writers took every number that was tried."""


class _Snapshots:
    """The numbered files; any storage whose rename does not overwrite."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._path(f"{path}/snapshots")
        self._fs = self._folder.getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def latest(self) -> tuple[int, list[str]]:
        """The highest number and its parts; 0 where there is none."""
        if not self._fs.exists(self._folder):
            return 0, []
        number = max((int(f.getPath().getName()) for f in self._fs.listStatus(self._folder) if f.getPath().getName().isdigit()), default=0)
        if not number:
            return 0, []
        stream = self._fs.open(self._jvm.org.apache.hadoop.fs.Path(self._folder, str(number)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return number, text.split()

    def commit(self, number: int, parts: list[str]) -> bool:
        """Whether snapshot ``number`` is now this one."""
        self._fs.mkdirs(self._folder)
        Path = self._jvm.org.apache.hadoop.fs.Path  # noqa: N806
        mine, final = Path(self._folder, f".{uuid.uuid4().hex}"), Path(self._folder, str(number))
        stream = self._fs.create(mine, True)
        try:
            stream.write(bytearray("\n".join(parts).encode()))
        finally:
            stream.close()
        from py4j.protocol import Py4JJavaError
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self._conf)
        none = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(self._fs.makeQualified(mine), self._fs.makeQualified(final), none)
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            self._fs.delete(mine, False)
            return False

    def drop(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)


def _read(spark: SparkSession, path: str, parts: list[str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], COLLECTION)
    stored = spark.read.option("basePath", f"{path}/data").schema(COLLECTION).parquet(*[f"{path}/data/part={p}" for p in parts])
    return stored.select(*COLLECTION.names)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """The stored collection, or an empty one where nothing is stored yet.  A
    filter on ``type`` reads those folders only."""
    return _read(spark, path, _Snapshots(spark, path).latest()[1])


def add_to_collection(vectors: DataFrame, path: str, attempts: int = 20) -> DataFrame:
    """Stores the vectors whose id is not stored yet, each id once, and
    returns the collection as it then is."""
    spark = vectors.sparkSession
    snapshots = _Snapshots(spark, path)
    folder = mine = None
    for _ in range(attempts):
        number, parts = snapshots.latest()
        if mine is None:
            mine, folder = _write(vectors.select(*COLLECTION.names), path)
        more = _to_store(_read(spark, path, [mine]), _read(spark, path, parts))
        if more is not None:
            (mine, folder), before = _write(more, path), folder
            snapshots.drop(before)
        if snapshots.commit(number + 1, [*parts, mine]):
            return read_collection(spark, path)
    snapshots.drop(folder)
    raise Conflict(f"{attempts} attempts to add to {path}")


def _write(rows: DataFrame, path: str) -> tuple[str, str]:
    """A new part that nobody reads yet, and its folder."""
    mine = uuid.uuid4().hex
    with passing_shuffles(rows.sparkSession):
        rows.write.partitionBy("type").parquet(f"{path}/data/part={mine}")
    return mine, f"{path}/data/part={mine}"


def _to_store(given: DataFrame, stored: DataFrame) -> DataFrame | None:
    """The given rows without those whose id is stored, each id once; none if
    these are all of them."""
    ids = given.select("id")
    twice = ids.groupBy("id").count().where("count > 1").select(F.col("id").alias("_id"))
    with passing_shuffles(given.sparkSession):
        again, known = not twice.isEmpty(), not ids.join(stored.select("id"), "id", "left_semi").isEmpty()
    if not again and not known:
        return None
    rows = given
    if again:
        same = F.col("id").eqNullSafe(F.col("_id"))
        first = F.min_by(F.struct(*COLLECTION.names), F.struct(*ORDER))
        once = given.join(twice, same, "left_semi").groupBy(F.col("id").alias("_id")).agg(first.alias("_row")).select("_row.*")
        rows = given.join(twice, same, "left_anti").unionByName(once)
    return rows.join(stored.select("id"), "id", "left_anti").select(*COLLECTION.names) if known else rows
