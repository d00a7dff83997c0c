"""Readers and writers: question JSON, claim CSV, raw document bytes,
labelled images, and the JSON sinks of the curation run."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..session import rows_a_batch

QUESTION_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("air_date", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("round", T.StringType()),
    T.StructField("show_number", T.StringType()),
])


def read_questions(spark: SparkSession, path: str, schema: T.StructType = QUESTION_SCHEMA,
                   multi_line: bool = False) -> DataFrame:
    """Question records from JSON.  ``multi_line=True`` reads files holding
    one JSON array; otherwise JSON lines (splittable, the right layout for
    large inputs).  A missing path raises Spark's PATH_NOT_FOUND error.
    Extra fields may be listed in ``schema``; missing fields read as null
    (a JSON reader with a schema cannot tell missing from null)."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_claims_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header.  Types are inferred once when no schema is given
    (pass the schema of the training file for scoring files).  A missing
    file gives an empty frame with columns (id, target)."""
    try:
        r = spark.read.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], "id long, target int")


def read_binary_docs(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Raw document bytes: (path, modificationTime, length, content) plus
    any partition columns found in the folder names."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def read_labelled_images(spark: SparkSession, path: str) -> DataFrame:
    """Images decoded by Spark's image source; ``label`` is the name of the
    parent folder.  Undecodable files are dropped."""
    img = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    return img.select(
        F.col("image.origin").alias("origin"),
        F.regexp_extract(F.col("image.origin"), r"/([^/]+)/[^/]+$", 1).alias("label"),
        F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"), F.col("image.mode").alias("mode"),
        F.col("image.data").alias("data"))


def write_json(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """JSON-lines sink (one part file per task; non-ASCII and null fields
    kept as they are)."""
    w = df.write.mode(mode).option("ignoreNullFields", False)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


#: Text of an array that a task holds at once, and rows it takes at once.
PIECE_BYTES, PIECE_ROWS = 1 << 20, 1024


def write_json_arrays(objects: DataFrame, path: str, max_rows: int = 10_000, max_bytes: int = 8 << 20) -> None:
    """Files of one JSON array each, from one column of JSON objects as text.
    Every task cuts its rows into files of up to ``max_rows`` objects and
    ``max_bytes`` bytes; a single larger object has a file of its own.

    An array is written as lines of up to ``PIECE_BYTES``, so a task holds two of
    them and not the array.  All files have the same number of lines, the last
    ones empty, by which the sink tells where one ends."""
    lines = max(1, max_bytes // PIECE_BYTES)
    most = max_bytes // lines

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, size = "", [], 0  # the line before, the objects of this one
        written = used = count = 0  # lines, the room they take, objects of the file

        def told(values: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])

        def end_line() -> Iterator[pa.RecordBatch]:
            nonlocal last, held, size, written, used
            if held:
                if written:
                    yield told([last])
                last = ("," if written else "[") + ",".join(held)
                written, used = written + 1, used + -(-(size + 2) // most)
                held, size = [], 0

        def end_file() -> Iterator[pa.RecordBatch]:
            nonlocal last, written, used, count
            yield told([last + "]"] + [""] * (lines - written))
            last, written, used, count = "", 0, 0, 0

        for batch in batches:
            for value in batch.column(0):
                value = value.as_py()
                n = len(value.encode()) + 1
                if count == max_rows or size + n + 2 > most:
                    yield from end_line()
                if written and not held and (count == max_rows or used + -(-(n + 2) // most) > lines):
                    yield from end_file()
                held.append(value)
                size += n
                count += 1
        yield from end_line()
        if written:
            yield from end_file()

    with rows_a_batch(objects.sparkSession, PIECE_ROWS):
        objects.mapInArrow(arrays, "value string").write.option("maxRecordsPerFile", lines).text(path)
