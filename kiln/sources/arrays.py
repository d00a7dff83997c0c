"""One large JSON array read by many tasks.

A file that holds one array has no line ends to split at, and a plain reader
gives it to one task.  Here Spark's text source cuts it at every ``}``, so each
task reads a range of bytes and ends its pieces behind one.  What is missing is
where each piece stands: inside a string or not, and how deep.  Both are sums:

* no escape reaches across a ``}``, so the quotes of a chunk can be counted by
  itself, and a chunk begins inside a string if the quotes before it are odd;
* the depth a chunk adds is found for both beginnings; with the beginnings
  known it is summed too.

A running sum over one small row a chunk (a few megabytes of text) gives the
state at each chunk's start; the chunks, read again from where they were
written, then cut out their objects.  An object that reaches across chunks is
put together from its parts, and ``from_json`` parses whole objects.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, rows_a_batch

_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*"?', re.S)
_MARK = re.compile(r'"(?:[^"\\]|\\.)*"?|[{}\[\]]', re.S)
_QUOTE = re.compile(r'\\.|"', re.S)


def quotes(text: str) -> int:
    """Quotes that no backslash precedes."""
    return sum(m == '"' for m in _QUOTE.findall(text))


def marks(text: str, inside: bool) -> Iterator[tuple[int, str]]:
    """(place, bracket) of the brackets outside strings of a text that begins
    inside a string or not."""
    at = _REST_OF_STRING.match(text).end() if inside else 0
    for m in _MARK.finditer(text, at):
        if (c := m[0]) in "{}[]":
            yield m.start(), c


def depth(text: str, inside: bool) -> int:
    return sum(1 if c in "{[" else -1 for _, c in marks(text, inside))


def cut(text: str, inside: bool, level: int) -> tuple[str | None, list[str], str | None]:
    """(the rest of an object begun before, whole objects, the beginning of one
    that goes on) of a chunk that begins ``level`` deep; the array is 1 deep."""
    begin = 0 if level > 1 else None
    old, head, whole = begin is not None, None, []
    for place, c in marks(text, inside):
        if c in "{[":
            level += 1
            if level == 2:
                begin = place
        else:
            level -= 1
            if level == 1 and begin is not None:
                if old:
                    head, old = text[begin:place + 1], False
                else:
                    whole.append(text[begin:place + 1])
                begin = None
    if begin is None:
        return head, whole, None
    return (text, whole, None) if old else (head, whole, text[begin:])


def _chunks(spark: SparkSession, path: str, chunk_bytes: int) -> DataFrame:
    """``file, start, no, text`` and the sums, written: the pieces of each range
    of a file, in order, a few megabytes a row."""
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    kind = "file string, start long, no long, text string, quotes long, outside long, inside long"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for lo in range(0, b.num_rows, 1024) for row in zip(*(b.column(i).slice(lo, 1024).to_pylist() for i in range(3))))
        for (file, start), run in groupby(rows, lambda r: r[:2]):
            held, size, no = [], 0, 0

            def packed(text: str, no: int, file=file, start=start) -> pa.RecordBatch:
                return pa.RecordBatch.from_pylist([{"file": file, "start": start, "no": no, "text": text, "quotes": quotes(text),
                                                    "outside": depth(text, False), "inside": depth(text, True)}],
                                                  pa.schema([("file", pa.string()), ("start", pa.int64()), ("no", pa.int64()), ("text", pa.string()),
                                                             ("quotes", pa.int64()), ("outside", pa.int64()), ("inside", pa.int64())]))

            for _, _, value in run:
                held.append(value + "}")  # one too many behind the last piece of a file, after its array
                size += len(value) + 1
                if size >= chunk_bytes:
                    yield packed("".join(held), no)
                    held, size, no = [], 0, no + 1
            if held:
                yield packed("".join(held), no)

    with rows_a_batch(spark, 1024):
        return materialize(pieces.mapInArrow(pack, kind), "array-chunks")


def array_objects(spark: SparkSession, path: str, chunk_bytes: int = 4 << 20) -> DataFrame:
    """``file, object``: the text of every object of the arrays in ``path``, one
    array a file."""
    chunks = _chunks(spark, path, chunk_bytes)
    before = Window.partitionBy("file").orderBy("start", "no").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    states = chunks.select("file", "start", "no", "outside", "inside", begin.alias("begins_inside"), "quotes")
    step = F.when(F.col("begins_inside"), F.col("inside")).otherwise(F.col("outside"))
    states = states.withColumn("step", step).select("file", "start", "no", "begins_inside", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("level"))
    given = chunks.select("file", "start", "no", "text").join(states, ["file", "start", "no"])
    kind = "file string, start long, no long, seq int, text string"

    def objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                file, start, no, text, inside, level = (b.column(i)[row].as_py() for i in range(6))
                head, whole, tail = cut(text, inside, level)
                out = [(0, head)] * (head is not None) + [(1, tail)] * (tail is not None) + [(2, w) for w in whole]
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(out), pa.string()), pa.array([start] * len(out), pa.int64()), pa.array([no] * len(out), pa.int64()),
                                                  pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.string())], ["file", "start", "no", "seq", "text"])

    with rows_a_batch(spark, 2):  # a row is a chunk
        found = materialize(given.mapInArrow(objects, kind), "array-objects")
    # a part belongs to the object that the last beginning before it opened
    order = Window.partitionBy("file").orderBy("start", "no", "seq").rowsBetween(Window.unboundedPreceding, 0)
    parts = found.where("seq < 2").withColumn("_object", F.sum(F.col("seq")).over(order))
    joined = parts.groupBy("file", "_object").agg(F.array_sort(F.collect_list(F.struct("start", "no", "seq", "text"))).alias("_parts"))
    whole = joined.select("file", F.array_join(F.transform("_parts", lambda p: p["text"]), "").alias("object"))
    return found.where("seq = 2").select("file", F.col("text").alias("object")).unionByName(whole).where(F.col("object").startswith("{"))


def read_array(spark: SparkSession, path: str, schema: T.StructType, chunk_bytes: int = 4 << 20) -> DataFrame:
    """The objects of the arrays in ``path`` as rows of ``schema``; as with
    Spark's reader a field that is missing or does not fit is null."""
    return array_objects(spark, path, chunk_bytes).select(F.from_json("object", schema).alias("_row")).select("_row.*")
