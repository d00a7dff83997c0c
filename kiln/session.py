"""Session helper and shared-folder lookup.

Scale notes: shuffle width and file split size are the two knobs that
decide whether partitions fit in executor memory.  They are only set here
when the caller builds the session; an existing cluster session keeps its
own values.  AQE stays on so that small derived tables (strata counts,
label dictionaries) become broadcast joins at run time only after their
real size has been measured.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kiln") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    # getOrCreate on a running session ignores builder options for static
    # confs; the runtime one is applied explicitly
    spark.conf.set("spark.sql.session.timeZone", DEFAULT_CONF["spark.sql.session.timeZone"])
    ensure_checkpoint_dir(spark)
    return spark


_own: dict[str, str] = {}  # application -> folder, where none is named
_written: dict[str, list[str]] = {}  # application -> scratch folders


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must name storage that all executors share.
    Only a local session without it gets a temporary folder of its own."""
    app = spark.sparkContext.applicationId
    d = spark.conf.get("spark.checkpoint.dir", None) or _own.get(app)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
        d = _own[app] = tempfile.mkdtemp(prefix="kiln-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_folders(spark: SparkSession) -> list[str]:
    """The scratch folders this session has written and not yet cleared."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, folders: Iterable[str] | None = None) -> int:
    """Deletes the given scratch folders of this session, or all, once their
    frames are no longer read; the number of folders."""
    mine = _written.get(spark.sparkContext.applicationId, [])
    gone = [p for p in mine if folders is None or p in set(folders)]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in gone:
        mine.remove(p)
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(gone)


#: Whether Spark deletes the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Row groups of a few rows where each has megabytes.
_WIDE = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1}


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind: they go as soon
    as it is written, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    try:
        spark.conf.set(_CLEANUP, "true")
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialize(df, name: str, **options):
    """Write ``df`` as parquet under the shared checkpoint folder and read
    it back: cuts the lineage (a lost executor recomputes from the files,
    not from the model step) and lets later plans prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_passing(df, name: str, **options):
    """As ``materialize``, and the shuffle files of ``df`` go at once."""
    with passing_shuffles(df.sparkSession):
        return materialize(df, name, **options)


def materialize_wide(df, name: str):
    """As ``materialize_passing``, for rows of megabytes: a reader or writer
    holds a few of them at a time."""
    return materialize_passing(df, name, **_WIDE)


def forget(df) -> None:
    """Deletes the scratch folder of a materialized frame nobody reads again."""
    parts = {x for f in df.inputFiles()[:1] for x in f.split("/")}
    clear_scratch(df.sparkSession, [p for p in scratch_folders(df.sparkSession) if os.path.basename(p) in parts])


@contextmanager
def rows_a_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Frames run inside hand at most ``rows`` rows at a time to Python (fewer
    where the session says so), for rows that are large; the session's own
    setting comes back after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
        yield
    finally:
        spark.conf.set(key, before)


def spread(df, key: str):
    """Hash-partition ``df`` by ``key`` when it has fewer partitions than
    the cluster can run at once (a single large file read as one task).
    Used before CPU-heavy per-row text work; with many input files it is a
    no-op and adds no shuffle.  The rows are the same either way.  Hashing by
    the row id keeps the layout deterministic across task retries."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want, key)
