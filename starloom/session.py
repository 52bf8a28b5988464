"""Session defaults and shared-folder handling."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_PASSING = threading.local()  # by thread, as batches of several streams may run at a time


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="starloom-")
    return _LOCAL_FOLDERS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    path = f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if getattr(_PASSING, "scopes", None):
        _PASSING.scopes[-1].append(path)
    return path


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """What this thread writes to fresh scratch paths inside is deleted at the end; frames that read it become invalid."""
    if not hasattr(_PASSING, "scopes"):
        _PASSING.scopes = []
    made: list[str] = []
    _PASSING.scopes.append(made)
    try:
        yield
    finally:
        _PASSING.scopes.pop()
        for path in made:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/starloom/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote below the shared folder; frames that read it become invalid."""
    _delete(spark, _scratch_root(spark))


#: Rows that go to a Python worker at a time where they hold texts: an executor and its workers each hold such a batch.
TEXT_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession) -> None:
    """From now on Python functions of this session get at most TEXT_ROWS rows at a time.

    For stages that return a frame which their caller runs; the setting must still hold then, so it stays. It changes no result.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= TEXT_ROWS:
        spark.conf.set(_BATCH, TEXT_ROWS)


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(*sessions: SparkSession) -> Iterator[None]:
    """Shuffle files of what these sessions run inside go when its execution ends, not when the driver next collects its garbage.

    For frames that are run once: one that is run again writes its exchanges again.
    """
    before = [(spark, spark.conf.get(_FREE)) for spark in sessions]
    for spark in sessions:
        spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        for spark, value in before:
            spark.conf.set(_FREE, value)


def materialize(df: DataFrame, name: str = "table", batch_rows: int | None = None) -> DataFrame:
    """Write a frame once and read it back.

    Cuts the lineage with files in the shared folder, so a lost executor costs a
    re-read and not a recomputation, and several consumers share one computation.
    With batch_rows, Python functions of the frame get at most so many rows at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = int(spark.conf.get(_BATCH))
    if batch_rows and not 0 < before <= batch_rows:
        spark.conf.set(_BATCH, batch_rows)
    try:
        with freed_shuffles(spark):
            df.write.mode("errorifexists").parquet(path)
    finally:
        if int(spark.conf.get(_BATCH)) != before:
            spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def materialize_pieces(pieces: Sequence[DataFrame], name: str = "table") -> DataFrame:
    """As `materialize`, for a table that comes in pieces of one schema: one is written after another, so only one's exchanges are there at a time."""
    spark, first = pieces[0].sparkSession, pieces[0].schema
    if any([(f.name, f.dataType) for f in p.schema] != [(f.name, f.dataType) for f in first] for p in pieces):
        raise ValueError("the pieces of a table must have the same columns")
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        for p in pieces:
            p.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(first).parquet(path)


def plan_size(df: DataFrame) -> int:
    """Catalyst's estimate of the size of a frame in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """True when the estimate is below the session's broadcast threshold."""
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    text = str(raw).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    digits = text.rstrip("bkmg")
    limit = int(digits) * units.get(text[len(digits):] or "b", 1)
    return 0 <= plan_size(df) <= limit
