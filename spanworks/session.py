"""Session set-up shared by every operator."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
#: Bytes of an Arrow batch that goes to a Python worker, unless the session has set its own; an executor holds each several times outside its heap.
BATCH_BYTES, _BATCH_KEY = 2 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "spanworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library assumes: UTC, adaptive execution, Arrow."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def ensure_checkpoints(spark: SparkSession) -> str:
    """The folder that lineage cuts are written to.

    A cluster names it in ``spark.checkpoint.dir``, and it is an error if it doesn't; only a
    session on one machine, as in tests, gets a temporary folder.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="spark-checkpoints-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files, wherever Spark's file systems reach."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    The zip goes through Spark's own file server, so executors need no shared folder.
    Arrow batches are cut by bytes as well, so that long texts don't fill a worker.
    """
    if spark.sparkContext.getConf().get(_BATCH_KEY) is None:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="spark-ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def release() -> None:
    """Hand memory that Arrow and the C library keep for later back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A step over batches that releases its task's memory at its end: Spark keeps idle workers beside those of the next steps."""

    @functools.wraps(run)
    def ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return ending
