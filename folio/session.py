"""Session set-up and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch where batches are bounded: its buffers then come from pools, which the JVM uses again.
BATCH_BYTES = 2 << 20
#: Paths written in the innermost ``scratch`` block of this thread.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def build_session(app: str = "folio", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` adds or overrides settings.

    Leave ``master`` unset under ``spark-submit``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Let tasks send rows to Python ``BATCH_BYTES`` at a time, whatever the length of their texts.

    By rows alone a batch is a whole split of long texts, several times in memory outside the heap, and the C library
    keeps much of that for the rest of the executor's life. Plans read the setting when they run, so it stays.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="folio-"))
    return context.getCheckpointDir().rstrip("/")


def _work_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/folio-{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{_work_root(spark)}/{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_work(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once nothing reads them any more."""
    _delete(spark, _work_root(spark))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    It does so once the driver's collector has found out, which may take long on a driver with little to do.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def noting() -> Iterator[list[str]]:
    """The paths of the tables that are materialized inside and stay; nothing is deleted."""
    outer, own = _SCRATCH.get(), []
    _SCRATCH.set(own)
    try:
        yield own
    finally:
        _SCRATCH.set(outer)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete materialized tables that nothing reads any more."""
    for path in paths:
        _delete(spark, path)
    free_shuffles(spark)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables materialized inside are deleted at the end; the function it gives writes one that stays.

    What leaves the block must be such a table or values on the driver, not a plan over a deleted table.
    """
    outer, own = _SCRATCH.get(), []
    _SCRATCH.set(own)

    def keep(df: DataFrame, label: str) -> DataFrame:
        _SCRATCH.set(outer)
        try:
            return materialize(df, label)
        finally:
            _SCRATCH.set(own)

    try:
        yield keep
    finally:
        _SCRATCH.set(outer)
        drop_tables(spark, own)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage: what follows neither recomputes the input nor depends on the
    executors that produced it.
    """
    path = work_path(df.sparkSession, label)
    if (written := _SCRATCH.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
