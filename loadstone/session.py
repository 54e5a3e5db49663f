"""Session settings every load relies on."""

from __future__ import annotations

import os
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; all of them can be set on a session that already runs.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split over tasks at run time, even where the split
    # costs one more exchange further up the plan.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Loads join narrow rows that compress to some ten bytes each: 64 MB of them, Spark's usual share of a task,
# are gigabytes once they are sorted for the joins and aggregates of a stage. Settled rows take a third less with zstd.
LOAD_CONF = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.parquet.compression.codec": "zstd"}


def tune(spark: SparkSession, loads: bool = False) -> SparkSession:
    """Apply the runtime settings to a session somebody else created; ``loads`` adds those of the loads."""
    for key, value in {**RUNTIME_CONF, **(LOAD_CONF if loads else {})}.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "loadstone", cores: int | None = None, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster pass the cluster's own to ``tune``."""
    builder = SparkSession.builder.appName(app)
    if cores is not None:
        builder = builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(cores))
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Plans have hundreds of column expressions; noting where each was written takes longer than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LOADSTONE_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: what the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a folder below the warehouse. Fails where that is on the machine's own
    disk and the executors are on other machines: each would write to its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        scheme = files_of(spark, folder)[1].getUri().getScheme()
        if scheme == "file" and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share; the warehouse folder is a local one")
    return folder.rstrip("/")


def files_of(spark: SparkSession, path: str):
    """A path and the file system it lies on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


# Folders written inside the innermost ``scratch`` block of this thread.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def scratch_path(spark: SparkSession, kind: str = "rows") -> str:
    """A new folder in the shared folder; it goes at the end of the ``scratch`` block or of the application."""
    path = f"{shared_folder(spark)}/{kind}-{uuid4()}"
    folder, files = files_of(spark, path)
    files.mkdirs(folder)
    if (block := _written.get()) is not None:
        block.append(path)
    else:
        files.deleteOnExit(folder)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """Delete the rows that were settled inside, also after a failure."""
    mine: list[str] = []
    token = _written.set(mine)
    try:
        yield
    finally:
        _written.reset(token)
        for path in mine:
            folder, files = files_of(spark, path)
            files.delete(folder, True)


@contextmanager
def lasting():
    """Rows settled inside go at the end of the application, whatever block this is in: others use them later."""
    token = _written.set(None)
    try:
        yield
    finally:
        _written.reset(token)


def settle_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """Settle the rows that ``make`` returns, and delete what it has settled on the way to them."""
    mine: list[str] = []
    token = _written.set(mine)
    try:
        df = make()
    finally:
        _written.reset(token)
    try:
        return settle(df)
    finally:
        for path in mine:
            folder, files = files_of(df.sparkSession, path)
            files.delete(folder, True)


def settle(df: DataFrame) -> DataFrame:
    """Write rows that many later steps use to the shared folder and read them back.

    They are computed once, the plans on top stay small, their measured size lets Spark
    decide whether to broadcast them, and a lost executor does not repeat what is behind them.
    What was exchanged to work them out is deleted at once: it would stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark)}/data"
    with _conf(spark, CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Deletes the files of a query's exchanges at its end. Versions of Spark that do not know it keep them for a while longer.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    """Set a runtime setting inside the block."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
