"""Session defaults and the shared staging area."""

from __future__ import annotations

import atexit
import gc
import itertools
import uuid

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_BYTES = 128 * 1024 * 1024


def build_session(
    app_name: str = "tallyhouse", master: str | None = None, input_bytes: int | None = None, **conf
) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC clocks.

    `input_bytes`, the size of the largest table a run shuffles, sets the number of shuffle
    partitions so that each holds about 128 MB; adaptive execution merges those that turn
    out smaller. Stream state is kept in RocksDB, off the heap.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if input_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", max(200, -(-input_bytes // SHUFFLE_BYTES)))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that nothing refers to any more, before the next large step."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Without that setting it is a folder in the warehouse, which executors share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


class StagingArea:
    """Parquet copies of intermediates that more than one plan reads.

    A staged frame is computed once, survives the loss of any executor and is read back
    with column pruning. Each area owns one run folder; `clear` deletes that folder only.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self._root = root
        self._folder: str | None = None
        self._numbers = itertools.count(1)
        self._paths: dict[int, str] = {}

    @property
    def folder(self) -> str:
        if self._folder is None:
            root = self._root or shared_folder(self.spark)
            self._folder = f"{root}/staging-{uuid.uuid4().hex}"
            atexit.register(self._clear_at_exit)
        return self._folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{next(self._numbers):03d}-{name}"

    def stage(self, df: DataFrame, name: str = "frame") -> DataFrame:
        path = self.path(name)
        # Hashes are hex text: zstd halves them, Spark's default codec for parquet leaves them as they are.
        df.write.option("compression", "zstd").parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(staged)] = path
        return staged

    def drop(self, staged: DataFrame) -> None:
        """Delete one table of this area, as `stage` returned it, that no later plan reads."""
        delete_folder(self.spark, self._paths.pop(id(staged)))

    def clear(self) -> None:
        if self._folder is None:
            return
        delete_folder(self.spark, self._folder)
        self._folder = None

    def _clear_at_exit(self) -> None:
        try:
            self.clear()
        except Exception:  # the JVM may be gone by then
            pass
