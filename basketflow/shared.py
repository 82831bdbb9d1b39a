"""Intermediate tables in the folder that all executors share."""

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Setting by which a query leaves no shuffle files behind.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_RUN: ContextVar[str | None] = ContextVar("run folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where driver and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="basketflow-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses, in the folder of the run if there is one."""
    return f"{_RUN.get() or f'{shared_folder(spark)}/basketflow'}/{uuid.uuid4().hex}/{name}"


@contextmanager
def run_folder(spark: SparkSession, keep: bool = False) -> Iterator[str]:
    """All tables written inside go to one folder, which is deleted at the end, also after a failure.

    Results must have been written elsewhere by then, as they are read from these tables. ``keep`` leaves them.
    """
    folder = f"{shared_folder(spark)}/basketflow/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        if not keep:
            remove(spark, folder)


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, system = _hadoop_path(spark, path)
    return system.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark writes to; nothing happens where there is none."""
    found, system = _hadoop_path(spark, path)
    system.delete(found, True)


def as_counted_table(df: DataFrame, name: str, counts: Sequence[Column]) -> tuple[DataFrame, dict]:
    """The same with aggregates over all rows, which the write itself gives: no second scan."""
    seen = Observation()
    table = as_table(df.observe(seen, *counts), name)
    return table, seen.get


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the files.

    Later uses read only the columns they need, and a lost executor costs a re-read instead of
    a recomputation of everything upstream. Shuffle files of the write go with its end, as nothing reads them again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
