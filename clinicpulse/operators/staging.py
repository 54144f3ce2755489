"""Write an intermediate result once to the cluster's shared folder and read it back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Staged outside any scope: kept until ``release``.
_written: list[str] = []
# The paths of the scope a thread is in; a scope owns what is staged inside it and nothing else.
_scope: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; only a local session may fall back to its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir: the executors have folders of their own")
    folder = tempfile.mkdtemp(prefix="clinicpulse-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/clinicpulse/{label}-{uuid.uuid4().hex}"
    owned = _scope.get()
    (_written if owned is None else owned).append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Materialise ``df`` as parquet.

    Unlike a cache it survives lost executors; unlike an RDD checkpoint later reads are column-pruned and
    their true size is known to the planner, so join strategies are chosen on facts.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove what this thread stages inside once the block ends; its results must be written by then."""
    owned: list[str] = []
    token = _scope.set(owned)
    try:
        yield
    finally:
        _scope.reset(token)
        _remove(spark, owned)


def release(spark: SparkSession) -> None:
    """Remove everything this process staged outside scopes."""
    paths = list(_written)
    _remove(spark, paths)
    del _written[: len(paths)]
