"""State tables kept as parquet."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from clinicpulse.sources import files


class StateTable:
    """A table in partitions that a run appends to or replaces one by one.

    Replacing stages the new files and swaps whole partitions when the job commits, so a plan may read the
    partitions it replaces, a lost executor costs only its tasks, and a run can be repeated.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, partition_by: Sequence[str]):
        self.spark, self.path, self.schema, self.partition_by = spark, path, schema, list(partition_by)

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def _balanced(self, df: DataFrame) -> DataFrame:
        """Few files per partition, and several tasks for a partition that holds much of the data."""
        columns = T.StructType.fromDDL(self.schema).fieldNames()
        return df.select(*columns).hint("rebalance", *self.partition_by)

    def append(self, df: DataFrame) -> None:
        self._balanced(df).write.mode("append").partitionBy(*self.partition_by).parquet(self.path)

    def replace_partitions(self, df: DataFrame) -> None:
        """Replace the partitions ``df`` has rows for; the others stay."""
        self.overwrite(self._balanced(df))

    def overwrite(self, df: DataFrame) -> None:
        """The same with the files as ``df`` is dealt out."""
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partition_by)
            .parquet(self.path)
        )


class VersionedTable:
    """A table that is replaced as a whole, in one step.

    Each version is a folder of its own, ``versions/<name>``. Once it is complete an empty file
    ``pointers/<number>.<name>`` makes it the current one: readers follow the highest pointer, so a run that fails
    anywhere before leaves the table as it was, and a plan made before a replacement goes on reading its version. Of two
    runs that publish at once, both are kept and one is current.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _pointers(self) -> list[str]:
        return [f.name for f in files.listed(self.spark, f"{self.path}/pointers")]

    def publish(self, df: DataFrame) -> str:
        """Make ``df`` the table's content; it may read the table. Returns the version's name."""
        columns = T.StructType.fromDDL(self.schema).fieldNames()
        name = uuid.uuid4().hex
        df.select(*columns).write.parquet(f"{self.path}/versions/{name}")
        last = max((int(p.split(".")[0]) for p in self._pointers()), default=0)
        files.create(self.spark, f"{self.path}/pointers/{last + 1:012d}.{name}")
        return name

    def read(self) -> DataFrame:
        """The current version; no rows before the first one."""
        pointers = self._pointers()
        if not pointers:
            return self.spark.createDataFrame([], self.schema)
        current = pointers[-1].split(".")[1]
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/versions/{current}")

    def expire(self, keep: int = 3, abandoned_after: timedelta = timedelta(days=1)) -> list[str]:
        """Remove all but the last ``keep`` versions, and folders of runs that never finished once they are that old.

        Returns the names removed. Pointers go first, so no pointer is ever without its folder.
        """
        pointers = self._pointers()
        old, kept = pointers[:-keep], {p.split(".")[1] for p in pointers[-keep:]}
        for pointer in old:
            files.remove(self.spark, f"{self.path}/pointers/{pointer}")
        done = {p.split(".")[1] for p in old}
        limit = (time.time() - abandoned_after.total_seconds()) * 1000
        gone = []
        for folder in files.listed(self.spark, f"{self.path}/versions"):
            if folder.name not in kept and (folder.name in done or folder.changed_ms < limit):
                files.remove(self.spark, folder.path)
                gone.append(folder.name)
        return gone
