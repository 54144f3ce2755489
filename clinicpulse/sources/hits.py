"""The user ids that web hits carried, by hit: filled at load, looked up without a scan of the params."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


class HitIndex:
    """(watch_id, internal) in buckets by hit, so that a join by hit moves the hits alone.

    The files lie under ``path``; a session that has not seen them enters them in its catalog. Rows may come twice: the
    highest user id of a hit counts, whatever else is there.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.name = f"hits_{hashlib.md5(path.encode()).hexdigest()}"

    def _known(self) -> str:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (watch_id DECIMAL(20,0), internal BIGINT) USING parquet "
            f"CLUSTERED BY (watch_id) SORTED BY (watch_id) INTO {BUCKETS} BUCKETS LOCATION '{self.path}'"
        )
        return self.name

    def append(self, users: DataFrame) -> None:
        rows = users.select("watch_id", "internal").repartition(BUCKETS, "watch_id")
        rows.write.insertInto(self._known())

    def read(self) -> DataFrame:
        return self.spark.table(self._known())
