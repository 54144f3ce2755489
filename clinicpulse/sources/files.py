"""Names and sizes of files in any store Spark can reach; their contents are read by Spark alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Listed:
    name: str
    path: str
    size: int
    changed_ms: int
    is_folder: bool

    @property
    def is_data(self) -> bool:
        return not self.is_folder and self.name[0] not in "._"


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, folder: str) -> list[Listed]:
    """What lies directly in a folder, by name; nothing if there is no such folder."""
    place, fs = _opened(spark, folder)
    if not fs.exists(place):
        return []
    found = [
        Listed(s.getPath().getName(), s.getPath().toString(), s.getLen(), s.getModificationTime(), s.isDirectory())
        for s in fs.listStatus(place)
    ]
    return sorted(found, key=lambda f: f.name)


def create(spark: SparkSession, path: str) -> None:
    """An empty file; it is there at once or not at all, and an existing one is an error."""
    place, fs = _opened(spark, path)
    fs.mkdirs(place.getParent())
    if not fs.createNewFile(place):
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    place, fs = _opened(spark, path)
    fs.delete(place, True)
