"""Table upkeep: which tables there are, their statistics, and merging of small files."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinicpulse import params as P
from clinicpulse.sources import files
from clinicpulse.sources.state import StateTable

FILE_BYTES = 256 * 1024 * 1024


def tables(spark: SparkSession, exclude: Sequence[str] = P.EXCLUDED_SCHEMAS) -> list[str]:
    """Stored tables of the catalog as ``schema.table``, without views and excluded schemas."""
    found = []
    for schema in spark.catalog.listDatabases():
        if schema.name in exclude:
            continue
        found += [
            f"{schema.name}.{t.name}"
            for t in spark.catalog.listTables(schema.name)
            if not t.isTemporary and t.tableType in ("MANAGED", "EXTERNAL")
        ]
    return sorted(found)


def analyze(spark: SparkSession, table: str) -> None:
    """Refresh row count, size and column statistics, which the cost-based optimiser reads."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def row_count(spark: SparkSession, table: str) -> int:
    """The row count of the last ``analyze``, from the catalog."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Statistics")
    return int(re.search(r"(\d+) rows", described.first()["data_type"])[1])


def files_needed(sizes: Sequence[int], file_bytes: int = FILE_BYTES) -> int:
    return max(1, -(-sum(sizes) // file_bytes))


def worth_merging(sizes: Sequence[int], file_bytes: int = FILE_BYTES) -> bool:
    """More files than their bytes need, some of them below half the size wanted.

    Once rewritten there are no more than needed, so a second sweep leaves the files alone.
    """
    small = [s for s in sizes if s < file_bytes / 2]
    return len(small) > 1 and len(sizes) > files_needed(sizes, file_bytes)


def partitions(
    spark: SparkSession, folder: str, depth: int
) -> Iterator[tuple[tuple[str | None, ...], str, list[files.Listed]]]:
    """Values of each partition ``depth`` folders below, as text, its folder, and what lies in it."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    if not depth:
        yield (), folder, files.listed(spark, folder)
        return
    for inner in files.listed(spark, folder):
        if inner.is_folder and "=" in inner.name:
            text = unescape(inner.name.split("=", 1)[1])
            value = None if text == "__HIVE_DEFAULT_PARTITION__" else text
            for rest, path, found in partitions(spark, inner.path, depth - 1):
                yield (value, *rest), path, found


def partition_files(spark: SparkSession, folder: str, depth: int) -> Iterator[tuple[tuple[str | None, ...], list[int]]]:
    """Values of each partition and the sizes of its files."""
    for values, _, found in partitions(spark, folder, depth):
        yield values, [f.size for f in found if f.is_data]


def due_rows(table: StateTable, due: Sequence[tuple]) -> DataFrame:
    """The rows of the partitions in ``due`` (their values as text, then a number, which becomes ``_files``)."""
    by = table.partition_by
    shape = ", ".join([*[f"`_{c}` STRING" for c in by], "_files INT"])
    wanted = table.spark.createDataFrame(list(due), shape)
    stored = table.read()
    first = sorted({d[0] for d in due if d[0] is not None})
    opened = F.col(by[0]).cast("string").isin(first)
    if any(d[0] is None for d in due):
        opened = opened | F.col(by[0]).isNull()
    same = reduce(lambda a, b: a & b, [F.col(c).cast("string").eqNullSafe(F.col(f"_{c}")) for c in by])
    return stored.filter(opened).join(wanted, same).select(*stored.columns, "_files")


def merge_partitions(
    table: StateTable,
    file_bytes: int = FILE_BYTES,
    settled: Callable[[Sequence[files.Listed]], bool] = lambda found: False,
) -> int:
    """Rewrite the partitions of a state table that have too many small files, each as the files its bytes need.

    The files are listed on the driver, as every scan does. Other partitions are not opened, nor are those whose files
    are ``settled`` otherwise. Returns how many partitions were rewritten; readers should not be at work on those
    meanwhile.
    """
    due = []
    for values, _, found in partitions(table.spark, table.path, len(table.partition_by)):
        sizes = [f.size for f in found if f.is_data]
        if worth_merging(sizes, file_bytes) and not settled(found):
            due.append((*values, files_needed(sizes, file_bytes)))
    if not due:
        return 0
    rows = due_rows(table, due)
    hashed = [c for c in rows.columns if c != "_files"]
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*hashed), F.col("_files"))).drop("_files")
    dealt = rows.repartition(sum(d[-1] for d in due), *table.partition_by, "_part").drop("_part")
    table.overwrite(dealt)
    return len(due)


def compact(spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rewrite a parquet table with few, even files into ``target`` and return it.

    Rows are rebalanced to files of about ``FILE_BYTES``; a partition holding much of the data is split over
    several tasks. The source stays until the caller points readers to the new copy.
    """
    # A session of its own, as the size is a setting.
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(FILE_BYTES))
    stored = own.read.parquet(source)
    stored.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(target)
    return spark.read.schema(stored.schema).parquet(target)


def _place(spark: SparkSession, table: str) -> str:
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return facts.first()["data_type"]


def merge_files(spark: SparkSession, table: str, folder: str) -> bool:
    """Rewrite a catalog table's files under ``folder`` and point the catalog to the copy, if it has too many small ones.

    Readers see the old files until the switch and the new ones after it; ``expire`` removes old copies.
    """
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    place = _place(spark, table)
    if not any(worth_merging(sizes) for _, sizes in partition_files(spark, place, len(parts))):
        return False
    target = f"{folder}/{table}-{uuid.uuid4().hex}"
    compact(spark, place, target, parts)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
    if parts:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return True


def expire(spark: SparkSession, folder: str, older_than: timedelta = timedelta(days=7)) -> list[str]:
    """Remove the copies under ``folder`` that no catalog table points to and that are so old that nobody reads them."""
    used = {_place(spark, name).rstrip("/").rsplit("/", 1)[-1] for name in tables(spark, exclude=())}
    limit = (time.time() - older_than.total_seconds()) * 1000
    gone = [f for f in files.listed(spark, folder) if f.is_folder and f.name not in used and f.changed_ms < limit]
    for copy in gone:
        files.remove(spark, copy.path)
    return [f.name for f in gone]


def sweep(spark: SparkSession, exclude: Sequence[str] = P.EXCLUDED_SCHEMAS, merge_into: str | None = None) -> list[str]:
    """Maintain every table: merge its small files into the folder ``merge_into``, if given, and refresh its
    statistics. A table whose files are large enough is not rewritten. A failure stops the sweep."""
    names = tables(spark, exclude)
    for name in names:
        if merge_into is not None:
            merge_files(spark, name, merge_into)
        analyze(spark, name)
    return names
