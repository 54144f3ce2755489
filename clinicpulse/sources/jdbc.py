"""Optional database adapter: clinic tables in, results out. The driver jar comes from the cluster."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession


def day_predicates(column: str, start: date, end: date, days_each: int) -> list[str]:
    """Disjoint ranges covering ``start`` to ``end``, one query (and one task) each."""
    cuts = range(0, (end - start).days + 1, days_each)
    return [
        f"{column} >= DATE '{start + timedelta(days=n)}' AND "
        f"{column} < DATE '{min(start + timedelta(days=n + days_each), end + timedelta(days=1))}'"
        for n in cuts
    ]


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Without predicates a table comes through one connection, so give them for any large table."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def publish(
    df: DataFrame, url: str, table: str, properties: dict[str, str], batch_rows: int = 10_000
) -> None:
    """Replace a report table in a database, every task sending its own rows in batches."""
    df.write.option("batchsize", batch_rows).option("truncate", True).jdbc(
        url, table, mode="overwrite", properties=properties
    )
