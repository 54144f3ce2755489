"""Registering queries, and giving results a form two engines agree on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clinicpulse.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Days and times as text, decimals as doubles, arrays as joined text, whole numbers as bigint."""

    def plain(field: T.StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a function of (spark, test folder) under ``name`` with the SQL that must agree with it."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(configure(spark), sf_dir))

        QUERIES[name] = run
        CHECKS[name] = sql
        return build

    return register


def day(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {name or column}"


def time(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name or column}"


def number(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) AS {name or column}"
