"""Keyed inserts and upserts over frames; both sides hold one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clinicpulse.operators.staging import stage

_FIXED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)

# What happens to a column of a row that exists on both sides; columns not named keep the stored value.
NEW = "new"
NEW_IF_SET = "new if set"
GREATEST = "greatest"


def _same(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])


def _renamed(df: DataFrame, key: Sequence[str], *more: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{k}") for k in key], *more)


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first in ``order_by``, and of equally first ones that of the lowest digest.

    ``df`` is computed once and staged. Then only keys are shuffled, to find those that come more than once: rows of
    the others pass as they are, and just the repeated ones are settled. Nulls come first, equal rows are one.
    """
    columns = df.columns
    rows = stage(df.withColumn("_digest", F.xxhash64(*columns)), "keyed")
    for column in order_by:
        if not isinstance(rows.schema[column].dataType, _FIXED):
            raise TypeError(f"{column} cannot be ordered by hash aggregates")
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = stage(_renamed(counted, key), "repeated-keys")
    if repeated.isEmpty():
        return rows.select(*columns)
    single = rows.join(repeated, _same(key), "left_anti")
    several = rows.join(repeated, _same(key), "left_semi")
    return single.unionByName(_settled(several, key, order_by)).select(*columns)


def _settled(rows: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key. Every step aggregates numbers by hash, so no group is sorted and no text is kept in an
    aggregate: the winner is found by number and met again by key."""
    rows = rows.distinct()
    for column in (*order_by, "_digest"):
        first = F.when(F.count(F.lit(1)) == F.count(column), F.min(column)).alias("_first")
        best = _renamed(rows.groupBy(*key).agg(first), key, "_first")
        rows = rows.join(best, _same(key) & F.col(column).eqNullSafe(F.col("_first")), "left_semi")
    return rows


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """The rows to append: one per new key, the first in ``order_by``; None if keys are distinct already.

    Pass ``existing`` already cut to the days being loaded. With ``order_by`` the incoming rows are staged.
    """
    fresh = incoming if order_by is None else first_per_key(incoming, key, order_by)
    return fresh.join(existing.select(*key), list(key), "left_anti").select(*incoming.columns)


def merge(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    rules: Mapping[str, str],
    stamp: Column | None = None,
    stamp_column: str = "updated_at",
) -> DataFrame:
    """Merge by key, column by column. Keys match NULL to NULL, so that a repeated load changes nothing.

    ``stamp`` marks updated rows only: rows just inserted and rows left alone keep theirs.
    """
    old = existing.select(F.struct(*existing.columns).alias("old"), F.lit(True).alias("in_old"))
    new = incoming.select(F.struct(*incoming.columns).alias("new"), F.lit(True).alias("in_new"))
    same_key = reduce(
        lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in key]
    )
    both = F.col("in_old").isNotNull() & F.col("in_new").isNotNull()

    def resolved(column: str) -> Column:
        stored = F.col(f"old.{column}")
        if column == stamp_column and stamp is not None:
            value = F.when(both, stamp).otherwise(stored)
        elif column not in incoming.columns:
            value = stored
        else:
            fresh = F.col(f"new.{column}")
            on_match = {
                NEW: fresh,
                NEW_IF_SET: F.coalesce(fresh, stored),
                GREATEST: F.greatest(stored, fresh),
            }.get(rules.get(column, ""), stored)
            value = F.when(both, on_match).when(F.col("in_old").isNotNull(), stored).otherwise(fresh)
        return value.alias(column)

    return old.join(new, same_key, "full_outer").select(*[resolved(c) for c in existing.columns])
