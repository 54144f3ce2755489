"""Joining a fact side that may have hot keys with a side that has one row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot when it holds at least this share of the rows, so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 0.01
_TRACKED = 1024
_REDUCERS = 128


def _digest(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(df: DataFrame, *key_sets: Sequence[str], share: float = HOT_SHARE) -> list[list[int]]:
    """For each set of join keys, digests of the keys holding at least ``share`` of the rows.

    One pass over the key columns with mergeable heavy-hitter sketches, merged in parallel groups so that no
    task sees all of them; each answer is bounded by ``1 / share``. It only steers salting: a key missed or
    listed in excess costs balance, never correctness.
    """
    top = int(1 / share)
    sketches = [
        F.expr(f"approx_top_k(key{i}, {top}, {_TRACKED})").alias(f"top{i}") for i in range(len(key_sets))
    ]
    part = (
        df.select(
            *[_digest(keys).alias(f"key{i}") for i, keys in enumerate(key_sets)],
            F.pmod(F.spark_partition_id(), F.lit(_REDUCERS)).alias("part"),
        )
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"), *sketches)
    )
    # At most _REDUCERS * top entries per set.
    tops = [F.flatten(F.collect_list(f"top{i}")).alias(f"top{i}") for i in range(len(key_sets))]
    hits = (
        part.agg(F.sum("n").alias("total"), F.array(*tops).alias("tops"))
        .select("total", F.posexplode("tops").alias("set", "top"))
        .select("total", "set", F.inline("top").alias("key", "n"))
        .groupBy("set", "key")
        .agg(F.sum("n").alias("n"), F.max("total").alias("total"))
        .filter(F.col("n") >= F.col("total") * share)
    )
    found: list[list[int]] = [[] for _ in key_sets]
    for row in hits.select("set", "key").collect():
        found[row["set"]].append(row["key"])
    return found


def join_to_unique(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    collapse: Callable[[DataFrame], DataFrame] | None = None,
    hot: Sequence[int] | None = None,
    salts: int = 64,
) -> DataFrame:
    """Inner or left join where ``right`` has at most one row per key, so the output never fans out.

    Adaptive execution splits a hot partition only between two plain exchanges, not where one side is an
    aggregate. So hot keys are looked up first, unless given. None: a plain join that reuses the aggregate's
    partitioning. Some: ``collapse`` folds copies on the left, and just the hot keys are salted by
    ``spread_by`` on the left and repeated ``salts`` times on the right.
    """
    on = list(on)
    for key in on:
        # Digests of equal keys are equal only if their types are.
        if left.schema[key].dataType != right.schema[key].dataType:
            raise TypeError(f"join key {key} has different types on the two sides")
    hot = hot_keys(left, on)[0] if hot is None else list(hot)
    if not hot:
        return left.join(right, on, how)
    if collapse is not None:
        left = collapse(left)
    is_hot = _digest(on).isin(hot)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(salts)).cast("int")
    everywhere = F.sequence(F.lit(0), F.lit(salts - 1))
    salted = left.withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0)))
    repeated = right.withColumn(
        "_salt", F.explode(F.when(is_hot, everywhere).otherwise(F.array(F.lit(0))))
    )
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
