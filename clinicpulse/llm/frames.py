"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Bounded batches: a batch of long texts must fit a Python worker beside the executor's heap.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    for key, value in ARROW.items():
        spark.conf.set(key, value)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def by_id(docs: DataFrame, ids: DataFrame, on: str | list[str], how: str) -> DataFrame:
    """A semi or anti join of documents with a list of ids that grows with them.

    Both sides are dealt by id at every size, and a task holds the ids of its part only; texts are not sorted.
    """
    return docs.join(ids.hint("shuffle_hash"), on, how)
