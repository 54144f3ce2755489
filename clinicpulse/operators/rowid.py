"""A reload-safe row id for exports that carry no key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse.operators.staging import stage

_FIELD_SEPARATOR = "\u001f"
_NULL_MARK = "\u0000"
COPIES_PER_BLOCK = 10_000


def _as_uuid(digest: Column) -> Column:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def with_row_id(df: DataFrame, name: str, block: int = COPIES_PER_BLOCK) -> DataFrame:
    """Add a uuid-shaped id made of the row's content and its number among identical rows.

    Identical rows get distinct ids, and the same rows always yield the same ids. A frame that is loaded in
    batches must say where a row came from (its export day and file), so that copies are numbered within one
    file and never within a batch. Copies are folded into a count before the shuffle, so no window ever holds a group of copies; a
    count above ``block`` is first cut into blocks that are spread over the cluster, then unfolded.
    """
    columns = df.columns
    # A fixed number of partitions: block rows are tiny before they unfold, and would be coalesced otherwise.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written, so that the few and the many copies are read from one fold and ``df`` is computed once.
    folded = stage(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")), "folded")
    few = folded.filter(F.col("_copies") <= block).select(
        *columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_nth")
    )
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / block))
    first, last = F.col("_block") * block + 1, F.least((F.col("_block") + 1) * block, F.col("_copies"))
    many = (
        folded.filter(F.col("_copies") > block)
        .select(*columns, "_copies", F.explode(blocks).alias("_block"))
        .repartition(parts, *columns, "_block")
        .select(*columns, F.explode(F.sequence(first, last)).alias("_nth"))
    )
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(_NULL_MARK)) for c in columns]
    digest = F.sha2(F.concat_ws(_FIELD_SEPARATOR, *fields, F.col("_nth").cast("string")), 256)
    return few.unionByName(many).select(_as_uuid(digest).alias(name), *columns)
