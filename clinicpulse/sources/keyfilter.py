"""Which keys a stored table may hold, by partition, without opening its files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinicpulse.sources.state import StateTable

# A filter is cut into blocks of as many bits as one bitmap holds; a key sets its bits in one block.
BLOCK_BITS = 32768
BITS_PER_KEY = 12
PROBES = 4
DAY = "filter_day"


class KeyFilter:
    """Bloom filters of the keys of a table's partitions, kept beside it as rows of (day, blocks, block, bits).

    Every batch adds filters of its own size for the days it has keys of, before its rows are stored: a filter may then
    name keys that never came, but it never lacks one that did. A key is looked up in all filters of its day. About two
    keys in a hundred that are not stored seem to be.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str]):
        self.key = list(key)
        self.table = StateTable(spark, path, f"blocks int, block int, bits binary, {DAY} string", [DAY])

    def _hashed(self, rows: DataFrame, day: str) -> DataFrame:
        return rows.select(
            F.coalesce(F.col(day).cast("string"), F.lit("none")).alias(DAY),
            F.xxhash64(*self.key).alias("_place"),
            F.xxhash64(F.lit(1), *self.key).alias("_bits"),
            *self.key,
        )

    @staticmethod
    def _probes() -> list[Column]:
        return [F.shiftright("_bits", 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)]

    @staticmethod
    def _block() -> Column:
        return F.pmod(F.col("_place"), F.col("blocks").cast("bigint")).cast("int")

    def add(self, rows: DataFrame, day: str) -> None:
        """Note the keys of ``rows`` under the days in column ``day``; a null day is a day of its own."""
        hashed = self._hashed(rows, day)
        wanted = F.count(F.lit(1)) * BITS_PER_KEY / BLOCK_BITS
        sizes = hashed.groupBy(DAY).agg(F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), wanted)))).cast("int").alias("blocks"))
        bits = hashed.join(sizes, DAY).select(DAY, "blocks", self._block().alias("block"), F.explode(F.array(*self._probes())).alias("bit"))
        self.table.append(bits.groupBy(DAY, "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits")))

    def is_empty(self) -> bool:
        return self.table.read().isEmpty()

    def may_hold(self, rows: DataFrame, day: str) -> DataFrame:
        """The distinct keys of ``rows``, with their day as text, that the table may hold on that day."""
        hashed = self._hashed(rows, day)
        filters = self.table.read()
        sizes = filters.select(DAY, "blocks").distinct()
        placed = hashed.join(sizes, DAY).withColumn("block", self._block())
        set_bits = reduce(lambda a, b: a & b, [_is_set("bits", p) for p in self._probes()])
        return placed.join(filters, [DAY, "blocks", "block"]).filter(set_bits).select(DAY, *self.key).distinct()


def _is_set(bits: str, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), position % 8)) % 2 == 1
