"""Distinct users that can be merged over days: exact bitmaps of numbered users, and sketches.

A day's users are counted once, when its presence is written; months and years are then put together from days, without
reading presence again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clinicpulse import params as P
from clinicpulse.functions import periods
from clinicpulse.functions.periods import Months
from clinicpulse.operators import staging
from clinicpulse.plans import mau
from clinicpulse.sources.state import StateTable

BUCKETS = 64
# Numbers of one bucket lie together, so that bitmaps are dense: bucket b has b * _SPAN, b * _SPAN + 1, ...
_SPAN = 1 << 40
# 2^14 registers: a standard error of 0.8 %.
SKETCH_K = 14


def person(product: str) -> Column:
    return mau.booking_person() if product == P.PRODUCT_BOOKING else mau.account_person()


def daily_people(presence: DataFrame) -> DataFrame:
    """(product, activity_date, person), once each; presence without a known person is left out."""
    chosen = F.when(F.col("product") == P.PRODUCT_BOOKING, person(P.PRODUCT_BOOKING)).otherwise(person(P.PRODUCT_ACCOUNT))
    people = presence.select("product", "activity_date", chosen.alias("person"))
    return people.filter("person IS NOT NULL").distinct()


class UserNumbers:
    """A number for every person ever counted; it never changes."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = StateTable(spark, path, "person string, number bigint, bucket int", ["bucket"])

    @staticmethod
    def _bucket() -> Column:
        return F.pmod(F.xxhash64("person"), F.lit(BUCKETS)).cast("int")

    def add(self, people: DataFrame) -> None:
        """Number the persons not known yet, per bucket from where it stands. ``people`` has one row per person."""
        known = self.table.read()
        fresh = people.select("person", self._bucket().alias("bucket")).join(known.select("person", "bucket"), ["person", "bucket"], "left_anti")
        # A row per bucket.
        last = known.groupBy("bucket").agg((F.max("number") + 1).alias("next"))
        nth = F.row_number().over(Window.partitionBy("bucket").orderBy("person")) - 1
        first = F.coalesce("next", F.col("bucket").cast("bigint") * _SPAN)
        numbered = fresh.join(last, "bucket", "left").withColumn("number", first + nth)
        self.table.append(staging.stage(numbered.select("person", "number", "bucket"), "numbers"))

    def of(self, people: DataFrame) -> DataFrame:
        return people.join(self.table.read().select("person", "number"), "person")


# Rows are by day; partitions by month, so that years of days are not as many small files.
BITS = "block bigint, bits binary, activity_date date, product string, month date"
SKETCHES = "sketch binary, activity_date date, product string, month date"
PARTITIONS = ["product", "month"]


def day_bits(numbered: DataFrame) -> DataFrame:
    """(product, activity_date, number) to bitmaps of 32,768 users each; blocks without a user have no row."""
    return numbered.groupBy("product", "activity_date", F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def day_sketches(people: DataFrame) -> DataFrame:
    return people.groupBy("product", "activity_date").agg(F.hll_sketch_agg("person", F.lit(SKETCH_K)).alias("sketch"))


def _exact(days: DataFrame, period: Column, name: str) -> DataFrame:
    merged = days.groupBy(period.alias(name), "block").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("users"))
    return merged.groupBy(name).agg(F.sum("users").alias("count"))


def monthly(bits: DataFrame, months: Months, product: str) -> DataFrame:
    """Exact distinct users per month, 0 where there are none."""
    days = bits.filter((F.col("product") == product) & months.of("month"))
    return months.fill(_exact(days, F.col("month"), "month"), "count")


def monthly_estimate(sketches: DataFrame, months: Months, product: str) -> DataFrame:
    """Distinct users per month from the days' sketches, within a few percent."""
    days = sketches.filter((F.col("product") == product) & months.of("month"))
    merged = days.groupBy("month").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("count")
    )
    return months.fill(merged, "count")


def year_to_date(bits: DataFrame, as_of: date, first_year: int = periods.FIRST_YEAR) -> DataFrame:
    """What ``mau.year_to_date`` counts, from the days' bitmaps."""
    reached = (F.month("month") <= as_of.month) & F.col("month").between(F.lit(date(first_year, 1, 1)), F.lit(as_of))
    days = mau.up_to_day(bits.filter(reached), as_of, first_year)
    return mau.yearly(_exact(days, F.year("activity_date"), "year").withColumnRenamed("count", "value"), as_of, first_year)


def renew(numbers: UserNumbers, bits: StateTable, sketches: StateTable, presence: DataFrame) -> None:
    """Count the days of ``presence`` anew: their bitmaps and sketches replace those that are there.

    Persons are numbered before bitmaps speak of them, so a failed run leaves at most numbers nobody uses yet. Presence
    only grows, so a day that has bitmaps keeps some.
    """
    with staging.scope(presence.sparkSession):
        people = staging.stage(daily_people(presence), "people")
        numbers.add(people.select("person").distinct())
        days = staging.stage(people.select("product", "activity_date").distinct(), "days")
        _replace_days(bits, day_bits(numbers.of(people)), days)
        _replace_days(sketches, day_sketches(people), days)


def _replace_days(table: StateTable, fresh: DataFrame, days: DataFrame) -> None:
    """The days' rows become ``fresh``; other days of their months are written again as they are."""
    month = periods.month_of("activity_date")
    touched = [r["month"] for r in days.select(month.alias("month")).distinct().collect()]
    stored = table.read().filter(F.col("month").isin(touched)).join(days, ["product", "activity_date"], "left_anti")
    table.replace_partitions(stored.unionByName(fresh.withColumn("month", month)))
