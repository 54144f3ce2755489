"""Month arithmetic and the ranges a run re-computes."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Where the first run of each monthly figure starts.
FIRST_MONTH = date(2025, 1, 1)
FIRST_MONTH_ACCOUNT_MAU = date(2026, 1, 1)
FIRST_YEAR = 2025
FIRST_LOAD_DAYS = 7


def first_of_month(day: date) -> date:
    return day.replace(day=1)


def shift_month(day: date, months: int) -> date:
    """First day of the month ``months`` away."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class Months:
    """Whole months, ``start`` (first of month) up to but not including ``end``."""

    start: date
    end: date

    def of(self, time: Column | str) -> Column:
        """Bare half-open range on a date or time column, so that it reaches the scan."""
        time = F.col(time) if isinstance(time, str) else time
        return (time >= F.lit(self.start)) & (time < F.lit(self.end))

    def spine(self, spark: SparkSession) -> DataFrame:
        """One row per month; none for an empty range."""
        count = (self.end.year - self.start.year) * 12 + self.end.month - self.start.month
        return spark.range(max(count, 0)).select(
            F.add_months(F.lit(self.start), F.col("id").cast("int")).alias("month")
        )

    def fill(self, monthly: DataFrame, column: str) -> DataFrame:
        """``monthly`` with a row for every month in range, 0 where it has none or NULL."""
        zero = F.lit(0).cast(monthly.schema[column].dataType)
        spine = self.spine(monthly.sparkSession)
        return spine.join(monthly, "month", "left").withColumn(column, F.coalesce(column, zero))


def trailing_months(last: date | None, as_of: date, first: date = FIRST_MONTH, floor: bool = True) -> Months:
    """From one month before the last stored one, never before ``first`` if ``floor``, to the current month."""
    start = first if last is None else shift_month(last, -1)
    if floor:
        start = max(start, first)
    return Months(start, shift_month(as_of, 1))


def last_value(df: DataFrame, column: str) -> date | None:
    """The newest day stored in ``column``; a single value."""
    return df.agg(F.max(F.to_date(column)).alias("last")).first()["last"]


def next_slice(last: date | None, as_of: date) -> tuple[date, date] | None:
    """Days still to load, both ends included; None when yesterday is already there."""
    yesterday = as_of - timedelta(days=1)
    if last is None:
        return yesterday - timedelta(days=FIRST_LOAD_DAYS), yesterday
    return None if last >= yesterday else (last + timedelta(days=1), yesterday)


def within_days(time: Column | str, start: date, end: date) -> Column:
    """Both days included, as a bare range on the time column."""
    time = F.col(time) if isinstance(time, str) else time
    return (time >= F.lit(start)) & (time < F.lit(end + timedelta(days=1)))


def month_of(time: Column | str) -> Column:
    return F.trunc(time, "MM")
