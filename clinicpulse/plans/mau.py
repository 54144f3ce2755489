"""Monthly and year-to-date active users."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse import params as P
from clinicpulse.functions import periods
from clinicpulse.functions.periods import Months


def booking_person() -> Column:
    """Internal id, or source and external id. NULL (not counted) when neither is known."""
    anonymous = F.concat(F.col("source"), F.lit(":"), F.col("external_user_id"))
    return F.coalesce(F.col("internal_user_id").cast("string"), anonymous)


def _per_month(active: DataFrame, person: Column, months: Months) -> DataFrame:
    counted = active.groupBy(periods.month_of("activity_date").alias("month")).agg(
        F.count_distinct(person).alias("count")
    )
    return months.fill(counted, "count")


def booking(presence: DataFrame, months: Months) -> DataFrame:
    active = presence.filter((F.col("product") == P.PRODUCT_BOOKING) & months.of("activity_date"))
    return _per_month(active, booking_person(), months)


def account_person() -> Column:
    """App users by internal or device id, site users by internal id only."""
    internal = F.col("internal_user_id").cast("string")
    return F.when(
        F.col("platform") == P.PLATFORM_MOBILE, F.coalesce(internal, F.col("external_user_id"))
    ).when(F.col("platform") == P.PLATFORM_WEB, internal)


def account(presence: DataFrame, months: Months) -> DataFrame:
    """App users and site users, counted as one set."""
    active = presence.filter((F.col("product") == P.PRODUCT_ACCOUNT) & months.of("activity_date"))
    return _per_month(active, account_person(), months)


def up_to_day(days: DataFrame, as_of: date, first_year: int) -> DataFrame:
    """Days of the booking product from 1 January to the month and day of ``as_of``, of each year."""
    day = F.col("activity_date")
    reached = (F.month(day) < as_of.month) | ((F.month(day) == as_of.month) & (F.dayofmonth(day) <= as_of.day))
    return days.filter(
        (F.col("product") == P.PRODUCT_BOOKING) & day.between(F.lit(date(first_year, 1, 1)), F.lit(as_of)) & reached
    )


def yearly(counted: DataFrame, as_of: date, first_year: int) -> DataFrame:
    """A row for each year, 0 where ``counted`` has none."""
    years = counted.sparkSession.range(first_year, as_of.year + 1).select(F.col("id").cast("int").alias("year"))
    return years.join(counted, "year", "left").select(
        "year", F.lit(P.KPI_USERS).alias("kpi"), F.coalesce("value", F.lit(0)).alias("value")
    )


def year_to_date(presence: DataFrame, as_of: date, first_year: int = periods.FIRST_YEAR) -> DataFrame:
    """Each year's users from 1 January to the month and day of ``as_of``, in one pass over all years."""
    active = up_to_day(presence, as_of, first_year)
    counted = active.groupBy(F.year("activity_date").alias("year")).agg(F.count_distinct(booking_person()).alias("value"))
    return yearly(counted, as_of, first_year)
