"""Change of a monthly figure against the year before, January to the last stored month."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse import params as P
from clinicpulse.functions import scalars


def diff(
    monthly: DataFrame,
    value: str,
    kpi: str,
    combine: Callable[[Column], Column],
    last_month: date | None = None,
) -> DataFrame:
    """One row (year, kpi, value), or none if nothing is stored yet.

    ``last_month`` is the right edge, by default the newest stored month, even if that is still open. Both
    sides come from one pass; a side without months counts as 0.
    """
    last = F.lit(last_month) if last_month else monthly.select(F.max("month")).scalar()
    month, amount = F.col("month"), F.col(value)
    before = F.make_date(F.year("last") - 1, F.month("last"), F.lit(1))
    now_side = month.between(F.trunc("last", "YEAR"), F.col("last"))
    old_side = month.between(F.make_date(F.year("last") - 1, F.lit(1), F.lit(1)), before)

    def of(side: Column) -> Column:
        return F.coalesce(combine(F.when(side, amount)), F.lit(0))

    return (
        monthly.withColumn("last", last)
        .groupBy(F.year("last").alias("year"))
        .agg((of(now_side) - of(old_side)).cast("decimal(18,4)").alias("value"))
        .select("year", F.lit(kpi).alias("kpi"), "value")
    )


def _mean(column: Column) -> Column:
    months = F.count(column)
    return F.when(months > 0, scalars.quotient(F.sum(column), months))


def revenue(revenue_kpi: DataFrame, last_month: date | None = None) -> DataFrame:
    return diff(revenue_kpi, "revenue", P.KPI_REVENUE, F.sum, last_month)


def ratio(ratio_kpi: DataFrame, last_month: date | None = None) -> DataFrame:
    return diff(ratio_kpi, "ratio_online_to_total", P.KPI_RATIO, _mean, last_month)
