"""Monthly revenue of paid services, with discounts and the clinic's rounding rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse.functions import periods, scalars
from clinicpulse.functions.periods import Months
from clinicpulse.operators.staging import stage
from clinicpulse.params import RevenueParams

MONEY = "decimal(18,4)"
# Percents are summed as they are; only the charge is rounded.
PERCENT = "decimal(14,8)"
COUNT = "decimal(18,0)"
# Rounding modes of the clinic setting; any other value rounds to cents.
CEIL, TRUNC, INT, CENTS = "1", "2", "3", "cents"


def services(t: Mapping[str, DataFrame], months: Months, params: RevenueParams) -> DataFrame:
    """Paid services in range, one row per service line and prescription.

    ``copies`` is how often the joins yield the line (1 unless a dimension repeats a key).
    """
    creators = t["sotr"].filter(F.col("sysuser") == params.sysuser).join(
        t["sysuser"].select(F.col("oid").alias("sysuser")), "sysuser", "left_semi"
    )
    visits = (
        t["presc"]
        .filter(F.col("presc_state_id").isin(list(params.states)) & months.of("upd_dt"))
        .join(creators.select(F.col("oid").alias("creator_id")), "creator_id", "left_semi")
        .select(F.col("id").alias("presc_id"), "mdoc_id", periods.month_of("upd_dt").alias("month"))
    )
    owned = visits.join(
        t["mdoc"].select(F.col("id").alias("mdoc_id"), F.col("people_id").alias("people_oid")), "mdoc_id"
    ).join(t["people"].select(F.col("oid").alias("people_oid")), "people_oid")
    paid = (
        t["services"]
        .filter(~F.col("pay_type").isin(list(params.skip_pay_types)))
        .select(F.col("oid").alias("service"))
    )
    kinds = t["service_presctype"].select(F.col("oid").alias("service_presctype"), "service").join(paid, "service")
    lines = t["presc_service"].select(
        F.col("oid").alias("line"), F.col("presc").alias("presc_id"), "service_presctype"
    )
    return (
        lines.join(owned, "presc_id")
        .join(kinds, "service_presctype")
        .groupBy("line", "presc_id")
        .agg(F.max("month").alias("month"), F.count(F.lit(1)).alias("copies"))
    )


def planned(t: Mapping[str, DataFrame], lines: DataFrame, params: RevenueParams) -> DataFrame:
    """Those of the lines that are under a fixed finance plan in force on the run date."""
    plans = (
        t["finance_plan"]
        .filter(F.col("fixed") & F.lit(params.as_of).between(F.col("date_begin"), F.col("date_end")))
        .select(F.col("oid").alias("finance_plan"), scalars.padded(F.col("visit")).alias("visit"))
    )
    cash = (
        t["visit"]
        .filter(F.col("pay_type_id") == params.plan_pay_type)
        .select(scalars.padded(F.col("id")).alias("visit"))
    )
    valid = plans.join(cash, "visit", "left_semi")
    return (
        t["finance_plan_presc_service"]
        .select("finance_plan", F.col("presc_service").alias("line"))
        .join(lines, "line", "left_semi")
        .join(valid, "finance_plan", "left_semi")
        .select("line")
        .distinct()
    )


def discounts(t: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    """Percent (own, else the discount's) and fixed amount of each of the lines; each may be NULL."""
    card = t["discount"].select(F.col("oid").alias("discount"), F.col("percent").alias("card_percent"))
    return (
        t["discount_presc"]
        .withColumnRenamed("presc_service", "line")
        .join(lines, "line", "left_semi")
        .join(card, "discount", "left")
        .groupBy("line")
        .agg(
            F.sum(F.coalesce("percent", "card_percent").cast(PERCENT)).cast(PERCENT).alias("percent"),
            F.sum(F.col("fix_sum").cast(MONEY)).cast(MONEY).alias("fix_sum"),
        )
    )


def prices(t: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    """The price of each of the lines under its own prescription. A second one fails the run: it would count the
    line twice."""
    one = F.when(F.count(F.lit(1)) == 1, F.max("price")).otherwise(
        F.raise_error(F.concat(F.lit("more than one price for line "), F.first("line"))).cast(MONEY)
    )
    return (
        t["price"]
        .select("presc_id", F.col("presc_service_oid").alias("line"), F.col("base_price").cast(MONEY).alias("price"))
        .join(lines, "line", "left_semi")
        .groupBy("line", "presc_id")
        .agg(one.alias("price"))
    )


def rounded(amount: Column, mode: str) -> Column:
    if mode == CEIL:
        value = F.ceil(amount)
    elif mode == TRUNC:
        value = F.when(amount < 0, F.ceil(amount)).otherwise(F.floor(amount))
    else:
        value = F.round(amount, 0 if mode == INT else 2)
    return value.cast(MONEY)


def charged(mode: str) -> Column:
    """Price after discounts. Without a percent there is no discount at all, not even the fixed amount."""
    off = F.col("price") * F.col("percent") * F.lit("0.01").cast("decimal(3,2)")
    left = F.col("price") - off - F.coalesce("fix_sum", F.lit(0).cast(MONEY))
    return F.when(F.col("percent").isNotNull(), rounded(left, mode)).otherwise(F.col("price"))


def by_mode(t: Mapping[str, DataFrame], months: Months, params: RevenueParams) -> DataFrame:
    """Monthly revenue under each rounding mode, in one pass.

    The lines in range are written once; plans, discounts and prices are cut to them before they are folded.
    """
    found = stage(services(t, months, params), "services")
    # Every line has a copy: the filter marks this side as one that a Bloom filter may be made of.
    lines = found.filter("copies > 0").select("line")
    under_plan = planned(t, lines, params).withColumn("in_plan", F.lit(True))
    off = F.col("in_plan").isNull()
    priced = (
        found.join(under_plan, "line", "left")
        .join(discounts(t, lines), "line", "left")
        .join(prices(t, lines), ["line", "presc_id"], "left")
        .withColumn("percent", F.when(off, F.col("percent")))
        .withColumn("fix_sum", F.when(off, F.col("fix_sum")))
    )
    # A line the joins yield n times meets its n discount rows n times.
    weight = (F.col("copies") * F.col("copies")).cast(COUNT)
    return priced.groupBy("month").agg(
        *[F.sum(charged(m) * weight).cast("decimal(28,4)").alias(f"m_{m}") for m in (CEIL, TRUNC, INT, CENTS)]
    )


def monthly(t: Mapping[str, DataFrame], months: Months, params: RevenueParams) -> DataFrame:
    """Revenue per month in range, 0 for a month without any.

    The setting is counted by value instead of cross-joined to every line: no setting row gives no
    revenue, and each further row counts the month again, as the cross join would.
    """
    mode = F.col("valuepar")
    other = mode.isNull() | ~mode.isin(CEIL, TRUNC, INT)
    rows = {m: F.count_if(mode == m) for m in (CEIL, TRUNC, INT)} | {CENTS: F.count_if(other)}
    setting = (
        t["systemsettings"]
        .filter(F.col("param") == params.rounding_setting)
        .select(F.struct(*[n.cast(COUNT).alias(m) for m, n in rows.items()]).alias("rows"))
    )
    sums = by_mode(t, months, params).withColumn("rows", setting.scalar())
    revenue = sum((F.col(f"m_{m}") * F.col(f"rows.{m}") for m in rows), F.lit(0).cast("decimal(1,0)"))
    return months.fill(sums.select("month", revenue.cast("decimal(18,4)").alias("revenue")), "revenue")
