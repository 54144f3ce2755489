"""Appointments by channel: counted for the call centre, loaded row by row for online booking."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date

from pyspark.sql import DataFrame, functions as F

from clinicpulse import params as P
from clinicpulse.functions import periods, scalars
from clinicpulse.functions.periods import Months
from clinicpulse.operators import upsert
from clinicpulse.operators.staging import stage
from clinicpulse.params import AppointmentParams


# Above any time in microseconds.
_NO_TIME = 2**63 - 1


def _slots(t: Mapping[str, DataFrame], months: Months, creators: DataFrame, slot_filter, hours_filter) -> DataFrame:
    """Booked slots with their prescription, type and working hours; prescriptions by ``creators`` in range."""
    prescriptions = (
        t["presc"]
        .filter(months.of("create_dt"))
        .join(creators.select(F.col("oid").alias("creator_id")), "creator_id", "left_semi")
        .select(F.col("id").alias("presc_id"), "create_dt", F.col("presctype_id").alias("prescribed_type"))
    )
    bookings = t["presc_schedule"].filter(F.col("presc_id").isNotNull()).select(
        F.col("shedule_id").alias("slot"), "presc_id", F.col("presctype").alias("type")
    )
    slots = t["schedule"].filter(slot_filter).select(F.col("oid").alias("slot"), F.col("work_time").alias("hours"))
    types = t["presctype"].select(F.col("oid").alias("type"), "time_cells", "tags")
    hours = t["schedule_work_time"].filter(hours_filter).select(
        F.col("oid").alias("hours"), F.col("presctype").alias("offered")
    )
    return (
        prescriptions.join(bookings, "presc_id")
        .join(slots, "slot")
        .join(types, "type")
        .join(hours, "hours")
    )


def call_center(t: Mapping[str, DataFrame], months: Months, params: AppointmentParams) -> DataFrame:
    """Appointments the call centre made in open slots of site-visible hours, per month."""
    posts = t["post"].filter(F.col("oid").isin(list(params.call_center_posts)))
    staff = t["sotr"].join(posts.select(F.col("oid").alias("post")), "post", "left_semi")
    booked = _slots(t, months, staff, F.col("islocked") == 0, F.col("insite") == 1).filter(
        scalars.csv_has(F.col("offered"), F.col("prescribed_type"))
        & F.col("time_cells").isNotNull()
        & F.arrays_overlap("tags", F.array(*[F.lit(tag) for tag in params.tags]))
    )
    counted = booked.groupBy(periods.month_of("create_dt").alias("month")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return months.fill(counted, "count").select("month", F.lit(P.CHANNEL_CALL_CENTER).alias("source"), "count")


def online(t: Mapping[str, DataFrame], months: Months, params: AppointmentParams) -> DataFrame:
    """Appointments written under the online booking user; a prescription may hold several slots."""
    users = t["sysuser"].filter(F.col("oid") == params.sysuser).select(F.col("oid").alias("sysuser"))
    staff = t["sotr"].join(users, "sysuser", "left_semi")
    return _slots(t, months, staff, F.lit(True), F.lit(True)).select(
        "create_dt", F.col("presc_id").alias("appointment_id")
    )


def new_online(stored: DataFrame, found: DataFrame) -> DataFrame:
    """The appointments not loaded yet, one row each."""
    return upsert.insert_if_absent(stored, found, ["appointment_id"], ["create_dt"])


def latest_source(log: DataFrame, after: date) -> DataFrame:
    """The channel last written for each appointment; days after ``after`` only.

    A missing update time counts as newest. Equal times are settled by the channel name.
    """
    # One row per appointment and channel first, with the time as a number, newest if missing. Each step is written, so
    # that a task holds one aggregate and one table of ids at a time.
    newest = F.when(F.count("updated_at") == F.count(F.lit(1)), F.unix_micros(F.max("updated_at").cast("timestamp")))
    per_channel = stage(
        log.filter(F.col("created_at") >= F.date_add(F.lit(after), 1))
        .groupBy(F.col("appointment_oid").alias("appointment_id"), "source")
        .agg(F.coalesce(newest, F.lit(_NO_TIME)).alias("at")),
        "channel-times",
    )
    last = per_channel.groupBy("appointment_id").agg(F.max("at").alias("at"))
    tied = stage(per_channel.join(last.hint("shuffle_hash"), ["appointment_id", "at"]), "channels-tied")
    other = tied.select(F.col("appointment_id").alias("same"), F.col("source").alias("other"))
    higher = (F.col("source") < F.col("other")) | (F.col("source").isNull() & F.col("other").isNotNull())
    return tied.join(
        other.hint("shuffle_hash"), (F.col("appointment_id") == F.col("same")) & higher, "left_anti"
    ).select("appointment_id", "source")


def with_channel(appointments: DataFrame, sources: DataFrame) -> DataFrame:
    """Online appointments with their channel; one the log has nothing about has none and is in no count."""
    return appointments.join(sources, "appointment_id", "left")


def by_channel(appointments: DataFrame) -> DataFrame:
    """Online appointments per month and channel."""
    return (
        appointments.filter(F.col("source").isNotNull())
        .groupBy(periods.month_of("create_dt").alias("month"), "source")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def with_zeros(counted: DataFrame, months: Collection[date], source: str) -> DataFrame:
    """Counts of one channel with a row for each of the months, 0 where it has none."""
    spine = counted.sparkSession.createDataFrame([(m, source) for m in sorted(months)], "month date, source string")
    return spine.join(counted, ["month", "source"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def online_ratio(rates: DataFrame) -> DataFrame:
    """Share of online booking in online booking plus call centre, per month; 0 when there is neither."""
    online_count = F.coalesce(F.sum(F.when(F.col("source") == P.CHANNEL_ONLINE, F.col("count"))), F.lit(0))
    total = F.sum("count")
    ratio = F.when(total > 0, scalars.quotient(online_count, total)).otherwise(F.lit(0))
    return (
        rates.filter(F.col("source").isin(P.CHANNEL_ONLINE, P.CHANNEL_CALL_CENTER))
        .groupBy("month")
        .agg(F.round(ratio, 4).cast("decimal(9,4)").alias("ratio_online_to_total"))
    )
