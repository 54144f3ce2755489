"""Whole runs against a warehouse: loads cut into batches, and a step that fails in between."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinicpulse import bindings as B
from clinicpulse import params as P
from clinicpulse.functions import periods, scalars
from clinicpulse.operators import staging
from clinicpulse.plans import daily, identity, upkeep
from clinicpulse.registry.analytics import ACCOUNT_ID, DEVICE, ID_COLUMNS, raw_mobile, raw_web, whole_month
from clinicpulse.registry.base import day, query, time
from clinicpulse.sources import ingest, landing, specs


def _warehouse(spark: SparkSession) -> daily.Warehouse:
    return daily.Warehouse(spark, staging.new_folder(spark, "warehouse"))


@query(
    "ingest_in_batches",
    f"""
    SELECT CASE WHEN event_id % 11 <> 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') END AS event_datetime,
           event_type AS event_name, {DEVICE} AS appmetrica_device_id, count(*) AS rows
    FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 5 = 0)
    GROUP BY 1, 2, 3""",
)
def ingest_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, some repeated and some without a readable time, in three batches, the second of them twice."""
    spec, path, w = specs.mobile(), staging.new_folder(spark, "landing"), _warehouse(spark)
    once = raw_mobile(spark, sf_dir, also=["event_id"])
    raw = once.unionByName(once.filter("event_id % 5 = 0")).withColumn(landing.DAY, F.to_date("event_datetime"))
    bad = F.when(F.col("event_id") % 11 == 0, F.lit("no time")).otherwise(F.col("event_datetime"))
    landing.write(raw.withColumn("event_datetime", bad).drop("event_id"), path, spec)
    for first, last in ((1, 10), (11, 20), (11, 20), (21, 31)):
        daily.append_export(w, spec, landing.read(spark, path, spec, date(2024, 1, first), date(2024, 1, last)))
    stored = daily.stored_export(w, spec, "events")
    return stored.groupBy("event_datetime", "event_name", F.col("appmetrica_device_id").cast("string").alias("appmetrica_device_id")).agg(
        F.count(F.lit(1)).alias("rows")
    )


class _Stopped(Exception):
    pass


@query(
    "resume_after_failure",
    f"""
    SELECT {day('CAST(e.ts AS DATE)', 'activity_date')}, e.device AS external_user_id, i.internal_user_id,
           {time("min(date_trunc('second', e.ts))", 'first_event_time')}
    FROM (SELECT *, {DEVICE} AS device FROM events) e
    JOIN (SELECT {DEVICE} AS device, max(CASE WHEN event_id % 3 = 0 THEN user_id END) AS internal_user_id
          FROM events GROUP BY 1) i ON i.device = e.device
    GROUP BY CAST(e.ts AS DATE), e.device, i.internal_user_id""",
)
def resume_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run loads its days and stops before identity and presence; the next one makes them good.

    The outcome is that of a run nothing disturbed.
    """
    spec, path, w = specs.mobile(), staging.new_folder(spark, "landing"), _warehouse(spark)
    landing.write(raw_mobile(spark, sf_dir).withColumn(landing.DAY, F.to_date("event_datetime")), path, spec)
    listed = spark.createDataFrame([], "event_type string")

    def stop(start: date, end: date) -> None:
        raise _Stopped

    daily.load_source(w, path, spec, date(2024, 1, 9))
    try:
        daily.catch_up(w, spec, daily.IDENTITY, stop)
    except _Stopped:
        pass
    daily.load_source(w, path, spec, date(2024, 2, 1))
    daily.catch_up(w, spec, daily.IDENTITY, lambda start, end: daily.identify_mobile(w, start, end))
    daily.catch_up(w, spec, daily.PRESENCE, lambda start, end: daily.attend_mobile(w, listed, start, end))
    return w.presence.read().select("activity_date", "external_user_id", "internal_user_id", "first_event_time")


@query(
    "channel_moved_away",
    f"""
    SELECT {day("date_trunc('month', o_orderdate)", 'month')}, 'ONLINE_BOOKING' AS source,
           count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate >= DATE '1996-01-01'
                            AND o_orderkey % 5 <> 0) AS count
    FROM orders GROUP BY date_trunc('month', o_orderdate)""",
)
def channel_moved_away(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Online appointments that the log later gives to another channel: their months' counts go down, some to zero."""
    orders, w = B.table(spark, sf_dir, "orders"), _warehouse(spark)
    booked = orders.select(
        F.col("o_orderdate").alias("create_dt"), F.col("o_orderkey").cast("string").alias("appointment_id"),
        periods.month_of("o_orderdate").alias("month"),
    )
    w.appointments.append(booked)
    channel = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), P.CHANNEL_ONLINE).otherwise("APP")

    def log(source: Column, at: str) -> DataFrame:
        written = F.lit(at).cast("timestamp_ntz")
        return orders.select(
            F.col("o_orderkey").cast("string").alias("appointment_oid"), source.alias("source"),
            written.alias("created_at"), written.alias("updated_at"),
        )

    months = [r["month"] for r in booked.select("month").distinct().collect()]
    first = log(channel, "2025-02-01 00:00:00")
    daily.renew_channels(w, first, months)
    moved = (F.col("o_orderdate") < F.lit(date(1996, 1, 1))) | (F.col("o_orderkey") % 5 == 0)
    later = log(F.when(moved, "PARTNER").otherwise(channel), "2025-03-01 00:00:00")
    daily.renew_channels(w, first.unionByName(later), months)
    return w.figure("rate_kpi").read()


@query(
    "ingest_split_files",
    f"""
    SELECT CASE WHEN event_id % 3 = 0 THEN user_id END AS profile_id,
           {time("date_trunc('second', ts)", 'event_datetime')}, event_type AS event_name,
           replace(props, '{{', '{{' || chr(10) || '"q": 1,' || chr(10)) AS event_json, {DEVICE} AS appmetrica_device_id
    FROM events""",
)
def ingest_split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events landed on one day, with quotes and line breaks in every row; each file is read by many tasks.

    Few events make one file, more make as many as the day is split over.
    """
    spec, path = specs.mobile(), staging.new_folder(spark, "landing")
    raw = raw_mobile(spark, sf_dir).withColumn("event_json", F.replace("event_json", F.lit("{\n"), F.lit('{\n"q": 1,\n')))
    landing.write(raw.withColumn(landing.DAY, F.lit("2024-01-05")), path, spec)
    largest = max((f.size for f in landing.landed_files(spark, path, date(2024, 1, 5), date(2024, 1, 5))), default=0)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(1, largest // 16)))
    try:
        read = staging.stage(landing.read(spark, path, spec, date(2024, 1, 5), date(2024, 1, 5)), "read")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    wide = ingest.normalise(read, spec)
    return wide.select(
        "profile_id", "event_datetime", "event_name", "event_json",
        F.col("appmetrica_device_id").cast("string").alias("appmetrica_device_id"),
    )


@query(
    "ingest_rejects",
    """
    SELECT 'session_id' AS field, count(*) AS rows FROM events WHERE event_id % 7 = 0
    UNION ALL SELECT 'google_aid', count(*) FROM events WHERE event_id % 4 = 2
    UNION ALL SELECT 'event_datetime', count(*) FROM events WHERE event_id % 11 = 0""",
)
def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a wrong type, loaded twice: each raw row that has one is kept once, with the fields concerned."""
    spec, path, w = specs.mobile(), staging.new_folder(spark, "landing"), _warehouse(spark)
    raw = raw_mobile(spark, sf_dir, also=["event_id"]).withColumn(landing.DAY, F.to_date("event_datetime"))
    bad = F.when(F.col("event_id") % 11 == 0, F.lit("no time")).otherwise(F.col("event_datetime"))
    landing.write(raw.withColumn("event_datetime", bad).drop("event_id"), path, spec)
    for last in (20, 31):
        daily.append_export(w, spec, landing.read(spark, path, spec, date(2024, 1, 1), date(2024, 1, last)))
    found = w.rejects(spec).read().select(F.explode("fields").alias("field"), "copies")
    return found.groupBy("field").agg(F.sum("copies").alias("rows"))


@query(
    "insert_by_key_filter",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS hit,
           {time("date_trunc('second', CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 20000 DAY ELSE ts END)", 'date_time')}
    FROM events""",
)
def insert_by_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of which every tenth is dated 55 years early, loaded in halves that overlap: each is stored once."""
    spec, w = specs.web("booking"), _warehouse(spark)
    number = F.expr("bigint(substring(`ym:pv:watchID`, 3))")
    early = F.date_format(F.to_timestamp_ntz("ym:pv:dateTime") - F.expr("interval 20000 day"), "yyyy-MM-dd HH:mm:ss")
    moved = F.when(number % 10 == 0, early).otherwise(F.col("`ym:pv:dateTime`"))
    raw = raw_web(spark, sf_dir, spec).withColumn("ym:pv:dateTime", moved)
    for part in (number % 3 < 2, number % 3 > 0, number % 3 == 0):
        daily.append_export(w, spec, raw.filter(part))
    stored = daily.stored_export(w, spec, "events")
    return stored.select(F.expr("string(bigint(substring(string(watch_id), 3)))").alias("hit"), "date_time")


@query(
    "identity_account_index",
    B.with_tables("web_events", "web_params", ident=whole_month(ACCOUNT_ID), body=f"SELECT {ID_COLUMNS} FROM ident"),
)
def identity_account_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account identity from the index of hits that three loads have filled."""
    t, spec, w = B.tables(spark, sf_dir), specs.web(specs.ACCOUNT), _warehouse(spark)
    hits, params = t["web_events"], t["web_params"].select("watch_id", "params")
    users = params.select("watch_id", scalars.user_id_from_json(F.col("params"), B.USER_ID_PATH).alias("internal"))
    for part in range(3):
        w.hits.append(users.filter((F.col("watch_id") % 3 == part) & F.col("internal").isNotNull()))
    hits = hits.withColumn("watch_id", F.col("watch_id").cast("decimal(20,0)"))
    return identity.account_by_index(hits, w.hits.read(), date(2024, 1, 1), date(2024, 1, 31)).select(
        "source", "external_user_id", "internal_user_id", "first_seen_at", "last_seen_at"
    )


@query(
    "maintain_warehouse",
    f"""
    SELECT {day('CAST(ts AS DATE)', 'event_day')}, count(*) AS rows, true AS one_file, true AS left_alone
    FROM events GROUP BY CAST(ts AS DATE)""",
)
def maintain_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A warehouse loaded in eight batches and swept twice: a file per day, and nothing to do the second time."""
    spec, w = specs.web("booking"), _warehouse(spark)
    number = F.expr("bigint(substring(`ym:pv:watchID`, 3))")
    for part in range(8):
        daily.append_export(w, spec, raw_web(spark, sf_dir, spec).filter(number % 8 == part))
    first, second = daily.run_upkeep(w), daily.run_upkeep(w)
    days = daily.stored_export(w, spec, "events").groupBy("event_day", F.col("_metadata.file_name").alias("file")).count()
    return days.groupBy("event_day").agg(
        F.sum("count").alias("rows"), (F.count(F.lit(1)) == 1).alias("one_file"), F.lit(bool(first) and not second).alias("left_alone")
    )


@query(
    "cluster_warehouse",
    f"""
    SELECT {DEVICE} AS device, count(*) AS rows, {time("min(date_trunc('second', ts))", 'first_time')},
           true AS few_files, true AS left_alone
    FROM events GROUP BY 1""",
)
def cluster_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events stored as one day of sixteen files, swept twice: by their footers at most half the files hold a device."""
    spec, w = specs.mobile(), _warehouse(spark)
    events = w.export(spec, spec.tables[0])
    wide = ingest.normalise(raw_mobile(spark, sf_dir), spec).withColumn("uuid", F.expr("uuid()"))
    events.append(wide.withColumn(ingest.EVENT_DAY, F.lit(date(2024, 1, 1))))
    name = f"{spec.name}/events"
    [(_, sizes)] = upkeep.partition_files(spark, events.path, 1)
    first, second = daily.run_upkeep(w, sum(sizes) // 15), daily.run_upkeep(w, sum(sizes) // 15)
    device = F.col("appmetrica_device_id")
    spans = events.read().groupBy(F.col("_metadata.file_name")).agg(F.min(device).alias("low"), F.max(device).alias("high"))
    # A span per file, and the sweep makes some sixteen files whatever the table's size.
    listed = spans.agg(F.collect_list(F.struct("low", "high"))).scalar()
    seen = events.read().groupBy(device.cast("string").alias("device"), device.alias("id")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_datetime").alias("first_time")
    )
    holding = F.filter("spans", lambda s: F.col("id").between(s["low"], s["high"]))
    held = seen.withColumn("spans", listed).withColumn("count", F.size(holding)).filter("count > 0")
    few = (F.col("count") <= spans.count() / 2).alias("few_files")
    return held.select("device", "rows", "first_time", few, F.lit(first == {name: 1} and not second).alias("left_alone"))
