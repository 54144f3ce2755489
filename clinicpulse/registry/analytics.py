"""Exports, identity, presence and active users."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import PySparkException as SparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from clinicpulse import bindings as B
from clinicpulse import params as P
from clinicpulse.functions import periods
from clinicpulse.functions.periods import Months
from clinicpulse.operators import rowid, staging, upsert
from clinicpulse.plans import counts, identity, mau, presence
from clinicpulse.registry.base import CHECKS, day, query, time
from clinicpulse.sources import ingest, landing, specs
from clinicpulse.sources.state import StateTable, VersionedTable

START, END = B.EVENT_DAYS
IN_RANGE = "{0} >= DATE '2024-01-05' AND {0} < DATE '2024-01-26'"
NOW = "TIMESTAMP '2024-02-01 03:00:00'"

# --- identity -------------------------------------------------------------------------------------

MOBILE_ID = f"""
    SELECT 'appmetrica' AS source, CAST(appmetrica_device_id AS VARCHAR) AS external_user_id,
           max(profile_id) AS internal_user_id, min(event_datetime) AS first_seen_at,
           max(event_datetime) AS last_seen_at
    FROM mobile_events
    WHERE appmetrica_device_id IS NOT NULL AND {IN_RANGE.format('event_datetime')}
    GROUP BY appmetrica_device_id"""

USER = "CASE WHEN json_valid(p.params) THEN TRY_CAST(json_extract_string(p.params, '$.k') AS BIGINT) END"

BOOKING_ID = f"""
    SELECT 'booking' AS source, CAST(h.client_id AS VARCHAR) AS external_user_id,
           max({USER}) AS internal_user_id, min(h.date_time) AS first_seen_at, max(h.date_time) AS last_seen_at
    FROM web_events h, web_params p
    WHERE h.watch_id = p.watch_id AND h.date_time = p.date_time AND {IN_RANGE.format('h.date_time')}
    GROUP BY h.client_id"""

ACCOUNT_ID = f"""
    SELECT 'web_lk' AS source, CAST(h.client_id AS VARCHAR) AS external_user_id,
           max({USER}) AS internal_user_id, min(h.date_time) AS first_seen_at, max(h.date_time) AS last_seen_at
    FROM (SELECT * FROM web_events WHERE {IN_RANGE.format('date_time')}) h
    LEFT JOIN web_params p USING (watch_id)
    GROUP BY h.client_id"""

ID_COLUMNS = f"source, external_user_id, internal_user_id, {time('first_seen_at')}, {time('last_seen_at')}"


@query("identity_mobile", B.with_tables("mobile_events", ident=MOBILE_ID, body=f"SELECT {ID_COLUMNS} FROM ident"))
def identity_mobile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.mobile(B.tables(spark, sf_dir)["mobile_events"], START, END)


@query(
    "identity_booking",
    B.with_tables("web_events", "web_params", ident=BOOKING_ID, body=f"SELECT {ID_COLUMNS} FROM ident"),
)
def identity_booking(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    return identity.booking(t["web_events"], t["web_params"], START, END, path=B.USER_ID_PATH)


@query(
    "identity_account",
    B.with_tables("web_events", "web_params", ident=ACCOUNT_ID, body=f"SELECT {ID_COLUMNS} FROM ident"),
)
def identity_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    return identity.account(t["web_events"], t["web_params"], START, END, path=B.USER_ID_PATH)


# --- presence -------------------------------------------------------------------------------------


def presence_sql(events: str, id_text: str, external: str, at: str, labels: tuple[str, str, str], where: str) -> str:
    source, product, platform = labels
    return f"""
        SELECT CAST(e.{at} AS DATE) AS activity_date, '{source}' AS source, '{product}' AS product,
               '{platform}' AS platform, max(i.internal_user_id) AS internal_user_id,
               CAST(e.{external} AS VARCHAR) AS external_user_id, min(e.{at}) AS first_event_time
        FROM {events} e LEFT JOIN ({id_text}) i ON i.external_user_id = CAST(e.{external} AS VARCHAR)
        WHERE {where} AND {IN_RANGE.format('e.' + at)}
        GROUP BY CAST(e.{at} AS DATE), e.{external}"""


PRESENT_MOBILE = presence_sql(
    "mobile_events", MOBILE_ID, "appmetrica_device_id", "event_datetime", ("appmetrica", "lk", "mobile"), "true"
)
PRESENT_LISTED = presence_sql(
    "mobile_events", MOBILE_ID, "appmetrica_device_id", "event_datetime", ("appmetrica", "oz", "mobile"),
    "e.event_name IN (SELECT event_type FROM allowed)",
)
PRESENT_GOAL = presence_sql(
    "web_events", BOOKING_ID, "client_id", "date_time", ("booking", "oz", "web"),
    "NOT e.is_page_view AND starts_with(e.url, 'goal://site/')",
)
PRESENT_VIEW = presence_sql(
    "web_events", ACCOUNT_ID, "client_id", "date_time", ("web_lk", "lk", "web"), "e.is_page_view"
)
PRESENCE_COLUMNS = (
    f"{day('activity_date')}, source, product, platform, internal_user_id, external_user_id, "
    f"{time('first_event_time')}"
)
PRESENCE_BODY = f"SELECT {PRESENCE_COLUMNS} FROM present"


@query("presence_mobile_all", B.with_tables("mobile_events", present=PRESENT_MOBILE, body=PRESENCE_BODY))
def presence_mobile_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = B.tables(spark, sf_dir)["mobile_events"]
    return presence.build(events, identity.mobile(events, START, END), presence.mobile_all(), START, END)


@query("presence_allowlist", B.with_tables("mobile_events", "allowed", present=PRESENT_LISTED, body=PRESENCE_BODY))
def presence_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    known = identity.mobile(t["mobile_events"], START, END)
    # Written first: its true size keeps the events from being exchanged by their name.
    allowed = staging.stage(t["allowed"], "allowed")
    return presence.build(t["mobile_events"], known, presence.mobile_listed(allowed), START, END)


@query("presence_goal", B.with_tables("web_events", "web_params", present=PRESENT_GOAL, body=PRESENCE_BODY))
def presence_goal(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    known = identity.booking(t["web_events"], t["web_params"], START, END, path=B.USER_ID_PATH)
    return presence.build(t["web_events"], known, presence.site_goals(B.GOAL_PREFIX), START, END)


@query("presence_pageview", B.with_tables("web_events", "web_params", present=PRESENT_VIEW, body=PRESENCE_BODY))
def presence_pageview(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    known = identity.account(t["web_events"], t["web_params"], START, END, path=B.USER_ID_PATH)
    return presence.build(t["web_events"], known, presence.site_page_views(), START, END)


# --- active users ---------------------------------------------------------------------------------

PERSON = "coalesce(CAST(internal_user_id AS VARCHAR), source || ':' || external_user_id)"
HISTORY_MONTHS = Months(date(1995, 1, 1), date(2001, 9, 1))


def months_sql(start: str, end: str) -> str:
    return f"SELECT CAST(unnest(range(DATE '{start}', DATE '{end}', INTERVAL 1 MONTH)) AS DATE) AS month"


def monthly_sql(per_month: str) -> str:
    """Months of range ``spine`` with the count of ``per_month``, 0 where it has none."""
    return f"""
        SELECT {day('spine.month', 'month')}, coalesce(c.n, 0) AS count
        FROM spine LEFT JOIN ({per_month}) c USING (month)"""


BOOKING_USERS = f"""
    SELECT CAST(date_trunc('month', activity_date) AS DATE) AS month, count(DISTINCT {PERSON}) AS n
    FROM history WHERE product = 'oz' GROUP BY 1"""


@query(
    "mau_booking",
    B.with_tables("history", spine=months_sql("1995-01-01", "2001-09-01"), body=monthly_sql(BOOKING_USERS)),
)
def mau_booking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mau.booking(B.tables(spark, sf_dir)["history"], HISTORY_MONTHS)


@query(
    "mau_account",
    B.with_tables(
        "history",
        spine=months_sql("1995-01-01", "2001-09-01"),
        body=monthly_sql("""
            SELECT month, count(who) AS n FROM (
                SELECT CAST(date_trunc('month', activity_date) AS DATE) AS month,
                       coalesce(CAST(internal_user_id AS VARCHAR), external_user_id) AS who
                FROM history WHERE product = 'lk' AND platform = 'mobile'
                UNION
                SELECT CAST(date_trunc('month', activity_date) AS DATE), CAST(internal_user_id AS VARCHAR)
                FROM history WHERE product = 'lk' AND platform = 'web' AND internal_user_id IS NOT NULL)
            GROUP BY month"""),
    ),
)
def mau_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mau.account(B.tables(spark, sf_dir)["history"], HISTORY_MONTHS)


@query(
    "ytd_users",
    B.with_tables(
        "history",
        body=f"""
            SELECT y.year, 'mau_ob' AS kpi, count(DISTINCT {PERSON}) AS value
            FROM (SELECT unnest(range(1994, 2001)) AS year) y
            LEFT JOIN history h ON h.product = 'oz'
              AND h.activity_date BETWEEN make_date(y.year, 1, 1)
                  AND CASE WHEN y.year % 4 = 0 THEN make_date(y.year, 2, 29) ELSE make_date(y.year, 2, 28) END
            GROUP BY y.year""",
    ),
)
def ytd_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run on a leap day: years without one end on 28 February. 1994 has no data and gets 0."""
    return mau.year_to_date(B.tables(spark, sf_dir)["history"], date(2000, 2, 29), first_year=1994)


@query(
    "recompute_months",
    B.with_tables("history", spine=months_sql("2001-02-01", "2002-01-01"), body=monthly_sql(BOOKING_USERS)),
)
def recompute_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored up to March 2001: start a month earlier, and write 0 for the months still without data."""
    history = B.tables(spark, sf_dir)["history"]
    stored = history.filter(F.col("activity_date") < F.lit(date(2001, 4, 1)))
    last = periods.last_value(stored, "activity_date")
    months = periods.trailing_months(last, as_of=date(2001, 12, 15), floor=False)
    return mau.booking(history, months)


def _counted(spark: SparkSession, sf_dir: str) -> tuple[StateTable, StateTable]:
    """The history counted in three loads, each into the same numbers, bitmaps and sketches."""
    history, root = B.tables(spark, sf_dir)["history"], staging.new_folder(spark, "counts")
    by = counts.PARTITIONS
    bits, sketches = StateTable(spark, f"{root}/bits", counts.BITS, by), StateTable(spark, f"{root}/sketches", counts.SKETCHES, by)
    for part in range(3):
        days = history.filter(F.year("activity_date") % 3 == part)
        counts.renew(counts.UserNumbers(spark, f"{root}/numbers"), bits, sketches, days)
    return bits, sketches


query("ytd_users_bitmaps", CHECKS["ytd_users"])(
    lambda spark, sf_dir: counts.year_to_date(_counted(spark, sf_dir)[0].read(), date(2000, 2, 29), first_year=1994)
)


@query(
    "mau_booking_sketches",
    B.with_tables("history", spine=months_sql("1995-01-01", "2001-09-01"), body=f"SELECT *, true AS close FROM ({monthly_sql(BOOKING_USERS)})"),
)
def mau_booking_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact users per month from bitmaps, and whether the sketches come within five standard errors of them."""
    bits, sketches = _counted(spark, sf_dir)
    exact = counts.monthly(bits.read(), HISTORY_MONTHS, P.PRODUCT_BOOKING)
    near = counts.monthly_estimate(sketches.read(), HISTORY_MONTHS, P.PRODUCT_BOOKING).withColumnRenamed("count", "near")
    close = F.abs(F.col("near") - F.col("count")) <= 0.04 * F.col("count") + 0.5
    return exact.join(near, "month").select("month", "count", close.alias("close"))


def whole_month(sql: str) -> str:
    return sql.replace("2024-01-05", "2024-01-01").replace("2024-01-26", "2024-02-01")


def users_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain on raw events: identity, presence of all four kinds, then monthly users."""
    t = B.tables(spark, sf_dir)
    web, app = t["web_events"], t["mobile_events"]
    # Two kinds of presence look it up.
    start, end = date(2024, 1, 1), date(2024, 1, 31)
    app_ids = staging.stage(identity.mobile(app, start, end), "identity-mobile")
    allowed = staging.stage(t["allowed"], "allowed")
    booking_ids = identity.booking(web, t["web_params"], start, end, path=B.USER_ID_PATH)
    account_ids = identity.account(web, t["web_params"], start, end, path=B.USER_ID_PATH)
    days = [
        presence.build(app, app_ids, presence.mobile_listed(allowed), start, end),
        presence.build(app, app_ids, presence.mobile_all(), start, end),
        presence.build(web, booking_ids, presence.site_goals(B.GOAL_PREFIX), start, end),
        presence.build(web, account_ids, presence.site_page_views(), start, end),
    ]
    present = staging.stage(days[0].unionByName(days[1]).unionByName(days[2]).unionByName(days[3]), "presence")
    months = Months(date(2024, 1, 1), date(2024, 3, 1))
    of_booking = mau.booking(present, months).withColumn("kpi", F.lit("booking"))
    return of_booking.unionByName(mau.account(present, months).withColumn("kpi", F.lit("account")))


query(
    "mau_from_events",
    B.with_tables(
        "mobile_events", "web_events", "web_params", "allowed",
        present=whole_month(" UNION ALL ".join((PRESENT_LISTED, PRESENT_MOBILE, PRESENT_GOAL, PRESENT_VIEW))),
        spine=months_sql("2024-01-01", "2024-03-01"),
        body=f"""
            SELECT {day('spine.month', 'month')}, kpi, count(DISTINCT who) AS count
            FROM spine CROSS JOIN (VALUES ('booking'), ('account')) k(kpi)
            LEFT JOIN (
                SELECT CAST(date_trunc('month', activity_date) AS DATE) AS month, 'booking' AS kpi,
                       {PERSON} AS who
                FROM present WHERE product = 'oz'
                UNION ALL
                SELECT CAST(date_trunc('month', activity_date) AS DATE), 'account',
                       CASE platform WHEN 'web' THEN CAST(internal_user_id AS VARCHAR)
                            ELSE coalesce(CAST(internal_user_id AS VARCHAR), external_user_id) END
                FROM present WHERE product = 'lk') u USING (month, kpi)
            GROUP BY spine.month, kpi""",
    ),
)(users_from_events)


# --- upserts --------------------------------------------------------------------------------------


def identity_between(first: int, last: int) -> str:
    """Mobile identity of January days ``first`` to ``last``."""
    after = date(2024, 1, last) + timedelta(days=1)
    return MOBILE_ID.replace("2024-01-05", f"2024-01-{first:02d}").replace("2024-01-26", after.isoformat())


@query(
    "upsert_identity_merge",
    B.with_tables(
        "mobile_events",
        old=identity_between(1, 18),
        new=identity_between(12, 31),
        body=f"""
            SELECT coalesce(o.source, n.source) AS source,
                   coalesce(o.external_user_id, n.external_user_id) AS external_user_id,
                   coalesce(n.internal_user_id, o.internal_user_id) AS internal_user_id,
                   {time('coalesce(o.first_seen_at, n.first_seen_at)', 'first_seen_at')},
                   {time('greatest(o.last_seen_at, n.last_seen_at)', 'last_seen_at')},
                   {time(f"CASE WHEN o.source = n.source THEN {NOW} END", 'updated_at')}
            FROM old o FULL JOIN new n ON o.external_user_id = n.external_user_id""",
    ),
)
def upsert_identity_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches that overlap and together cover the table."""
    events = B.tables(spark, sf_dir)["mobile_events"]
    stored = identity.mobile(events, date(2024, 1, 1), date(2024, 1, 18)).withColumn(
        "updated_at", F.lit(None).cast("timestamp_ntz")
    )
    batch = identity.mobile(events, date(2024, 1, 12), date(2024, 1, 31))
    return identity.merge(stored, batch, F.expr(NOW.replace("TIMESTAMP", "TIMESTAMP_NTZ")))


def presence_between(first: int, last: int) -> str:
    return f"""
        SELECT CAST(event_datetime AS DATE) AS activity_date, 'appmetrica' AS source, 'lk' AS product,
               'mobile' AS platform, CAST(appmetrica_device_id AS VARCHAR) AS external_user_id,
               min(event_datetime) AS first_event_time
        FROM mobile_events
        WHERE event_datetime >= DATE '2024-01-{first:02d}' AND event_datetime < DATE '2024-01-{last:02d}' + 1
        GROUP BY 1, appmetrica_device_id"""


@query(
    "upsert_presence_merge",
    B.with_tables(
        "mobile_events",
        old_ids=identity_between(1, 7),
        new_ids=identity_between(8, 31),
        old=presence_between(1, 18),
        new=presence_between(12, 31),
        body=f"""
            SELECT {day('coalesce(o.activity_date, n.activity_date)', 'activity_date')},
                   'appmetrica' AS source, 'lk' AS product, 'mobile' AS platform,
                   coalesce(CASE WHEN n.source IS NOT NULL THEN j.internal_user_id END,
                            CASE WHEN o.source IS NOT NULL THEN i.internal_user_id END) AS internal_user_id,
                   coalesce(o.external_user_id, n.external_user_id) AS external_user_id,
                   {time('coalesce(o.first_event_time, n.first_event_time)', 'first_event_time')},
                   {time(f"CASE WHEN o.source = n.source THEN {NOW} END", 'updated_at')}
            FROM old o FULL JOIN new n
              ON o.activity_date = n.activity_date AND o.external_user_id IS NOT DISTINCT FROM n.external_user_id
            LEFT JOIN old_ids i ON i.external_user_id = o.external_user_id
            LEFT JOIN new_ids j ON j.external_user_id = n.external_user_id""",
    ),
)
def upsert_presence_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = B.tables(spark, sf_dir)["mobile_events"]
    old_ids = identity.mobile(events, date(2024, 1, 1), date(2024, 1, 7))
    new_ids = identity.mobile(events, date(2024, 1, 8), date(2024, 1, 31))
    stored = presence.build(events, old_ids, presence.mobile_all(), date(2024, 1, 1), date(2024, 1, 18)).withColumn(
        "updated_at", F.lit(None).cast("timestamp_ntz")
    )
    batch = presence.build(events, new_ids, presence.mobile_all(), date(2024, 1, 12), date(2024, 1, 31))
    return presence.merge(stored, batch, F.expr(NOW.replace("TIMESTAMP", "TIMESTAMP_NTZ")))


@query(
    "upsert_replace",
    f"""
    SELECT {day("date_trunc('month', o_orderdate)", 'month')},
           CASE WHEN o_orderdate < DATE '1999-07-01' THEN count(*) ELSE count(DISTINCT o_custkey) END AS count
    FROM orders GROUP BY date_trunc('month', o_orderdate), o_orderdate < DATE '1999-07-01'""",
)
def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored: orders per month to 1999. Recomputed from July 1999 on: customers per month."""
    orders = B.table(spark, sf_dir, "orders")
    monthly = orders.groupBy(periods.month_of("o_orderdate").alias("month"))
    stored = monthly.agg(F.count(F.lit(1)).alias("count")).filter(F.col("month") < F.lit(date(2000, 1, 1)))
    fresh = monthly.agg(F.count_distinct("o_custkey").alias("count")).filter(
        F.col("month") >= F.lit(date(1999, 7, 1))
    )
    table = StateTable(spark, staging.new_folder(spark, "figure"), "month date, count bigint", ["month"])
    table.append(stored.select(F.col("month").cast("date").alias("month"), "count"))
    table.replace_partitions(fresh.select(F.col("month").cast("date").alias("month"), "count"))
    return table.read()


@query(
    "report_replace",
    """
    SELECT o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY o_orderstatus""",
)
def report_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report table written as a whole, then replaced as a whole by a frame that reads it."""
    orders = B.table(spark, sf_dir, "orders")
    report = VersionedTable(spark, staging.new_folder(spark, "report"), "status string, orders bigint")
    by = lambda c: orders.groupBy(F.col(c).alias("status")).agg(F.count(F.lit(1)).alias("orders"))
    report.publish(by("o_orderpriority"))
    report.publish(by("o_orderstatus").join(report.read().select("status"), "status", "left_anti"))
    return report.read()


@query(
    "report_replace_after_failure",
    """
    SELECT o_orderpriority AS status, count(*) AS orders FROM orders GROUP BY o_orderpriority""",
)
def report_replace_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replacement fails in the middle of its rows; the report that was there is still read."""
    orders = B.table(spark, sf_dir, "orders")
    report = VersionedTable(spark, staging.new_folder(spark, "report"), "status string, orders bigint")
    report.publish(orders.groupBy(F.col("o_orderpriority").alias("status")).agg(F.count(F.lit(1)).alias("orders")))
    last = orders.agg(F.max("o_orderkey").alias("last")).first()["last"]
    lost = F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("lost in the middle")).cast("bigint"))
    try:
        report.publish(orders.select(F.col("o_orderstatus").alias("status"), F.coalesce(lost, F.lit(1)).alias("orders")))
    except SparkException as failure:
        if "lost in the middle" not in str(failure):
            raise
    return report.read()


@query(
    "insert_if_absent",
    f"""
    WITH loaded AS (SELECT DISTINCT user_id, props FROM events WHERE ts < DATE '2024-01-15')
    SELECT user_id, props, min(event_id) AS event_id, {time('arg_min(ts, event_id)', 'ts')}
    FROM events n
    WHERE ts >= DATE '2024-01-10'
      AND NOT EXISTS (SELECT 1 FROM loaded l WHERE l.user_id = n.user_id AND l.props = n.props)
    GROUP BY user_id, props""",
)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches overlap by five days; of several new rows of one key the first event is inserted."""
    rows = B.table(spark, sf_dir, "events").select("user_id", "props", "event_id", "ts")
    stored = rows.filter(F.col("ts") < F.lit(date(2024, 1, 15)))
    batch = rows.filter(F.col("ts") >= F.lit(date(2024, 1, 10)))
    return upsert.insert_if_absent(stored, batch, ["user_id", "props"], ["event_id"])


# --- exports --------------------------------------------------------------------------------------


@query(
    "incremental_slice",
    f"""
    SELECT event_id, {time('ts')} FROM events
    WHERE ts >= (SELECT CAST(max(ts) AS DATE) + 1 FROM events WHERE ts < DATE '2024-01-20')
      AND ts < DATE '2024-01-27'""",
)
def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded before 20 January, run on the 27th: everything after the last loaded day to yesterday."""
    events = B.table(spark, sf_dir, "events").select("event_id", "ts")
    last = periods.last_value(events.filter(F.col("ts") < F.lit(date(2024, 1, 20))), "ts")
    days = periods.next_slice(last, as_of=date(2024, 1, 27))
    return events.filter(periods.within_days("ts", *days) if days else F.lit(False))


def raw_mobile(spark: SparkSession, sf_dir: str, also: Sequence[str] = ()) -> DataFrame:
    """The events as a mobile export would write them: text columns, ids above 2^63, some bad values."""
    number_ = F.col("event_id")
    known = {
        "profile_id": F.when(number_ % 3 == 0, F.col("user_id").cast("string")),
        "application_id": F.lit("4777504"),
        "event_name": F.col("event_type"),
        # A line break inside a text.
        "event_json": F.replace("props", F.lit("{"), F.lit("{\n")),
        "event_datetime": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "appmetrica_device_id": F.concat(F.lit("18000000000000"), F.lpad(F.col("user_id").cast("string"), 6, "0")),
        "session_id": F.when(number_ % 7 != 0, number_.cast("string")).otherwise("none"),
        "google_aid": F.when(number_ % 4 == 0, "0000-0000").when(number_ % 4 == 1, "").when(
            number_ % 4 == 2, "not-a-uuid"
        ).otherwise(F.concat(F.lit("ABCDEF01-0000-4000-8000-"), F.lpad(number_.cast("string"), 12, "0"))),
    }
    columns = [known.get(c, F.lit(None).cast("string")).alias(c) for c in specs.MOBILE_COLUMNS]
    return B.table(spark, sf_dir, "events").select(*columns, *also)


def raw_web(spark: SparkSession, sf_dir: str, spec: specs.ExportSpec) -> DataFrame:
    known = {
        "watchID": F.concat(F.lit("17"), F.lpad(F.col("event_id").cast("string"), 18, "0")),
        "clientID": F.col("user_id").cast("string"),
        "dateTime": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "URL": F.concat(F.lit(B.GOAL_PREFIX), F.col("event_type")),
        "isPageView": F.when(F.col("event_type") == "view", "1").otherwise("0"),
        "params": F.replace("props", F.lit("{"), F.lit("{\n")),
    }
    columns = [
        known.get(c.removeprefix(spec.prefix), F.lit(None).cast("string")).alias(c) for c in spec.header
    ]
    return B.table(spark, sf_dir, "events").select(*columns)


DEVICE = "'18000000000000' || lpad(CAST(user_id AS VARCHAR), 6, '0')"


@query(
    "ingest_events",
    f"""
    SELECT CASE WHEN event_id % 3 = 0 THEN user_id END AS profile_id, 4777504 AS application_id,
           {time("date_trunc('second', ts)", 'event_datetime')}, event_type AS event_name,
           CASE WHEN event_id % 7 <> 0 THEN event_id END AS session_id, {DEVICE} AS appmetrica_device_id
    FROM events WHERE {IN_RANGE.format('ts')}""",
)
def ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed as CSV by day, read back for a range of days, typed, numbered, and cut to the events table."""
    spec = specs.mobile()
    path = staging.new_folder(spark, "landing")
    raw = raw_mobile(spark, sf_dir)
    landing.write(raw.withColumn(landing.DAY, F.to_date("event_datetime")), path, spec)
    nothing = {t.name: spark.createDataFrame([], stored_schema(spec, t)) for t in spec.tables}
    loaded = ingest.run(spark, path, spec, nothing, START, END)["events"]
    return loaded.select(
        "profile_id", F.col("application_id").cast("int"), "event_datetime", "event_name", "session_id",
        F.col("appmetrica_device_id").cast("string").alias("appmetrica_device_id"),
    )


def stored_schema(spec: specs.ExportSpec, table: specs.Table) -> str:
    kinds = {f.target: specs.SPARK_TYPES[f.type] for f in spec.fields}
    return ", ".join(f"{c} {kinds.get(c, 'string')}" for c in table.columns)


@query(
    "ingest_null_sentinels",
    """
    SELECT CASE WHEN event_id % 3 = 0 THEN user_id END AS profile_id,
           CASE WHEN event_id % 4 = 3 THEN 'abcdef01-0000-4000-8000-' || lpad(CAST(event_id AS VARCHAR), 12, '0')
           END AS google_aid
    FROM events""",
)
def ingest_null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = specs.mobile()
    return raw_mobile(spark, sf_dir).select(
        ingest.typed(spec.field("profile_id")), ingest.typed(spec.field("google_aid"))
    )


@query(
    "ingest_fanout_counts",
    """
    SELECT s.export, t.name AS "table", count(*) AS rows, count(DISTINCT event_id) AS keys
    FROM events,
         (VALUES ('mobile', 'm'), ('booking', 'w'), ('web_lk', 'w')) s(export, shape),
         (VALUES ('m', 'events'), ('m', 'event_params'), ('m', 'devices'), ('m', 'location'),
                 ('w', 'events'), ('w', 'event_params'), ('w', 'marketing_info'), ('w', 'devices'),
                 ('w', 'location'), ('w', 'offline_calls')) t(shape, name)
    WHERE s.shape = t.shape GROUP BY s.export, t.name""",
)
def ingest_fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct keys of each of the 16 tables the three exports feed."""
    counts = []
    for name, spec in specs.all_specs().items():
        raw = raw_mobile(spark, sf_dir) if name == "mobile" else raw_web(spark, sf_dir, spec)
        wide = staging.stage(ingest.normalise(raw, spec), f"export-{name}")
        for table in spec.tables:
            counts.append(
                ingest.fan_out(wide, spec)[table.name].groupBy(
                    F.lit(name).alias("export"), F.lit(table.name).alias("table")
                ).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*table.key).alias("keys"))
            )
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "ingest_row_id",
    """
    SELECT user_id, event_type,
           concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS row_id
    FROM (SELECT user_id, event_type,
                 sha256(concat_ws(chr(31), CAST(user_id AS VARCHAR), event_type,
                        CAST(row_number() OVER (PARTITION BY user_id, event_type) AS VARCHAR))) AS h
          FROM events)""",
)
def ingest_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users repeat the same event, so most rows here have copies; copies are cut into blocks of 8."""
    rows = B.table(spark, sf_dir, "events").select("user_id", "event_type")
    return rowid.with_row_id(rows, "row_id", block=8)
