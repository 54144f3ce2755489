"""Single operators of the jobs, each over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinicpulse import bindings as B
from clinicpulse.functions import periods, scalars
from clinicpulse.functions.periods import Months
from clinicpulse.plans import revenue
from clinicpulse.registry.base import day, number, query, time

# --- filters --------------------------------------------------------------------------------------


@query(
    "filter_half_open_month",
    f"""
    SELECT o_orderkey, {time('o_orderdate')} FROM orders
    WHERE o_orderdate >= DATE '1997-02-01' AND o_orderdate < DATE '1997-03-01'""",
)
def filter_half_open_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    february = Months(date(1997, 2, 1), date(1997, 3, 1))
    return B.table(spark, sf_dir, "orders").filter(february.of("o_orderdate")).select("o_orderkey", "o_orderdate")


@query(
    "filter_inclusive_days",
    f"SELECT event_id, {time('ts')} FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
)
def filter_inclusive_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = periods.within_days("ts", date(2024, 1, 10), date(2024, 1, 12))
    return B.table(spark, sf_dir, "events").filter(days).select("event_id", "ts")


@query(
    "filter_in_not_in",
    B.with_tables(
        "presc", "visit",
        body="""
            SELECT r.id, r.presc_state_id, v.pay_type_id FROM presc r JOIN visit v ON v.id = r.visit_id
            WHERE r.presc_state_id IN ('sign', 'done_lab') AND v.pay_type_id NOT IN ('cash', 'budget')""",
    ),
)
def filter_in_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL passes neither list."""
    t = B.tables(spark, sf_dir)
    signed = t["presc"].filter(F.col("presc_state_id").isin("sign", "done_lab"))
    other = t["visit"].filter(~F.col("pay_type_id").isin("cash", "budget"))
    return signed.join(other.withColumnRenamed("id", "visit_id"), "visit_id").select(
        "id", "presc_state_id", "pay_type_id"
    )


@query(
    "filter_tristate_like",
    B.with_tables(
        "schedule_log",
        body="""
            SELECT schedule, commentary, 'with' AS kept FROM schedule_log WHERE contains(commentary, 'ДМС')
            UNION ALL
            SELECT schedule, commentary, 'without' FROM schedule_log WHERE NOT contains(commentary, 'ДМС')
            UNION ALL
            SELECT schedule, commentary, 'all' FROM schedule_log""",
    ),
)
def filter_tristate_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing comment passes only the unset filter."""
    log = B.tables(spark, sf_dir)["schedule_log"].select("schedule", "commentary")

    def kept(flag: bool | None, label: str) -> DataFrame:
        condition = scalars.contains_if(flag, F.col("commentary"), "ДМС")
        rows = log if condition is None else log.filter(condition)
        return rows.withColumn("kept", F.lit(label))

    return kept(True, "with").unionByName(kept(False, "without")).unionByName(kept(None, "all"))


@query(
    "filter_like_prefix",
    B.with_tables("web_events", body="SELECT watch_id, url FROM web_events WHERE url LIKE 'goal://site/%'"),
)
def filter_like_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = B.tables(spark, sf_dir)["web_events"]
    return events.filter(F.col("url").startswith(B.GOAL_PREFIX)).select("watch_id", "url")


@query(
    "filter_null_bool",
    B.with_tables(
        "people", "pinfo",
        body="""
            SELECT h.oid, h.account_id IS NOT NULL AS has_account, coalesce(n.auto_notification, false) AS notified,
                   n.auto_notification IS TRUE AS surely, n.auto_notification IS FALSE AS surely_not
            FROM people h LEFT JOIN pinfo n ON n.oid = h.oid
            WHERE n.auto_notification IS NULL OR h.account_id IS NOT NULL""",
    ),
)
def filter_null_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    joined = t["people"].join(t["pinfo"], "oid", "left")
    notified = F.col("auto_notification")
    return joined.filter(notified.isNull() | F.col("account_id").isNotNull()).select(
        "oid",
        F.col("account_id").isNotNull().alias("has_account"),
        F.coalesce(notified, F.lit(False)).alias("notified"),
        notified.eqNullSafe(True).alias("surely"),
        notified.eqNullSafe(False).alias("surely_not"),
    )


@query(
    "filter_array_overlap",
    B.with_tables(
        "presc", "presctype",
        body="""
            SELECT r.id, y.oid AS type FROM presc r JOIN presctype y ON y.oid = r.presctype_id
            WHERE list_contains(y.tags, 'CHILD') OR list_contains(y.tags, 'ADULT')""",
    ),
)
def filter_array_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    tagged = t["presctype"].filter(F.arrays_overlap("tags", F.array(F.lit("CHILD"), F.lit("ADULT"))))
    return t["presc"].join(tagged.select(F.col("oid").alias("presctype_id")), "presctype_id").select(
        "id", F.col("presctype_id").alias("type")
    )


@query(
    "filter_validity_asof",
    B.with_tables(
        "finance_plan",
        body=f"""
            SELECT oid, {day('date_begin')}, {day('date_end')} FROM finance_plan
            WHERE DATE '1998-06-01' BETWEEN date_begin AND date_end AND fixed""",
    ),
)
def filter_validity_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit(date(1998, 6, 1))
    plans = B.tables(spark, sf_dir)["finance_plan"]
    return plans.filter(F.col("fixed") & as_of.between(F.col("date_begin"), F.col("date_end"))).select(
        "oid", "date_begin", "date_end"
    )


# --- joins ----------------------------------------------------------------------------------------


@query(
    "join_inner_chain",
    B.with_tables(
        "presc_service", "presc", "mdoc", "people", "service_presctype", "services",
        body="""
            SELECT v.pay_type, h.account_id IS NOT NULL AS has_account, count(*) AS lines
            FROM presc_service s, presc r, mdoc m, people h, service_presctype k, services v
            WHERE r.id = s.presc AND m.id = r.mdoc_id AND h.oid = m.people_id AND k.oid = s.service_presctype
              AND v.oid = k.service
            GROUP BY ALL""",
    ),
)
def join_inner_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    lines = t["presc_service"].select(F.col("presc").alias("presc_id"), "service_presctype")
    owners = t["mdoc"].select(F.col("id").alias("mdoc_id"), F.col("people_id").alias("person")).join(
        t["people"].select(F.col("oid").alias("person"), "account_id"), "person"
    )
    kinds = t["service_presctype"].withColumnRenamed("oid", "service_presctype").join(
        t["services"].withColumnRenamed("oid", "service"), "service"
    )
    return (
        lines.join(t["presc"].select(F.col("id").alias("presc_id"), "mdoc_id"), "presc_id")
        .join(owners, "mdoc_id")
        .join(kinds, "service_presctype")
        .groupBy("pay_type", F.col("account_id").isNotNull().alias("has_account"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@query(
    "join_left_discount",
    B.with_tables(
        "discount_presc", "discount",
        body=f"""
            SELECT a.presc_service, a.discount, {number('coalesce(a.percent, b.percent)', 'percent')}
            FROM discount_presc a LEFT JOIN discount b ON b.oid = a.discount""",
    ),
)
def join_left_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    cards = t["discount"].select(F.col("oid").alias("discount"), F.col("percent").alias("card"))
    return t["discount_presc"].join(cards, "discount", "left").select(
        "presc_service", "discount", F.coalesce("percent", "card").alias("percent")
    )


@query(
    "join_semi_exists",
    B.with_tables(
        "presc", "sotr",
        body="""
            SELECT r.id FROM presc r
            WHERE EXISTS (SELECT 1 FROM sotr w WHERE w.oid = r.creator_id AND w.sysuser = 'u3')""",
    ),
)
def join_semi_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    creators = t["sotr"].filter(F.col("sysuser") == B.ONLINE_SYSUSER).select(F.col("oid").alias("creator_id"))
    return t["presc"].join(creators, "creator_id", "left_semi").select("id")


@query(
    "join_left_with_anti",
    B.with_tables(
        "mdoc", "presc", "presc_schedule",
        body="""
            SELECT m.people_id, count(r.id) AS unbooked
            FROM mdoc m LEFT JOIN presc r ON r.mdoc_id = m.id
              AND r.id NOT IN (SELECT presc_id FROM presc_schedule WHERE presc_id IS NOT NULL)
            GROUP BY m.people_id""",
    ),
)
def join_left_with_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prescriptions are counted per patient file first; only then are files joined."""
    t = B.tables(spark, sf_dir)
    booked = t["presc_schedule"].select(F.col("presc_id").alias("id")).distinct()
    unbooked = t["presc"].join(booked, "id", "left_anti").groupBy("mdoc_id").agg(F.count("id").alias("n"))
    files = t["mdoc"].select(F.col("id").alias("mdoc_id"), "people_id")
    return files.join(unbooked, "mdoc_id", "left").groupBy("people_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("unbooked")
    )


@query(
    "join_existence_flag",
    B.with_tables(
        "presc", "presc_schedule",
        body="SELECT id, id IN (SELECT presc_id FROM presc_schedule WHERE presc_id IS NOT NULL) AS booked FROM presc",
    ),
)
def join_existence_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    booked = t["presc_schedule"].select(F.col("presc_id").alias("id")).distinct().withColumn("found", F.lit(True))
    return t["presc"].join(booked, "id", "left").select("id", F.col("found").isNotNull().alias("booked"))


@query(
    "join_anti",
    B.with_tables(
        "presc", "presc_schedule",
        body="""
            SELECT r.id, r.mdoc_id FROM presc r LEFT JOIN presc_schedule b ON b.presc_id = r.id WHERE b.id IS NULL""",
    ),
)
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    booked = t["presc_schedule"].select(F.col("presc_id").alias("id")).distinct()
    return t["presc"].join(booked, "id", "left_anti").select("id", "mdoc_id")


@query(
    "join_same_day_later",
    B.with_tables(
        "schedule", "presc_schedule", "presc",
        body="""
            SELECT DISTINCT s.oid FROM schedule s
            JOIN presc_schedule b ON b.shedule_id = s.oid
            JOIN presc r ON r.id = b.presc_id
            JOIN presc q ON q.mdoc_id = r.mdoc_id AND CAST(q.create_dt AS DATE) = CAST(s.starton AS DATE)
                        AND q.create_dt > s.starton""",
    ),
)
def join_same_day_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots after which the same patient file got another prescription that day. Only the last one of a
    file and day can decide, so slots meet one time instead of all of the day's prescriptions."""
    t = B.tables(spark, sf_dir)
    last = t["presc"].groupBy("mdoc_id", F.to_date("create_dt").alias("day")).agg(F.max("create_dt").alias("last"))
    slots = (
        t["presc_schedule"].select(F.col("shedule_id").alias("oid"), F.col("presc_id").alias("id"))
        .join(t["presc"].select("id", "mdoc_id"), "id")
        .join(t["schedule"].select("oid", "starton"), "oid")
        .select("oid", "mdoc_id", F.to_date("starton").alias("day"), "starton")
    )
    return slots.join(last, ["mdoc_id", "day"]).filter(F.col("last") > F.col("starton")).select("oid").distinct()


@query(
    "join_composite_key",
    B.with_tables(
        "web_events", "web_params",
        body="""
            SELECT e.watch_id, e.client_id, p.params FROM web_events e
            JOIN web_params p ON p.watch_id = e.watch_id AND p.date_time = e.date_time""",
    ),
)
def join_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    return t["web_events"].join(t["web_params"], ["watch_id", "date_time"]).select("watch_id", "client_id", "params")


@query(
    "array_membership_csv",
    B.with_tables(
        "schedule", "schedule_work_time", "presc_schedule",
        body="""
            SELECT s.oid, b.presctype FROM schedule s
            JOIN presc_schedule b ON b.shedule_id = s.oid
            JOIN schedule_work_time w ON w.oid = s.work_time
            WHERE b.presctype IN (SELECT unnest(string_split(w.presctype, ',')))""",
    ),
)
def array_membership_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    hours = t["schedule_work_time"].select(F.col("oid").alias("work_time"), F.col("presctype").alias("offered"))
    bookings = t["presc_schedule"].select(F.col("shedule_id").alias("oid"), "presctype")
    slots = t["schedule"].select("oid", "work_time").join(bookings, "oid").join(hours, "work_time")
    return slots.filter(scalars.csv_has(F.col("offered"), F.col("presctype"))).select("oid", "presctype")


@query(
    "join_padded_key",
    B.with_tables(
        "finance_plan", "visit",
        body="""
            SELECT f.oid, v.pay_type_id FROM finance_plan f JOIN visit v ON rpad(v.id, 36, ' ') = rpad(f.visit, 36, ' ')
            WHERE f.fixed""",
    ),
)
def join_padded_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    plans = t["finance_plan"].filter("fixed").select("oid", scalars.padded(F.col("visit")).alias("visit"))
    visits = t["visit"].select(scalars.padded(F.col("id")).alias("visit"), "pay_type_id")
    return plans.join(visits, "visit").select("oid", "pay_type_id")


# --- aggregates -----------------------------------------------------------------------------------


@query(
    "agg_min_max",
    f"SELECT user_id, {time('min(ts)', 'first')}, {time('max(ts)', 'last')}, max(event_id) AS top FROM events GROUP BY user_id",
)
def agg_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.max("event_id").alias("top")
    )


@query(
    "agg_discounts",
    B.with_tables(
        "discount_presc", "discount",
        body=f"""
            SELECT a.presc_service AS line, {number('sum(coalesce(a.percent, b.percent))', 'percent')},
                   {number('sum(a.fix_sum)', 'fix_sum')}
            FROM discount_presc a LEFT JOIN discount b ON b.oid = a.discount GROUP BY a.presc_service""",
    ),
)
def agg_discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    return revenue.discounts(t, t["discount_presc"].select(F.col("presc_service").alias("line")).distinct())


@query(
    "agg_global",
    f"""
    SELECT count(*) AS orders, {number('sum(CAST(o_totalprice AS DECIMAL(18,2)))', 'total')},
           CAST(round(avg(o_orderkey), 4) AS DOUBLE) AS mean_key, {time('max(o_orderdate)', 'last')} FROM orders""",
)
def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        F.round(F.avg("o_orderkey"), 4).alias("mean_key"),
        F.max("o_orderdate").alias("last"),
    )


@query(
    "agg_empty_zero",
    """
    SELECT CAST(coalesce(sum(o_totalprice) FILTER (o_orderdate < DATE '1900-01-01'), 0) AS DOUBLE) AS total,
           CAST(coalesce(avg(o_totalprice) FILTER (o_orderdate < DATE '1900-01-01'), 0) AS DOUBLE) AS mean,
           count(*) AS orders
    FROM orders""",
)
def agg_empty_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = F.when(F.col("o_orderdate") < F.lit(date(1900, 1, 1)), F.col("o_totalprice"))
    return B.table(spark, sf_dir, "orders").agg(
        F.coalesce(F.sum(early), F.lit(0.0)).alias("total"),
        F.coalesce(F.avg(early), F.lit(0.0)).alias("mean"),
        F.count(F.lit(1)).alias("orders"),
    )


@query(
    "count_distinct_users",
    B.with_tables(
        "history",
        body="""
            SELECT product, count(DISTINCT coalesce(CAST(internal_user_id AS VARCHAR),
                                                    source || ':' || external_user_id)) AS users
            FROM history GROUP BY product""",
    ),
)
def count_distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    anonymous = F.concat(F.col("source"), F.lit(":"), F.col("external_user_id"))
    person = F.coalesce(F.col("internal_user_id").cast("string"), anonymous)
    return B.tables(spark, sf_dir)["history"].groupBy("product").agg(F.count_distinct(person).alias("users"))


@query(
    "agg_conditional",
    """
    SELECT o_custkey, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS signed,
           coalesce(CAST((2 * sum(o_orderkey) FILTER (o_orderstatus = 'F') * 100
                          + count(*) FILTER (o_orderstatus = 'F'))
                    // (2 * count(*) FILTER (o_orderstatus = 'F')) AS DOUBLE) / 100, 0) AS mean_signed
    FROM orders GROUP BY o_custkey""",
)
def agg_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = F.col("o_orderstatus") == "F"
    n = F.count_if(signed)
    mean = F.when(n > 0, scalars.quotient(F.sum(F.when(signed, F.col("o_orderkey"))), n)).otherwise(F.lit(0))
    return B.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("total"), n.alias("signed"), F.round(mean, 2).cast("decimal(18,2)").alias("mean_signed")
    )


@query(
    "agg_array_distinct",
    B.with_tables(
        "sotr", "staff_name", "post",
        body="""
            SELECT n.full_name, array_to_string(list_sort(list(DISTINCT o.name)), ',') AS posts
            FROM sotr w JOIN staff_name n ON n.sysuser = w.sysuser JOIN post o ON o.oid = w.post
            GROUP BY n.full_name""",
    ),
)
def agg_array_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    posts = t["post"].select(F.col("oid").alias("post"), "name")
    return t["sotr"].join(t["staff_name"], "sysuser").join(posts, "post").groupBy("full_name").agg(
        F.sort_array(F.collect_set("name")).alias("posts")
    )


@query(
    "distinct_rows",
    B.with_tables(
        "finance_plan_presc_service", "finance_plan",
        body="""
            SELECT DISTINCT f.visit, f.fixed FROM finance_plan_presc_service x
            JOIN finance_plan f ON f.oid = x.finance_plan""",
    ),
)
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    plans = t["finance_plan"].select(F.col("oid").alias("finance_plan"), "visit", "fixed")
    return t["finance_plan_presc_service"].join(plans, "finance_plan").select("visit", "fixed").distinct()


@query("latest_month", f"SELECT {day('max(month)', 'month')} FROM ({B.SQL['revenue_kpi']})")
def latest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.tables(spark, sf_dir)["revenue_kpi"].agg(F.max("month").alias("month"))


# --- scalars --------------------------------------------------------------------------------------


@query(
    "scalar_string",
    """
    SELECT p_partkey, lower(p_type) AS lowered, p_brand || ':' || p_partkey AS joined,
           CASE WHEN p_partkey % 3 <> 0 THEN p_name || ':' || p_type END AS null_aware,
           replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS comma,
           contains(p_name, 'ring') AS has_ring
    FROM part""",
)
def scalar_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.when(F.col("p_partkey") % 3 != 0, F.col("p_type"))
    return B.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lower("p_type").alias("lowered"),
        F.concat("p_brand", F.lit(":"), F.col("p_partkey").cast("string")).alias("joined"),
        F.concat("p_name", F.lit(":"), tail).alias("null_aware"),
        scalars.decimal_comma(F.col("p_retailprice").cast("decimal(12,2)")).alias("comma"),
        F.col("p_name").contains("ring").alias("has_ring"),
    )


@query(
    "scalar_split_list",
    B.with_tables(
        "schedule_work_time", "presctype",
        body="""
            SELECT p_partkey, array_to_string(items, '|') AS items, len(items) AS n
            FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN [] ELSE
                         string_split(replace(p_name || ', ' || p_brand || ',' || p_type, ' ', ''), ',') END AS items
                  FROM part)""",
    ),
)
def scalar_split_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks go, an empty text is an empty list."""
    text = F.concat("p_name", F.lit(", "), "p_brand", F.lit(","), "p_type")
    items = scalars.split_list(F.when(F.col("p_partkey") % 7 == 0, "").otherwise(text))
    return B.table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(items, "|").alias("items"), F.size(items).alias("n")
    )


@query(
    "scalar_date",
    f"""
    SELECT event_id, {day('CAST(ts AS DATE)', 'day')}, {day("date_trunc('month', ts)", 'month')},
           strftime(ts, '%Y-%m-%d') AS text, {day("CAST(ts AS DATE) + 1", 'next_day')},
           {day("CAST(strptime(strftime(ts, '%d.%m.%Y'), '%d.%m.%Y') AS DATE)", 'parsed')}
    FROM events""",
)
def scalar_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "events").select(
        "event_id",
        F.to_date("ts").alias("day"),
        periods.month_of("ts").alias("month"),
        F.date_format("ts", "yyyy-MM-dd").alias("text"),
        F.date_add(F.to_date("ts"), 1).alias("next_day"),
        F.to_date(F.date_format("ts", "dd.MM.yyyy"), "dd.MM.yyyy").alias("parsed"),
    )


@query(
    "scalar_lead_days",
    B.with_tables(
        "schedule", "schedule_log",
        body="""
            SELECT s.oid, g.operator,
                   CAST(sign(d) * ((200 * abs(d) + 86400) // 172800) AS DOUBLE) / 100 AS days
            FROM (SELECT *, date_diff('second', operation_date_time, starton) AS d
                  FROM schedule_log JOIN schedule ON oid = schedule) s
            JOIN (SELECT DISTINCT operator FROM schedule_log) g ON g.operator = s.operator""",
    ),
)
def scalar_lead_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    log = t["schedule_log"].select(F.col("schedule").alias("oid"), "operator", "operation_date_time")
    return t["schedule"].select("oid", "starton").join(log, "oid").select(
        "oid", "operator", scalars.lead_days(F.col("starton"), F.col("operation_date_time")).alias("days")
    )


@query(
    "scalar_months",
    f"""
    SELECT o_orderkey, {day("date_trunc('month', o_orderdate) + INTERVAL 1 MONTH", 'next')},
           {day("date_trunc('month', o_orderdate) - INTERVAL 1 MONTH", 'previous')},
           {day('last_day(o_orderdate)', 'month_end')}
    FROM orders""",
)
def scalar_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = periods.month_of("o_orderdate")
    return B.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.add_months(month, 1).alias("next"),
        F.add_months(month, -1).alias("previous"),
        F.last_day(F.to_date("o_orderdate")).alias("month_end"),
    )


@query(
    "scalar_null",
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id ELSE event_id END AS first_set,
           CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS not_view,
           CASE WHEN event_id % 3 = 0 THEN greatest(event_id, user_id) ELSE event_id END AS larger
    FROM events""",
)
def scalar_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger of two skips a missing one."""
    some = F.when(F.col("event_id") % 3 == 0, F.col("user_id"))
    return B.table(spark, sf_dir, "events").select(
        "event_id",
        F.coalesce(some, F.col("event_id")).alias("first_set"),
        F.nullif("event_type", F.lit("view")).alias("not_view"),
        F.greatest(F.col("event_id"), some).alias("larger"),
    )


@query(
    "ratio_decimal_comma",
    """
    SELECT o_custkey,
           CASE WHEN whole = 0 THEN '0,00' ELSE
               CAST(h // 100 AS VARCHAR) || ',' || lpad(CAST(h % 100 AS VARCHAR), 2, '0') END AS share
    FROM (SELECT *, CASE WHEN whole > 0 THEN (200 * part + whole) // (2 * whole) END AS h
          FROM (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS part,
                       count(*) FILTER (o_orderstatus <> 'O') AS whole
                FROM orders GROUP BY o_custkey))""",
)
def ratio_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return B.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        scalars.decimal_comma(scalars.safe_ratio(F.count_if(status == "F"), F.count_if(status != "O"))).alias("share")
    )


@query(
    "json_safe_extract",
    B.with_tables(
        "web_params",
        body="""
            SELECT watch_id, CASE WHEN json_valid(params)
                             THEN TRY_CAST(json_extract_string(params, '$.k') AS BIGINT) END AS user_id
            FROM web_params""",
    ),
)
def json_safe_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = B.tables(spark, sf_dir)["web_params"]
    return params.select("watch_id", scalars.user_id_from_json(F.col("params"), B.USER_ID_PATH).alias("user_id"))


@query(
    "scalar_casts",
    """
    SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS part_text,
           TRY_CAST(l_returnflag || l_linenumber AS BIGINT) AS bad_number,
           TRY_CAST(CAST(l_suppkey AS VARCHAR) AS BIGINT) AS good_number,
           TRY_CAST(CASE WHEN l_linestatus = 'F' THEN 'true' ELSE 'maybe' END AS BOOLEAN) AS flag,
           CAST(CAST(l_quantity AS DECIMAL(18,4)) AS DOUBLE) AS quantity
    FROM lineitem""",
)
def scalar_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_linestatus") == "F", "true").otherwise("maybe")
    return B.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").cast("string").alias("part_text"),
        F.concat("l_returnflag", F.col("l_linenumber").cast("string")).try_cast("bigint").alias("bad_number"),
        F.col("l_suppkey").cast("string").try_cast("bigint").alias("good_number"),
        flag.try_cast("boolean").alias("flag"),
        F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
    )
