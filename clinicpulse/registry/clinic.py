"""Revenue, appointments, year-on-year changes, the no-show report, and upkeep."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinicpulse import bindings as B
from clinicpulse.functions.periods import Months
from clinicpulse.operators import staging, upsert
from clinicpulse.params import AppointmentParams, ReportParams, RevenueParams
from clinicpulse.plans import appointments, noshow, revenue, upkeep, yoy
from clinicpulse.registry.analytics import monthly_sql, months_sql
from clinicpulse.registry.base import day, number, query, time

# --- revenue --------------------------------------------------------------------------------------

REVENUE_MONTHS = Months(date(1995, 1, 1), date(2002, 1, 1))
REVENUE_PARAMS = RevenueParams(as_of=date(1998, 6, 1), sysuser=B.ONLINE_SYSUSER)
REVENUE_TABLES = (
    "people", "mdoc", "presc", "presc_service", "service_presctype", "services", "sotr", "sysuser",
    "finance_plan_presc_service", "finance_plan", "visit", "discount_presc", "discount", "price",
)

LINES = """
    SELECT ps.oid, ps.presc, CAST(date_trunc('month', r.upd_dt) AS DATE) AS month
    FROM presc_service ps
    JOIN presc r ON r.id = ps.presc
    JOIN mdoc m ON m.id = r.mdoc_id
    JOIN people h ON h.oid = m.people_id
    JOIN service_presctype k ON k.oid = ps.service_presctype
    JOIN services v ON v.oid = k.service
    WHERE r.presc_state_id IN ('sign', 'done_lab', 'done', 'done_other_lpu')
      AND v.pay_type NOT IN ('sp_budget', 'budget')
      AND r.creator_id IN (SELECT w.oid FROM sotr w JOIN sysuser u ON u.oid = w.sysuser WHERE u.oid = 'u3')"""

IN_PLAN = """
    SELECT DISTINCT x.presc_service
    FROM finance_plan_presc_service x, finance_plan f, visit v
    WHERE x.finance_plan = f.oid AND f.visit = v.id AND v.pay_type_id = 'cash' AND f.fixed
      AND DATE '1998-06-01' >= f.date_begin AND DATE '1998-06-01' <= f.date_end"""

OFF = """
    SELECT a.presc_service, CAST(sum(coalesce(a.percent, b.percent)) AS DECIMAL(9,4)) AS pct,
           CAST(sum(a.fix_sum) AS DECIMAL(18,4)) AS fix
    FROM discount_presc a LEFT JOIN discount b ON b.oid = a.discount GROUP BY a.presc_service"""

COST = """
    SELECT l.month, l.oid, p.base_price,
           CASE WHEN l.oid IN (SELECT presc_service FROM in_plan) THEN NULL ELSE o.pct END AS pct,
           p.base_price - p.base_price * o.pct * CAST(0.01 AS DECIMAL(3,2)) - coalesce(o.fix, 0) AS reduced
    FROM lines l
    LEFT JOIN off o ON o.presc_service = l.oid
    LEFT JOIN price p ON p.presc_id = l.presc AND p.presc_service_oid = l.oid"""


def revenue_sql(rounding: str) -> str:
    return B.with_tables(
        *REVENUE_TABLES,
        lines=LINES,
        in_plan=IN_PLAN,
        off=OFF,
        cost=COST,
        spine=months_sql("1995-01-01", "2002-01-01"),
        per_month=f"""
            SELECT month, sum(CASE WHEN pct IS NULL THEN base_price
                                   ELSE CAST({rounding} AS DECIMAL(18,4)) END) AS total
            FROM cost GROUP BY month""",
        body=f"""
            SELECT {day('spine.month', 'month')}, {number('coalesce(total, 0)', 'revenue')}
            FROM spine LEFT JOIN per_month USING (month)""",
    )


def monthly_revenue(setting: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return revenue.monthly(B.tables(spark, sf_dir, rounding=setting), REVENUE_MONTHS, REVENUE_PARAMS)

    return build


query("revenue_month", revenue_sql("round(reduced, 2)"))(monthly_revenue("exact"))
query("revenue_rounding_ceil", revenue_sql("ceil(reduced)"))(monthly_revenue("1"))
query("revenue_rounding_trunc", revenue_sql("trunc(reduced)"))(monthly_revenue("2"))
query("revenue_rounding_int", revenue_sql("round(reduced, 0)"))(monthly_revenue("3"))


# Percents of eight decimals, and two setting rows that both round to cents, so every month counts twice.
LONG_PERCENTS = """
    SELECT <line> AS presc_service, 'd' || (l_partkey % 12) AS discount,
           CAST(CAST(l_discount * 100 AS DECIMAL(9,2)) AS DECIMAL(18,8)) + CAST(0.33333333 AS DECIMAL(18,8)) AS percent,
           CASE WHEN l_tax <> 0 THEN CAST(l_tax * 10 AS DECIMAL(18,4)) END AS fix_sum
    FROM lineitem WHERE l_returnflag <> 'A'"""
TWO_SETTINGS = """
    SELECT CASE WHEN r_regionkey < 2 THEN 'DiscountAmountRounding' ELSE r_name END AS param,
           CASE r_regionkey WHEN 0 THEN '0' ELSE 'exact' END AS valuepar
    FROM region"""


@query(
    "revenue_rounding_cents",
    B.with_tables(
        *[n for n in REVENUE_TABLES if n != "discount_presc"],
        discount_presc=B.in_duckdb(LONG_PERCENTS),
        settings=TWO_SETTINGS,
        lines=LINES,
        in_plan=IN_PLAN,
        off=OFF.replace("DECIMAL(9,4)", "DECIMAL(14,8)"),
        # Wide enough for the longer product.
        cost=COST.replace("p.base_price * o.pct", "CAST(p.base_price AS DECIMAL(24,4)) * o.pct"),
        spine=months_sql("1995-01-01", "2002-01-01"),
        per_month="""
            SELECT month, sum(CASE WHEN pct IS NULL THEN base_price
                                   ELSE CAST(round(reduced, 2) AS DECIMAL(18,4)) END) AS total
            FROM cost, settings WHERE param = 'DiscountAmountRounding' GROUP BY month""",
        body=f"""
            SELECT {day('spine.month', 'month')}, {number('coalesce(total, 0)', 'revenue')}
            FROM spine LEFT JOIN per_month USING (month)""",
    ),
)
def revenue_rounding_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.Tables(spark, sf_dir, discount_presc=LONG_PERCENTS, systemsettings=TWO_SETTINGS)
    return revenue.monthly(t, REVENUE_MONTHS, REVENUE_PARAMS)


# --- appointments ---------------------------------------------------------------------------------

VISIT_MONTHS = Months(date(1995, 1, 1), date(2002, 1, 1))
VISIT_PARAMS = AppointmentParams(sysuser=B.ONLINE_SYSUSER, call_center_posts=B.CALL_CENTER_POSTS)
VISIT_TABLES = ("presc", "presc_schedule", "schedule", "presctype", "schedule_work_time", "sotr")

CALL_CENTER = """
    SELECT CAST(date_trunc('month', r.create_dt) AS DATE) AS month, count(*) AS n
    FROM schedule s, presc_schedule b, presc r, presctype y, schedule_work_time w
    WHERE b.shedule_id = s.oid AND r.id = b.presc_id AND y.oid = b.presctype AND w.oid = s.work_time
      AND s.islocked = 0 AND w.insite = 1 AND y.time_cells IS NOT NULL
      AND r.creator_id IN (SELECT t.oid FROM sotr t JOIN post o ON o.oid = t.post WHERE o.oid IN ('po1', 'po4'))
      AND list_contains(string_split(w.presctype, ','), r.presctype_id)
      AND (list_contains(y.tags, 'CHILD') OR list_contains(y.tags, 'ADULT'))
    GROUP BY 1"""

FOUND = """
    SELECT r.create_dt, r.id AS appointment_id
    FROM schedule s, presc_schedule b, presc r, presctype y, schedule_work_time w
    WHERE b.shedule_id = s.oid AND r.id = b.presc_id AND y.oid = b.presctype AND w.oid = s.work_time
      AND r.creator_id IN (SELECT t.oid FROM sotr t JOIN sysuser u ON u.oid = t.sysuser WHERE u.oid = 'u3')"""

LATEST = """
    SELECT appointment_oid AS appointment_id, source
    FROM (SELECT *, row_number() OVER (PARTITION BY appointment_oid
                                       ORDER BY updated_at DESC NULLS FIRST, source DESC) AS nth
          FROM appointment_record WHERE CAST(created_at AS DATE) > DATE '1995-06-01')
    WHERE nth = 1"""


@query(
    "call_center_count",
    B.with_tables(
        *VISIT_TABLES, "post",
        spine=months_sql("1995-01-01", "2002-01-01"),
        body=f"SELECT month, 'call_center' AS source, count FROM ({monthly_sql(CALL_CENTER)})",
    ),
)
def call_center_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return appointments.call_center(B.tables(spark, sf_dir), VISIT_MONTHS, VISIT_PARAMS)


@query(
    "online_appointments",
    B.with_tables(
        *VISIT_TABLES, "sysuser",
        found=FOUND,
        body=f"""
            SELECT DISTINCT appointment_id, {time('create_dt')} FROM found
            WHERE create_dt >= DATE '1997-01-01'""",
    ),
)
def online_appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored up to February 1997, reloaded from 1996 on: only appointments not stored yet come out."""
    t = B.tables(spark, sf_dir)
    stored = appointments.online(t, Months(date(1995, 1, 1), date(1997, 1, 1)), VISIT_PARAMS)
    found = appointments.online(t, Months(date(1996, 1, 1), date(2002, 1, 1)), VISIT_PARAMS)
    return appointments.new_online(stored, found)


@query(
    "latest_per_key",
    B.with_tables("appointment_record", body=LATEST),
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return appointments.latest_source(B.tables(spark, sf_dir)["appointment_record"], date(1995, 6, 1))


@query(
    "online_ratio",
    B.with_tables(
        *VISIT_TABLES, "post", "sysuser", "appointment_record",
        rates=f"""
            SELECT month, n, 0 AS online FROM ({CALL_CENTER})
            UNION ALL
            SELECT CAST(date_trunc('month', f.create_dt) AS DATE), count(*), count(*)
            FROM (SELECT DISTINCT create_dt, appointment_id FROM ({FOUND})) f
            JOIN ({LATEST}) l USING (appointment_id) WHERE l.source = 'ONLINE_BOOKING' GROUP BY 1""",
        spine=months_sql("1995-01-01", "2002-01-01"),
        body=f"""
            SELECT {day('spine.month', 'month')},
                   CASE WHEN coalesce(sum(n), 0) = 0 THEN 0.0
                        ELSE CAST((2 * 10000 * sum(online) + sum(n)) // (2 * sum(n)) AS DOUBLE) / 10000 END
                        AS ratio_online_to_total
            FROM spine LEFT JOIN rates USING (month) GROUP BY spine.month""",
    ),
)
def online_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.tables(spark, sf_dir)
    found = appointments.online(t, VISIT_MONTHS, VISIT_PARAMS)
    loaded = upsert.first_per_key(found, ["appointment_id"], ["create_dt"])
    channels = appointments.by_channel(
        appointments.with_channel(loaded, appointments.latest_source(t["appointment_record"], date(1995, 6, 1)))
    )
    calls = appointments.call_center(t, VISIT_MONTHS, VISIT_PARAMS)
    return appointments.online_ratio(channels.unionByName(calls))


# --- year on year ---------------------------------------------------------------------------------


@query(
    "yoy_revenue",
    B.with_tables(
        "revenue_kpi",
        body="""
            SELECT 2001 AS year, 'revenue' AS kpi,
                   CAST(coalesce(sum(revenue) FILTER (month >= DATE '2001-01-01'), 0)
                        - coalesce(sum(revenue) FILTER (month BETWEEN DATE '2000-01-01' AND DATE '2000-08-01'), 0)
                        AS DOUBLE) AS value
            FROM revenue_kpi""",
    ),
)
def yoy_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yoy.revenue(B.tables(spark, sf_dir)["revenue_kpi"])


@query(
    "yoy_ratio",
    B.with_tables(
        "ratio_kpi",
        body="""
            SELECT 2001 AS year, 'ratio' AS kpi,
                   CAST(round((avg(ratio_e4) FILTER (month >= DATE '2001-01-01')
                        - avg(ratio_e4) FILTER (month BETWEEN DATE '2000-01-01' AND DATE '2000-08-01')) / 10000, 4)
                        AS DOUBLE) AS value
            FROM ratio_kpi""",
    ),
)
def yoy_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = B.tables(spark, sf_dir)["ratio_kpi"]
    ratio = (F.col("ratio_e4") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(9,4)")
    return yoy.ratio(stored.select("month", ratio.alias("ratio_online_to_total")))


# --- no-show report -------------------------------------------------------------------------------

REPORT = ReportParams(date(1996, 1, 1), date(1999, 12, 31))
REPORT_TABLES = (
    "schedule", "schedule_log", "presc_schedule", "presc", "visit", "presctype", "presctypefolder", "mdoc",
    "people", "pinfo", "sotr",
)
REPORT_WHERE = "s.work_mode <> 'WorkTimeCabinet' AND v.pay_type_id IN ('cash', 'dms')"


def visits_sql(where: str) -> str:
    return f"""
        SELECT DISTINCT g.operator AS sotr_oid, r.id AS presc_oid, s.lpu AS lpu_oid,
               coalesce(s.sysuser, w.sysuser) AS doc_sysuser_oid, r.presc_state_id AS presc_state,
               g.presctype AS presctype_oid, g.operation_date_time AS create_date_time,
               s.starton AS schedule_date_time, h.oid AS people_oid, m.id AS mdoc_oid, n.auto_notification,
               h.account_id
        FROM schedule_log g
        JOIN schedule s ON s.oid = g.schedule
        JOIN presc_schedule b ON b.id = g.presc_schedule
        JOIN presc r ON r.id = b.presc_id
        JOIN visit v ON v.id = r.visit_id
        JOIN presctype y ON y.oid = g.presctype
        JOIN presctypefolder f ON f.id = y.presctypefolderid_parent
        JOIN mdoc m ON m.id = r.mdoc_id
        JOIN people h ON h.oid = m.people_id
        LEFT JOIN pinfo n ON n.oid = h.oid
        LEFT JOIN sotr w ON w.oid = s.sotr
        WHERE g.action = 1 AND s.blockreason IS NULL AND g.operation_date_time < s.starton
          AND CAST(s.starton AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND {where}"""


VISITS = visits_sql(REPORT_WHERE)
VISIT_COLUMNS = (
    "sotr_oid, presc_oid, lpu_oid, doc_sysuser_oid, presc_state, presctype_oid, "
    f"{time('create_date_time')}, {time('schedule_date_time')}, people_oid, mdoc_oid, auto_notification, account_id"
)
ALTERNATES = """
    SELECT DISTINCT v.presc_oid
    FROM visits v
    JOIN presc r ON r.mdoc_id = v.mdoc_oid AND CAST(r.create_dt AS DATE) = CAST(v.schedule_date_time AS DATE)
    JOIN sotr w ON w.oid = r.creator_id AND w.sysuser = v.doc_sysuser_oid
    WHERE r.presc_state_id IN ('sign', 'done_lab') AND r.create_dt > v.schedule_date_time
      AND NOT EXISTS (SELECT 1 FROM presc_schedule b WHERE b.presc_id = r.id)"""
SEEN = """
    SELECT DISTINCT m.people_id AS people_oid
    FROM presc r JOIN mdoc m ON m.id = r.mdoc_id
    WHERE r.presc_state_id IN ('sign', 'done_lab') AND r.id NOT IN (SELECT presc_oid FROM visits)"""
# Lead time in hundredths of a day, rounded half up in whole numbers.
PIVOT = """
    SELECT CAST(schedule_date_time AS DATE) AS schedule_date, sotr_oid, presc_oid, lpu_oid,
           presc_oid IN (SELECT presc_oid FROM alternates) OR presc_state IN ('sign', 'done_lab') AS is_signed,
           presc_state IN ('sign', 'done_lab') AS state_signed, presctype_oid,
           (200 * date_diff('second', create_date_time, schedule_date_time) + 86400) // 172800 AS depth,
           account_id IS NOT NULL AS has_lk, coalesce(auto_notification, false) AS auto,
           people_oid NOT IN (SELECT people_oid FROM seen) AS is_first_visit
    FROM visits"""


def _side(name: str, test: str) -> str:
    return f"""
        sum(depth) FILTER ({test}) AS {name}_days, count(depth) FILTER ({test}) AS {name}_n,
        count(*) FILTER ({test} AND auto) AS {name}_auto, count(*) FILTER ({test} AND has_lk) AS {name}_has_lk,
        count(*) FILTER ({test} AND is_first_visit) AS {name}_is_first_visit"""


TOTALS = f"""
    SELECT v.schedule_date, g.fullname AS lpu, n.full_name AS doctor_name,
           list_sort(list(DISTINCT o.name)) AS post_names, count(*) AS total,
           count(*) FILTER (is_signed) AS signed, count(*) FILTER (NOT is_signed) AS no_show,
           {_side('signed', 'state_signed')}, {_side('no_show', 'NOT state_signed')}
    FROM marked v
    JOIN sotr w ON w.oid = v.sotr_oid
    JOIN lpu_geo g ON g.oid = v.lpu_oid
    JOIN post o ON o.oid = w.post
    LEFT JOIN staff_name n ON n.sysuser = w.sysuser
    GROUP BY v.schedule_date, g.fullname, n.full_name"""


def mean_sql(side: str) -> str:
    """Average lead time in hundredths of a day, half up; NULL for no visits."""
    return f"CAST((2 * {side}_days + {side}_n) // (2 * {side}_n) AS BIGINT)"


def text_sql(hundredths: str) -> str:
    return f"CAST({hundredths} // 100 AS VARCHAR) || ',' || lpad(CAST({hundredths} % 100 AS VARCHAR), 2, '0')"


def share_sql(part: str, whole: str, name: str) -> str:
    hundredths = f"CAST((200 * {part} + {whole}) // (2 * {whole}) AS BIGINT)"
    return f"CASE WHEN {whole} = 0 THEN '0,00' ELSE {text_sql(hundredths)} END AS {name}"


def details_sql(side: str) -> str:
    shares = [
        share_sql(f"{side}_{part}", side, f"{side}_{name}_pct")
        for part, name in (("auto", "auto"), ("has_lk", "has_lk"), ("is_first_visit", "is_first"))
    ]
    return (
        f"CASE WHEN {side}_n = 0 THEN '0' ELSE {text_sql(mean_sql(side))} END AS {side}_depth_in_days, "
        + ", ".join(shares)
    )


# The words that tell the class of a post, in the order they are tried.
CLASS_WORDS = [
    ("Онлайн-запись", ["медицинский регистратор", "самозапись"]), ("врач", ["врач"]),
    ("оператор", ["оператор"]), ("администратор", ["администратор"]), ("медсестра/брат", ["сестра", "брат"]),
    ("менеджер", ["менеджер"]), ("лаборант", ["лаборант"]), ("акушер", ["акушер"]),
]


def class_sql(names: str) -> str:
    text = f"lower(list_aggregate({names}, 'string_agg', '|'))"
    cases = " ".join(
        f"WHEN {' OR '.join(f'contains({text}, {chr(39)}{w}{chr(39)})' for w in ws)} THEN '{label}'"
        for label, ws in CLASS_WORDS
    )
    return f"CASE {cases} ELSE 'остальные' END"


def report_sql(body: str, *more: str) -> str:
    return B.with_tables(
        *REPORT_TABLES, *more, visits=VISITS, alternates=ALTERNATES, seen=SEEN, marked=PIVOT, body=body
    )


TOTAL_TABLES = ("lpu_geo", "post", "staff_name")


def staged_visits(spark: SparkSession, sf_dir: str):
    t = B.tables(spark, sf_dir)
    return staging.stage(noshow.base(t, REPORT), "no-show-visits"), t


@query("no_show_base", B.with_tables(*REPORT_TABLES, visits=VISITS, body=f"SELECT {VISIT_COLUMNS} FROM visits"))
def no_show_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noshow.base(B.tables(spark, sf_dir), REPORT)


@query(
    "filter_optional_params",
    B.with_tables(
        *REPORT_TABLES,
        visits=visits_sql("""
            s.lpu IN ('l1', 'l5', 'l8', 'l12') AND NOT contains(g.commentary, 'ДМС')
            AND y.presctypefolderid_parent <> 'f1' AND g.presctype NOT IN ('pt2', 'pt6')"""),
        body=f"SELECT {VISIT_COLUMNS} FROM visits",
    ),
)
def filter_optional_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other way round of every filter: room schedules and pay types open, the rest set."""
    chosen = ReportParams(
        REPORT.date_start, REPORT.date_end, pay_types=(), site_group=2, is_online_dms=False,
        exclude_folders=("f1",), exclude_presctypes=("pt2", "pt6"), exclude_cabinet=False,
        site_groups=((1, ("l0",)), (2, ("l1", "l5", "l8", "l12"))),
    )
    return noshow.base(B.tables(spark, sf_dir), chosen)


@query("no_show_alt_signed", report_sql("SELECT presc_oid FROM alternates"))
def no_show_alt_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits, t = staged_visits(spark, sf_dir)
    return noshow.alt_signed(visits, t, REPORT)


@query(
    "no_show_first_visit",
    report_sql("""
        SELECT people_oid, people_oid NOT IN (SELECT people_oid FROM seen) AS is_first_visit
        FROM (SELECT DISTINCT people_oid FROM visits)"""),
)
def no_show_first_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits, t = staged_visits(spark, sf_dir)
    known = noshow.seen_before(visits, t, REPORT).withColumn("known", F.lit(True))
    people = visits.select("people_oid").distinct()
    return people.join(known, "people_oid", "left").select(
        "people_oid", F.col("known").isNull().alias("is_first_visit")
    )


@query(
    "no_show_flags",
    report_sql(f"""
        SELECT {day('schedule_date')}, sotr_oid, presc_oid, lpu_oid, is_signed, state_signed, presctype_oid,
               CAST(depth AS DOUBLE) / 100 AS depth, has_lk, auto, is_first_visit
        FROM marked"""),
)
def no_show_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits, t = staged_visits(spark, sf_dir)
    return noshow.flags(visits, t, REPORT)


@query(
    "no_show_totals",
    report_sql(
        f"""
        SELECT {day('schedule_date')}, lpu, doctor_name, array_to_string(post_names, ',') AS post_names, total,
               signed, no_show,
               CASE WHEN signed_n > 0 THEN CAST({mean_sql('signed')} AS DOUBLE) / 100 END AS signed_depth,
               signed_auto, signed_has_lk, signed_is_first_visit,
               CASE WHEN no_show_n > 0 THEN CAST({mean_sql('no_show')} AS DOUBLE) / 100 END AS no_show_depth,
               no_show_auto, no_show_has_lk, no_show_is_first_visit
        FROM ({TOTALS})""",
        *TOTAL_TABLES,
    ),
)
def no_show_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits, t = staged_visits(spark, sf_dir)
    return noshow.totals(noshow.flags(visits, t, REPORT), t)


@query(
    "no_show_report",
    report_sql(
        f"""
        SELECT {day('schedule_date', 'date')}, lpu, {class_sql('post_names')} AS key_post_name,
               array_to_string(post_names, ',') AS post_names, doctor_name, total, signed AS signed_count,
               {share_sql('signed', 'total', 'signed_pct')}, no_show AS no_show_count,
               {share_sql('no_show', 'total', 'no_show_pct')}, {details_sql('signed')}, {details_sql('no_show')}
        FROM ({TOTALS})""",
        *TOTAL_TABLES,
    ),
)
def no_show_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noshow.report(B.tables(spark, sf_dir), REPORT)


@query(
    "classify_post",
    B.with_tables(
        "post", "sotr", "staff_name",
        body=f"""
            SELECT doctor_name, {class_sql('names')} AS key_post_name
            FROM (SELECT n.full_name AS doctor_name, list(DISTINCT o.name) AS names
                  FROM sotr w JOIN post o ON o.oid = w.post JOIN staff_name n ON n.sysuser = w.sysuser
                  GROUP BY n.full_name, w.post)""",
    ),
)
def classify_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (name, post) pair among the staff, classed by that post alone."""
    t = B.tables(spark, sf_dir)
    posts = t["post"].select(F.col("oid").alias("post"), "name")
    grouped = t["sotr"].join(posts, "post").join(t["staff_name"], "sysuser").groupBy("full_name", "post").agg(
        F.collect_set("name").alias("names")
    )
    return grouped.select(
        F.col("full_name").alias("doctor_name"), noshow.post_class(F.col("names")).alias("key_post_name")
    )


# --- upkeep ---------------------------------------------------------------------------------------

UPKEEP_TABLES = ("customer", "orders", "lineitem", "events")


@query(
    "catalog_tables",
    " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {n}" for n in UPKEEP_TABLES),
)
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test tables put into a catalog schema of their own, listed, analysed, and reported with the row
    counts the catalog then has."""
    schema, hidden = (f"upkeep_{uuid.uuid4().hex}" for _ in range(2))
    for name in (schema, hidden):
        spark.sql(f"CREATE DATABASE {name}")
    try:
        for name in UPKEEP_TABLES:
            spark.catalog.createTable(f"{schema}.{name}", f"{sf_dir}/{name}.parquet", "parquet")
        spark.catalog.createTable(f"{hidden}.left_out", f"{sf_dir}/nation.parquet", "parquet")
        others = [d.name for d in spark.catalog.listDatabases() if d.name != schema]
        listed = upkeep.sweep(spark, exclude=others)
        rows = [(name.removeprefix(f"{schema}."), upkeep.row_count(spark, name)) for name in listed]
    finally:
        for name in (schema, hidden):
            spark.sql(f"DROP DATABASE {name} CASCADE")
    return spark.createDataFrame(rows, "table string, rows bigint")


@query(
    "maintain_tables",
    " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", count(*) AS rows, true AS fewer_files FROM {n}" for n in UPKEEP_TABLES
    ),
)
def maintain_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables scattered over many small files, swept: the catalog then points to fewer files and lost no row."""
    schema, parts = f"upkeep_{uuid.uuid4().hex}", []
    spark.sql(f"CREATE DATABASE {schema}")
    try:
        for name in UPKEEP_TABLES:
            scattered = staging.new_folder(spark, f"scattered-{name}")
            B.table(spark, sf_dir, name).repartition(32).write.parquet(scattered)
            spark.catalog.createTable(f"{schema}.{name}", scattered, "parquet")
        others = [d.name for d in spark.catalog.listDatabases() if d.name != schema]
        for name in upkeep.sweep(spark, exclude=others, merge_into=staging.new_folder(spark, "merged")):
            place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
            files = spark.read.parquet(place).select(F.col("_metadata.file_name").alias("file"))
            table = F.lit(name.removeprefix(f"{schema}.")).alias("table")
            parts.append(
                files.groupBy(table, "file").agg(F.count(F.lit(1)).alias("n")).groupBy("table").agg(
                    F.sum("n").alias("rows"), (F.count(F.lit(1)) < 32).alias("fewer_files")
                )
            )
    finally:
        spark.sql(f"DROP DATABASE {schema} CASCADE")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
