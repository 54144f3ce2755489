"""The jobs' input tables as projections of the test tables.

The clinic and analytics tables do not exist in the test data. Each is derived from whole test tables by one
SQL text, which both engines run; only the few constructs they spell differently are filled in per engine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

EVENT_DAYS = (date(2024, 1, 5), date(2024, 1, 25))
USER_ID_PATH = "$.k"
GOAL_PREFIX = "goal://site/"
ONLINE_SYSUSER = "u3"
CALL_CENTER_POSTS = ("po1", "po4")

POST_NAMES = (
    "Врач", "Администратор", "Медицинский регистратор", "Оператор", "Медсестра",
    "Менеджер", "Лаборант", "Акушерка", "Санитар",
)
_POSTS = ", ".join(f"'{n}'" for n in POST_NAMES)

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# What the two engines spell differently. Names in angle brackets stand for these in the texts below.
_DUCK = {
    "line": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER))",
    "created": "o_orderdate + to_seconds((o_orderkey * 7919) % 86400)",
    "slot": "o_orderdate + to_days(CAST(o_orderkey % 21 - 1 AS INTEGER)) + to_hours(9 + o_orderkey % 8)",
    "k": "CAST(json_extract_string(props, '$.k') AS BIGINT)",
    "post_name": f"list_extract([{_POSTS}], p_partkey % 9 + 1)",
    "child": "['CHILD', 'X']", "adult": "['ADULT']", "other": "['OTHER']",
    "per_10000": "sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 10000 ELSE 0 END) // count(*)",
    "month": "CAST(date_trunc('month', o_orderdate) AS DATE)",
}
_SPARK = {
    "line": "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),"
    " CAST(l_suppkey AS STRING), CAST(CAST(l_quantity AS INT) AS STRING))",
    "created": "timestampadd(SECOND, CAST(o_orderkey * 7919 % 86400 AS INT), o_orderdate)",
    "slot": "timestampadd(HOUR, CAST(24 * (o_orderkey % 21 - 1) + 9 + o_orderkey % 8 AS INT), o_orderdate)",
    "k": "CAST(get_json_object(props, '$.k') AS BIGINT)",
    "post_name": f"element_at(array({_POSTS}), CAST(p_partkey % 9 AS INT) + 1)",
    "child": "array('CHILD', 'X')", "adult": "array('ADULT')", "other": "array('OTHER')",
    "per_10000": "sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 10000 ELSE 0 END) div count(*)",
    "month": "trunc(o_orderdate, 'MM')",
}


def _later(engine: dict[str, str], time: str, unit: str, count: str) -> str:
    if engine is _SPARK:
        return f"timestampadd({unit}, CAST({count} AS INT), {time})"
    return f"{time} + to_{unit.lower()}s(CAST({count} AS INTEGER))"


def _spell(text: str, engine: dict[str, str]) -> str:
    """Fill in ``<name>``, and ``<name + count UNIT>`` for a time moved on."""
    text = re.sub(
        r"<(\w+) \+ ([^<>]+) (HOUR|DAY)>",
        lambda m: _later(engine, engine[m[1]], m[3], m[2]),
        text,
    )
    return re.sub(r"<(\w+)>", lambda m: engine[m[1]], text)


TEXTS: dict[str, str] = {
    # analytics
    "mobile_events": """
        SELECT CAST(event_id AS STRING) AS uuid,
               CASE WHEN k % 3 = 0 AND user_id % 5 <> 0 THEN k END AS profile_id,
               CASE WHEN event_id % 50 <> 0 THEN user_id END AS appmetrica_device_id,
               ts AS event_datetime, event_type AS event_name
        FROM (SELECT *, <k> AS k FROM events)""",
    "web_events": """
        SELECT event_id AS watch_id, user_id AS client_id, ts AS date_time,
               event_type = 'view' AS is_page_view,
               CASE WHEN event_type = 'error' THEN 'https://site/error'
                    ELSE 'goal://site/' || event_type END AS url
        FROM events""",
    "web_params": """
        SELECT event_id AS watch_id, ts AS date_time,
               CASE WHEN user_id % 5 = 0 OR k % 3 = 2 THEN '{}' WHEN k % 3 = 0 THEN props ELSE '{bad' END AS params
        FROM (SELECT *, <k> AS k FROM events)
        WHERE event_type <> 'signup'""",
    "allowed": "SELECT DISTINCT event_type FROM events WHERE event_type IN ('click', 'purchase')",
    # presence over several years
    "history": """
        SELECT CAST(o_orderdate AS DATE) AS activity_date,
               CASE WHEN o_orderkey % 4 = 0 THEN 'web_lk' WHEN o_orderkey % 4 = 1 THEN 'booking'
                    ELSE 'appmetrica' END AS source,
               CASE WHEN o_orderkey % 3 = 0 THEN 'lk' ELSE 'oz' END AS product,
               CASE WHEN o_orderkey % 4 < 2 THEN 'web' ELSE 'mobile' END AS platform,
               CASE WHEN o_custkey % 3 = 0 THEN o_custkey END AS internal_user_id,
               CASE WHEN o_orderkey % 37 <> 0 THEN CAST(o_custkey + 1 AS STRING) END AS external_user_id
        FROM orders""",
    # people and staff
    "people": """
        SELECT 'p' || c_custkey AS oid, CASE WHEN c_custkey % 3 = 0 THEN 'a' || c_custkey END AS account_id
        FROM customer""",
    "pinfo": """
        SELECT 'p' || c_custkey AS oid,
               CASE c_mktsegment WHEN 'BUILDING' THEN true WHEN 'MACHINERY' THEN false
                    WHEN 'HOUSEHOLD' THEN true END AS auto_notification
        FROM customer WHERE c_mktsegment <> 'FURNITURE'""",
    "mdoc": "SELECT 'm' || c_custkey AS id, 'p' || (c_custkey - c_custkey % 2) AS people_id FROM customer",
    "sotr": """
        SELECT 's' || s_suppkey AS oid, 'u' || s_suppkey AS sysuser, 'po' || (s_suppkey % 9) AS post
        FROM supplier""",
    "sysuser": "SELECT 'u' || s_suppkey AS oid FROM supplier",
    "staff_name": "SELECT 'u' || s_suppkey AS sysuser, 'Name ' || (s_suppkey % 7) AS full_name FROM supplier",
    "post": """
        SELECT DISTINCT 'po' || (p_partkey % 9) AS oid, <post_name> AS name
        FROM part""",
    "lpu_geo": "SELECT 'l' || n_nationkey AS oid, n_name AS fullname FROM nation",
    # prescriptions: one per order, and a later unbooked one for some orders
    "presc": """
        SELECT 'r' || o_orderkey AS id, 'm' || o_custkey AS mdoc_id, 'v' || o_orderkey AS visit_id,
               CASE WHEN o_custkey % 8 < 2 OR o_orderstatus = 'O' THEN 'new' WHEN o_orderstatus = 'F' THEN 'sign'
                    WHEN o_orderkey % 5 <> 0 THEN 'done_lab' END AS presc_state_id,
               'pt' || (o_orderkey % 20) AS presctype_id, 's' || (o_custkey % 10) AS creator_id,
               <created> AS create_dt, <created + o_orderkey % 40 DAY> AS upd_dt
        FROM orders
        UNION ALL
        SELECT 'w' || o_orderkey, 'm' || o_custkey, 'v' || o_orderkey,
               CASE WHEN o_custkey % 8 < 2 THEN 'new' ELSE 'sign' END, 'pt0',
               's' || ((o_orderkey + o_orderkey % 5 % 2) % 10), <slot + o_orderkey % 4 HOUR>, <slot>
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "visit": """
        SELECT 'v' || o_orderkey AS id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'cash' WHEN '5-LOW' THEN 'cash'
                    WHEN '2-HIGH' THEN 'dms' WHEN '3-MEDIUM' THEN 'oms' END AS pay_type_id
        FROM orders""",
    # schedule
    "schedule": """
        SELECT 'sl' || o_orderkey AS oid, 's' || (o_orderkey % 10) AS sotr,
               CASE WHEN o_orderkey % 4 = 0 THEN 'u' || (o_orderkey % 10) END AS sysuser,
               'l' || (o_custkey % 25) AS lpu, <slot> AS starton,
               CASE WHEN o_orderkey % 29 = 0 THEN 'repair' END AS blockreason,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS INTEGER) AS islocked,
               CASE o_orderkey % 13 WHEN 0 THEN 'WorkTimeCabinet' WHEN 1 THEN NULL ELSE 'WorkTime' END
                   AS work_mode,
               'wt' || (o_custkey % 40) AS work_time
        FROM orders""",
    "presc_schedule": """
        SELECT 'ps' || o_orderkey AS id, 'sl' || o_orderkey AS shedule_id,
               CASE WHEN o_orderkey % 17 <> 0 THEN 'r' || o_orderkey END AS presc_id,
               'pt' || (o_orderkey % 20) AS presctype
        FROM orders""",
    "schedule_log": """
        SELECT 'sl' || o_orderkey AS schedule, 'ps' || o_orderkey AS presc_schedule,
               'pt' || (o_orderkey % 20) AS presctype, 's' || (o_orderkey * 3 % 10) AS operator,
               <created> AS operation_date_time, CAST(1 AS INTEGER) AS action,
               CASE o_orderkey % 4 WHEN 0 THEN 'запись ДМС' WHEN 1 THEN NULL ELSE 'запись' END AS commentary
        FROM orders
        UNION ALL
        SELECT 'sl' || o_orderkey, 'ps' || o_orderkey, 'pt' || (o_orderkey % 20),
               's' || (o_orderkey * 7 % 10), <created + 1 HOUR>, CAST(o_orderkey % 3 AS INTEGER), 'ДМС'
        FROM orders WHERE o_orderpriority = '2-HIGH'""",
    "presctype": """
        SELECT DISTINCT 'pt' || (p_partkey % 20) AS oid, 'f' || (p_partkey % 5) AS presctypefolderid_parent,
               CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey % 5 AS INTEGER) END AS time_cells,
               CASE p_partkey % 20 % 4 WHEN 0 THEN <child> WHEN 1 THEN <adult>
                    WHEN 2 THEN <other> END AS tags
        FROM part""",
    "presctypefolder": "SELECT DISTINCT 'f' || (p_partkey % 4) AS id FROM part",
    "schedule_work_time": """
        SELECT DISTINCT 'wt' || (p_partkey % 40) AS oid,
               concat('pt', p_partkey % 20, ',pt', (p_partkey % 20 + 5) % 20, ',pt', (p_partkey % 20 + 7) % 20,
                      ', pt', (p_partkey % 20 + 9) % 20) AS presctype,
               CAST(CASE WHEN p_partkey % 40 % 3 = 0 THEN 0 ELSE 1 END AS INTEGER) AS insite
        FROM part""",
    # services and money
    "presc_service": """
        SELECT <line> AS oid, 'r' || l_orderkey AS presc, 'sp' || l_partkey AS service_presctype FROM lineitem""",
    "service_presctype": "SELECT 'sp' || p_partkey AS oid, 'sv' || p_partkey AS service FROM part",
    "services": """
        SELECT 'sv' || p_partkey AS oid,
               CASE p_partkey % 5 WHEN 0 THEN 'budget' WHEN 2 THEN 'cash' WHEN 3 THEN 'dms'
                    WHEN 4 THEN 'sp_budget' END AS pay_type
        FROM part""",
    "price": """
        SELECT 'r' || l_orderkey AS presc_id, <line> AS presc_service_oid,
               CAST(l_extendedprice AS DECIMAL(18,4)) AS base_price
        FROM lineitem WHERE l_quantity <> 13""",
    "discount": """
        SELECT DISTINCT 'd' || (p_partkey % 10) AS oid,
               CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey % 10 AS DECIMAL(18,4)) END AS percent
        FROM part""",
    "discount_presc": """
        SELECT <line> AS presc_service, 'd' || (l_partkey % 12) AS discount,
               CASE WHEN l_discount <> 0 THEN CAST(CAST(l_discount * 100 AS DECIMAL(9,2)) AS DECIMAL(18,4)) END
                   AS percent,
               CASE WHEN l_tax <> 0 THEN CAST(l_tax * 10 AS DECIMAL(18,4)) END AS fix_sum
        FROM lineitem WHERE l_returnflag <> 'A'
        UNION ALL
        SELECT <line>, 'd' || (l_suppkey % 12), NULL, NULL FROM lineitem WHERE l_linestatus = 'F'""",
    "finance_plan": """
        SELECT 'fp' || o_orderkey AS oid, 'v' || o_orderkey AS visit, o_orderkey % 2 = 0 AS fixed,
               CAST(o_orderdate AS DATE) AS date_begin, CAST(o_orderdate + INTERVAL '800' DAY AS DATE) AS date_end
        FROM orders""",
    "finance_plan_presc_service": """
        SELECT <line> AS presc_service, 'fp' || l_orderkey AS finance_plan
        FROM lineitem WHERE l_returnflag = 'N'""",
    # channel log
    "appointment_record": """
        SELECT 'r' || (o_orderkey - o_orderkey % 3) AS appointment_oid,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'ONLINE_BOOKING' WHEN '2-HIGH' THEN 'ONLINE_BOOKING'
                    WHEN '3-MEDIUM' THEN 'APP' ELSE 'PARTNER' END AS source,
               <created> AS created_at,
               CASE WHEN o_orderkey % 41 <> 0
                    THEN <created + o_orderkey % 7 DAY> END AS updated_at
        FROM orders""",
    # stored monthly figures
    "revenue_kpi": """
        SELECT <month> AS month,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue
        FROM orders GROUP BY 1""",
    "ratio_kpi": """
        SELECT <month> AS month,
               CAST(<per_10000> AS BIGINT)
                   AS ratio_e4
        FROM orders GROUP BY 1""",
}



def in_duckdb(text: str) -> str:
    return _spell(text, _DUCK)


SQL = {name: in_duckdb(text) for name, text in TEXTS.items()}


def setting_text(value: str) -> str:
    """The clinic's settings with the given rounding mode."""
    return f"""
        SELECT CASE r_regionkey WHEN 0 THEN 'DiscountAmountRounding' ELSE r_name END AS param,
               '{value}' AS valuepar
        FROM region"""


def with_tables(*names: str, body: str, **extra: str) -> str:
    """``body`` under the named derived tables; ``extra`` adds derived tables of the query's own."""
    ctes = [f"{n} AS ({SQL[n]})" for n in names] + [f"{n} AS ({text})" for n, text in extra.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


class Tables(Mapping[str, DataFrame]):
    """The derived tables of one test folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, **more: str):
        self._spark, self._folder = spark, sf_dir
        self._texts = TEXTS | more
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            text = _spell(self._texts[name], _SPARK).replace("{", "{{").replace("}", "}}")
            used = {s for s in SCHEMAS if re.search(rf"\bFROM {s}\b", text)}
            text = re.sub(r"\bFROM (\w+)", lambda m: f"FROM {{{m[1]}}}" if m[1] in used else m[0], text)
            sources = {s: table(self._spark, self._folder, s) for s in used}
            self._built[name] = self._spark.sql(text, **sources)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._texts)

    def __len__(self) -> int:
        return len(self._texts)


def tables(spark: SparkSession, sf_dir: str, rounding: str = "") -> Tables:
    """All derived tables; ``rounding`` is the value of the clinic's rounding setting."""
    return Tables(spark, sf_dir, systemsettings=setting_text(rounding))
