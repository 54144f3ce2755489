"""What must hold whatever the data: repeatability, splitting of ranges, skew, plans."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clinicpulse import bindings as B
from clinicpulse import params as P
from clinicpulse import session
from clinicpulse.functions.periods import Months
from clinicpulse.operators import joins, rowid, staging, upsert
from clinicpulse.params import AppointmentParams, RevenueParams
from clinicpulse.plans import appointments, daily, identity, mau, noshow, presence, revenue, upkeep
from clinicpulse.registry import QUERIES, clinic
from clinicpulse.registry.analytics import raw_mobile, raw_web
from clinicpulse.sources import files, ingest, jdbc, landing, specs
from clinicpulse.sources.state import StateTable, VersionedTable
from clinicpulse.streaming import intake

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


# --- skew -----------------------------------------------------------------------------------------


def skewed(spark, n=6000):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 900)
    return spark.range(n).select(key.alias("k"), F.col("id").alias("v"))


def test_hot_keys_are_few_and_found(spark):
    left = skewed(spark)
    found, both = (set(h) for h in joins.hot_keys(left, ["k"], ["k", "v"]))
    seven = left.select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert seven in found and len(found) <= 1 / joins.HOT_SHARE
    assert not both and joins.hot_keys(left.filter("v < 0"), ["k"]) == [[]]
    assert joins.hot_keys(spark.range(5000).select(F.col("id").alias("k")), ["k"]) == [[]]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = left.filter("k % 2 = 1").groupBy("k").agg(F.max("v").alias("top"))
    salted = joins.join_to_unique(left, right, ["k"], how, spread_by=["v"])
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(salted) == rows(left.join(right, ["k"], how))


def test_salt_spreads_the_hot_key(spark):
    left = skewed(spark)
    right = left.groupBy("k").agg(F.max("v").alias("top"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.join_to_unique(left, right, ["k"], "left", spread_by=["v"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 0.45 * sum(sizes)


def test_identity_with_a_hot_hit_id(spark):
    """A third of all hits and params share one hit id; copies of one hit make up much of it."""
    events = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("watch_id"),
        F.when(F.col("id") % 6 == 0, 1).otherwise(F.col("id") % 40).alias("client_id"),
        F.lit(datetime(2025, 1, 2)).cast("timestamp_ntz").alias("date_time"),
    )
    params = events.select(
        "watch_id", "date_time", F.concat(F.lit('{"user_id": '), (F.col("watch_id") % 11).cast("string"), F.lit("}")).alias("params")
    )
    span = (date(2025, 1, 1), date(2025, 1, 3))
    for build, on, how in (
        (identity.booking, ["watch_id", "date_time"], "inner"), (identity.account, ["watch_id"], "left"),
    ):
        users = params.groupBy(*on).agg(F.max(F.col("watch_id") % 11).alias("u"))
        plain = events.join(users, on, how).groupBy(F.col("client_id").cast("string").alias("c")).agg(F.max("u").alias("u"))
        found = build(events, params, *span).select(F.col("external_user_id").alias("c"), F.col("internal_user_id").alias("u"))
        assert rows(found) == rows(plain)


# --- row ids --------------------------------------------------------------------------------------


def test_row_ids_do_not_depend_on_layout(spark):
    df = spark.range(300).select((F.col("id") % 7).cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    one, other = (rowid.with_row_id(d, "uuid", block=b) for d, b in ((df.repartition(7), 10), (df.coalesce(1), 1000)))
    assert rows(one) == rows(other)
    assert one.count() == 300 == one.select("uuid").distinct().count()
    assert one.filter(~F.col("uuid").rlike(ingest.UUID_PATTERN)).count() == 0


# --- splitting ranges -----------------------------------------------------------------------------


def test_identity_in_two_runs_equals_one(spark):
    events = B.tables(spark, DATA)["mobile_events"]
    first, middle, last = date(2024, 1, 1), date(2024, 1, 12), date(2024, 1, 30)
    nothing = spark.createDataFrame([], identity.SCHEMA)
    once = identity.merge(nothing, identity.mobile(events, first, last)).drop("updated_at", "internal_user_id")
    half = identity.merge(nothing, identity.mobile(events, first, middle))
    twice = identity.merge(half, identity.mobile(events, middle + timedelta(days=1), last))
    assert rows(once) == rows(twice.drop("updated_at", "internal_user_id"))
    again = identity.merge(twice, identity.mobile(events, middle + timedelta(days=1), last))
    assert rows(again.drop("updated_at")) == rows(twice.drop("updated_at"))


def test_presence_in_two_runs_equals_one(spark):
    events = B.tables(spark, DATA)["mobile_events"]
    known = identity.mobile(events, date(2024, 1, 1), date(2024, 1, 30))
    kind, nothing = presence.mobile_all(), spark.createDataFrame([], presence.SCHEMA)
    build = lambda a, b: presence.build(events, known, kind, date(2024, 1, a), date(2024, 1, b))
    once = presence.merge(nothing, build(1, 30))
    twice = presence.merge(presence.merge(nothing, build(1, 12)), build(13, 30))
    assert rows(once.drop("updated_at")) == rows(twice.drop("updated_at"))


def test_one_pass_over_months_equals_the_month_by_month_loop(spark):
    t = B.tables(spark, DATA, rounding="1")
    params = RevenueParams(date(1998, 6, 1), sysuser=B.ONLINE_SYSUSER)
    span = Months(date(1997, 11, 1), date(1998, 3, 1))
    visits = AppointmentParams(sysuser=B.ONLINE_SYSUSER, call_center_posts=B.CALL_CENTER_POSTS)
    for build in (
        lambda m: revenue.monthly(t, m, params),
        lambda m: appointments.call_center(t, m, visits),
        lambda m: mau.booking(t["history"], m),
    ):
        months = [r.month for r in span.spine(spark).collect()]
        assert len(months) == 4
        loop = [r for m in months for r in rows(build(Months(m, (m + timedelta(days=31)).replace(day=1))))]
        assert sorted(loop) == rows(build(span))


def test_users_never_exceed_distinct_pairs(spark):
    history = B.tables(spark, DATA)["history"].filter("product = 'oz' and external_user_id is not null")
    span = Months(date(1995, 1, 1), date(2001, 9, 1))
    pairs = history.groupBy(F.trunc("activity_date", "MM").alias("month")).agg(
        F.count_distinct("source", "external_user_id").alias("pairs")
    )
    assert mau.booking(history, span).join(pairs, "month").filter("count > pairs").count() == 0


def test_report_counts_add_up(spark):
    summary = QUERIES["no_show_totals"](spark, DATA)
    assert summary.filter("signed + no_show > total").count() == 0


def test_repeated_dimension_rows_count_like_the_double_join(spark):
    """Two equal rows for a service type double its lines in prices and in discounts: four times the sum."""
    t = dict(B.tables(spark, DATA))
    params, span = RevenueParams(date(1998, 6, 1), sysuser=B.ONLINE_SYSUSER), Months(date(1995, 1, 1), date(2002, 1, 1))
    total = lambda: revenue.monthly(t, span, params).agg(F.sum("revenue")).first()[0]
    once = total()
    t["services"] = t["services"].unionByName(t["services"])
    assert once > 0 and total() == 4 * once


# --- storing --------------------------------------------------------------------------------------


def test_state_table_replaces_only_touched_partitions(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), "k string, v int", ["k"])
    assert table.read().count() == 0
    table.append(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
    table.replace_partitions(table.read().filter("k = 'b'").withColumn("v", F.col("v") * 10))
    assert rows(table.read()) == ["('a', 1)", "('b', 20)"]


def test_replace(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), "v int, k string", ["k"])
    table.append(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
    table.replace_partitions(spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int"))
    assert rows(table.read().select("k", "v")) == [
        "('a', 1)", "('b', 9)", "('c', 3)",
    ]


def test_landing_opens_only_the_days_asked_for(spark, tmp_path):
    spec, path = specs.mobile(), str(tmp_path / "landed")
    raw = raw_mobile(spark, DATA)
    landing.write(raw.withColumn(landing.DAY, F.to_date("event_datetime")), path, spec)
    day = landing.read(spark, path, spec, date(2024, 1, 5), date(2024, 1, 5))
    assert 0 < day.count() < raw.count()
    assert "PartitionFilters: [isnotnull(export_date" in day._jdf.queryExecution().executedPlan().toString()
    whole = landing.read(spark, path, spec, date(2024, 1, 1), date(2024, 1, 31))
    assert rows(whole) == rows(raw.replace("", None))


def test_landing_as_json(spark, tmp_path):
    spec, path = replace(specs.web("booking"), format="json"), str(tmp_path / "landed")
    raw = raw_web(spark, DATA, spec)
    landing.write(raw.withColumn(landing.DAY, F.to_date(F.col("`ym:pv:dateTime`"))), path, spec)
    whole = landing.read(spark, path, spec, date(2024, 1, 1), date(2024, 1, 31))
    assert rows(ingest.normalise(whole, spec)) == rows(ingest.normalise(raw, spec))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    paths = {name: str(root / name) for name in specs.all_specs()}
    for name, spec in specs.all_specs().items():
        raw = raw_mobile(spark, DATA) if name == "mobile" else raw_web(spark, DATA, spec)
        time = "event_datetime" if name == "mobile" else spec.prefix + "dateTime"
        landing.write(raw.withColumn(landing.DAY, F.to_date(F.col(f"`{time}`"))), paths[name], spec)
    return paths


def test_analytics_day_by_day(spark, tmp_path, landed):
    w = daily.Warehouse(spark, str(tmp_path / "wh"))
    allowed = B.tables(spark, DATA)["allowed"]
    run = lambda as_of: daily.run_analytics(w, landed, allowed, B.GOAL_PREFIX, as_of, B.USER_ID_PATH)
    # First load takes the eight days before the run, the next one what came since.
    run(date(2024, 1, 12))
    events = lambda: w.export(specs.mobile(), specs.mobile().tables[0]).read()
    assert {r[0] for r in events().select(F.min("event_day"), F.max("event_day")).collect()} == {date(2024, 1, 4)}
    run(date(2024, 1, 20))
    stored, kept = events().count(), rows(w.presence.read().drop("updated_at"))
    source = B.table(spark, DATA, "events").filter("date(ts) between '2024-01-04' and '2024-01-19'")
    assert stored == source.count()
    assert w.presence.read().groupBy(*presence.KEY).count().filter("count > 1").count() == 0
    assert {r.source for r in w.identity.read().select("source").distinct().collect()} == {
        P.SOURCE_MOBILE, P.SOURCE_BOOKING, P.SOURCE_ACCOUNT,
    }
    # Running again loads nothing new; loading the same rows again appends nothing.
    run(date(2024, 1, 20))
    daily.append_export(w, specs.mobile(), landing.read(spark, landed["mobile"], specs.mobile(), date(2024, 1, 4), date(2024, 1, 19)))
    daily.update_mobile(w, allowed, date(2024, 1, 4), date(2024, 1, 19))
    assert events().count() == stored
    assert len(rows(w.presence.read())) == len(kept)
    months = w.figure("mau_ob_kpi").read()
    assert months.count() == 0  # the first month of this figure lies after the data


def test_streaming_intake_catches_up(spark, tmp_path, landed):
    w = daily.Warehouse(spark, str(tmp_path / "wh"))
    allowed = B.tables(spark, DATA)["allowed"]
    follow = lambda: intake.follow(
        spark, w, specs.mobile(), landed["mobile"], str(tmp_path / "checkpoint"),
        lambda start, end: daily.update_mobile(w, allowed, start, end), files_per_batch=20,
    ).awaitTermination(600)
    assert follow()
    events = B.table(spark, DATA, "events")
    assert w.export(specs.mobile(), specs.mobile().tables[0]).read().count() == events.count()
    days = events.select("user_id", F.to_date("ts")).distinct().count()
    assert w.presence.read().filter(F.col("product") == P.PRODUCT_ACCOUNT).count() == days
    assert follow()
    assert w.export(specs.mobile(), specs.mobile().tables[0]).read().count() == events.count()


def test_clinic_run_is_repeatable(spark, tmp_path):
    w = daily.Warehouse(spark, str(tmp_path / "wh"))
    # The test tables end in 2001, so the whole calendar is moved to where the figures start.
    t = dict(B.tables(spark, DATA, rounding="1"))
    move = lambda c: (F.col(c) + F.expr("interval 28 years")).alias(c)
    for name, times in (("presc", ["create_dt", "upd_dt"]), ("appointment_record", ["created_at", "updated_at"])):
        t[name] = t[name].select(*[move(c) if c in times else c for c in t[name].columns])
    visits = AppointmentParams(sysuser=B.ONLINE_SYSUSER, call_center_posts=B.CALL_CENTER_POSTS)
    run = lambda: daily.run_clinic(
        w, t, date(2026, 5, 20), RevenueParams(date(2026, 5, 20), sysuser=B.ONLINE_SYSUSER), visits
    )
    run()
    names = ["revenue_kpi", "rate_kpi", "ob_to_call_centre_kpi", "kpis_summary"]
    first = {n: rows(w.figure(n).read()) for n in names}
    stored = rows(w.appointments.read())
    assert len(first["revenue_kpi"]) == 17 and len(first["kpis_summary"]) == 2 and stored
    run()
    assert {n: rows(w.figure(n).read()) for n in names} == first
    assert rows(w.appointments.read()) == stored


def test_report_is_replaced(spark, tmp_path):
    w = daily.Warehouse(spark, str(tmp_path / "wh"))
    for _ in range(2):
        daily.run_report(w, B.tables(spark, DATA), clinic.REPORT)
    wanted = rows(QUERIES["no_show_report"](spark, DATA))
    assert len(wanted) == w.report.read().count()
    stored = rows(w.report.read())
    bad = dict(B.tables(spark, DATA))
    broken = F.raise_error(F.lit("lost")).cast("string")
    bad["staff_name"] = bad["staff_name"].withColumn("full_name", broken)
    with pytest.raises(Exception, match="lost"):
        daily.run_report(w, bad, clinic.REPORT)
    assert rows(w.report.read()) == stored


def test_a_failed_replacement_is_no_version_and_goes_once_it_is_old(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "v bigint")
    table.publish(spark.range(5).select(F.col("id").alias("v")))
    broken = F.when(F.col("id") == 77, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="lost"):
        table.publish(spark.range(100).select(broken.alias("v")))
    # What is left of a run that was killed.
    spark.range(3).write.parquet(f"{table.path}/versions/killed")
    assert table.read().count() == 5 and table.expire() == []
    assert "killed" in table.expire(abandoned_after=timedelta(days=-1))
    assert len(files.listed(spark, f"{table.path}/versions")) == 1 and table.read().count() == 5


def test_versions_of_a_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "v int")
    assert table.read().count() == 0
    for n in range(12):
        table.publish(spark.range(n + 1).select(F.col("id").cast("int").alias("v"), F.lit(1).alias("other")))
        before = table.read()
    table.publish(table.read().filter("v < 3"))
    assert (table.read().count(), before.count()) == (3, 12)
    assert len(table.expire(keep=2)) == 11
    assert (table.read().count(), before.count()) == (3, 12) and table.expire(keep=2) == []


# --- upkeep and databases -------------------------------------------------------------------------


def test_catalog_upkeep(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS amplitude_web")
    for name in ("default.upkeep_orders", "amplitude_web.upkeep_skipped"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        B.table(spark, DATA, "orders").write.option("path", str(tmp_path / name)).saveAsTable(name)
    try:
        found = upkeep.tables(spark)
        assert "default.upkeep_orders" in found and "amplitude_web.upkeep_skipped" not in found
        upkeep.analyze(spark, "default.upkeep_orders")
        facts = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED default.upkeep_orders").collect()}
        assert "1500 rows" in facts["Statistics"]
    finally:
        for name in ("default.upkeep_orders", "amplitude_web.upkeep_skipped"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql("DROP DATABASE IF EXISTS amplitude_web CASCADE")


def test_database_ranges_cover_every_day_once():
    parts = jdbc.day_predicates("d", date(2025, 1, 1), date(2025, 1, 10), 4)
    assert parts == [
        "d >= DATE '2025-01-01' AND d < DATE '2025-01-05'",
        "d >= DATE '2025-01-05' AND d < DATE '2025-01-09'",
        "d >= DATE '2025-01-09' AND d < DATE '2025-01-11'",
    ]


# --- plans ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_distributed_and_on_the_jvm(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


def test_time_ranges_and_columns_reach_the_scan(spark):
    plan = identity.mobile(B.tables(spark, DATA)["mobile_events"], date(2024, 1, 5), date(2024, 1, 6))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-05" in text and "LessThan(ts,2024-01-07" in text
    assert "event_type" not in text.split("ReadSchema")[1]


def test_staged_frames_live_in_the_shared_folder(spark):
    staged = staging.stage(spark.range(3), "probe")
    assert staging.shared_folder(spark) in staged.inputFiles()[0]
    assert staged.count() == 3
    with staging.scope(spark):
        inner = staging.stage(spark.range(2), "probe")
        assert inner.count() == 2
    assert staged.count() == 3
    with pytest.raises(Exception, match="FAILED_READ_FILE|PATH_NOT_FOUND|does not exist"):
        inner.collect()


def test_prices_and_discounts_of_a_large_scan_are_cut_before_they_are_shuffled(spark):
    """revenue_month, revenue_rounding_*: a Bloom filter of the lines in range is looked up while lineitem is read."""
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    t = B.tables(spark, DATA, rounding="1")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set(name, "1k")
        cut = revenue.by_mode(t, clinic.REVENUE_MONTHS, clinic.REVENUE_PARAMS)
        plan = cut._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("might_contain") >= 3
        found = sorted(map(tuple, cut.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.unset(name)
        session.configure(spark)
    assert found == sorted(map(tuple, revenue.by_mode(t, clinic.REVENUE_MONTHS, clinic.REVENUE_PARAMS).collect()))


def test_channels_are_settled_by_tables_of_ids(spark):
    """channel_moved_away: no task sorts the log or holds several aggregates of it at once."""
    log = B.tables(spark, DATA)["appointment_record"]
    plan = appointments.latest_source(log, date(1995, 6, 1))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan
    for held in ("SortMergeJoin", "HashAggregate"):
        assert held not in plan
