"""Failed runs, other batches, line breaks, scopes: what the daily runs must not depend on."""

import threading
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clinicpulse import bindings as B
from clinicpulse.operators import rowid, staging, upsert
from clinicpulse.plans import appointments, daily, revenue
from clinicpulse.registry.analytics import raw_mobile, raw_web
from clinicpulse.registry.clinic import REVENUE_MONTHS, REVENUE_PARAMS
from clinicpulse.sources import ingest, landing, specs
from clinicpulse.sources.state import StateTable
from clinicpulse.streaming import intake

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def land(spark, path, raw, spec, time):
    landing.write(raw.withColumn(landing.DAY, F.to_date(F.col(f"`{time}`"))), str(path), spec)
    return str(path)


def test_a_failure_between_two_tables_is_made_good(spark, tmp_path, monkeypatch):
    w, spec = daily.Warehouse(spark, str(tmp_path / "wh")), specs.web("booking")
    path = land(spark, tmp_path / "in", raw_web(spark, DATA, spec), spec, spec.prefix + "dateTime")
    plain, calls = StateTable.append, []

    def failing(self, df):
        calls.append(self.path)
        if len(calls) == 3:
            raise RuntimeError("lost")
        plain(self, df)

    monkeypatch.setattr(StateTable, "append", failing)
    with pytest.raises(RuntimeError):
        daily.load_source(w, path, spec, date(2024, 1, 9))
    assert daily.done_to(w, "booking", daily.LOAD) is None
    assert daily.stored_export(w, spec, "events").isEmpty()
    monkeypatch.setattr(StateTable, "append", plain)
    daily.load_source(w, path, spec, date(2024, 1, 9))
    wanted = B.table(spark, DATA, "events").filter("date(ts) <= '2024-01-08'").count()
    assert {daily.stored_export(w, spec, t.name).count() for t in spec.tables} == {wanted}
    assert daily.done_to(w, "booking", daily.LOAD) == date(2024, 1, 8)


def test_the_result_does_not_depend_on_the_batch_limit(spark, tmp_path):
    spec = specs.mobile()
    raw = raw_mobile(spark, DATA).filter("event_datetime < '2024-01-05'")
    raw = raw.unionByName(raw).repartition(6)
    path = land(spark, tmp_path / "in", raw, spec, "event_datetime")
    found = []
    for limit in (1, 100):
        w = daily.Warehouse(spark, str(tmp_path / f"wh{limit}"))
        assert intake.follow(
            spark, w, spec, path, str(tmp_path / f"cp{limit}"), lambda start, end: None, files_per_batch=limit
        ).awaitTermination(600)
        found.append(rows(daily.stored_export(w, spec, "events")))
    assert found[0] == found[1] and len(found[0]) == raw.count()


def test_a_reload_of_rows_without_a_time_adds_nothing(spark, tmp_path):
    w, spec = daily.Warehouse(spark, str(tmp_path / "wh")), specs.mobile()
    raw = raw_mobile(spark, DATA).limit(20).withColumn("event_datetime", F.when(F.rand(1) < 2, F.lit("never")))
    raw = staging.stage(raw.withColumn(landing.FILE, F.lit("a")), "raw")
    assert daily.append_export(w, spec, raw) == 20
    daily.append_export(w, spec, raw)
    assert daily.stored_export(w, spec, "events").count() == 20


def test_line_breaks_inside_texts(spark, tmp_path):
    spec = specs.mobile()
    raw = raw_mobile(spark, DATA).limit(50).withColumn("event_json", F.lit('{"a":\n"b\n\nc"}'))
    path = land(spark, tmp_path / "in", raw, spec, "event_datetime")
    back = landing.read(spark, path, spec, date(2024, 1, 1), date(2024, 1, 31))
    whole = ["event_json", "event_name", "event_datetime", "appmetrica_device_id", "session_id"]
    assert rows(back.select(*whole)) == rows(raw.select(*whole))


def test_one_stray_date_renews_only_its_own_days(spark, tmp_path):
    spec, calls = specs.mobile(), []
    raw = raw_mobile(spark, DATA).filter("event_datetime < '2024-01-03'")
    stray = raw.limit(1).withColumn("event_datetime", F.lit("1970-01-01 00:00:00"))
    land(spark, tmp_path / "in", raw.unionByName(stray), spec, "event_datetime")
    w = daily.Warehouse(spark, str(tmp_path / "wh"))
    assert intake.follow(
        spark, w, spec, str(tmp_path / "in"), str(tmp_path / "cp"), lambda a, b: calls.append((a, b))
    ).awaitTermination(600)
    assert calls == [(date(1970, 1, 1), date(1970, 1, 1)), (date(2024, 1, 1), date(2024, 1, 2))]


def test_three_exports_followed_at_once(spark, tmp_path):
    w, queries = daily.Warehouse(spark, str(tmp_path / "wh")), []
    for name, spec in specs.all_specs().items():
        raw = raw_mobile(spark, DATA) if name == "mobile" else raw_web(spark, DATA, spec)
        time = "event_datetime" if name == "mobile" else spec.prefix + "dateTime"
        path = land(spark, tmp_path / name, raw.filter(F.col(f"`{time}`") < "2024-01-04"), spec, time)
        queries.append(intake.follow(spark, w, spec, path, str(tmp_path / f"cp-{name}"), lambda a, b: None, files_per_batch=1))
    assert all(q.awaitTermination(900) for q in queries)
    wanted = B.table(spark, DATA, "events").filter("ts < '2024-01-04'").count()
    assert {daily.stored_export(w, s, "events").count() for s in specs.all_specs().values()} == {wanted}


def test_scopes_of_two_threads_keep_to_their_own(spark):
    inside, leave, found = threading.Event(), threading.Event(), []

    def other():
        with staging.scope(spark):
            frame = staging.stage(spark.range(5), "other")
            inside.set()
            leave.wait(60)
            found.append(frame.count())

    thread = threading.Thread(target=other)
    with staging.scope(spark):
        thread.start()
        inside.wait(60)
        staging.stage(spark.range(3), "mine")
    leave.set()
    thread.join()
    assert found == [5]


def test_copies_of_many_rows_are_spread(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("a")).crossJoin(spark.range(12).select(F.lit(1).alias("b")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = rowid.with_row_id(df, "uuid", block=8)
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 24_000 and max(sizes) < 0.6 * sum(sizes)


def test_keys_are_settled_without_sorting(spark):
    spec = specs.web("booking")
    raw = raw_web(spark, DATA, spec)
    log = B.tables(spark, DATA)["appointment_record"]
    for df in (ingest.normalise(raw, spec), appointments.latest_source(log, date(1995, 6, 1))):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_with_nulls_and_copies(spark):
    data = [("a", 2, "x"), ("a", None, "y"), ("a", None, "y"), ("b", 3, "p"), ("b", 3, "q"), (None, 1, "z"), (None, 1, "z")]
    df = spark.createDataFrame(data, "k string, n int, t string")
    found = rows(upsert.first_per_key(df, ["k"], ["n"]))
    assert ("a", None, "y") in found and (None, 1, "z") in found and len(found) == 3
    assert found == rows(upsert.first_per_key(df.unionByName(df).repartition(5), ["k"], ["n"]))
    with pytest.raises(TypeError):
        upsert.first_per_key(df, ["k"], ["t"])


def test_a_price_of_another_prescription_changes_nothing_and_a_second_one_fails(spark):
    t = dict(B.tables(spark, DATA, rounding="1"))
    plain = rows(revenue.monthly(t, REVENUE_MONTHS, REVENUE_PARAMS))
    price = t["price"]
    t["price"] = price.unionByName(price.withColumn("presc_id", F.lit("another")))
    assert rows(revenue.monthly(t, REVENUE_MONTHS, REVENUE_PARAMS)) == plain
    t["price"] = price.unionByName(price)
    with pytest.raises(Exception, match="more than one price"):
        revenue.monthly(t, REVENUE_MONTHS, REVENUE_PARAMS).collect()


def test_identity_rewrites_only_touched_buckets(spark, tmp_path):
    w = daily.Warehouse(spark, str(tmp_path / "wh"))
    seen = lambda ids: spark.createDataFrame(
        [("appmetrica", i, None, datetime(2024, 1, 1), datetime(2024, 1, 1)) for i in ids],
        "source string, external_user_id string, internal_user_id bigint, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz",
    ).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    daily._merge_identity(w, "appmetrica", seen([str(i) for i in range(200)]))
    before = set(w.identity.read().inputFiles())
    daily._merge_identity(w, "appmetrica", seen(["7"]))
    after = set(w.identity.read().inputFiles())
    assert w.identity.read().count() == 200
    assert len(before - after) <= 2 and before & after


def test_local_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "local-cluster[2,1,512]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        staging.shared_folder(Session())
