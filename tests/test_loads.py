"""Loads: files read in parts, filters of stored keys, the index of hits, values that do not fit."""

import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clinicpulse.operators import staging, upsert
from clinicpulse.plans import daily, identity
from clinicpulse.registry.analytics import raw_mobile, raw_web
from clinicpulse.sources import ingest, landing, specs
from clinicpulse.sources.keyfilter import KeyFilter

DATA = "/root/testdata/sf0.001"
DAYS = date(2024, 1, 1), date(2024, 1, 31)


def rows(df):
    return sorted([tuple(r) for r in df.select(*sorted(df.columns)).collect()], key=str)


@pytest.fixture
def small_parts(spark):
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def write_csv(folder, texts, end="\n", last=True, header=None):
    """One file of the mobile export, ``texts`` in its JSON column."""
    spec = specs.mobile()
    folder.mkdir(parents=True)
    lines = [",".join(header or spec.header)]
    for n, text in enumerate(texts):
        quoted = '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n\r') or text == "" else text
        lines.append(",".join({"event_json": quoted, "session_id": str(n), "event_name": "e"}.get(c, "") for c in spec.header))
    (folder / "one.csv").write_text(end.join(lines) + (end if last else ""), newline="")


HOSTILE = ["a", "", 'q"uote', '""', "line\nbreak", "\n\n", 'mix"ed\n"both\n', "comma,s", "\r\n inside", ",\n\",", "é\n🙂", " ", "x" * 400 + "\n" + "y" * 400]


@pytest.mark.parametrize("end,last,part", [("\n", True, 64), ("\n", False, 150), ("\r\n", True, 64), ("\n", True, 1000)])
def test_a_file_in_parts_equals_the_file_read_whole(spark, tmp_path, small_parts, end, last, part):
    rng = random.Random(part)
    texts = [rng.choice(HOSTILE) for _ in range(300)]
    write_csv(tmp_path / "in" / "export_date=2024-01-05", texts, end, last)
    spec, path = specs.mobile(), str(tmp_path / "in")
    whole = rows(landing.with_file(landing.read(spark, path, spec, *DAYS)))
    small_parts(part)
    parts = landing.read(spark, path, spec, *DAYS)
    assert rows(parts) == whole and len(whole) == 300
    lines, _ = landing.records(spark, path, [f.path for f in landing.landed_files(spark, path, *DAYS)])
    assert lines.count() == 301


def test_many_tasks_read_one_file(spark, tmp_path, small_parts):
    write_csv(tmp_path / "in" / "export_date=2024-01-05", HOSTILE * 40)
    small_parts(1000)
    plain = spark.read.option("lineSep", "\n").text(str(tmp_path / "in" / "export_date=2024-01-05"))
    assert plain.rdd.getNumPartitions() > 10


def test_a_file_with_open_quotes_is_read_whole(spark, tmp_path, small_parts):
    spec, folder = specs.mobile(), tmp_path / "in" / "export_date=2024-01-05"
    write_csv(folder, ["a\nb", "c"])
    text = (folder / "one.csv").read_text()
    (folder / "two.csv").write_text(text.replace('"a\nb"', 'a 5" screen'))
    small_parts(64)
    read = landing.read(spark, str(tmp_path / "in"), spec, *DAYS)
    assert [r[0] for r in read.select("event_json").orderBy("event_json").collect()] == ["a\nb", 'a 5" screen', "c", "c"]
    assert {r[0] for r in read.select(landing.FILE).distinct().collect()} == {f"export_date=2024-01-05/{n}.csv" for n in ("one", "two")}


def test_a_wrong_header_fails(spark, tmp_path, small_parts):
    spec = specs.mobile()
    write_csv(tmp_path / "in" / "export_date=2024-01-05", HOSTILE * 5, header=["wrong", *spec.header[1:]])
    small_parts(64)
    with pytest.raises(Exception, match="does not name"):
        landing.read(spark, str(tmp_path / "in"), spec, *DAYS).collect()


def test_keys_settled_in_one_scan(spark, tmp_path):
    df = spark.createDataFrame([(i % 50 if i < 60 else i, f"t{i % 7}") for i in range(300)], "k int, t string")
    df.write.parquet(str(tmp_path / "t"))
    scans = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(t):
        scans.add(1)
        return t

    found = upsert.first_per_key(spark.read.parquet(str(tmp_path / "t")).withColumn("t", counted("t")), ["k"])
    assert found.count() == 290 == found.select("k").distinct().count()
    assert scans.value == 300
    assert "Exchange" not in upsert.first_per_key(spark.range(9), ["id"])._jdf.queryExecution().executedPlan().toString()


# --- filters of stored keys -----------------------------------------------------------------------


def test_a_filter_names_every_key_it_was_given(spark, tmp_path):
    keys = spark.range(60_000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 < 9, F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 10 % 2).cast("int"))).alias("day"))
    held = KeyFilter(spark, str(tmp_path / "f"), ["k"])
    assert held.is_empty()
    held.add(keys.filter("k < 50000"), "day")
    held.add(keys.filter("k >= 50000 AND k < 50100"), "day")
    assert {r["blocks"] for r in held.table.read().select("blocks").collect()} >= {1, 8}
    assert held.may_hold(keys.filter("k < 50100"), "day").count() == 50_100
    assert held.may_hold(keys.filter("k >= 50100"), "day").count() < 0.05 * 9_900
    other_day = keys.filter("k < 50100").withColumn("day", F.lit(date(2024, 2, 1)))
    assert held.may_hold(other_day, "day").count() == 0


def web_batch(spark, ids, at=None):
    spec = specs.web("booking")
    raw = raw_web(spark, DATA, spec).filter(F.expr(f"bigint(substring(`ym:pv:watchID`, 3)) IN ({','.join(map(str, ids))})"))
    return raw if at is None else raw.withColumn("ym:pv:dateTime", F.lit(at))


def test_a_batch_opens_only_days_that_may_hold_its_keys(spark, tmp_path):
    w, spec = daily.Warehouse(spark, str(tmp_path / "wh")), specs.web("booking")
    daily.append_export(w, spec, raw_web(spark, DATA, spec))
    total = daily.stored_export(w, spec, "events").count()
    stored = {t.name: w.export(spec, t).read() for t in spec.tables}

    def opened(raw):
        wide = staging.stage(ingest.normalise(raw, spec), "wide")
        new = ingest.new_rows(wide, spec, stored, w.keys(spec))
        plan = new["events"]._jdf.queryExecution().executedPlan().toString()
        days = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
        return new["events"].count(), sorted(set(re.findall(r"\d{4}-\d\d-\d\d", " ".join(d for d in days if "event_day" in d))))

    # New hits, one dated 1970: nothing stored is opened.
    fresh = web_batch(spark, range(20), "2030-01-01 00:00:00").unionByName(web_batch(spark, [3], "1970-01-01 00:00:00"))
    assert opened(fresh) == (21, [])
    # A stored hit among them: its day alone.
    again = fresh.unionByName(web_batch(spark, [7]))
    count, days = opened(again)
    assert count == 21 and len(days) == 1
    daily.append_export(w, spec, again)
    daily.append_export(w, spec, again)
    assert daily.stored_export(w, spec, "events").count() == total + 21


def test_a_warehouse_without_filters_gets_them(spark, tmp_path):
    w, spec = daily.Warehouse(spark, str(tmp_path / "wh")), specs.web("booking")
    wide = ingest.normalise(web_batch(spark, range(50)), spec)
    for table in spec.tables:
        w.export(spec, table).append(wide.select(*table.columns, F.to_date(spec.time).alias(ingest.EVENT_DAY)))
    daily.append_export(w, spec, web_batch(spark, range(80)))
    assert {daily.stored_export(w, spec, t.name).count() for t in spec.tables} == {80}


# --- the index of hits ----------------------------------------------------------------------------


def test_account_identity_reads_the_index_and_moves_only_the_hits(spark, tmp_path):
    w, spec = daily.Warehouse(spark, str(tmp_path / "wh")), specs.web(specs.ACCOUNT)
    daily.append_export(w, spec, raw_web(spark, DATA, spec), "$.k")
    events, params = (daily.stored_export(w, spec, t) for t in ("events", "event_params"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = identity.account_by_index(events, w.hits.read(), *DAYS)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any("/event_params/" in f for f in found.inputFiles())
        below = plan[plan.rindex("Join") :]
        left, right = below.split("HashAggregate(keys=[watch_id", 1)
        assert "Exchange" in left and "Exchange" not in right and "Bucketed: true" in right
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(found) == rows(identity.account(events, params, *DAYS, path="$.k"))
    daily.identify_account(w, *DAYS, "$.k")
    assert rows(w.identity.read().drop("updated_at", "bucket")) == rows(found)


def test_an_old_warehouse_fills_its_index_once(spark, tmp_path):
    w, spec = daily.Warehouse(spark, str(tmp_path / "wh")), specs.web(specs.ACCOUNT)
    wide = ingest.normalise(raw_web(spark, DATA, spec), spec)
    for table in spec.tables:
        w.export(spec, table).append(wide.select(*table.columns, F.to_date(spec.time).alias(ingest.EVENT_DAY)))
    daily.identify_account(w, *DAYS, "$.k")
    events, params = (daily.stored_export(w, spec, t) for t in ("events", "event_params"))
    assert rows(w.identity.read().drop("updated_at", "bucket")) == rows(identity.account(events, params, *DAYS, path="$.k"))
    assert w.hits.read().count() > 0


# --- values that do not fit -----------------------------------------------------------------------


def test_misfits_are_kept_raw_and_counted(spark, tmp_path):
    w, spec = daily.Warehouse(spark, str(tmp_path / "wh")), specs.mobile()
    base = raw_mobile(spark, DATA).limit(6).select(*[F.lit(None).cast("string").alias(c) for c in spec.header])
    good = base.withColumn("event_datetime", F.lit("2024-01-05 10:00:00"))
    bad = good.withColumn("mcc", F.lit("12x")).withColumn("ios_ifa", F.lit("zz")).withColumn("city", F.lit("any"))
    blank = good.withColumn("mcc", F.lit(" ")).withColumn("google_aid", F.lit("0000-0000"))
    raw = staging.stage(good.unionByName(bad).unionByName(blank).withColumn(landing.FILE, F.lit("export_date=2024-01-05/a.csv")), "raw")
    for _ in range(2):
        assert daily.append_export(w, spec, raw) == 0
    [kept] = w.rejects(spec).read().collect()
    assert (kept["fields"], kept["copies"], kept["landed_day"]) == (["ios_ifa", "mcc"], 6, "2024-01-05")
    assert '"mcc":"12x"' in kept["raw"] and kept[landing.FILE] == "export_date=2024-01-05/a.csv"
    assert daily.stored_export(w, spec, "devices").count() == 18


def test_an_empty_batch_loads(spark, tmp_path):
    w, spec = daily.Warehouse(spark, str(tmp_path / "wh")), specs.web("booking")
    assert daily.append_export(w, spec, raw_web(spark, DATA, spec).filter("`ym:pv:watchID` = 'none'")) == 0
    assert daily.stored_export(w, spec, "events").count() == 0


def test_events_that_land_in_several_files_are_read_whole(spark):
    """ingest_split_files: a day too large for one file is split, and each file is read in parts."""
    from clinicpulse.registry import QUERIES

    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    whole = rows(QUERIES["ingest_split_files"](spark, DATA))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        assert rows(QUERIES["ingest_split_files"](spark, DATA)) == whole
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)


def test_a_batch_is_parsed_once_whatever_is_made_of_it(spark, tmp_path):
    """ingest_rejects, ingest_in_batches, resume_after_failure: rows, copies and rejects come from one reading."""
    spec, w = specs.mobile(), daily.Warehouse(spark, str(tmp_path / "w"))
    write_csv(tmp_path / "in" / "export_date=2024-01-05", ["a", "b", "b"])
    raw = landing.with_file(landing.read(spark, str(tmp_path / "in"), spec, *DAYS))
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(name):
        parsed.add(1)
        return "not-a-uuid"

    raw = raw.withColumn("google_aid", counted.asNondeterministic()("event_name"))
    daily.append_export(w, spec, raw)
    assert parsed.value == 3
    found = w.rejects(spec).read()
    assert {r["landed_file"] for r in found.collect()} == {"export_date=2024-01-05/one.csv"}
    assert found.agg(F.sum("copies")).first()[0] == 3 == daily.stored_export(w, spec, "events").count()
