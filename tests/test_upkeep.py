"""Counts that merge over days, and files that are merged by size."""

from datetime import date, datetime, timedelta
from urllib.parse import unquote

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from clinicpulse import bindings as B
from clinicpulse import params as P
from clinicpulse.functions.periods import Months
from clinicpulse.operators import staging
from clinicpulse.plans import clustering, counts, mau, upkeep
from clinicpulse.sources import files
from clinicpulse.sources.state import StateTable

DATA = "/root/testdata/sf0.001"
MONTHS = Months(date(1995, 1, 1), date(2001, 9, 1))


def rows(df):
    return sorted([tuple(r) for r in df.select(*sorted(df.columns)).collect()], key=str)


def counted(spark, root, parts):
    by = counts.PARTITIONS
    bits, sketches = StateTable(spark, f"{root}/bits", counts.BITS, by), StateTable(spark, f"{root}/sketches", counts.SKETCHES, by)
    numbers = counts.UserNumbers(spark, f"{root}/numbers")
    for part in parts:
        counts.renew(numbers, bits, sketches, part)
    return numbers, bits, sketches


def test_bitmaps_count_what_presence_counts(spark, tmp_path):
    history = staging.stage(B.tables(spark, DATA)["history"], "history")
    old = history.filter("activity_date < '1998-01-11'")
    # The same days twice, the last time with fewer persons: days are replaced, numbers stay.
    numbers, bits, sketches = counted(spark, tmp_path, [history.filter("activity_date >= '1997-06-15'"), old, history])
    assert rows(counts.monthly(bits.read(), MONTHS, P.PRODUCT_BOOKING)) == rows(mau.booking(history, MONTHS))
    assert rows(counts.monthly(bits.read(), MONTHS, P.PRODUCT_ACCOUNT)) == rows(mau.account(history, MONTHS))
    for as_of in (date(2000, 2, 29), date(1999, 12, 31), date(2001, 1, 1)):
        assert rows(counts.year_to_date(bits.read(), as_of, 1994)) == rows(mau.year_to_date(history, as_of, 1994))
    known = numbers.table.read()
    assert known.count() == known.select("person").distinct().count() == known.select("number").distinct().count()
    # Numbers of a bucket have no gaps.
    spans = known.groupBy("bucket").agg((F.max("number") - F.min("number") + 1 - F.count("*")).alias("gap"))
    assert {r["gap"] for r in spans.collect()} == {0}


def test_year_to_date_reads_bitmaps_of_its_days_alone(spark, tmp_path):
    history = B.tables(spark, DATA)["history"]
    _, bits, _ = counted(spark, tmp_path, [history])
    plan = counts.year_to_date(bits.read(), date(2000, 2, 29), 1999)._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [")[1]


def test_sketches_stay_within_the_error(spark, tmp_path):
    people = spark.range(300_000).select(
        F.lit("oz").alias("product"), F.date_add(F.lit(date(2025, 1, 1)), (F.col("id") % 20).cast("int")).alias("activity_date"),
        (F.col("id") % 90_000).cast("string").alias("person"),
    )
    sketched = counts.day_sketches(people).withColumn("month", F.trunc("activity_date", "MM"))
    found = counts.monthly_estimate(sketched, Months(date(2025, 1, 1), date(2025, 3, 1)), "oz").orderBy("month").collect()
    assert abs(found[0]["count"] - 90_000) < 0.04 * 90_000 and found[1]["count"] == 0


def test_nobody_known_counts_nothing(spark, tmp_path):
    history = B.tables(spark, DATA)["history"].filter("product = 'none'")
    _, bits, sketches = counted(spark, tmp_path, [history])
    assert {r["count"] for r in counts.monthly(bits.read(), MONTHS, "oz").collect()} == {0}
    assert {r["count"] for r in counts.monthly_estimate(sketches.read(), MONTHS, "oz").collect()} == {0}


# --- files ----------------------------------------------------------------------------------------


def test_when_files_are_worth_merging():
    worth = lambda *sizes: upkeep.worth_merging(sizes, 100)
    assert worth(1, 1) and worth(40, 30, 100) and worth(*[10] * 30)
    assert not worth(10) and not worth() and not worth(90, 90, 20) and not worth(55, 55) and not worth(100, 100, 30)


def test_only_partitions_with_small_files_are_rewritten(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), "v bigint, a string, b int", ["a", "b"])
    part = lambda n, a, b: spark.range(n).select(F.col("id").alias("v"), F.lit(a).cast("string").alias("a"), F.lit(b).alias("b"))
    for _ in range(3):
        table.append(part(50, "x=1/y", 1))
        table.append(part(50, None, 2))
    table.append(part(1000, "x=1/y", 3))
    before, names = rows(table.read()), set(table.read().inputFiles())
    assert upkeep.merge_partitions(table) == 2
    after = set(table.read().inputFiles())
    assert rows(table.read()) == before and len(after) == 3 and len(after & names) == 1
    assert upkeep.merge_partitions(table) == 0 and set(table.read().inputFiles()) == after


def test_a_large_partition_gets_as_many_files_as_it_needs(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), "v string, a int", ["a"])
    text = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("a"))
    text.repartition(40).write.partitionBy("a").parquet(table.path)
    [(_, sizes)] = upkeep.partition_files(spark, table.path, 1)
    cap = sum(sizes) // 4
    assert upkeep.merge_partitions(table, cap) == 1
    [(_, merged)] = upkeep.partition_files(spark, table.path, 1)
    assert 3 <= len(merged) <= 5 and table.read().count() == 20_000
    assert upkeep.merge_partitions(table, cap) == 0


def test_old_copies_go_once_nothing_points_to_them(spark, tmp_path):
    folder, name = str(tmp_path / "merged"), "default.upkeep_copies"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    B.table(spark, DATA, "orders").repartition(9).write.parquet(str(tmp_path / "scattered"))
    spark.catalog.createTable(name, str(tmp_path / "scattered"), "parquet")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        assert upkeep.merge_files(spark, name, folder) and not upkeep.merge_files(spark, name, folder)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == size
        B.table(spark, DATA, "orders").write.parquet(f"{folder}/replaced")
        assert upkeep.expire(spark, folder) == []
        assert upkeep.expire(spark, folder, timedelta(days=-1)) == ["replaced"]
        assert len(files.listed(spark, folder)) == 1 and spark.table(name).count() == 1500
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- clustering -----------------------------------------------------------------------------------


def test_bits_of_the_ranks_in_turn(spark):
    pairs = spark.range(16 * 16).select((F.col("id") % 16).alias("a"), F.floor(F.col("id") / 16).alias("b"))
    out = pairs.select("a", "b", clustering.interleaved([F.col("a"), F.col("b")], 4).alias("z")).collect()
    weave = lambda a, b: int("".join(x + y for x, y in zip(f"{a:04b}", f"{b:04b}", strict=True)), 2)
    assert {(r["a"], r["b"]): r["z"] for r in out} == {(a, b): weave(a, b) for a in range(16) for b in range(16)}


def test_ranks_follow_the_cuts_at_or_below(spark):
    values = [(None,), *[(v,) for v in (-5, 0, 1, 2, 3, 7, 8, 9, 100)]]
    bounds = ["1", "3", "8"]
    out = spark.createDataFrame(values, "v int").select("v", clustering.rank(F.col("v"), "int", bounds, 3).alias("r")).collect()
    assert {r["v"]: r["r"] for r in out} == {v: 0 if v is None else 2 * sum(v >= int(b) for b in bounds) for (v,) in values}
    assert {r["r"] for r in spark.range(3).select(clustering.rank(F.col("id"), "bigint", []).alias("r")).collect()} == {0}


def footers(table):
    spans = []
    for path in table.read().inputFiles():
        stats = pq.ParquetFile(unquote(path.removeprefix("file://"))).metadata
        at = {stats.schema.column(i).name: i for i in range(stats.num_columns)}
        groups = [stats.row_group(g) for g in range(stats.num_row_groups)]
        spans.append({c: (min(g.column(i).statistics.min for g in groups), max(g.column(i).statistics.max for g in groups)) for c, i in at.items()})
    return spans


def test_footers_rule_out_most_files_by_either_column(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), "at timestamp_ntz, device string, n bigint, day string", ["day"])
    # A third of the rows are of one device; one day has one small file.
    n = F.col("id")
    device = F.when(n % 3 == 0, F.lit("d-0333")).otherwise(F.format_string("d-%04d", F.pmod(F.xxhash64(n), F.lit(1000))))
    at = F.expr("timestamp_ntz'2025-03-01 00:00:00' + make_dt_interval(0, 0, 0, id)")
    made = spark.range(60_000).select(at.alias("at"), device.alias("device"), n.alias("n"))
    table.append(made.withColumn("day", F.lit("a/b")))
    small = spark.sql("SELECT timestamp_ntz'2025-03-01 00:00:00' AS at, CAST(NULL AS STRING) AS device, 1L AS n, CAST(NULL AS STRING) AS day")
    table.append(small)
    before = rows(table.read())
    size = max(sum(sizes) for _, sizes in upkeep.partition_files(spark, table.path, 1))
    assert clustering.cluster_partitions(table, ["at", "device"], size // 31) == 1
    assert rows(table.read()) == before
    spans = [s for s in footers(table) if s["n"] != (1, 1)]
    holding = lambda c, v: sum(s[c][0] <= v <= s[c][1] for s in spans)
    assert 30 <= len(spans) <= 36
    for d in ("d-0001", "d-0250", "d-0500", "d-0999"):
        assert holding("device", d) <= len(spans) / 2
    for hour in (0, 7, 15):
        assert holding("at", datetime(2025, 3, 1, hour)) <= len(spans) / 2


def test_clustered_partitions_are_left_alone_until_rows_come(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), "v bigint, w string, a int", ["a"])
    part = lambda n: spark.range(n).select(F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("w"), F.lit(1).alias("a"))
    table.append(part(20_000))
    [(_, sizes)] = upkeep.partition_files(spark, table.path, 1)
    cap, by = sum(sizes) // 4, ["v", "w"]
    assert clustering.cluster_partitions(table, by, cap) == 1
    names = set(table.read().inputFiles())
    still = lambda found: clustering.clustered(found, by)
    assert upkeep.merge_partitions(table, cap, still) == 0 and clustering.cluster_partitions(table, by, cap) == 0
    assert set(table.read().inputFiles()) == names
    # Other columns are another order; so are new rows.
    assert clustering.cluster_partitions(table, ["w"], cap) == 1 and clustering.cluster_partitions(table, by, cap) == 1
    table.append(part(10))
    assert clustering.cluster_partitions(table, by, cap) == 1 and table.read().count() == 20_010
    empty = StateTable(spark, str(tmp_path / "none"), "v bigint, a int", ["a"])
    assert clustering.cluster_partitions(empty, ["v"], cap) == 0
