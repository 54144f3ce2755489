"""Export files landed under ``<path>/export_date=YYYY-MM-DD/``."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F, types as T

from clinicpulse.operators import staging
from clinicpulse.sources import files
from clinicpulse.sources.specs import ExportSpec

DAY = "export_date"
FILE = "landed_file"


def _place() -> Column:
    """The landed day's folder and the file's name; found by counting slashes, as every row asks for it."""
    return F.substring_index("_metadata.file_path", "/", -2)


def raw_schema(spec: ExportSpec) -> T.StructType:
    """All text: types are applied by the spec, where a bad value becomes NULL and not a failed load."""
    return T.StructType([T.StructField(c, T.StringType()) for c in spec.header])


def reader_options(spec: ExportSpec) -> dict[str, object]:
    """JSON lines spell line breaks out, so only CSV needs to be told of them."""
    if spec.format != "csv":
        return {}
    return {
        "multiLine": spec.multiline, "header": True, "quote": '"', "escape": '"', "enforceSchema": False, "emptyValue": "",
    }


def landed_schema(spec: ExportSpec) -> T.StructType:
    return T.StructType([*raw_schema(spec).fields, T.StructField(DAY, T.DateType())])


def with_file(files: DataFrame) -> DataFrame:
    """Name the day and file each row landed in: equal rows of two files are two rows, whatever batch reads them.

    A frame that names them already keeps its names, and rows that were not read from files have none. Files read
    back after staging would give other names, so a batch is named before it is staged.
    """
    if FILE in files.columns:
        return files
    try:
        return files.select("*", _place().alias(FILE))
    except AnalysisException as missing:
        if not missing.getCondition().startswith("UNRESOLVED_COLUMN"):
            raise
        return files


def landed_files(spark: SparkSession, path: str, start: date, end: date) -> list[files.Listed]:
    """The files of the landed days ``start`` to ``end``."""
    found = []
    for folder in files.listed(spark, path):
        name, _, day = folder.name.partition("=")
        if folder.is_folder and name == DAY and str(start) <= day <= str(end):
            found += [f for f in files.listed(spark, folder.path) if not f.is_folder and f.name[0] not in "._"]
    return found


def read(spark: SparkSession, path: str, spec: ExportSpec, start: date, end: date) -> DataFrame:
    """Rows of the landed days ``start`` to ``end``; other days' folders are not opened.

    A CSV reader that allows line breaks inside texts takes a file whole. So files above the size of a scan's task are
    read in parts, which stages them; the others are a task each as it is.
    """
    if spec.format == "csv" and spec.multiline:
        landed = [(f.path, f.size) for f in landed_files(spark, path, start, end)]
        if any(size > part_bytes(spark) for _, size in landed):
            return read_named(spark, path, spec, landed)
    return _reader(spark, spec).load(path).filter(F.col(DAY).between(F.lit(start), F.lit(end))).drop(DAY)


def read_named(spark: SparkSession, path: str, spec: ExportSpec, landed: Iterable[tuple[str, int]]) -> DataFrame:
    """Rows of files under ``path`` given by name and size."""
    landed = list(landed)
    parts = part_bytes(spark) if spec.format == "csv" and spec.multiline else float("inf")
    return read_files(spark, path, spec, [f for f, size in landed if size > parts], [f for f, size in landed if size <= parts])


def _reader(spark: SparkSession, spec: ExportSpec) -> DataFrameReader:
    return spark.read.format(spec.format).schema(landed_schema(spec)).options(**reader_options(spec))


def part_bytes(spark: SparkSession) -> int:
    """What one task of a scan reads at most."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def read_files(spark: SparkSession, path: str, spec: ExportSpec, large: list[str], small: list[str]) -> DataFrame:
    """Rows of some landed files under ``path``, with the file each is from: the large ones in parts."""
    parts, broken = records(spark, path, large) if large else (None, [])
    whole = small + broken
    rows = parsed(parts, spec) if large else None
    if whole or rows is None:
        read_whole = with_file(_reader(spark, spec).option("basePath", path).load(whole)).drop(DAY)
        rows = read_whole if rows is None else rows.unionByName(read_whole)
    return rows




def records(spark: SparkSession, path: str, large: list[str]) -> tuple[DataFrame, list[str]]:
    """(landed_file, number, text) of the records of CSV files, each file read by many tasks; and the files whose
    quotes do not close, which cannot be read so.

    A line break parts two records if the quotes before it are even in number, as a quote inside a text is written
    twice. The lines of each part of a file are numbered with a running count of quotes; the counts of whole parts are
    summed along the file; then every line knows whether a record ends with it, and which one it belongs to. Only
    records of several lines meet by a shuffle. As in any CSV of this kind, a text with a quote must itself be quoted.
    """
    raw = spark.read.schema("value string").option("lineSep", "\n").option("basePath", path).text(large)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = raw.select(
        "value",
        quotes.alias("quotes"),
        _place().alias(FILE),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("seq"),
    )
    so_far = Window.partitionBy(FILE, "part").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = lines.withColumn("running", F.sum("quotes").over(so_far)).withColumn("line", F.row_number().over(so_far))
    closed = (F.col("running") % 2 == 0).cast("bigint")
    numbered = staging.stage(numbered.withColumn("closed", F.sum(closed).over(so_far)), "lines")
    # A row per part of a file from here.
    first_line = (F.col("part") == 0) & (F.col("line") == 1)
    parts = numbered.groupBy(FILE, "part").agg(
        F.sum("quotes").alias("quotes"), F.max("closed").alias("closed"), F.count(F.lit(1)).alias("lines"),
        F.max(first_line & F.endswith("value", F.lit("\r"))).alias("returns"),
    )
    before = Window.partitionBy(FILE).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    opening = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    parts = parts.withColumn("opening", opening).withColumn(
        "ends", F.when(F.col("opening") == 0, F.col("closed")).otherwise(F.col("lines") - F.col("closed"))
    )
    parts = parts.withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    parts = staging.stage(parts.withColumn("returns", F.max("returns").over(Window.partitionBy(FILE))), "parts")
    open_files = parts.groupBy(FILE).agg((F.sum("quotes") % 2 == 1).alias("broken")).filter("broken")
    broken_names = {r[FILE] for r in open_files.collect()}
    placed = numbered.join(parts.select(FILE, "part", "opening", "first", "returns"), [FILE, "part"])
    inside = (F.col("opening") + F.col("running")) % 2
    ends = inside == 0
    begins = (F.col("opening") + F.col("running") - F.col("quotes")) % 2 == 0
    ended = F.when(F.col("opening") == 0, F.col("closed")).otherwise(F.col("line") - F.col("closed"))
    number = F.col("first") + ended - F.when(ends, 1).otherwise(0)
    # In a file whose lines end with carriage return and line feed, both are one line break.
    value = F.when(F.col("returns"), F.regexp_replace("value", "\r\\z", "")).otherwise(F.col("value")).alias("value")
    placed = placed.filter(~F.col(FILE).isin(sorted(broken_names))).select(
        FILE, number.alias("number"), "part", "seq", value, (begins & ends).alias("alone")
    )
    several = placed.filter("NOT alone").groupBy(FILE, "number").agg(
        F.array_sort(F.collect_list(F.struct("part", "seq", "value"))).alias("lines")
    )
    whole = placed.filter("alone").select(FILE, "number", F.col("value").alias("text")).unionByName(
        several.select(FILE, "number", F.array_join("lines.value", "\n").alias("text"))
    )
    broken = [p for p in large if "/".join(p.split("/")[-2:]) in broken_names]
    return whole, broken


def parsed(whole: DataFrame, spec: ExportSpec) -> DataFrame:
    """Records as the spec's text columns. The first record of a file must name them; blank ones are none."""
    shape = ", ".join(f"`{c}` STRING" for c in spec.header)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in reader_options(spec).items() if k not in ("header", "enforceSchema")}
    rows = whole.filter(F.trim("text") != "").select(FILE, "number", F.from_csv("text", shape, options).alias("row"))
    named = F.array(*[F.col("row")[c] for c in spec.header]) == F.array(*[F.lit(c) for c in spec.header])
    refused = F.raise_error(F.concat(F.lit("the header does not name the export's columns: "), F.col(FILE))).cast("boolean")
    is_row = F.when(F.col("number") > 0, F.lit(True)).otherwise(F.when(F.coalesce(named, F.lit(False)), F.lit(False)).otherwise(refused))
    return rows.filter(is_row).select("row.*", FILE)


def write(df: DataFrame, path: str, spec: ExportSpec, day: str = DAY) -> None:
    """Land a raw frame as export files, one folder per day; large days are split over several files."""
    out = df.hint("rebalance", day).write.partitionBy(day).format(spec.format)
    if spec.format == "csv":
        out = out.options(header=True, quote='"', escape='"', emptyValue="")
    out.mode("append").save(path)
