"""Typed tables from raw export rows."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from clinicpulse.functions import scalars
from clinicpulse.operators import rowid, staging, upsert
from clinicpulse.sources import landing
from clinicpulse.sources.keyfilter import DAY as KEY_DAY, KeyFilter
from clinicpulse.sources.specs import INET, JSON, SPARK_TYPES, STRING, UUID, ExportSpec, Field

# Partition column of the stored export tables: the day of the event.
EVENT_DAY = "event_day"
UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def typed(field: Field) -> Column:
    """The field's first set source, without sentinels, as its declared type; NULL if it does not fit."""
    value = F.coalesce(*[scalars.none_if(F.col(f"`{s}`"), field.null_values) for s in field.sources])
    if field.type == UUID:
        value = F.when(value.rlike(UUID_PATTERN), F.lower(value))
    return value.try_cast(SPARK_TYPES[field.type]).alias(field.target)


def required(field: Field) -> Column:
    missing = F.raise_error(F.lit(f"row without a valid {field.target}")).cast(SPARK_TYPES[field.type])
    return F.coalesce(typed(field), missing).alias(field.target)


def strip_prefix(raw: DataFrame, spec: ExportSpec) -> DataFrame:
    return raw.toDF(*[c.removeprefix(spec.prefix) for c in raw.columns])


def normalise(raw: DataFrame, spec: ExportSpec) -> DataFrame:
    """Every column any table of the spec needs, typed, one row per key of its tables.

    Exports without a key get a row id, so every row is kept. Otherwise the tables share one key, and its
    repeats are settled here once for all of them; a row whose key cannot be read fails the load, as a primary
    key would.
    """
    raw = strip_prefix(landing.with_file(raw), spec)
    if spec.row_id is None:
        key = spec.tables[0].key
        wide = raw.select(*[required(f) if f.target in key else typed(f) for f in spec.fields])
        return upsert.first_per_key(wide, key)
    return rowid.with_row_id(raw, spec.row_id).select(spec.row_id, *[typed(f) for f in spec.fields])


def misfit(field: Field) -> Column:
    """Whether the field has a value that is lost because it does not fit the declared type."""
    value = F.coalesce(*[scalars.none_if(F.col(f"`{s}`"), field.null_values) for s in field.sources])
    return F.coalesce(F.trim(value) != "", F.lit(False)) & typed(field).isNull()


def checked_fields(spec: ExportSpec) -> list[Field]:
    return [f for f in spec.fields if f.type not in (STRING, JSON, INET)]


def observed(raw: DataFrame, spec: ExportSpec, counts: Observation) -> DataFrame:
    """``raw``, which counts each field's misfits into ``counts`` whenever it is computed."""
    renamed = strip_prefix(raw, spec)
    # Found in compiled code first: what is observed is interpreted row by row.
    found = {f"_misfit{i}": f for i, f in enumerate(checked_fields(spec))}
    marked = renamed.select("*", *[misfit(f).alias(mark) for mark, f in found.items()])
    seen = marked.observe(counts, *[F.count_if(F.col(mark)).alias(f.target) for mark, f in found.items()])
    return seen.drop(*found).toDF(*raw.columns)


REJECTS = "landed_file string, fields array<string>, raw string, copies bigint, landed_day string"


def rejects(raw: DataFrame, spec: ExportSpec) -> DataFrame:
    """The raw rows that have misfits, as JSON, with the fields concerned; equal rows of a file are one with a count.

    The rows are loaded all the same, with NULL in those fields.
    """
    named = landing.with_file(raw)
    if landing.FILE not in named.columns:
        named = named.withColumn(landing.FILE, F.lit(None).cast("string"))
    renamed = strip_prefix(named, spec)
    bad = F.array_compact(F.array(*[F.when(misfit(f), F.lit(f.target)) for f in checked_fields(spec)]))
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in renamed.columns if c != landing.FILE]))
    found = renamed.select(landing.FILE, bad.alias("fields"), whole.alias("raw")).filter(F.size("fields") > 0)
    day = F.coalesce(F.regexp_extract(landing.FILE, f"{landing.DAY}=([^/]+)/", 1), F.lit("none"))
    return found.groupBy(landing.FILE, "fields", "raw").agg(F.count(F.lit(1)).alias("copies")).withColumn("landed_day", day)


def fan_out(wide: DataFrame, spec: ExportSpec) -> dict[str, DataFrame]:
    return {t.name: wide.select(*t.columns) for t in spec.tables}


def new_rows(
    wide: DataFrame, spec: ExportSpec, stored: Mapping[str, DataFrame], keys: KeyFilter | None = None
) -> dict[str, DataFrame]:
    """Per table, the rows to append. Equal keys have equal times, so a stored row can only lie on its own event day,
    or in the partition of rows without a readable time.

    With filters of the stored keys, only days that may hold one of the batch's are opened, and none if there are none.
    """
    loaded = fan_out(wide, spec)
    key = list(spec.tables[0].key)
    day = F.to_date(spec.time).alias(EVENT_DAY)
    if keys is None or keys.is_empty():
        held, days = None, [r[EVENT_DAY] for r in wide.select(day).distinct().collect()]
    else:
        held = staging.stage(keys.may_hold(wide.select(*dict.fromkeys([*key, spec.time]), day), EVENT_DAY), "held-keys")
        # No more than there are stored partitions, as each comes from a filter of one.
        days = [None if r[0] == "none" else date.fromisoformat(r[0]) for r in held.select(KEY_DAY).distinct().collect()]
        if not days:
            return loaded
    known = sorted(d for d in days if d is not None)
    rows = {}
    for table in spec.tables:
        old = stored[table.name]
        if EVENT_DAY in old.columns:
            of_days = F.col(EVENT_DAY).isin(known) if known else F.lit(False)
            old = old.filter(of_days | F.col(EVENT_DAY).isNull() if None in days else of_days)
        old = old.select(*table.key)
        if held is not None:
            old = old.join(held.select(*key), key, "left_semi")
        rows[table.name] = upsert.insert_if_absent(old, loaded[table.name], table.key)
    return rows


def unreadable(wide: DataFrame, spec: ExportSpec) -> int:
    """How many rows have no readable time; they are stored, but belong to no day."""
    return wide.filter(F.col(spec.time).isNull()).count()


def run(
    spark: SparkSession,
    path: str,
    spec: ExportSpec,
    stored: Mapping[str, DataFrame],
    start: date,
    end: date,
) -> dict[str, DataFrame]:
    """Landed files of the given days to rows to append."""
    return load(landing.read(spark, path, spec, start, end), spec, stored)


def load(raw: DataFrame, spec: ExportSpec, stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw rows to rows to append. The wide frame is written once; each table then reads its columns."""
    return new_rows(staging.stage(normalise(raw, spec), f"export-{spec.name}"), spec, stored)
