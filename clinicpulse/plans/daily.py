"""The daily runs: what the jobs read from and write to the warehouse, in order."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from datetime import date, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from clinicpulse import params as P
from clinicpulse.functions import periods, scalars
from clinicpulse.operators import staging
from clinicpulse.params import AppointmentParams, ReportParams, RevenueParams
from clinicpulse.plans import appointments, clustering, counts, identity, mau, noshow, presence, revenue, upkeep, yoy
from clinicpulse.sources import ingest, landing, specs
from clinicpulse.sources.hits import HitIndex
from clinicpulse.sources.keyfilter import KeyFilter
from clinicpulse.sources.specs import SPARK_TYPES, ExportSpec, Table
from clinicpulse.sources.state import StateTable, VersionedTable

# Figures are partitioned by their key, so writing a month or year again is an upsert of just that.
FIGURES = {
    "mau_ob_kpi": ("month date, count bigint", ["month"]),
    "mau_lk_kpi": ("month date, count bigint", ["month"]),
    "revenue_kpi": ("month date, revenue decimal(18,4)", ["month"]),
    "rate_kpi": ("month date, source string, count bigint", ["month", "source"]),
    "ob_to_call_centre_kpi": ("month date, ratio_online_to_total decimal(9,4)", ["month"]),
    "kpis_summary": ("year int, kpi string, value decimal(18,4)", ["year", "kpi"]),
}


class Warehouse:
    """Where each table of the pipeline is kept under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def export(self, spec: ExportSpec, table: Table) -> StateTable:
        kinds = {f.target: SPARK_TYPES[f.type] for f in spec.fields}
        columns = [f"{c} {kinds.get(c, 'string')}" for c in table.columns]
        schema = ", ".join([*columns, f"{ingest.EVENT_DAY} date"])
        return StateTable(self.spark, f"{self.root}/{spec.name}/{table.name}", schema, [ingest.EVENT_DAY])

    def keys(self, spec: ExportSpec) -> KeyFilter:
        """Filters of the keys an export's tables may hold; the tables share one key."""
        return KeyFilter(self.spark, f"{self.root}/{spec.name}-keys", spec.tables[0].key)

    def rejects(self, spec: ExportSpec) -> StateTable:
        """Raw rows of an export that had values of a wrong type."""
        return StateTable(self.spark, f"{self.root}/{spec.name}-rejects", ingest.REJECTS, ["landed_day"])

    @property
    def hits(self) -> HitIndex:
        """User ids by hit of the account site."""
        return HitIndex(self.spark, f"{self.root}/web_lk-hits")

    @property
    def identity(self) -> StateTable:
        by = ["source", "bucket"]
        return StateTable(self.spark, f"{self.root}/user_identity", f"{identity.SCHEMA}, bucket int", by)

    @property
    def progress(self) -> StateTable:
        """How far each step of each source has come."""
        return StateTable(self.spark, f"{self.root}/progress", "source string, step string, done_to date", ["source", "step"])

    @property
    def presence(self) -> StateTable:
        by = ["source", "product", "activity_date"]
        return StateTable(self.spark, f"{self.root}/user_presence", presence.SCHEMA, by)

    @property
    def appointments(self) -> StateTable:
        schema = "create_dt timestamp_ntz, appointment_id string, month date"
        return StateTable(self.spark, f"{self.root}/appointments", schema, ["month"])

    @property
    def channels(self) -> StateTable:
        """Online appointments with the channel they were last written under."""
        schema = "create_dt timestamp_ntz, appointment_id string, source string, month date"
        return StateTable(self.spark, f"{self.root}/online_appointments", schema, ["month"])

    @property
    def numbers(self) -> counts.UserNumbers:
        return counts.UserNumbers(self.spark, f"{self.root}/user_numbers")

    @property
    def user_bits(self) -> StateTable:
        return StateTable(self.spark, f"{self.root}/user_bits", counts.BITS, counts.PARTITIONS)

    @property
    def user_sketches(self) -> StateTable:
        return StateTable(self.spark, f"{self.root}/user_sketches", counts.SKETCHES, counts.PARTITIONS)

    def tables(self) -> dict[str, StateTable]:
        """Every table that runs add to or rewrite by partition."""
        named = {f"{s.name}/{t.name}": self.export(s, t) for s in specs.all_specs().values() for t in s.tables}
        for spec in specs.all_specs().values():
            named |= {f"{spec.name}-keys": self.keys(spec).table, f"{spec.name}-rejects": self.rejects(spec)}
        for name in ("identity", "progress", "presence", "appointments", "channels", "user_bits", "user_sketches"):
            named[name] = getattr(self, name)
        return named | {"user_numbers": self.numbers.table} | {name: self.figure(name) for name in FIGURES}

    def clustered_by(self, name: str) -> list[str]:
        """What a table's large partitions are clustered by: time and device for events, nothing for others."""
        for spec in specs.all_specs().values():
            if name == f"{spec.name}/events":
                device = {"client_id", "appmetrica_device_id"} & {f.target for f in spec.fields}
                return [spec.time, *device]
        return []

    @property
    def report(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/no_show_dashboard", noshow.SCHEMA)

    def figure(self, name: str) -> StateTable:
        schema, key = FIGURES[name]
        return StateTable(self.spark, f"{self.root}/{name}", schema, key)


def append_export(w: Warehouse, spec: ExportSpec, raw: DataFrame, path: str = identity.USER_ID_PATH) -> int:
    """Add a raw batch to the export's tables; rows already there are left as they are.

    Returns how many rows have no readable time. A failure between two tables is made good by running the batch
    again; ``events`` comes last, so a row there has its rows in the others. Filters of the keys, and the account
    site's index of hits (user ids lie at ``path`` of the params), are written before the rows they speak of.
    """
    stored = {t.name: w.export(spec, t).read() for t in spec.tables}
    # ``events`` last: the first table written has every key that any of them has.
    tables = sorted(spec.tables, key=lambda t: t.name == "events")
    first, key_columns = tables[0].name, dict.fromkeys([*spec.tables[0].key, spec.time])
    keys, misfits = w.keys(spec), Observation()
    if keys.is_empty() and not stored[first].isEmpty():
        # A warehouse filled before there were filters.
        keys.add(stored[first].select(*key_columns, ingest.EVENT_DAY), ingest.EVENT_DAY)
    with staging.scope(w.spark):
        # Computing it once counts the values that do not fit.
        raw = ingest.observed(landing.with_file(raw), spec, misfits)
        if landing.FILE in raw.columns:
            # Landed files are parsed once; what needs the rows again reads them typed as text.
            raw = staging.stage(raw, "raw")
        wide = staging.stage(ingest.normalise(raw, spec), f"export-{spec.name}")
        if any(misfits.get.values()):
            add_rejects(w, spec, ingest.rejects(raw, spec))
        rows = ingest.new_rows(wide, spec, stored, keys)
        day = F.to_date(spec.time).alias(ingest.EVENT_DAY)
        keys.add(rows[first].select(*key_columns, day), ingest.EVENT_DAY)
        if spec.name == specs.ACCOUNT:
            params = rows["event_params"].select("watch_id", scalars.user_id_from_json(F.col("params"), path).alias("internal"))
            w.hits.append(params.filter("internal IS NOT NULL"))
        for table in tables:
            w.export(spec, table).append(rows[table.name].select("*", day))
        return ingest.unreadable(wide, spec)


def add_rejects(w: Warehouse, spec: ExportSpec, found: DataFrame) -> None:
    """Keep the raw rows a load could not type whole; the same file read again adds none."""
    stored = w.rejects(spec).read()
    found = staging.stage(found, "rejects")
    days = [r["landed_day"] for r in found.select("landed_day").distinct().collect()]
    old = stored.filter(F.col("landed_day").isin(days)).select(F.sha2(F.concat_ws("\n", landing.FILE, "raw"), 256).alias("_id"))
    w.rejects(spec).append(found.join(old, F.sha2(F.concat_ws("\n", landing.FILE, "raw"), 256) == F.col("_id"), "left_anti"))


def stored_export(w: Warehouse, spec: ExportSpec, table: str) -> DataFrame:
    return w.export(spec, next(t for t in spec.tables if t.name == table)).read()


def read_export(w: Warehouse, spec: ExportSpec, table: str, start: date, end: date) -> DataFrame:
    """The stored rows of the given days; other partitions are not opened."""
    return stored_export(w, spec, table).filter(F.col(ingest.EVENT_DAY).between(F.lit(start), F.lit(end)))


# The steps of a source, each done up to a day of its own.
LOAD, IDENTITY, PRESENCE = "load", "identity", "presence"
CLINIC, CHANNELS = "clinic", "channels"


def done_to(w: Warehouse, source: str, step: str) -> date | None:
    found = w.progress.read().filter((F.col("source") == source) & (F.col("step") == step))
    return periods.last_value(found, "done_to")


def mark_done(w: Warehouse, source: str, step: str, day: date) -> None:
    """Written after the step's results, so a step that failed is run again, for all the days it missed."""
    w.progress.replace_partitions(w.spark.createDataFrame([(source, step, day)], "source string, step string, done_to date"))


def load_source(
    w: Warehouse, landed: str, spec: ExportSpec, as_of: date, path: str = identity.USER_ID_PATH
) -> tuple[date, date] | None:
    """Load the days the source has not been loaded for; None if yesterday is there already."""
    days = periods.next_slice(done_to(w, spec.name, LOAD), as_of)
    if days is not None:
        with staging.scope(w.spark):
            append_export(w, spec, landing.read(w.spark, landed, spec, *days), path)
        mark_done(w, spec.name, LOAD, days[1])
    return days


def pending(w: Warehouse, spec: ExportSpec, step: str) -> tuple[date, date] | None:
    """The loaded days a step has not covered yet; None if there are none."""
    loaded, done = done_to(w, spec.name, LOAD), done_to(w, spec.name, step)
    if loaded is None:
        return None
    if done is None:
        first = stored_export(w, spec, "events").agg(F.min(ingest.EVENT_DAY).alias("first")).first()["first"]
        done = (first or loaded) - timedelta(days=1)
    return None if done >= loaded else (done + timedelta(days=1), loaded)


def catch_up(w: Warehouse, spec: ExportSpec, step: str, run: Callable[[date, date], None]) -> None:
    """Run a step over the loaded days it has not covered. All steps are merges, so a day may come twice."""
    days = pending(w, spec, step)
    if days is not None:
        run(*days)
        mark_done(w, spec.name, step, days[1])


def _merge_identity(w: Warehouse, source: str, batch: DataFrame) -> None:
    """Only the hash buckets that hold a device of the batch are read and rewritten."""
    with staging.scope(w.spark):
        batch = staging.stage(batch.withColumn("bucket", identity.bucket("external_user_id")), "identity-batch")
        # At most ``identity.BUCKETS`` numbers.
        touched = [r["bucket"] for r in batch.select("bucket").distinct().collect()]
        stored = w.identity.read().filter((F.col("source") == source) & F.col("bucket").isin(touched))
        merged = identity.merge(stored.drop("bucket"), batch.drop("bucket"))
        w.identity.replace_partitions(merged.withColumn("bucket", identity.bucket("external_user_id")))


def _merge_presence(w: Warehouse, kind: presence.Presence, batch: DataFrame, start: date, end: date) -> None:
    stored = w.presence.read().filter(
        (F.col("source") == kind.source)
        & (F.col("product") == kind.product)
        & F.col("activity_date").between(F.lit(start), F.lit(end))
    )
    w.presence.replace_partitions(presence.merge(stored, batch))


def _present(w: Warehouse, spec: ExportSpec, kinds: Sequence[presence.Presence], start: date, end: date) -> None:
    events = read_export(w, spec, "events", start, end)
    for kind in kinds:
        _merge_presence(w, kind, presence.build(events, w.identity.read(), kind, start, end), start, end)
        renew_counts(w, kind.product, start, end)


def renew_counts(w: Warehouse, product: str, start: date, end: date) -> None:
    """Bitmaps and sketches of a product's days, from all its sources."""
    days = F.col("activity_date").between(F.lit(start), F.lit(end))
    present = w.presence.read().filter((F.col("product") == product) & days)
    counts.renew(w.numbers, w.user_bits, w.user_sketches, present)


def identify_mobile(w: Warehouse, start: date, end: date) -> None:
    events = read_export(w, specs.mobile(), "events", start, end)
    _merge_identity(w, P.SOURCE_MOBILE, identity.mobile(events, start, end))


def attend_mobile(w: Warehouse, allowed: DataFrame, start: date, end: date) -> None:
    with staging.scope(w.spark):
        # Written first, so that the planner sees how small it is and leaves the events where they are.
        listed = presence.mobile_listed(staging.stage(allowed.select("event_type").distinct(), "allowed"))
        _present(w, specs.mobile(), (listed, presence.mobile_all()), start, end)


def identify_booking(w: Warehouse, start: date, end: date, path: str) -> None:
    events, extra = (read_export(w, specs.web("booking"), t, start, end) for t in ("events", "event_params"))
    _merge_identity(w, P.SOURCE_BOOKING, identity.booking(events, extra, start, end, path=path))


def attend_booking(w: Warehouse, goal_prefix: str, start: date, end: date) -> None:
    _present(w, specs.web("booking"), (presence.site_goals(goal_prefix),), start, end)


def identify_account(w: Warehouse, start: date, end: date, path: str) -> None:
    """Params match by hit whatever their time; the index of hits has their user ids, so no params are read.

    A warehouse filled before there was an index gets it from all its params once.
    """
    spec = specs.web(specs.ACCOUNT)
    if w.hits.read().isEmpty():
        params = stored_export(w, spec, "event_params")
        users = params.select("watch_id", scalars.user_id_from_json(F.col("params"), path).alias("internal"))
        w.hits.append(users.filter("internal IS NOT NULL"))
    events = read_export(w, spec, "events", start, end)
    _merge_identity(w, P.SOURCE_ACCOUNT, identity.account_by_index(events, w.hits.read(), start, end))


def attend_account(w: Warehouse, start: date, end: date) -> None:
    _present(w, specs.web("web_lk"), (presence.site_page_views(),), start, end)


def update_mobile(w: Warehouse, allowed: DataFrame, start: date, end: date) -> None:
    identify_mobile(w, start, end)
    attend_mobile(w, allowed, start, end)


def update_booking(w: Warehouse, goal_prefix: str, start: date, end: date, path: str) -> None:
    identify_booking(w, start, end, path)
    attend_booking(w, goal_prefix, start, end)


def update_account(w: Warehouse, start: date, end: date, path: str) -> None:
    identify_account(w, start, end, path)
    attend_account(w, start, end)


def update_users(w: Warehouse, as_of: date) -> None:
    """Monthly users from one month before the last stored one, and each year's users to this day."""
    present = w.presence.read()
    for name, build, first in (
        ("mau_ob_kpi", mau.booking, periods.FIRST_MONTH),
        ("mau_lk_kpi", mau.account, periods.FIRST_MONTH_ACCOUNT_MAU),
    ):
        last = periods.last_value(w.figure(name).read(), "month")
        months = periods.trailing_months(last, as_of, first, floor=False)
        w.figure(name).replace_partitions(build(present, months))
    if w.user_bits.read().isEmpty():
        # A warehouse filled before days were counted.
        counts.renew(w.numbers, w.user_bits, w.user_sketches, present)
    yearly = counts.year_to_date(w.user_bits.read(), as_of)
    w.figure("kpis_summary").replace_partitions(yearly.withColumn("value", F.col("value").cast("decimal(18,4)")))


def run_analytics(
    w: Warehouse, landed: Mapping[str, str], allowed: DataFrame, goal_prefix: str, as_of: date,
    path: str = identity.USER_ID_PATH,
) -> None:
    """The whole chain for one day. A step that is up to date is skipped, one that failed before covers the days it
    missed, and the figures are always renewed."""
    mobile, booking, account = specs.mobile(), specs.web("booking"), specs.web(specs.ACCOUNT)
    load_source(w, landed["mobile"], mobile, as_of)
    catch_up(w, mobile, IDENTITY, lambda start, end: identify_mobile(w, start, end))
    catch_up(w, mobile, PRESENCE, lambda start, end: attend_mobile(w, allowed, start, end))
    load_source(w, landed["booking"], booking, as_of)
    catch_up(w, booking, IDENTITY, lambda start, end: identify_booking(w, start, end, path))
    catch_up(w, booking, PRESENCE, lambda start, end: attend_booking(w, goal_prefix, start, end))
    load_source(w, landed["web_lk"], account, as_of, path)
    catch_up(w, account, IDENTITY, lambda start, end: identify_account(w, start, end, path))
    catch_up(w, account, PRESENCE, lambda start, end: attend_account(w, start, end))
    update_users(w, as_of)


def _touched(log: DataFrame, since: date) -> Column:
    """Entries written or changed since a day, or at an unknown time."""
    return (
        (F.col("created_at") >= F.lit(since)) | (F.col("updated_at") >= F.lit(since)) | F.col("updated_at").isNull()
    )


def renew_channels(w: Warehouse, log: DataFrame, months: Collection[date]) -> None:
    """Split the online appointments of some months by channel again, and count those of the online channel.

    The months are counted anew and not by differences, as a count can be repeated after a failure. A month that has
    none left is written as 0, so its old count does not stay.
    """
    due = w.appointments.read().filter(F.col("month").isin(sorted(months)))
    # A task holds the ids of its part only; the log's rows pass.
    ids = due.select(F.col("appointment_id").alias("appointment_oid")).hint("shuffle_hash")
    entries = log.join(ids, "appointment_oid", "left_semi")
    with staging.scope(w.spark):
        split = staging.stage(
            appointments.with_channel(due, appointments.latest_source(entries, periods.FIRST_MONTH)), "channels"
        )
        w.channels.replace_partitions(split)
        counted = appointments.by_channel(split).filter(F.col("source") == P.CHANNEL_ONLINE)
        w.figure("rate_kpi").replace_partitions(appointments.with_zeros(counted, months, P.CHANNEL_ONLINE))


def run_clinic(
    w: Warehouse, t: Mapping[str, DataFrame], as_of: date, revenue_params: RevenueParams,
    visit_params: AppointmentParams,
) -> None:
    """Revenue, call-centre counts, online appointments, channel split, and the yearly changes."""

    def months(last: date | None) -> periods.Months:
        return periods.trailing_months(last, as_of)

    stored = w.figure("revenue_kpi")
    span = months(periods.last_value(stored.read(), "month"))
    with staging.scope(w.spark):
        stored.replace_partitions(revenue.monthly(t, span, revenue_params))

    rates = w.figure("rate_kpi")
    calls = rates.read().filter(F.col("source") == P.CHANNEL_CALL_CENTER)
    span = months(periods.last_value(calls, "month"))
    rates.replace_partitions(appointments.call_center(t, span, visit_params))

    loaded = w.appointments
    span = months(periods.last_value(loaded.read(), "create_dt"))
    found = appointments.online(t, span, visit_params).withColumn("month", periods.month_of("create_dt"))
    recent = loaded.read().filter(span.of("month"))
    with staging.scope(w.spark):
        loaded.append(appointments.new_online(recent, found))

    # A log entry may come at any later time, so the months renewed are those of the appointments in range and those
    # the log has written about since the last run.
    marked = done_to(w, CLINIC, CHANNELS)
    log = t["appointment_record"]
    with staging.scope(w.spark):
        since = log if marked is None else log.filter(_touched(log, marked - timedelta(days=1)))
        written = since.select(F.col("appointment_oid").alias("appointment_id")).distinct()
        touched = loaded.read().join(written, "appointment_id", "left_semi").select("month").distinct()
        # One date per month of the clinic's life.
        due = {r["month"] for r in touched.collect()} | {r["month"] for r in span.spine(w.spark).collect()}
    renew_channels(w, log, due)
    mark_done(w, CLINIC, CHANNELS, as_of)
    w.figure("ob_to_call_centre_kpi").replace_partitions(appointments.online_ratio(rates.read()))

    summary = w.figure("kpis_summary")
    summary.replace_partitions(yoy.revenue(w.figure("revenue_kpi").read()))
    summary.replace_partitions(yoy.ratio(w.figure("ob_to_call_centre_kpi").read()))


def run_report(w: Warehouse, t: Mapping[str, DataFrame], report_params: ReportParams) -> None:
    """Replace the no-show report. A run that fails raises, and the previous report stays the current one."""
    with staging.scope(w.spark):
        w.report.publish(noshow.report(t, report_params).orderBy(F.desc("date")))
    w.report.expire()


def run_upkeep(w: Warehouse, file_bytes: int = upkeep.FILE_BYTES) -> dict[str, int]:
    """Merge small files of the warehouse's tables and cluster large partitions of events by time and device.

    Returns how many partitions of each were rewritten. What is clustered and was not added to since is left alone.
    """
    rewritten = {}
    for name, table in w.tables().items():
        by = w.clustered_by(name)
        settled = partial(clustering.clustered, columns=by)
        rewritten[name] = upkeep.merge_partitions(table, file_bytes, settled)
        if by:
            rewritten[name] += clustering.cluster_partitions(table, by, file_bytes)
    w.report.expire()
    return {name: n for name, n in rewritten.items() if n}
