"""No-show report: how many booked visits of each booking operator took place, and what the others had in common."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse import params as P
from clinicpulse.functions import periods, scalars
from clinicpulse.operators.joins import hot_keys, join_to_unique
from clinicpulse.operators.staging import stage
from clinicpulse.params import ReportParams

DETAILS = ("auto", "has_lk", "is_first_visit")


def conditions(p: ReportParams) -> list[Column]:
    """The filters that are switched on; each is a plain predicate on one column."""
    groups = dict(p.site_groups)
    insurance = scalars.contains_if(p.is_online_dms, F.col("commentary"), P.INSURANCE_WORD)
    found = [
        F.col("work_mode") != P.CABINET_MODE if p.exclude_cabinet else None,
        F.col("pay_type_id").isin(list(p.pay_types)) if p.pay_types else None,
        F.col("lpu").isin(list(groups[p.site_group])) if p.site_group in groups else None,
        insurance,
        ~F.col("folder").isin(list(p.exclude_folders)) if p.exclude_folders else None,
        ~F.col("presctype").isin(list(p.exclude_presctypes)) if p.exclude_presctypes else None,
    ]
    return [c for c in found if c is not None]


def base(t: Mapping[str, DataFrame], p: ReportParams) -> DataFrame:
    """Booked visits: slot in the period, booked before it. One row per booking log entry and prescription."""
    slots = t["schedule"].filter(
        F.col("blockreason").isNull() & periods.within_days("starton", p.date_start, p.date_end)
    ).select(
        F.col("oid").alias("slot"), F.col("sotr").alias("slot_staff"), F.col("sysuser").alias("slot_user"),
        "lpu", "work_mode", F.col("starton").alias("schedule_time"),
    )
    # Booked before a slot of the period means booked before the period's end, which the log's scan can use.
    until = F.lit(p.date_end + timedelta(days=1))
    log = t["schedule_log"].filter((F.col("action") == 1) & (F.col("operation_date_time") < until)).select(
        F.col("schedule").alias("slot"), F.col("presc_schedule").alias("booking"), "presctype",
        "operator", F.col("operation_date_time").alias("create_time"), "commentary",
    )
    bookings = t["presc_schedule"].select(F.col("id").alias("booking"), "presc_id")
    prescriptions = t["presc"].select(
        F.col("id").alias("presc_id"), "mdoc_id", "visit_id", F.col("presc_state_id").alias("presc_state")
    )
    records = t["mdoc"].select(F.col("id").alias("mdoc_id"), F.col("people_id").alias("people_oid"))
    people = t["people"].select(F.col("oid").alias("people_oid"), "account_id")
    notices = t["pinfo"].select(F.col("oid").alias("people_oid"), "auto_notification")
    visits = t["visit"].select(F.col("id").alias("visit_id"), "pay_type_id")
    types = t["presctype"].select(
        F.col("oid").alias("presctype"), F.col("presctypefolderid_parent").alias("folder")
    )
    folders = t["presctypefolder"].select(F.col("id").alias("folder"))
    staff = t["sotr"].select(F.col("oid").alias("slot_staff"), F.col("sysuser").alias("staff_user"))
    joined = (
        slots.join(log, "slot")
        .filter(F.col("create_time") < F.col("schedule_time"))
        .join(bookings, "booking")
        .join(prescriptions, "presc_id")
        .join(visits, "visit_id")
        .join(types, "presctype")
        .join(folders, "folder")
        .join(records, "mdoc_id")
        .join(people, "people_oid")
        .join(notices, "people_oid", "left")
        .join(staff, "slot_staff", "left")
    )
    wanted = reduce(lambda a, b: a & b, conditions(p), F.lit(True))
    return joined.filter(wanted).select(
        F.col("operator").alias("sotr_oid"),
        F.col("presc_id").alias("presc_oid"),
        F.col("lpu").alias("lpu_oid"),
        F.coalesce("slot_user", "staff_user").alias("doc_sysuser_oid"),
        "presc_state",
        F.col("presctype").alias("presctype_oid"),
        F.col("create_time").alias("create_date_time"),
        F.col("schedule_time").alias("schedule_date_time"),
        "people_oid",
        F.col("mdoc_id").alias("mdoc_oid"),
        "auto_notification",
        "account_id",
    ).distinct()


FILE_DAY = ["mdoc_oid", "doc_sysuser_oid", "day"]


def alt_signed(
    visits: DataFrame, t: Mapping[str, DataFrame], p: ReportParams, hot: Sequence[int] | None = None
) -> DataFrame:
    """Prescriptions whose visit was signed under another record: same patient file, day and doctor, later
    than the slot, and never booked itself.

    Only the latest such record of a file, day and doctor matters, so these fold to one time each and a
    visit is compared with that, instead of pairing every visit with every record. Records are cut to the
    visits' files, days and doctors first, and only the few left are looked up among the bookings.
    """
    signers = t["sotr"].select(F.col("oid").alias("creator_id"), F.col("sysuser").alias("doc_sysuser_oid"))
    due = by_day(visits).select("presc_oid", *FILE_DAY, "schedule_date_time")
    signed = stage(
        t["presc"]
        .filter(
            F.col("presc_state_id").isin(list(p.signed_states))
            & periods.within_days("create_dt", p.date_start, p.date_end)
        )
        .join(signers, "creator_id")
        .select("id", F.col("mdoc_id").alias("mdoc_oid"), "doc_sysuser_oid", F.to_date("create_dt").alias("day"), "create_dt")
        .join(due.select(*FILE_DAY).distinct(), FILE_DAY, "left_semi"),
        "no-show-signed",
    )
    booked = t["presc_schedule"].select(F.col("presc_id").alias("id")).join(signed.select("id"), "id", "left_semi")
    latest = signed.join(booked, "id", "left_anti").groupBy(*FILE_DAY).agg(F.max("create_dt").alias("signed_at"))
    matched = join_to_unique(
        due, latest, FILE_DAY, "inner", spread_by=["presc_oid"], collapse=lambda d: d.distinct(), hot=hot
    )
    return matched.filter(F.col("signed_at") > F.col("schedule_date_time")).select("presc_oid").distinct()


def by_day(visits: DataFrame) -> DataFrame:
    return visits.withColumn("day", F.to_date("schedule_date_time"))


def seen_before(visits: DataFrame, t: Mapping[str, DataFrame], p: ReportParams) -> DataFrame:
    """The report's people with a signed prescription outside its visits.

    Starts from those people and their files, so that a report of one day shuffles a day of prescriptions.
    """
    people = stage(visits.select("people_oid").distinct(), "no-show-people")
    files = stage(
        t["mdoc"]
        .select(F.col("id").alias("mdoc_id"), F.col("people_id").alias("people_oid"))
        .join(people, "people_oid", "left_semi"),
        "no-show-files",
    )
    others = (
        t["presc"]
        .filter(F.col("presc_state_id").isin(list(p.signed_states)))
        .select(F.col("id").alias("presc_oid"), "mdoc_id")
        .join(files.select("mdoc_id").distinct(), "mdoc_id", "left_semi")
        .join(visits.select("presc_oid").distinct(), "presc_oid", "left_anti")
    )
    return files.join(others.select("mdoc_id").distinct(), "mdoc_id").select("people_oid").distinct()


def flags(visits: DataFrame, t: Mapping[str, DataFrame], p: ReportParams) -> DataFrame:
    """Per booked visit: signed (NULL for an unknown state), lead time, and the patient's traits."""
    hot_files, hot_people, hot_prescs = hot_keys(by_day(visits), FILE_DAY, ["people_oid"], ["presc_oid"])
    alternates = alt_signed(visits, t, p, hot_files).withColumn("alternate", F.lit(True))
    known = seen_before(visits, t, p).withColumn("known", F.lit(True))
    logged = ["presc_oid", "sotr_oid", "create_date_time"]
    marked = join_to_unique(visits, known, ["people_oid"], "left", spread_by=logged, hot=hot_people)
    marked = join_to_unique(marked, alternates, ["presc_oid"], "left", spread_by=logged, hot=hot_prescs)
    state_signed = F.col("presc_state").isin(list(p.signed_states))
    return marked.select(
        F.to_date("schedule_date_time").alias("schedule_date"),
        "sotr_oid",
        "presc_oid",
        "lpu_oid",
        F.when(F.col("alternate"), F.lit(True)).otherwise(state_signed).alias("is_signed"),
        state_signed.alias("state_signed"),
        "presctype_oid",
        scalars.lead_days(F.col("schedule_date_time"), F.col("create_date_time")).alias("depth"),
        F.col("account_id").isNotNull().alias("has_lk"),
        F.coalesce("auto_notification", F.lit(False)).alias("auto"),
        F.col("known").isNull().alias("is_first_visit"),
    )


def totals(pivot: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Per day, site and booking operator. ``signed`` and ``no_show`` follow ``is_signed``, which knows
    alternates; every detail follows the prescription's own state.

    Visits fold by the ids they carry before any name is joined, then by name: two operators of one name
    share a row.
    """
    staff = t["sotr"].select(F.col("oid").alias("sotr_oid"), "sysuser", "post")
    sites = t["lpu_geo"].select(F.col("oid").alias("lpu_oid"), F.col("fullname").alias("lpu"))
    posts = t["post"].select(F.col("oid").alias("post"), F.col("name").alias("post_name"))
    names = t["staff_name"].select("sysuser", F.col("full_name").alias("doctor_name"))

    def of(side: str, rows: Column) -> dict[str, Column]:
        depth = F.when(rows, F.col("depth"))
        sums = {f"{side}_days": F.sum(depth), f"{side}_visits": F.count(depth)}
        return sums | {f"{side}_{d}": F.count_if(rows & F.col(d)) for d in DETAILS}

    measures = {
        "total": F.count("presc_oid"),
        "signed": F.count_if(F.col("is_signed")),
        "no_show": F.count_if(~F.col("is_signed")),
        **of("signed", F.col("state_signed")),
        **of("no_show", ~F.col("state_signed")),
    }

    def mean(side: str) -> Column:
        days, visits = F.col(f"{side}_days"), F.col(f"{side}_visits")
        depth = F.round(F.when(visits > 0, scalars.quotient(days, visits)), 2)
        return depth.cast("decimal(12,2)").alias(f"{side}_depth")

    by_id = pivot.groupBy("schedule_date", "lpu_oid", "sotr_oid").agg(
        *[m.alias(name) for name, m in measures.items()]
    )
    by_name = (
        by_id.join(staff, "sotr_oid")
        .join(sites, "lpu_oid")
        .join(posts, "post")
        .join(names, "sysuser", "left")
        .groupBy("schedule_date", "lpu", "doctor_name")
        .agg(
            # One entry per distinct post of people of that name, so its size is that of the post list.
            F.sort_array(F.collect_set("post_name")).alias("post_names"),
            *[F.sum(name).alias(name) for name in measures],
        )
    )
    return by_name.select(
        "schedule_date", "lpu", "doctor_name", "post_names", "total", "signed", "no_show",
        mean("signed"), *[f"signed_{d}" for d in DETAILS],
        mean("no_show"), *[f"no_show_{d}" for d in DETAILS],
    )


def post_class(post_names: Column) -> Column:
    """The first class, in the given order, one of whose words occurs in any of the post names."""

    def has(words: tuple[str, ...]) -> Column:
        return F.exists(
            post_names, lambda name: reduce(lambda a, b: a | b, [F.lower(name).contains(w) for w in words])
        )

    (first, first_words), *rest = P.POST_CLASSES
    ladder = F.when(has(first_words), F.lit(first))
    for label, words in rest:
        ladder = ladder.when(has(words), F.lit(label))
    return ladder.otherwise(F.lit(P.OTHER_POST))


SCHEMA = (
    "date string, lpu string, key_post_name string, post_names array<string>, doctor_name string, total bigint, "
    "signed_count bigint, signed_pct string, no_show_count bigint, no_show_pct string, "
    "signed_depth_in_days string, signed_auto_pct string, signed_has_lk_pct string, signed_is_first_pct string, "
    "no_show_depth_in_days string, no_show_auto_pct string, no_show_has_lk_pct string, no_show_is_first_pct string"
)


def layout(summary: DataFrame) -> DataFrame:
    """The published columns; numbers as text with a decimal comma."""

    def share(part: str, whole: str) -> Column:
        return scalars.decimal_comma(scalars.safe_ratio(F.col(part), F.col(whole)))

    def days(column: str) -> Column:
        return F.when(F.col(column).isNull(), F.lit("0")).otherwise(scalars.decimal_comma(F.col(column)))

    def details(side: str) -> list[Column]:
        return [
            days(f"{side}_depth").alias(f"{side}_depth_in_days"),
            share(f"{side}_auto", side).alias(f"{side}_auto_pct"),
            share(f"{side}_has_lk", side).alias(f"{side}_has_lk_pct"),
            share(f"{side}_is_first_visit", side).alias(f"{side}_is_first_pct"),
        ]

    return summary.select(
        F.date_format("schedule_date", "yyyy-MM-dd").alias("date"),
        "lpu",
        post_class(F.col("post_names")).alias("key_post_name"),
        "post_names",
        "doctor_name",
        "total",
        F.col("signed").alias("signed_count"),
        share("signed", "total").alias("signed_pct"),
        F.col("no_show").alias("no_show_count"),
        share("no_show", "total").alias("no_show_pct"),
        *details("signed"),
        *details("no_show"),
    )


def report(t: Mapping[str, DataFrame], p: ReportParams) -> DataFrame:
    """The whole report. The visits, a chain of eleven joins used by three stages, are computed once."""
    visits = stage(base(t, p), "no-show-visits")
    return layout(totals(flags(visits, t, p), t))
