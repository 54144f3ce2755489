"""Hand-made edge rows, with the results worked out by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clinicpulse import params as P
from clinicpulse.functions import periods, scalars
from clinicpulse.functions.periods import Months
from clinicpulse.params import AppointmentParams, ReportParams, RevenueParams
from clinicpulse.plans import appointments, identity, mau, noshow, presence, revenue, yoy
from clinicpulse.sources import ingest, specs

JAN = (date(2025, 1, 1), date(2025, 1, 31))
def now():
    return F.expr("TIMESTAMP_NTZ '2025-02-01 03:00:00'")


def at(day, hour=0, minute=0, second=0, month=1, year=2025):
    return datetime(year, month, day, hour, minute, second)


# --- identity and presence ------------------------------------------------------------------------


@pytest.mark.parametrize("new_first", [at(3), datetime(2024, 12, 31)])
def test_identity_merge_keeps_first_sighting_and_known_id(spark, new_first):
    old = spark.createDataFrame([("s", "x", 7, at(1), at(5), None)], identity.SCHEMA)
    new = spark.createDataFrame([("s", "x", None, new_first, at(4), None)], identity.SCHEMA).drop("updated_at")
    row = identity.merge(old, new, now()).first()
    assert (row.internal_user_id, row.first_seen_at, row.last_seen_at) == (7, at(1), at(5))
    assert row.updated_at == datetime(2025, 2, 1, 3)


def test_identity_merge_inserts_without_stamp_and_leaves_others(spark):
    old = spark.createDataFrame([("s", "x", 7, at(1), at(5), at(6))], identity.SCHEMA)
    new = spark.createDataFrame([("s", "y", 1, at(3), at(4))], identity.SCHEMA.rsplit(",", 1)[0])
    rows = {r.external_user_id: r for r in identity.merge(old, new, now()).collect()}
    assert rows["y"].updated_at is None and rows["x"].updated_at == at(6) and rows["x"].internal_user_id == 7


def hits(spark, rows):
    return spark.createDataFrame(rows, "watch_id long, client_id long, date_time timestamp_ntz")


def extra(spark, rows):
    return spark.createDataFrame(rows, "watch_id long, date_time timestamp_ntz, params string")


def test_booking_needs_params_account_does_not(spark):
    events = hits(spark, [(1, 10, at(2)), (2, 11, at(3)), (3, None, at(3))])
    params = extra(spark, [(1, at(2), '{"user_id": 5}'), (1, at(9), '{"user_id": 6}'), (3, at(3), '{"user_id": 9}')])
    found = {r.external_user_id: r.internal_user_id for r in identity.booking(events, params, *JAN).collect()}
    assert found == {"10": 5}
    found = {r.external_user_id: r.internal_user_id for r in identity.account(events, params, *JAN).collect()}
    assert found == {"10": 6, "11": None}


def test_malformed_params_give_no_id(spark):
    events = hits(spark, [(1, 10, at(2))])
    for bad in ("{bad", "", "[]", '{"user_id": "x"}', None):
        row = identity.booking(events, extra(spark, [(1, at(2), bad)]), *JAN).first()
        assert row.internal_user_id is None


def test_presence_covers_the_whole_last_day(spark):
    events = spark.createDataFrame(
        [(1, at(31, 23, 59, 59)), (2, datetime(2025, 2, 1))], "appmetrica_device_id long, event_datetime timestamp_ntz"
    )
    nobody = spark.createDataFrame([], identity.SCHEMA)
    rows = presence.build(events, nobody, presence.mobile_all(), *JAN).collect()
    assert [r.external_user_id for r in rows] == ["1"]


def test_presence_conflict_changes_only_the_id(spark):
    old = spark.createDataFrame([(date(2025, 1, 2), "s", "oz", "web", None, "x", at(2, 9), None)], presence.SCHEMA)
    new = spark.createDataFrame(
        [(date(2025, 1, 2), "s", "oz", "mobile", 4, "x", at(2, 8), None)], presence.SCHEMA
    ).drop("updated_at")
    rows = presence.merge(old, new, now()).collect()
    assert len(rows) == 1
    assert (rows[0].platform, rows[0].internal_user_id, rows[0].first_event_time) == ("web", 4, at(2, 9))


def test_presence_without_external_id_is_not_piled_up(spark):
    day = spark.createDataFrame([(date(2025, 1, 2), "s", "oz", "web", None, None, at(2, 9), None)], presence.SCHEMA)
    assert presence.merge(day, day.drop("updated_at"), now()).count() == 1


def present(spark, rows):
    return spark.createDataFrame(
        [(date(2025, 1, 5), *r) for r in rows],
        "activity_date date, source string, product string, platform string, internal_user_id long, "
        "external_user_id string",
    )


def test_booking_users(spark):
    rows = [("web", "oz", "web", 1, "a"), ("mobile", "oz", "mobile", 1, "b"), ("web", "oz", "web", None, "a"),
            ("web", "oz", "web", None, None), ("web", "lk", "web", 8, "a")]
    row = mau.booking(present(spark, rows), Months(date(2025, 1, 1), date(2025, 2, 1))).first()
    assert row["count"] == 2


def test_account_users(spark):
    rows = [("m", "lk", "mobile", None, "x"), ("m", "lk", "mobile", 5, "y"), ("w", "lk", "web", 5, "z"),
            ("w", "lk", "web", None, "w")]
    row = mau.account(present(spark, rows), Months(date(2025, 1, 1), date(2025, 2, 1))).first()
    assert row["count"] == 2


def test_year_to_date_on_a_leap_day(spark):
    days = [date(2025, 2, 28), date(2025, 3, 1), date(2028, 2, 29), date(2028, 3, 1), date(2026, 12, 31)]
    frame = present(spark, [("s", "oz", "web", None, str(i)) for i in range(len(days))])
    frame = frame.withColumn(
        "activity_date", F.element_at(F.array(*[F.lit(d) for d in days]), F.col("external_user_id").cast("int") + 1)
    )
    found = {r.year: r.value for r in mau.year_to_date(frame, date(2028, 2, 29)).collect()}
    assert found == {2025: 1, 2026: 0, 2027: 0, 2028: 1}


# --- periods --------------------------------------------------------------------------------------


def test_trailing_range():
    assert periods.trailing_months(date(2025, 1, 1), date(2025, 3, 9)) == Months(date(2025, 1, 1), date(2025, 4, 1))
    assert periods.trailing_months(date(2025, 6, 1), date(2025, 7, 31)).start == date(2025, 5, 1)
    assert periods.trailing_months(None, date(2025, 2, 1)).start == date(2025, 1, 1)
    assert periods.shift_month(date(2025, 12, 31), 1) == date(2026, 1, 1)
    assert periods.shift_month(date(2025, 1, 31), -1) == date(2024, 12, 1)


def test_slices():
    assert periods.next_slice(None, date(2025, 1, 10)) == (date(2025, 1, 2), date(2025, 1, 9))
    assert periods.next_slice(date(2025, 1, 7), date(2025, 1, 10)) == (date(2025, 1, 8), date(2025, 1, 9))
    assert periods.next_slice(date(2025, 1, 9), date(2025, 1, 10)) is None


# --- revenue --------------------------------------------------------------------------------------

AS_OF = date(2025, 3, 10)
MARCH = Months(date(2025, 3, 1), date(2025, 4, 1))


def clinic(spark, lines, setting="other", upd=at(5, month=3), plan=None):
    """``lines``: (pay type, price, [(own percent, card percent, fixed)]) of one prescription each."""
    n = range(len(lines))
    plan_rows = [("f", "v0", *plan)] if plan else []
    discounts = [(f"l{i}", f"c{i}-{j}", d[0], d[2]) for i in n for j, d in enumerate(lines[i][2])]
    cards = [(f"c{i}-{j}", d[1]) for i in n for j, d in enumerate(lines[i][2])]
    make = spark.createDataFrame
    money = "decimal(18,4)"
    dec = lambda x: None if x is None else Decimal(str(x))
    return {
        "people": make([("p",)], "oid string"),
        "mdoc": make([("m", "p")], "id string, people_id string"),
        "sotr": make([("s", "online", "x")], "oid string, sysuser string, post string"),
        "sysuser": make([("online",)], "oid string"),
        "presc": make(
            [(f"r{i}", "m", "sign", "s", upd) for i in n],
            "id string, mdoc_id string, presc_state_id string, creator_id string, upd_dt timestamp_ntz",
        ),
        "presc_service": make([(f"l{i}", f"r{i}", f"k{i}") for i in n], "oid string, presc string, service_presctype string"),
        "service_presctype": make([(f"k{i}", f"v{i}") for i in n], "oid string, service string"),
        "services": make([(f"v{i}", lines[i][0]) for i in n], "oid string, pay_type string"),
        "price": make(
            [(f"r{i}", f"l{i}", dec(lines[i][1])) for i in n],
            f"presc_id string, presc_service_oid string, base_price {money}",
        ),
        "discount_presc": make(
            [(a, b, dec(c), dec(d)) for a, b, c, d in discounts],
            f"presc_service string, discount string, percent {money}, fix_sum {money}",
        ),
        "discount": make([(a, dec(b)) for a, b in cards], f"oid string, percent {money}"),
        "finance_plan": make(plan_rows, "oid string, visit string, fixed boolean, date_begin date, date_end date"),
        "finance_plan_presc_service": make([("l0", "f")] if plan else [], "presc_service string, finance_plan string"),
        # The stored key carries its padding.
        "visit": make([("v0" + " " * 34, "cash")], "id string, pay_type_id string"),
        "systemsettings": make(
            [("DiscountAmountRounding", s) for s in ([setting] if isinstance(setting, str) else setting)],
            "param string, valuepar string",
        ),
    }


def march(spark, *args, **kwargs):
    found = revenue.monthly(clinic(spark, *args, **kwargs), MARCH, RevenueParams(AS_OF, sysuser="online"))
    return {r.month: float(r.revenue) for r in found.collect()}[date(2025, 3, 1)]


@pytest.mark.parametrize("mode, total", [("1", 91), ("2", 90), ("3", 90), ("other", 90.50)])
def test_rounding_modes(spark, mode, total):
    assert march(spark, [("cash", 100.55, [(10, None, None)])], mode) == total


@pytest.mark.parametrize(
    "discounts, total",
    [([(10, None, 5)], 85), ([(None, 10, 5)], 85), ([(None, None, 5)], 100), ([], 100), ([(10, 50, None), (5, None, 1)], 84)],
)
def test_discounts(spark, discounts, total):
    assert march(spark, [("cash", 100, discounts)]) == total


def test_fixed_plan_in_force_on_the_run_date_lifts_discounts(spark):
    lines = [("cash", 100, [(10, None, None)])]
    assert march(spark, lines, plan=(True, date(2025, 3, 1), date(2025, 3, 31))) == 100
    assert march(spark, lines, plan=(False, date(2025, 3, 1), date(2025, 3, 31))) == 90
    assert march(spark, lines, plan=(True, date(2025, 3, 1), date(2025, 3, 9))) == 90


def test_pay_types_and_settings(spark):
    lines = [("cash", 100, []), ("budget", 10, []), (None, 1, [])]
    assert march(spark, lines) == 100
    assert march(spark, lines, setting=[]) == 0
    assert march(spark, lines, setting=["1", "2"]) == 200


def test_month_boundary_and_empty_month(spark):
    lines = [("cash", 100, [])]
    assert march(spark, lines, upd=datetime(2025, 4, 1)) == 0
    assert march(spark, lines, upd=datetime(2025, 3, 31, 23, 59, 59)) == 100


# --- appointments and yearly changes --------------------------------------------------------------


def test_csv_membership(spark):
    rows = spark.createDataFrame([("a,b", "b"), ("a, b", "b"), ("", ""), (None, "b")], "l string, i string")
    kept = rows.filter(scalars.csv_has(F.col("l"), F.col("i"))).collect()
    assert [tuple(r) for r in kept] == [("a,b", "b")]


def test_latest_channel(spark):
    log = spark.createDataFrame(
        [("x", "OLD", at(2), at(3)), ("x", "NEW", at(2), at(4)), ("y", "SET", at(2), at(9)), ("y", "UNSET", at(2), None),
         ("z", "FIRST_DAY", at(1, 12), at(5))],
        "appointment_oid string, source string, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    found = {r.appointment_id: r.source for r in appointments.latest_source(log, date(2025, 1, 1)).collect()}
    assert found == {"x": "NEW", "y": "UNSET"}


def test_yearly_change(spark):
    rows = [(date(2024, 1, 1), 10), (date(2024, 2, 1), 20), (date(2024, 3, 1), 99), (date(2025, 1, 1), 15), (date(2025, 2, 1), 40)]
    kpi = spark.createDataFrame([(m, Decimal(v)) for m, v in rows], "month date, revenue decimal(18,4)")
    assert [tuple(r) for r in yoy.revenue(kpi).collect()] == [(2025, "revenue", Decimal("25.0000"))]
    assert yoy.revenue(kpi.filter("month is null")).collect() == []
    ratio = kpi.withColumnRenamed("revenue", "ratio_online_to_total").filter("year(month) = 2025")
    assert yoy.ratio(ratio).first().value == Decimal("27.5000")


# --- no-show report -------------------------------------------------------------------------------


def visit_tables(spark, states, alternate=False, work_mode="WorkTime", account=None, notify=None, logs=1):
    """One booked visit per state, all on 10 January at 12:00, booked a day and a half before."""
    make, n = spark.createDataFrame, range(len(states))
    prescs = [(f"r{i}", f"m{i}", f"v{i}", states[i], "s0", at(9)) for i in n]
    if alternate:
        prescs.append(("alt", "m0", "v0", "sign", "s0", at(10, 13)))
    return {
        "schedule": make(
            [(f"sl{i}", "s0", None, "l", at(10, 12), None, work_mode) for i in n],
            "oid string, sotr string, sysuser string, lpu string, starton timestamp_ntz, blockreason string, work_mode string",
        ),
        "schedule_log": make(
            [(f"sl{i}", f"b{i}", "y", "s0", at(9, 0, k), 1, None) for i in n for k in range(logs)],
            "schedule string, presc_schedule string, presctype string, operator string, "
            "operation_date_time timestamp_ntz, action int, commentary string",
        ),
        "presc_schedule": make([(f"b{i}", f"r{i}") for i in n], "id string, presc_id string"),
        "presc": make(prescs, "id string, mdoc_id string, visit_id string, presc_state_id string, creator_id string, create_dt timestamp_ntz"),
        "visit": make([(f"v{i}", "cash") for i in n], "id string, pay_type_id string"),
        "presctype": make([("y", "f")], "oid string, presctypefolderid_parent string"),
        "presctypefolder": make([("f",)], "id string"),
        "mdoc": make([(f"m{i}", f"p{i}") for i in n], "id string, people_id string"),
        "people": make([(f"p{i}", account) for i in n], "oid string, account_id string"),
        "pinfo": make([("p0", notify)], "oid string, auto_notification boolean"),
        "sotr": make([("s0", "u0", "o")], "oid string, sysuser string, post string"),
        "lpu_geo": make([("l", "Site")], "oid string, fullname string"),
        "post": make([("o", "Врач")], "oid string, name string"),
        "staff_name": make([("u0", "N. N.")], "sysuser string, full_name string"),
    }


DAY = ReportParams(date(2025, 1, 10), date(2025, 1, 10))


def test_alternate_counts_as_signed_but_details_do_not_know(spark):
    row = noshow.report(visit_tables(spark, ["new"], alternate=True, account="a"), DAY).first()
    assert (row.total, row.signed_count, row.no_show_count) == (1, 1, 0)
    assert (row.signed_has_lk_pct, row.no_show_depth_in_days, row.signed_depth_in_days) == ("0,00", "1,50", "0")


def test_unknown_state_is_in_the_total_only(spark):
    row = noshow.report(visit_tables(spark, [None]), DAY).first()
    assert (row.total, row.signed_count, row.no_show_count) == (1, 0, 0)
    assert (row.signed_depth_in_days, row.signed_auto_pct, row.no_show_pct) == ("0", "0,00", "0,00")


def test_report_row(spark):
    row = noshow.report(visit_tables(spark, ["sign", "new", "done_lab"], account="a", notify=True), DAY).first()
    assert (row.date, row.lpu, row.key_post_name, row.doctor_name) == ("2025-01-10", "Site", "врач", "N. N.")
    assert (row.total, row.signed_count, row.signed_pct, row.no_show_pct) == (3, 2, "0,67", "0,33")
    assert (row.signed_auto_pct, row.signed_has_lk_pct, row.signed_is_first_pct) == ("0,50", "1,00", "1,00")
    assert len(row) == 18


def test_two_log_rows_count_twice(spark):
    assert noshow.report(visit_tables(spark, ["sign"], logs=2), DAY).first().total == 2


def test_unset_states_sign_nothing(spark):
    chosen = ReportParams(date(2025, 1, 10), date(2025, 1, 10), signed_states=())
    row = noshow.report(visit_tables(spark, ["sign", None]), chosen).first()
    assert (row.total, row.signed_count, row.no_show_count) == (2, 0, 2)


def test_room_schedules_and_unknown_modes_are_left_out(spark):
    for mode in (None, "WorkTimeCabinet"):
        assert noshow.base(visit_tables(spark, ["sign"], work_mode=mode), DAY).count() == 0
    open_to_all = ReportParams(date(2025, 1, 10), date(2025, 1, 10), exclude_cabinet=False)
    assert noshow.base(visit_tables(spark, ["sign"], work_mode=None), open_to_all).count() == 1


@pytest.mark.parametrize(
    "names, label",
    [(["Врач", "Администратор"], "врач"), (["Администратор", "Медицинский регистратор"], "Онлайн-запись"),
     (["Медбрат"], "медсестра/брат"), (["медицинский", "регистратор"], "остальные"), ([], "остальные"),
     (["Старшая акушерка"], "акушер")],
)
def test_post_classes(spark, names, label):
    frame = spark.createDataFrame([(names,)], "names array<string>")
    assert frame.select(noshow.post_class(F.col("names"))).first()[0] == label


# --- ingest ---------------------------------------------------------------------------------------


def test_sentinels_and_bad_values(spark):
    spec = specs.mobile()
    good = "ABCDEF01-0000-4000-8000-000000000001"
    raw = spark.createDataFrame([("0000-0000",), ("",), ("abc",), (good,)], "google_aid string")
    assert [r[0] for r in raw.select(ingest.typed(spec.field("google_aid"))).collect()] == [None, None, None, good.lower()]


def test_the_first_set_source_counts(spark):
    field = specs.Field("n", ("a", "b"), specs.INTEGER, null_values=("-",))
    raw = spark.createDataFrame([("1", "2"), (None, "3"), ("-", "4"), ("x", "5"), (None, None)], "a string, b string")
    assert [r.n for r in raw.select(ingest.typed(field)).collect()] == [1, 3, 4, None, None]


def test_a_web_row_without_its_key_fails_the_load(spark):
    spec = specs.web("booking")
    columns = [c.removeprefix(spec.prefix) for c in spec.header]
    known = {"watchID": "5", "dateTime": "2025-01-02 03:04:05", "isPageView": "1", "URL": "a"}

    def load(*changes):
        rows = [tuple({**known, **c}.get(name) for name in columns) for c in changes]
        raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in spec.header))
        return ingest.normalise(raw, spec).collect()

    # Two copies of a hit, and two versions of another: one row per hit, the smaller one wins.
    kept = load({}, {}, {"watchID": "18446744073709551615", "URL": "c"}, {"watchID": "18446744073709551615", "URL": "b"})
    assert sorted((int(r.watch_id), r.url, r.is_page_view) for r in kept) == [
        (5, "a", True), (18446744073709551615, "b", True),
    ]
    with pytest.raises(Exception, match="row without a valid watch_id"):
        load({}, {"watchID": "none"})


def test_specs_cover_all_tables():
    found = {name: {t.name: len(t.columns) for t in s.tables} for name, s in specs.all_specs().items()}
    assert found["mobile"] == {"events": 12, "event_params": 6, "devices": 19, "location": 5}
    web = {"events": 18, "event_params": 6, "marketing_info": 18, "devices": 32, "location": 8, "offline_calls": 11}
    assert found["booking"] == found["web_lk"] == web
    assert specs.web("booking").field("offline_call_url").sources == ("offlineCallURL",)
    assert specs.web("booking").field("utm_source").sources == ("UTMSource",)
