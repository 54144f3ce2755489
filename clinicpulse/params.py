"""Typed run parameters, and the fixed values they default to."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# ---------------------------------------------------------------------------------------------------
# Fixed values

# Labels stored in the identity and presence tables.
SOURCE_MOBILE = "appmetrica"
SOURCE_BOOKING = "booking"
SOURCE_ACCOUNT = "web_lk"
PRODUCT_BOOKING = "oz"
PRODUCT_ACCOUNT = "lk"
PLATFORM_MOBILE = "mobile"
PLATFORM_WEB = "web"

# Names of the yearly figures.
KPI_USERS = "mau_ob"
KPI_REVENUE = "revenue"
KPI_RATIO = "ratio"

# Channels in the monthly appointment counts.
CHANNEL_CALL_CENTER = "call_center"
CHANNEL_ONLINE = "ONLINE_BOOKING"

# Prescription states that count as revenue, and pay types that never do.
REVENUE_STATES = ("sign", "done_lab", "done", "done_other_lpu")
BUDGET_PAY_TYPES = ("sp_budget", "budget")
PLAN_PAY_TYPE = "cash"
ROUNDING_SETTING = "DiscountAmountRounding"

# System user that online booking writes under, and the two posts of the call centre.
ONLINE_SYSUSER = "5e95e526-907f-4eef-9093-ac0524a39f5b"
CALL_CENTER_POSTS = ("26a45943-7d97-4034-8405-d00aa050dd57", "48064f8f-1ac0-4b30-89f4-a1e93fde29c6")
PATIENT_TAGS = ("CHILD", "ADULT")

# No-show report: site groups, the work mode of a room's schedule, the insurance word in booking comments.
SITE_GROUPS = {
    1: ("ed62552d-b5c3-4ef2-a37d-a35926887a95", "5f8ad894-9bbe-49d4-81c8-3c14a2df9fa3"),
    2: ("0e0c9165-3956-4944-857c-e22df96c677c", "7cc2d104-9d12-434d-8d79-0ff1823bf437"),
}
CABINET_MODE = "WorkTimeCabinet"
INSURANCE_WORD = "ДМС"
REPORT_PAY_TYPES = ("cash", "dms")
REPORT_SIGNED_STATES = ("sign", "done_lab")

# Post classes of the report: the first class one of whose words is in any post name.
POST_CLASSES = (
    ("Онлайн-запись", ("медицинский регистратор", "самозапись")),
    ("врач", ("врач",)),
    ("оператор", ("оператор",)),
    ("администратор", ("администратор",)),
    ("медсестра/брат", ("сестра", "брат")),
    ("менеджер", ("менеджер",)),
    ("лаборант", ("лаборант",)),
    ("акушер", ("акушер",)),
)
OTHER_POST = "остальные"

# Schemas left out of the table upkeep.
EXCLUDED_SCHEMAS = ("amplitude_mob", "amplitude_web")
# ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ReportParams:
    """No-show report. An empty tuple, 0 or None means "no filter"; no signed states: nothing is signed."""

    date_start: date
    date_end: date
    pay_types: tuple[str, ...] = REPORT_PAY_TYPES
    site_group: int | None = 0
    is_online_dms: bool | None = None
    signed_states: tuple[str, ...] = REPORT_SIGNED_STATES
    exclude_folders: tuple[str, ...] = ()
    exclude_presctypes: tuple[str, ...] = ()
    exclude_cabinet: bool = True
    site_groups: tuple[tuple[int, tuple[str, ...]], ...] = tuple(SITE_GROUPS.items())


@dataclass(frozen=True)
class RevenueParams:
    """``as_of`` is the run date: it decides which finance plans are in force, also for past months."""

    as_of: date
    sysuser: str = ONLINE_SYSUSER
    states: tuple[str, ...] = REVENUE_STATES
    skip_pay_types: tuple[str, ...] = BUDGET_PAY_TYPES
    plan_pay_type: str = PLAN_PAY_TYPE
    rounding_setting: str = ROUNDING_SETTING


@dataclass(frozen=True)
class AppointmentParams:
    sysuser: str = ONLINE_SYSUSER
    call_center_posts: tuple[str, ...] = CALL_CENTER_POSTS
    tags: tuple[str, ...] = PATIENT_TAGS
