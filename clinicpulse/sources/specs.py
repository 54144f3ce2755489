"""Declared shape of the analytics exports and of the tables they feed."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

INTEGER, STRING, UUID, DATETIME, JSON, BOOLEAN, INET, BIG_ID = (
    "integer", "string", "uuid", "datetime", "json", "boolean", "inet", "big id",
)

SPARK_TYPES = {
    INTEGER: "bigint",
    # Device, client and hit ids are unsigned 64-bit numbers, which a bigint cannot hold.
    BIG_ID: "decimal(20,0)",
    STRING: "string",
    UUID: "string",
    DATETIME: "timestamp_ntz",
    JSON: "string",
    BOOLEAN: "boolean",
    INET: "string",
}


@dataclass(frozen=True)
class Field:
    """One target column: its type, and the export columns it is taken from (the first that is set)."""

    target: str
    sources: tuple[str, ...]
    type: str = STRING
    null_values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ExportSpec:
    """One export: its file format, columns, and the tables each of its rows fans out to."""

    name: str
    format: str
    prefix: str
    fields: tuple[Field, ...]
    tables: tuple[Table, ...]
    time: str
    row_id: str | None = None
    header: tuple[str, ...] = field(default=())
    # Texts, addresses and JSON hold line breaks.
    multiline: bool = True

    def field(self, target: str) -> Field:
        return next(f for f in self.fields if f.target == target)


# ---------------------------------------------------------------------------------------------------
# The export columns, their types, and which table takes which column.

MOBILE_COLUMNS = """
    profile_id application_id app_build_number ios_ifa ios_ifv android_id google_aid os_name os_version
    device_manufacturer device_model original_device_model device_type device_locale device_ipv6
    app_version_name event_name event_json event_datetime event_receive_datetime connection_type
    operator_name mcc mnc country_iso_code city appmetrica_device_id installation_id session_id windows_aid
""".split()

MOBILE_TYPES = {
    INTEGER: "profile_id application_id app_build_number session_id mcc mnc",
    BIG_ID: "appmetrica_device_id",
    DATETIME: "event_datetime event_receive_datetime",
    UUID: "installation_id ios_ifa ios_ifv google_aid",
    JSON: "event_json",
    INET: "device_ipv6",
}

MOBILE_NULL_VALUES = {"google_aid": ("0000-0000", "")}

MOBILE_TABLES = {
    "events": """
        uuid profile_id application_id event_datetime event_receive_datetime event_name session_id
        appmetrica_device_id installation_id app_version_name app_build_number windows_aid""",
    "event_params": "uuid profile_id event_datetime event_name session_id event_json",
    "devices": """
        uuid profile_id event_datetime device_manufacturer device_model original_device_model device_type
        device_locale device_ipv6 os_name os_version connection_type operator_name mcc mnc ios_ifa ios_ifv
        android_id google_aid""",
    "location": "uuid profile_id event_datetime country_iso_code city",
}

WEB_PREFIX = "ym:pv:"
# The site whose hits are matched with params whatever their time.
ACCOUNT = "web_lk"

WEB_HIT = "watchID pageViewID visitID clientID dateTime"

WEB_TABLES = {
    "events": """
        title goalsID URL referer isPageView link download notBounce artificial httpError shareService
        shareURL shareTitle""",
    "event_params": "params",
    "marketing_info": """
        UTMCampaign UTMContent UTMMedium UTMSource UTMTerm lastTrafficSource lastSearchEngineRoot
        lastSearchEngine lastAdvEngine lastSocialNetwork lastSocialNetworkProfile recommendationSystem
        messenger""",
    "devices": """
        operatingSystem browser browserMajorVersion browserMinorVersion browserCountry browserEngine
        browserEngineVersion1 browserEngineVersion2 browserEngineVersion3 browserEngineVersion4
        browserLanguage cookieEnabled deviceCategory javascriptEnabled mobilePhone mobilePhoneModel
        operatingSystemRoot physicalScreenHeight physicalScreenWidth screenColors screenFormat
        screenHeight screenOrientation screenOrientationName screenWidth windowClientHeight
        windowClientWidth""",
    "location": "ipAddress regionCity regionCountry",
    "offline_calls": """
        offlineCallTalkDuration offlineCallHoldDuration offlineCallMissed offlineCallTag
        offlineCallFirstTimeCaller offlineCallURL""",
}

WEB_TYPES = {
    BIG_ID: "watchID visitID clientID",
    INTEGER: """
        pageViewID httpError browserMajorVersion browserMinorVersion browserEngineVersion1
        browserEngineVersion2 browserEngineVersion3 browserEngineVersion4 physicalScreenHeight
        physicalScreenWidth screenColors screenHeight screenOrientation screenWidth windowClientHeight
        windowClientWidth offlineCallTalkDuration offlineCallHoldDuration offlineCallMissed
        offlineCallFirstTimeCaller""",
    DATETIME: "dateTime",
    BOOLEAN: "isPageView link download notBounce artificial cookieEnabled javascriptEnabled",
    JSON: "goalsID params",
}
# ---------------------------------------------------------------------------------------------------


def snake(name: str) -> str:
    """``clientID`` to ``client_id``, ``UTMSource`` to ``utm_source``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


def _type_of(types: dict[str, str]) -> dict[str, str]:
    return {column: kind for kind, columns in types.items() for column in columns.split()}


def mobile() -> ExportSpec:
    types = _type_of(MOBILE_TYPES)
    return ExportSpec(
        name="mobile",
        format="csv",
        prefix="",
        fields=tuple(
            Field(c, (c,), types.get(c, STRING), MOBILE_NULL_VALUES.get(c, ())) for c in MOBILE_COLUMNS
        ),
        tables=tuple(Table(n, ("uuid",), tuple(cols.split())) for n, cols in MOBILE_TABLES.items()),
        time="event_datetime",
        row_id="uuid",
        header=tuple(MOBILE_COLUMNS),
    )


def web(site: str) -> ExportSpec:
    """Hits of one site; the booking and the account site share one shape."""
    types = _type_of(WEB_TYPES)
    hit = WEB_HIT.split()
    own = {name: columns.split() for name, columns in WEB_TABLES.items()}
    columns = hit + [c for cols in own.values() for c in cols]
    return ExportSpec(
        name=site,
        format="csv",
        prefix=WEB_PREFIX,
        fields=tuple(Field(snake(c), (c,), types.get(c, STRING)) for c in columns),
        tables=tuple(
            Table(n, ("watch_id", "date_time"), tuple(snake(c) for c in hit + cols))
            for n, cols in own.items()
        ),
        time="date_time",
        header=tuple(WEB_PREFIX + c for c in columns),
    )


def all_specs() -> dict[str, ExportSpec]:
    return {"mobile": mobile(), "booking": web("booking"), ACCOUNT: web(ACCOUNT)}
