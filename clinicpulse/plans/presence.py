"""Who was active on which day, by product and platform."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse import params as P
from clinicpulse.functions import periods
from clinicpulse.operators import upsert

SCHEMA = (
    "activity_date date, source string, product string, platform string, internal_user_id bigint, "
    "external_user_id string, first_event_time timestamp_ntz, updated_at timestamp_ntz"
)
# Platform is not part of the key: a second platform for the same key changes nothing.
KEY = ("activity_date", "source", "product", "external_user_id")
RULES = {"internal_user_id": upsert.NEW_IF_SET}


@dataclass(frozen=True)
class Presence:
    """One kind of presence: its labels, where time and external id are, and which events count."""

    source: str
    product: str
    platform: str
    time: str
    external_id: str
    counts: Callable[[DataFrame], DataFrame]
    identity_source: str | None = None


def mobile_all() -> Presence:
    return Presence(
        P.SOURCE_MOBILE, P.PRODUCT_ACCOUNT, P.PLATFORM_MOBILE, "event_datetime", "appmetrica_device_id",
        counts=lambda events: events,
    )


def mobile_listed(allowed: DataFrame) -> Presence:
    """Only events whose name is in ``allowed.event_type``."""
    names = allowed.select(F.col("event_type").alias("event_name"))
    return Presence(
        P.SOURCE_MOBILE, P.PRODUCT_BOOKING, P.PLATFORM_MOBILE, "event_datetime", "appmetrica_device_id",
        counts=lambda events: events.join(names, "event_name", "left_semi"),
    )


def site_goals(goal_prefix: str) -> Presence:
    """Hits that are not page views and whose address is a goal of the site."""
    return Presence(
        P.SOURCE_BOOKING, P.PRODUCT_BOOKING, P.PLATFORM_WEB, "date_time", "client_id",
        counts=lambda events: events.filter(~F.col("is_page_view") & F.col("url").startswith(goal_prefix)),
    )


def site_page_views() -> Presence:
    return Presence(
        P.SOURCE_ACCOUNT, P.PRODUCT_ACCOUNT, P.PLATFORM_WEB, "date_time", "client_id",
        counts=lambda events: events.filter(F.col("is_page_view")),
    )


def build(events: DataFrame, identity: DataFrame, kind: Presence, start: date, end: date) -> DataFrame:
    """First event per day and external id, with the internal id the identity table has for it.

    Events fold to one row per day and id before the join, so a busy device is a handful of rows by then.
    """
    days = kind.counts(events.filter(periods.within_days(kind.time, start, end))).groupBy(
        F.to_date(kind.time).alias("activity_date"),
        F.col(kind.external_id).cast("string").alias("external_user_id"),
    ).agg(F.min(kind.time).alias("first_event_time"))
    known = identity.filter(F.col("source") == (kind.identity_source or kind.source)).select(
        "external_user_id", "internal_user_id"
    )
    return days.join(known, "external_user_id", "left").select(
        "activity_date",
        F.lit(kind.source).alias("source"),
        F.lit(kind.product).alias("product"),
        F.lit(kind.platform).alias("platform"),
        "internal_user_id",
        "external_user_id",
        "first_event_time",
    )


def merge(stored: DataFrame, batch: DataFrame, now: Column | None = None) -> DataFrame:
    """Only the internal id can still change; pass the stored days the batch touches."""
    stamp = F.localtimestamp() if now is None else now
    return upsert.merge(stored, batch, KEY, RULES, stamp)
