"""Which internal user stands behind a device or browser id."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse import params as P
from clinicpulse.functions import periods, scalars
from clinicpulse.operators import upsert
from clinicpulse.operators.joins import join_to_unique

SCHEMA = (
    "source string, external_user_id string, internal_user_id bigint, "
    "first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, updated_at timestamp_ntz"
)
KEY = ("source", "external_user_id")
RULES = {"internal_user_id": upsert.NEW_IF_SET, "last_seen_at": upsert.GREATEST}
USER_ID_PATH = "$.user_id"
# The stored table is cut by hash of the external id, so that a day rewrites only the buckets it touches.
BUCKETS = 64


def bucket(external_id: str) -> Column:
    return F.pmod(F.xxhash64(external_id), F.lit(BUCKETS)).cast("int")


def _summarise(hits: DataFrame, source: str, first: Column, last: Column) -> DataFrame:
    return hits.groupBy(F.col("external").cast("string").alias("external_user_id")).agg(
        F.max("internal").alias("internal_user_id"),
        F.min(first).alias("first_seen_at"),
        F.max(last).alias("last_seen_at"),
    ).select(F.lit(source).alias("source"), "*")


def mobile(events: DataFrame, start: date, end: date, source: str = P.SOURCE_MOBILE) -> DataFrame:
    """Per device: the highest profile id seen, first and last event."""
    hits = events.filter(
        periods.within_days("event_datetime", start, end) & F.col("appmetrica_device_id").isNotNull()
    ).select(
        F.col("appmetrica_device_id").alias("external"), F.col("profile_id").alias("internal"), "event_datetime"
    )
    return _summarise(hits, source, F.col("event_datetime"), F.col("event_datetime"))


def _web(
    events: DataFrame, params: DataFrame, on: list[str], how: str, source: str, path: str, hot: Sequence[int] | None
) -> DataFrame:
    """Only the highest user id and the time bounds are kept, so params fold to one row per key first and
    copies of a hit fold to its time bounds; the join then never multiplies rows."""
    hits = _hits(events, on)
    if how == "left":
        # The params are all there ever were: only those of the hits at hand are parsed, and one without a user id
        # says no more than a hit without params.
        params = params.join(hits.select(*on).distinct(), on, "left_semi")
    users = params.select(*on, scalars.user_id_from_json(F.col("params"), path).alias("internal"))
    if how == "left":
        users = users.filter("internal IS NOT NULL")
    return _linked(hits, users, on, how, source, hot)


def _hits(events: DataFrame, on: list[str]) -> DataFrame:
    return events.filter(F.col("client_id").isNotNull()).select(
        *on, F.col("client_id").alias("external"),
        F.col("date_time").alias("first"), F.col("date_time").alias("last"),
    )


def _linked(hits: DataFrame, users: DataFrame, on: list[str], how: str, source: str, hot: Sequence[int] | None) -> DataFrame:
    bounds = [F.min("first").alias("first"), F.max("last").alias("last")]
    keys = [*on, "external"]
    users = users.groupBy(*on).agg(F.max("internal").alias("internal"))
    joined = join_to_unique(
        hits, users, on, how, spread_by=["external"], collapse=lambda h: h.groupBy(*keys).agg(*bounds), hot=hot
    )
    return _summarise(joined, source, F.col("first"), F.col("last"))


def booking(
    events: DataFrame, params: DataFrame, start: date, end: date,
    source: str = P.SOURCE_BOOKING, path: str = USER_ID_PATH, hot: Sequence[int] | None = None,
) -> DataFrame:
    """Per browser; only hits that have a params row of the same hit and time.

    Looks hot hits up at once, with a job of its own, unless ``hot`` gives them.
    """
    days = periods.within_days("date_time", start, end)
    return _web(events.filter(days), params.filter(days), ["watch_id", "date_time"], "inner", source, path, hot)


def account(
    events: DataFrame, params: DataFrame, start: date, end: date,
    source: str = P.SOURCE_ACCOUNT, path: str = USER_ID_PATH, hot: Sequence[int] | None = None,
) -> DataFrame:
    """Per browser; hits without params count too, and params match by hit whatever their time.

    Looks hot hits up at once, with a job of its own, unless ``hot`` gives them.
    """
    days = periods.within_days("date_time", start, end)
    return _web(events.filter(days), params, ["watch_id"], "left", source, path, hot)


def account_by_index(
    events: DataFrame, index: DataFrame, start: date, end: date, source: str = P.SOURCE_ACCOUNT, hot: Sequence[int] | None = None
) -> DataFrame:
    """``account``, with the user ids of hits from an index of (watch_id, internal) in place of the params."""
    hits = _hits(events.filter(periods.within_days("date_time", start, end)), ["watch_id"])
    return _linked(hits, index, ["watch_id"], "left", source, hot)


def merge(stored: DataFrame, batch: DataFrame, now: Column | None = None) -> DataFrame:
    """A known id is kept when the batch has none; the first sighting stays, the last one only grows."""
    stamp = F.localtimestamp() if now is None else now
    return upsert.merge(stored, batch, KEY, RULES, stamp)
