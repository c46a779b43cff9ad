"""The two dimensions: from the fact directly, or from mergeable partials of it.

A partial holds, per month and key, the earliest event's attributes and the first and last time, and the number
of events. Minimum, maximum and sum of partials equal those of all events, so a dimension kept from partials is
exact and a rebuild reads them instead of the whole fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.clock import event_month, whole_seconds
from footfall.operators.filters import filter_nonempty
from footfall.schemas import DIM_GEO_SCHEMA, DIM_USERS_SCHEMA, GEO_ATTRIBUTES, GEO_KEYS, USER_ATTRIBUTES, USER_KEYS


def _earliest(attributes: Sequence[str]) -> Column:
    return F.min(F.struct("event_timestamp", "event_id", *attributes)).alias("first")


def _partials(rows: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        _earliest(attributes),
        F.min("event_timestamp").alias("first_seen"),
        F.max("event_timestamp").alias("last_seen"),
        F.count(F.lit(1)).alias("total_events"),
    )


def _merged(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(
        F.min("first").alias("first"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("total_events").alias("total_events"),
    )


def _users(partials: DataFrame) -> DataFrame:
    seen = {c: whole_seconds(c) for c in ("first_seen", "last_seen")}
    return partials.select("*", *[f"first.{c}" for c in USER_ATTRIBUTES]).withColumns(seen).select(
        *DIM_USERS_SCHEMA.fieldNames()
    )


def _places(partials: DataFrame) -> DataFrame:
    geo_id = F.concat("geo_country", F.lit("_"), "geo_region_name")
    return partials.select("*", *[f"first.{c}" for c in GEO_ATTRIBUTES]).withColumn("geo_id", geo_id).select(
        *DIM_GEO_SCHEMA.fieldNames()
    )


def dim_users(fact: DataFrame) -> DataFrame:
    """Known users: first and last event in whole seconds, events, and the attributes of the earliest event."""
    return _users(_partials(filter_nonempty(fact, "user_domain_id"), USER_KEYS, USER_ATTRIBUTES))


def dim_geo(fact: DataFrame) -> DataFrame:
    """Known regions, with the coordinates and time zone of their earliest event."""
    return _places(_partials(filter_nonempty(fact, "geo_country"), GEO_KEYS, GEO_ATTRIBUTES))


def users_state(fact: DataFrame) -> DataFrame:
    """Partials of ``dim_users`` per month."""
    rows = filter_nonempty(fact, "user_domain_id").withColumn("event_month", event_month())
    return _partials(rows, ["event_month", *USER_KEYS], USER_ATTRIBUTES)


def geo_state(fact: DataFrame) -> DataFrame:
    """Partials of ``dim_geo`` per month."""
    rows = filter_nonempty(fact, "geo_country").withColumn("event_month", event_month())
    return _partials(rows, ["event_month", *GEO_KEYS], GEO_ATTRIBUTES)


def collapse_users(partials: DataFrame) -> DataFrame:
    return _merged(partials, USER_KEYS)


def collapse_geo(partials: DataFrame) -> DataFrame:
    return _merged(partials, GEO_KEYS)


def users_from(partials: DataFrame) -> DataFrame:
    return _users(collapse_users(partials))


def geo_from(partials: DataFrame) -> DataFrame:
    return _places(collapse_geo(partials))
