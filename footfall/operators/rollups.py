"""Mergeable aggregates: partial states written per load, merged over any coarser grouping when read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.clock import event_day, event_hour
from footfall.functions.values import merged_estimate, merged_sketch, sketch
from footfall.schemas import HOURLY_KEYS, TRAFFIC_KEYS

# State column of each distinct count, and the fact column it counts.
HOURLY_SKETCHES = {"unique_users": "user_domain_id", "unique_clicks": "click_id"}
TRAFFIC_SKETCHES = {"unique_users": "user_domain_id", "unique_sessions": "click_id"}


def _hourly(fact: DataFrame) -> DataFrame:
    return fact.withColumn("event_hour", event_hour())


def _daily(fact: DataFrame) -> DataFrame:
    return fact.withColumn("date", event_day())


def _grouped(rows: DataFrame, keys: Sequence[str], distinct: Mapping[str, str], measure) -> DataFrame:
    measures: list[Column] = [measure(column).alias(name) for name, column in distinct.items()]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_events"), *measures)


def agg_events_hourly(fact: DataFrame) -> DataFrame:
    """Events, users and clicks per hour and the six dimensions, counted exactly."""
    return _grouped(_hourly(fact), HOURLY_KEYS, HOURLY_SKETCHES, F.count_distinct)


def agg_traffic_sources(fact: DataFrame) -> DataFrame:
    """Events, users and sessions per day and the five traffic dimensions, counted exactly."""
    return _grouped(_daily(fact), TRAFFIC_KEYS, TRAFFIC_SKETCHES, F.count_distinct)


def hourly_state(fact: DataFrame) -> DataFrame:
    """The hourly aggregate as partial state: a count and two sketches per group."""
    return _grouped(_hourly(fact), HOURLY_KEYS, HOURLY_SKETCHES, sketch)


def traffic_state(fact: DataFrame) -> DataFrame:
    return _grouped(_daily(fact), TRAFFIC_KEYS, TRAFFIC_SKETCHES, sketch)


def _sketch_columns(state: DataFrame) -> list[str]:
    return [c for c in state.columns if c.startswith("unique_")]


def merge(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts and distinct-count estimates over ``keys``, from any number of partials."""
    estimates = [merged_estimate(c).alias(c) for c in _sketch_columns(state)]
    return state.groupBy(*keys).agg(F.sum("total_events").alias("total_events"), *estimates)


def collapse(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partials of the same group merged into one, still as state."""
    sketches = [merged_sketch(c).alias(c) for c in _sketch_columns(state)]
    return state.groupBy(*keys).agg(F.sum("total_events").alias("total_events"), *sketches)
