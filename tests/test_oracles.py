"""Every registered query against its SQL, and the fixture counts the blueprint gives."""

from __future__ import annotations

import pytest
from compare import differences

import __spark_entry__ as driver
from footfall import registry
from footfall.operators.dedup import key_counts
from footfall.registry import inputs
from footfall.sources import fixtures

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), sf_dir, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).columns == ["event_hour", "events"]
    assert driver.entry(spark).count() > 0


# Rows at sf0.001 of derived tables.
EXPECTED = {
    "events_browser_raw": 1000,
    "events_device_raw": 358,
    "events_geo_raw": 375,
    "events_location_raw": 941,
    "fact_events": 1000,
    "dim_users": 15,
    "dim_geo": 15,
    "agg_events_hourly": 1000,
    "agg_traffic_sources": 835,
}


@pytest.mark.parametrize("table, rows", EXPECTED.items())
def test_fixture_counts(spark, small_dir, table, rows):
    assert inputs.warehouse(spark, small_dir).read(table).count() == rows


def test_overlay_counts(spark, small_dir):
    first, second = fixtures.two_batches(spark, small_dir)
    assert (first.count(), second.count()) == (520, 506)
    assert fixtures.browser_dup(spark, small_dir).count() == 1002
    assert key_counts(fixtures.browser_dup(spark, small_dir), "event_id").count() == 2
    assert fixtures.late_device(spark, small_dir)[1].count() == 31
    blank = fixtures.null_keys(spark, small_dir).filter("event_id is null or event_id = ''")
    assert blank.count() == 22
