"""Registered queries: reload, retention, compaction and repair jobs, each on a warehouse of its own."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import functions as F

from footfall.operators import rollups
from footfall.plans import dims, lease
from footfall.plans.warehouse import DWH_TABLES, LAYOUTS, STAGING_TABLES, Warehouse, summary, table_counts
from footfall.registry import inputs
from footfall.registry.book import Book
from footfall.registry.oracle import USERS
from footfall.schemas import BROWSER, DEVICE, FACT_COLUMNS, HOURLY_KEYS
from footfall.sources import fixtures, tables
from footfall.sources.fixtures import CLOCK
from footfall.workspace import fresh_folder

BOOK = Book()
query = BOOK.query


@query("SELECT * FROM dim_users")
def truncate_reload(spark, sf_dir):
    """A dimension of the first batch, replaced by that of the whole fact."""
    fact = inputs.fact(spark, sf_dir)
    path, schema = f"{fresh_folder(spark, 'reload')}/dim_users", LAYOUTS["dim_users"].schema
    early = fact.filter(F.col("event_timestamp") < F.lit(fixtures.SECOND_BATCH_FROM).cast("timestamp_ntz"))
    tables.truncate_reload(dims.dim_users(early), path, schema)
    tables.truncate_reload(dims.dim_users(fact), path, schema)
    return tables.read(spark, path, schema)


def _kept(table: str, cutoff: str, column: str) -> str:
    return f"SELECT '{table}' as table_name, count(*) as rows FROM {table} WHERE {column} >= TIMESTAMP '{cutoff}'"


@query(" UNION ALL ".join(_kept(t, "2024-01-24 00:00:00", "inserted_at") for t in STAGING_TABLES))
def retention_delete(spark, sf_dir):
    """Staging after rows inserted more than seven days before the clock are gone."""
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "retention"), sf_dir)
    wh.retention_delete(CLOCK)
    return table_counts({t: wh.read(t) for t in STAGING_TABLES})


_TTL_CLOCK = "2024-04-15 12:00:00"
_TTL_STAGING = "2024-01-16 12:00:00"
# 365 days after a midnight of the data.
_TTL_WAREHOUSE_CLOCK = "2025-01-15 00:00:00"
_TTL_WAREHOUSE = "2024-01-16 00:00:00"
_LIVING = f"(SELECT * FROM fact_events WHERE event_timestamp >= TIMESTAMP '{_TTL_WAREHOUSE}')"


@query(
    _kept("events_browser_raw", _TTL_STAGING, "event_timestamp")
    + " UNION ALL "
    + " UNION ALL ".join(_kept(t, _TTL_STAGING, "inserted_at") for t in STAGING_TABLES[1:])
    + " UNION ALL "
    + " UNION ALL ".join(
        _kept(t, _TTL_WAREHOUSE, column)
        for t, column in (("fact_events", "event_timestamp"), ("agg_events_hourly", "event_hour"), ("agg_traffic_sources", "date"))
    )
    + f" UNION ALL SELECT 'dim_users', count(*) FROM ({USERS.format(fact=_LIVING)})"
)
def ttl_expire(spark, sf_dir):
    """Staging at a clock 90 days after the middle of its data; fact, states and dimensions 365 days after."""
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "ttl"), sf_dir)
    wh.load("one", as_of=CLOCK)
    wh.ttl_expire(_TTL_CLOCK)
    staging = table_counts({t: wh.read(t) for t in STAGING_TABLES})  # of the folders that are live now
    wh.ttl_expire(_TTL_WAREHOUSE_CLOCK)
    wh.rebuild_dims()
    kept = summary({t: wh.read(t) for t in DWH_TABLES if t != "dim_geo"})
    return staging.unionByName(kept.select("table_name", "rows"))


@query(f"SELECT {', '.join(FACT_COLUMNS)} FROM fact_events")
def dedup_stored(spark, sf_dir):
    """A stored fact with repeated deliveries in it, deduplicated in place."""
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "dedup"), sf_dir, browser=fixtures.browser_dup(spark, sf_dir))
    wh.load("one", dedup=False, as_of=CLOCK)
    wh.deduplicate("fact_events", "event_id")
    return wh.read("fact_events").select(*FACT_COLUMNS)


@query(
    """SELECT event_hour, event_type, browser_name, device_type, geo_country, utm_source, utm_campaign, total_events
    FROM agg_events_hourly"""
)
def dedup_stored_states(spark, sf_dir):
    """The hourly aggregate after repeats have been taken out of the fact."""
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "dedup"), sf_dir, browser=fixtures.browser_dup(spark, sf_dir))
    wh.load("one", dedup=False, as_of=CLOCK)
    wh.deduplicate("fact_events", "event_id")
    return rollups.merge(wh.read("agg_events_hourly"), HOURLY_KEYS).select(*HOURLY_KEYS, "total_events")


@query(
    """SELECT 'agg_events_hourly' as table_name, count(*) as rows FROM agg_events_hourly UNION ALL
    SELECT 'agg_traffic_sources', count(*) FROM agg_traffic_sources UNION ALL
    SELECT 'dim_geo', count(*) FROM dim_geo UNION ALL SELECT 'dim_users', count(*) FROM dim_users UNION ALL
    SELECT 'fact_events', count(*) FROM fact_events"""
)
def compact(spark, sf_dir):
    """Two loads merged: the states hold one row per group again."""
    first, second = fixtures.two_batches(spark, sf_dir)
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "compact"), sf_dir, browser=first)
    wh.load("one", as_of=CLOCK)
    wh.stage(BROWSER, second, "second")
    wh.load("two", as_of=CLOCK)
    wh.rebuild_dims()
    wh.compact()
    return table_counts({t: wh.read(t) for t in DWH_TABLES})


@query(f"SELECT {', '.join(FACT_COLUMNS)} FROM fact_events")
def compact_contents(spark, sf_dir):
    """The fact after two loads, a compaction and a sweep of all that it replaced."""
    first, second = fixtures.two_batches(spark, sf_dir)
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "compact"), sf_dir, browser=first)
    wh.load("one", as_of=CLOCK)
    wh.stage(BROWSER, second, "second")
    wh.load("two", as_of=CLOCK)
    wh.compact()
    wh.sweep(older_than=0)
    return wh.read("fact_events").select(*FACT_COLUMNS)


@query(f"SELECT {', '.join(FACT_COLUMNS)} FROM fact_events")
def overlapping_loads(spark, sf_dir):
    """The fact after a load that another one ran into, and after one that was taken over and came back too late."""
    first, second = fixtures.two_batches(spark, sf_dir)
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "overlap"), sf_dir, browser=first)
    batches = wh.load_fact("a", as_of=CLOCK)
    with suppress(lease.Busy):
        wh.load("b", as_of=CLOCK)
    wh.finish_load("a", batches, as_of=CLOCK)
    wh.stage(BROWSER, second, "second")
    late = wh.load_fact("c", as_of=CLOCK)
    Warehouse(spark, wh.root, lease_seconds=0).load_fact("d", as_of=CLOCK)  # takes over, and dies
    with suppress(lease.Lost):
        wh.finish_load("c", late, as_of=CLOCK)
    Warehouse(spark, wh.root, lease_seconds=0).load("e", as_of=CLOCK)
    return wh.read("fact_events").select(*FACT_COLUMNS)


@query(f"SELECT {', '.join(BROWSER.columns)} FROM events_browser_raw WHERE inserted_at >= TIMESTAMP '2024-01-24 00:00:00'")
def retention_contents(spark, sf_dir):
    """The rows of one staging table that the clear-out keeps."""
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "retention"), sf_dir)
    wh.retention_delete(CLOCK)
    return wh.read(BROWSER.table).select(*BROWSER.columns)


@query(
    """SELECT 'agg_events_hourly' as table_name, count(*) as rows, 'passed' as status FROM agg_events_hourly UNION ALL
    SELECT 'agg_traffic_sources', count(*), 'passed' FROM agg_traffic_sources UNION ALL
    SELECT 'dim_geo', count(*), 'passed' FROM dim_geo UNION ALL
    SELECT 'dim_users', count(*), 'passed' FROM dim_users UNION ALL
    SELECT 'fact_events', count(*), 'passed' FROM fact_events"""
)
def dwh_summary(spark, sf_dir):
    return inputs.warehouse(spark, sf_dir).dwh_summary()


@query(f"SELECT {', '.join(FACT_COLUMNS)} FROM fact_events")
def repair_fact(spark, sf_dir):
    """A fact built while some device rows were late, after they arrived and the repair ran."""
    early, late = fixtures.late_device(spark, sf_dir)
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "repair"), sf_dir, device=early)
    wh.load("one", as_of=CLOCK)
    wh.stage(DEVICE, late, "late")
    wh.repair(CLOCK, days=31)
    return wh.read("fact_events").select(*FACT_COLUMNS)
