"""Registered queries: data-quality checks on clean and dirty inputs."""

from __future__ import annotations

from footfall.plans import dims
from footfall.plans import quality as q
from footfall.registry import inputs, oracle
from footfall.registry.book import Book
from footfall.sources import fixtures
from footfall.sources.fixtures import CLOCK

BOOK = Book()
query = BOOK.query

_AGE = f"date_diff('microsecond', max(event_timestamp), TIMESTAMP '{CLOCK}') / 3.6e9::double"


def _status(count: str, bad: str = "warning") -> str:
    return f"case when {count} = 0 then 'passed' else '{bad}' end as status"


@query(
    f"""SELECT max(event_timestamp) as latest_ts, {_AGE} as age_hours,
    case when {_AGE} > 2 then 'failed' else 'passed' end as status FROM fact_events"""
)
def dq_freshness(spark, sf_dir):
    return q.dq_freshness(inputs.fact(spark, sf_dir), CLOCK)


_NULL_FACT = oracle.fact_over("null_keys")


def _blank(table: str, relation: str, column: str, condition: str) -> str:
    return f"""SELECT '{table}' as table_name, '{column}' as column_name,
    cast(count_if({condition}) as bigint) as null_count, count(*) as total_count,
    case when count(*) > 0 then (count_if({condition})::double / count(*)::double) * 100 else 0 end as null_percent,
    case when count_if({condition}) = 0 then 'passed' else 'warning' end as status FROM {relation}"""


@query(
    f"""SELECT * FROM (WITH dirty AS ({_NULL_FACT}), dirty_users AS ({oracle.USERS.format(fact='dirty')})
    {_blank('fact_events', 'dirty', 'event_id', "event_id IS NULL OR event_id = ''")} UNION ALL
    {_blank('fact_events', 'dirty', 'event_timestamp', "event_timestamp IS NULL")} UNION ALL
    {_blank('fact_events', 'dirty', 'click_id', "click_id IS NULL OR click_id = ''")} UNION ALL
    {_blank('dim_users', 'dirty_users', 'user_domain_id', "user_domain_id IS NULL OR user_domain_id = ''")})"""
)
def dq_nulls(spark, sf_dir):
    fact = inputs.dirty_fact(spark, sf_dir, "fact-null-keys", fixtures.null_keys)
    return q.dq_nulls(fact, dims.dim_users(fact))


_REPEATED = "SELECT event_id FROM browser_dup GROUP BY event_id HAVING count(*) > 1"


@query(
    f"""SELECT case when count(*) > 0 then 'failed' else 'passed' end as status,
    least(count(*), 10) as duplicate_count, count(*) as true_count,
    (SELECT string_agg(event_id, ',' ORDER BY event_id) FROM
      (SELECT event_id FROM ({_REPEATED}) ORDER BY event_id LIMIT 5)) as samples FROM ({_REPEATED})"""
)
def dq_duplicates(spark, sf_dir):
    return q.dq_duplicates(inputs.dirty_fact(spark, sf_dir, "fact-repeats", fixtures.browser_dup))


@query(
    f"""SELECT 'browser_events_orphaned' as check_name, count(*) as count, {_status('count(*)')}
    FROM events_browser_raw WHERE event_id NOT IN (SELECT event_id FROM first_batch)"""
)
def dq_orphans_browser(spark, sf_dir):
    """All events are staged while the fact holds the first batch."""
    staged = inputs.staging(spark, sf_dir).read("events_browser_raw")
    return q.dq_orphans_browser(staged, fixtures.two_batches(spark, sf_dir)[0])


@query(
    f"""SELECT 'device_events_orphaned' as check_name, count(*) as count, {_status('count(*)')}
    FROM device_orphan WHERE click_id NOT IN (SELECT click_id FROM fact_events)"""
)
def dq_orphans_device(spark, sf_dir):
    return q.dq_orphans_device(fixtures.device_orphan(spark, sf_dir), inputs.fact(spark, sf_dir))


@query(
    f"""SELECT 'missing_location_data' as check_name, count(*) as count, {_status('count(*)')}
    FROM fact_events WHERE page_url = ''"""
)
def dq_missing_location(spark, sf_dir):
    return q.dq_missing_location(inputs.fact(spark, sf_dir))


@query(
    f"""SELECT 'device_type_inconsistency' as check_name, count(*) as count, {_status('count(*)')} FROM fact_events
    WHERE device_is_mobile <> (device_type = 'Mobile')"""
)
def dq_device_consistency(spark, sf_dir):
    return q.dq_device_consistency(inputs.fact(spark, sf_dir))


_DIRTY = oracle.fact_over("browser_dup")
_ORPHANS = "SELECT 1 FROM device_orphan WHERE click_id NOT IN (SELECT click_id FROM dirty)"


@query(
    f"""SELECT * FROM (WITH dirty AS ({_DIRTY}), checks AS (
    SELECT 'freshness' as check_name, 'fact_events' as object, NULL::bigint as count,
      case when {_AGE} > 2 then 'failed' else 'passed' end as status FROM dirty
    UNION ALL SELECT 'null_event_id', 'fact_events', count(*), {_status('count(*)')} FROM dirty WHERE event_id = ''
    UNION ALL SELECT 'null_event_timestamp', 'fact_events', count(*), {_status('count(*)')} FROM dirty
      WHERE event_timestamp IS NULL
    UNION ALL SELECT 'null_click_id', 'fact_events', count(*), {_status('count(*)')} FROM dirty WHERE click_id = ''
    UNION ALL SELECT 'missing_location_data', 'fact_events', count(*), {_status('count(*)')} FROM dirty
      WHERE page_url = ''
    UNION ALL SELECT 'device_type_inconsistency', 'fact_events', count(*), {_status('count(*)')} FROM dirty
      WHERE device_is_mobile <> (device_type = 'Mobile')
    UNION ALL SELECT 'null_user_domain_id', 'dim_users', 0, 'passed'
    UNION ALL SELECT 'duplicate_event_ids', 'fact_events', count(*), {_status('count(*)', 'failed')} FROM ({_REPEATED})
    UNION ALL SELECT 'browser_events_orphaned', 'events_browser_raw', 0, 'passed'
    UNION ALL SELECT 'device_events_orphaned', 'events_device_raw', count(*), {_status('count(*)')} FROM ({_ORPHANS}))
    SELECT * FROM checks UNION ALL SELECT 'overall', 'all', count(*),
      case when count(*) = 0 then 'passed' else 'failed' end FROM checks WHERE status <> 'passed')"""
)
def dq_report(spark, sf_dir):
    """All checks, with repeated deliveries in the fact and device rows of unknown clicks in staging."""
    fact = inputs.dirty_fact(spark, sf_dir, "fact-repeats", fixtures.browser_dup)
    tables = {
        "fact_events": fact,
        "dim_users": dims.dim_users(fact),
        "events_browser_raw": fixtures.browser_dup(spark, sf_dir),
        "events_device_raw": fixtures.device_orphan(spark, sf_dir),
    }
    return q.dq_report(tables, CLOCK)
