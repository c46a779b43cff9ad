"""Registered queries: the report datasets and charts."""

from __future__ import annotations

from footfall.plans import reports as r
from footfall.registry import inputs
from footfall.registry.book import Book, close
from footfall.registry.oracle import half_up
from footfall.sources.fixtures import CLOCK

BOOK = Book()

_CLOCK = f"TIMESTAMP '{CLOCK}'"
_USERS = "count(distinct user_domain_id)"
_HOUR = "date_trunc('hour', event_timestamp)"
_DAY = "cast(event_timestamp as date)"
_DATASET = f"""SELECT {_DAY} as date, utm_source, utm_medium, utm_campaign, count(*) as total_events,
  {_USERS} as unique_users FROM fact_events GROUP BY ALL"""
_HOURLY = f"""SELECT {_HOUR} as event_hour, event_type, geo_country, utm_source, count(*) as total_events,
  {_USERS} as unique_users FROM fact_events GROUP BY ALL"""


def _count(*keys: str) -> str:
    names = ", ".join(keys)
    return f"SELECT {names}, count(*) as events FROM fact_events GROUP BY {names}"


def _top(key: str, k: int) -> str:
    return f"{_count(key)} ORDER BY events DESC, {key} LIMIT {k}"


_FUNNEL = """WITH v AS (SELECT user_domain_id as u, page_url_path as p, event_timestamp as t FROM fact_events
    WHERE user_domain_id <> ''),
  s1 AS (SELECT u, min(t) as reached FROM v WHERE p = '/home' GROUP BY u),
  s2 AS (SELECT v.u, min(t) as reached FROM v JOIN s1 ON v.u = s1.u WHERE p = '/product_a' AND t > reached GROUP BY v.u),
  s3 AS (SELECT v.u, min(t) as reached FROM v JOIN s2 ON v.u = s2.u WHERE p = '/product_b' AND t > reached GROUP BY v.u),
  s4 AS (SELECT v.u, min(t) as reached FROM v JOIN s3 ON v.u = s3.u WHERE p = '/checkout' AND t > reached GROUP BY v.u)
  SELECT 1 as step, '/home' as page, count(*) as users FROM s1 UNION ALL SELECT 2, '/product_a', count(*) FROM s2
  UNION ALL SELECT 3, '/product_b', count(*) FROM s3 UNION ALL SELECT 4, '/checkout', count(*) FROM s4"""

# Reports over the fact, and the SQL of each.
_OVER_FACT = {
    r.ds_hourly_events: _HOURLY,
    r.ds_traffic_sources: _DATASET,
    r.traffic_stats: f"""SELECT utm_source, utm_campaign, count(*) as total_events, {_USERS} as unique_users
      FROM fact_events GROUP BY ALL""",
    r.events_last_24h: f"""SELECT {_HOUR} as event_hour, event_type, count(*) as events, {_USERS} as users
      FROM fact_events WHERE {_HOUR} >= {_CLOCK} - INTERVAL 24 HOUR GROUP BY ALL""",
    r.total_events: "SELECT count(*) as total_events FROM fact_events",
    r.unique_users: f"SELECT {_USERS} as unique_users FROM fact_events",
    r.events_by_type: _count("event_type"),
    r.events_timeline: f"SELECT {_HOUR} as event_hour, count(*) as events FROM fact_events GROUP BY ALL",
    r.top_browsers: _top("browser_name", 10),
    r.device_distribution: _count("device_type"),
    r.traffic_breakdown: f"""SELECT utm_source, utm_medium, utm_campaign,
      cast(sum(total_events) as bigint) as total_events, cast(sum(unique_users) as bigint) as user_days
      FROM ({_DATASET}) GROUP BY ALL""",
    r.source_performance: f"SELECT utm_source, count(*) as events, {_USERS} as users FROM fact_events GROUP BY ALL",
    r.campaigns_by_source: _count("utm_campaign", "utm_source"),
    r.traffic_trend: f"SELECT {_DAY} as date, utm_source, count(*) as events FROM fact_events GROUP BY ALL",
    r.utm_matrix: f"""SELECT *, {half_up('total_events', 'unique_sessions')} as events_per_session FROM (
      SELECT utm_source, utm_medium, utm_campaign, count(*) as total_events, {_USERS} as unique_users,
      count(distinct click_id) as unique_sessions FROM fact_events WHERE utm_source <> '' GROUP BY ALL)
      ORDER BY total_events DESC, utm_source, utm_medium, utm_campaign LIMIT 20""",
    r.top_countries: _top("geo_country", 10),
    r.top_locations: f"""SELECT geo_country, geo_region_name, count(*) as events, {_USERS} as users
      FROM fact_events GROUP BY ALL ORDER BY events DESC, geo_country, geo_region_name LIMIT 20""",
    r.geo_hierarchy: """SELECT geo_country, geo_region_name,
      case grouping_id(geo_country, geo_region_name) when 0 then 'region' when 1 then 'country' else 'all' end
      as level, count(*) as events FROM fact_events GROUP BY ROLLUP (geo_country, geo_region_name)""",
    r.country_device: _count("geo_country", "device_type"),
    r.geo_performance: f"""SELECT geo_country, events, users, {half_up('events', 'users')} as events_per_user,
      conversions, {half_up('100 * conversions', 'events')} as conversion_rate FROM (
      SELECT geo_country, count(*) as events, {_USERS} as users,
      cast(count_if(event_type = 'conversion') as bigint) as conversions FROM fact_events GROUP BY geo_country
      HAVING count(*) > 50) ORDER BY events DESC, geo_country LIMIT 15""",
    r.top_pages: _top("page_url_path", 15),
    r.referrer_flow: _count("referer_medium", "utm_source"),
    r.user_journey: """SELECT utm_source as source, page_url_path as target, count(*) as value FROM fact_events
      GROUP BY ALL HAVING value > 10 ORDER BY value DESC, source, target LIMIT 50""",
    r.referer_page_flow: _count("referer_medium", "page_url_path"),
    r.funnel_share: f"""SELECT step, users, {half_up('100 * users', 'total')} as percentage FROM (
      SELECT page_url_path as step, count(*) as users, (SELECT count(*) FROM fact_events) as total FROM fact_events
      WHERE page_url_path IN ('/home', '/product_a', '/product_b', '/checkout') GROUP BY page_url_path)""",
    r.funnel_ordered: f"SELECT * FROM ({_FUNNEL})",
    r.retention_cohort: f"""SELECT cohort, cast(day - cohort as int) as day_offset, count(*) as users FROM (
      SELECT DISTINCT user_domain_id, {_DAY} as day,
      min({_DAY}) OVER (PARTITION BY user_domain_id) as cohort FROM fact_events WHERE user_domain_id <> '')
      GROUP BY ALL""",
    r.daily_cohort: f"""SELECT *, {half_up('events', 'unique_users')} as events_per_user FROM (
      SELECT {_DAY} as date, device_type, count(*) as events, {_USERS} as unique_users FROM fact_events
      WHERE event_timestamp >= cast({_CLOCK} as date) - 7 GROUP BY ALL)""",
    r.active_users_48h: f"""SELECT event_hour, summed_users, distinct_users FROM
      (SELECT event_hour, cast(sum(unique_users) as bigint) as summed_users FROM ({_HOURLY}) GROUP BY event_hour)
      JOIN (SELECT {_HOUR} as event_hour, {_USERS} as distinct_users FROM fact_events GROUP BY 1)
      USING (event_hour) WHERE event_hour >= {_CLOCK} - INTERVAL 48 HOUR""",
}


def _over_fact(report):
    def run(spark, sf_dir):
        return report(inputs.fact(spark, sf_dir), CLOCK)

    return run


for _report, _sql in _OVER_FACT.items():
    BOOK.query(_sql, name=_report.__name__)(_over_fact(_report))


@BOOK.query(
    """SELECT geo_country, events, latitude, longitude FROM
    (SELECT geo_country, count(*) as events FROM fact_events WHERE geo_country <> '' GROUP BY geo_country)
    LEFT JOIN (SELECT geo_country, arg_min(try_cast(geo_latitude as double), geo_id) as latitude,
      arg_min(try_cast(geo_longitude as double), geo_id) as longitude FROM dim_geo GROUP BY geo_country)
    USING (geo_country)"""
)
def events_map(spark, sf_dir):
    wh = inputs.warehouse(spark, sf_dir)
    return r.events_map(wh.read("fact_events"), wh.read("dim_geo"))


@BOOK.query(
    f"""SELECT event_hour, count(*) as events FROM (SELECT {_HOUR} as event_hour FROM fact_events)
    WHERE event_hour >= {_CLOCK} - INTERVAL 24 HOUR GROUP BY ROLLUP (event_hour)"""
)
def activity_24h(spark, sf_dir):
    return r.activity_24h(inputs.warehouse(spark, sf_dir).read("agg_events_hourly"), CLOCK)


@BOOK.query(
    """SELECT cast(hour(event_timestamp) as int) as hour, event_type, count(*) as events
    FROM fact_events GROUP BY ALL"""
)
def activity_heatmap(spark, sf_dir):
    return r.activity_heatmap(inputs.warehouse(spark, sf_dir).read("agg_events_hourly"))


# The dataset reports from the stored states: counts are exact, and users within the sketch's error.
_OVER_STATE = {
    r.ds_hourly_events: ("agg_events_hourly", "total_events", "unique_users"),
    r.ds_traffic_sources: ("agg_traffic_sources", "total_events", "unique_users"),
    r.traffic_stats: ("agg_traffic_sources", "total_events", "unique_users"),
    r.events_last_24h: ("agg_events_hourly", "events", "users"),
}


def _over_state(report, state, events, users):
    def run(spark, sf_dir):
        wh = inputs.warehouse(spark, sf_dir)
        merged = report(wh.read(state), CLOCK)
        exact = report(wh.read("fact_events"), CLOCK).withColumnRenamed(users, "exact").drop(events)
        keys = [c for c in exact.columns if c != "exact"]
        return merged.join(exact, keys).select(*keys, events, close(users, "exact").alias("users_close"))

    return run


for _report, (_state, _events, _users) in _OVER_STATE.items():
    _sql = f"SELECT * EXCLUDE ({_users}), true as users_close FROM ({_OVER_FACT[_report]})"
    BOOK.query(_sql, name=f"{_report.__name__}_from_state")(_over_state(_report, _state, _events, _users))
