"""Oracle relations in SQL: the fixtures, the fact and the dirty overlays, written apart from the Spark side."""

from __future__ import annotations

_PAGE = (
    "case k % 6 when 0 then '/home' when 1 then '/product_a' when 2 then '/product_b' "
    "when 3 then '/cart' when 4 then '/checkout' else '/confirmation' end"
)

BROWSER_COLUMNS = "event_id, event_timestamp, event_type, click_id, browser_name, browser_user_agent, browser_language"
DEVICE_COLUMNS = "os, os_name, os_timezone, device_type, device_is_mobile, user_custom_id, user_domain_id"
GEO_COLUMNS = "geo_latitude, geo_longitude, geo_country, geo_timezone, geo_region_name, ip_address"
LOCATION_COLUMNS = (
    "page_url, page_url_path, referer_url, referer_medium, utm_medium, utm_source, utm_content, utm_campaign"
)

_DEVICE_FROM_CLICKS = """
  click_id,
  case when user_id % 4 < 2 then 'mobile-os' else 'desktop-os' end as os,
  case user_id % 4 when 0 then 'Android' when 1 then 'iOS' when 2 then 'Windows' else 'Linux' end as os_name,
  case when user_id % 2 = 0 then 'Europe/Berlin' else 'America/New_York' end as os_timezone,
  case user_id % 3 when 0 then 'Mobile' when 1 then 'Desktop' else 'Tablet' end as device_type,
  (user_id % 3 = 0) <> (user_id % 29 = 0) as device_is_mobile,
  concat('cust', cast(user_id as string)) as user_custom_id,
  concat('u', cast(user_id as string)) as user_domain_id,
  first_ts as inserted_at"""

FEEDS = {
    "ev": """SELECT cast(event_id as string) as event_id, event_id as n, ts, user_id, event_type,
  concat('c', cast(user_id as string), '-', cast(cast(ts as date) as string)) as click_id,
  user_id * 31 + day(ts) as ch, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k FROM events""",
    "clicks": "SELECT click_id, user_id, ch, min(ts) as first_ts FROM ev GROUP BY click_id, user_id, ch",
    "browser_n": """SELECT event_id, ts as event_timestamp,
  case when event_type = 'purchase' then 'conversion' else event_type end as event_type, click_id,
  case user_id % 5 when 0 then 'Chrome' when 1 then 'Safari' when 2 then 'Firefox' when 3 then 'Edge'
    else 'Opera' end as browser_name,
  concat('Mozilla/5.0 ua', cast(user_id % 7 as string)) as browser_user_agent,
  case user_id % 3 when 0 then 'en' when 1 then 'de' else 'ru' end as browser_language,
  ts as inserted_at, n FROM ev""",
    "events_browser_raw": "SELECT * EXCLUDE (n) FROM browser_n",
    "events_device_raw": f"SELECT {_DEVICE_FROM_CLICKS} FROM clicks WHERE ch % 10 <> 0",
    "events_geo_raw": """SELECT click_id, cast(user_id % 90 as string) as geo_latitude,
  cast(user_id % 180 as string) as geo_longitude, n_name as geo_country,
  concat('TZ', cast(user_id % 25 as string)) as geo_timezone,
  concat(n_name, '-R', cast(user_id % 4 as string)) as geo_region_name,
  concat('10.0.', cast(user_id % 256 as string), '.1') as ip_address, first_ts as inserted_at
  FROM clicks JOIN nation ON n_nationkey = user_id % 25 WHERE ch % 20 <> 1""",
    "events_location_raw": f"""SELECT event_id, concat('https://shop.example', {_PAGE}) as page_url,
  {_PAGE} as page_url_path, concat('https://ref', cast(k % 4 as string), '.example') as referer_url,
  case k % 4 when 0 then 'search' when 1 then 'social' when 2 then 'internal' else 'unknown' end as referer_medium,
  case k % 3 when 0 then 'cpc' when 1 then 'social' else 'email' end as utm_medium,
  case k % 5 when 0 then 'google' when 1 then 'facebook' when 2 then '' when 3 then 'newsletter'
    else 'tiktok' end as utm_source,
  concat('content_', cast(k % 8 as string)) as utm_content,
  concat('camp_', cast(k % 4 as string)) as utm_campaign, ts as inserted_at FROM ev WHERE n % 17 <> 0""",
}


def _filled(prefix: str, columns: str) -> str:
    names = [c.strip() for c in columns.split(",")]
    return ", ".join(
        f"coalesce({prefix}.{c}, {'false' if c == 'device_is_mobile' else repr('')}) as {c}" for c in names
    )


def fact_over(browser: str = "events_browser_raw", device: str = "events_device_raw") -> str:
    """The fact join over given browser and device relations."""
    head = ", ".join(f"b.{c.strip()}" for c in BROWSER_COLUMNS.split(","))
    return f"""SELECT {head}, {_filled('d', DEVICE_COLUMNS)}, {_filled('g', GEO_COLUMNS)},
  {_filled('l', LOCATION_COLUMNS)} FROM {browser} b
  LEFT JOIN {device} d ON b.click_id = d.click_id LEFT JOIN events_geo_raw g ON b.click_id = g.click_id
  LEFT JOIN events_location_raw l ON b.event_id = l.event_id"""


USERS = """SELECT user_domain_id, arg_min(user_custom_id, (event_timestamp, event_id)) as user_custom_id,
  date_trunc('second', min(event_timestamp)) as first_seen, date_trunc('second', max(event_timestamp)) as last_seen,
  count(*) as total_events, arg_min(device_type, (event_timestamp, event_id)) as device_type,
  arg_min(os_name, (event_timestamp, event_id)) as os_name
  FROM {fact} WHERE user_domain_id <> '' GROUP BY user_domain_id"""

HOURLY = """SELECT date_trunc('hour', event_timestamp) as event_hour, event_type, browser_name, device_type,
  geo_country, utm_source, utm_campaign, count(*) as total_events,
  count(distinct user_domain_id) as unique_users, count(distinct click_id) as unique_clicks
  FROM fact_events GROUP BY ALL"""

TRAFFIC = """SELECT cast(event_timestamp as date) as date, utm_source, utm_medium, utm_campaign, utm_content,
  referer_medium, count(*) as total_events, count(distinct user_domain_id) as unique_users,
  count(distinct click_id) as unique_sessions FROM fact_events GROUP BY ALL"""

GEO = """SELECT concat(geo_country, '_', geo_region_name) as geo_id, geo_country, geo_region_name,
  arg_min(geo_latitude, (event_timestamp, event_id)) as geo_latitude,
  arg_min(geo_longitude, (event_timestamp, event_id)) as geo_longitude,
  arg_min(geo_timezone, (event_timestamp, event_id)) as geo_timezone
  FROM fact_events WHERE geo_country <> '' GROUP BY geo_country, geo_region_name"""

RELATIONS = {
    **FEEDS,
    "fact_events": fact_over(),
    "dim_users": USERS.format(fact="fact_events"),
    "dim_geo": GEO,
    "agg_events_hourly": HOURLY,
    "agg_traffic_sources": TRAFFIC,
    # Dirty overlays
    "browser_dup": "SELECT * EXCLUDE (n) FROM browser_n UNION ALL SELECT * EXCLUDE (n) FROM browser_n WHERE n % 500 = 0",
    "device_dup": f"""SELECT * FROM events_device_raw UNION ALL
  SELECT * REPLACE ('Other' as os_name, inserted_at + interval 1 hour as inserted_at)
  FROM (SELECT {_DEVICE_FROM_CLICKS} FROM clicks WHERE ch % 10 <> 0 AND user_id % 40 = 0)""",
    "device_orphan": """SELECT * FROM events_device_raw UNION ALL
  SELECT concat('orphan-', cast(user_id as string)), 'desktop-os', 'Windows', 'Europe/Berlin', 'Desktop', false, '',
  concat('u', cast(user_id as string)), min(ts) FROM ev WHERE user_id % 50 = 0 GROUP BY user_id""",
    "null_keys": """SELECT * EXCLUDE (n) REPLACE (
  case when n % 97 = 0 then '' when n % 89 = 0 then '' else event_id end as event_id,
  case when n = 5 then NULL else event_timestamp end as event_timestamp) FROM browser_n""",
    "first_batch": "SELECT * FROM events_browser_raw WHERE event_timestamp < TIMESTAMP '2024-01-16 00:00:00'",
    "second_batch": """SELECT * FROM events_browser_raw WHERE event_timestamp >= TIMESTAMP '2024-01-16 00:00:00'
  OR cast(event_timestamp as date) = DATE '2024-01-15'""",
}


def with_feeds(sql: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in RELATIONS.items()) + "\n" + sql


def half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator to two places, halves up, in whole numbers until the last step."""
    n, d = f"cast({numerator} as bigint)", f"cast({denominator} as bigint)"
    return f"(((200 * {n} + {d}) // (2 * {d})) / 100.0)::double"
