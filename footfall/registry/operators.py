"""Registered queries: filters, joins, aggregates, states, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall.functions.values import ratio
from footfall.operators import aggregates as agg
from footfall.operators import dedup, filters, joins, rollups
from footfall.plans import dims
from footfall.plans import fact as fact_plan
from footfall.plans.warehouse import STAGING_TABLES
from footfall.registry import inputs, oracle
from footfall.registry.book import Book, close
from footfall.registry.oracle import BROWSER_COLUMNS, DEVICE_COLUMNS, GEO_COLUMNS, LOCATION_COLUMNS, half_up
from footfall.schemas import BROWSER, DEVICE, FACT_COLUMNS, GEO, HOURLY_KEYS, LOCATION
from footfall.sources import fixtures

BOOK = Book()
query = BOOK.query

_FACT = ", ".join([BROWSER_COLUMNS, DEVICE_COLUMNS, GEO_COLUMNS, LOCATION_COLUMNS])
_CLOCK = f"TIMESTAMP '{fixtures.CLOCK}'"


def _staged(spark, sf_dir):
    wh = inputs.staging(spark, sf_dir)
    return [wh.read(table) for table in STAGING_TABLES]


# Projections and filters


@query(f"SELECT {_FACT} FROM fact_events")
def project_fact(spark, sf_dir):
    browser, device, geo, location = _staged(spark, sf_dir)
    events = joins.join_location(browser.select(*BROWSER.columns), location)
    joined = joins.join_geo(joins.join_device(events, device), geo)
    return fact_plan.project_fact(joined, fixtures.CLOCK).drop("created_at")


@query("SELECT event_id, utm_source FROM fact_events WHERE utm_source <> ''")
def filter_nonempty(spark, sf_dir):
    return filters.filter_nonempty(inputs.fact(spark, sf_dir), "utm_source").select("event_id", "utm_source")


@query("SELECT click_id, event_timestamp, event_type FROM null_keys WHERE event_id IS NULL OR event_id = ''")
def filter_blank(spark, sf_dir):
    rows = filters.filter_blank(fixtures.null_keys(spark, sf_dir), "event_id")
    return rows.select("click_id", "event_timestamp", "event_type")


@query("SELECT event_id, page_url_path FROM fact_events WHERE page_url_path IN ('/cart', '/checkout')")
def filter_in_list(spark, sf_dir):
    rows = filters.filter_in_list(inputs.fact(spark, sf_dir), "page_url_path", ["/cart", "/checkout"])
    return rows.select("event_id", "page_url_path")


@query(f"SELECT event_id, event_timestamp FROM fact_events WHERE event_timestamp >= {_CLOCK} - INTERVAL 24 HOUR")
def filter_since(spark, sf_dir):
    rows = filters.filter_since(inputs.fact(spark, sf_dir), fixtures.CLOCK, hours=24)
    return rows.select("event_id", "event_timestamp")


@query(
    """SELECT event_id, device_type, device_is_mobile FROM fact_events
    WHERE (device_is_mobile AND device_type <> 'Mobile') OR (NOT device_is_mobile AND device_type = 'Mobile')"""
)
def filter_bool_pair(spark, sf_dir):
    return filters.filter_bool_pair(inputs.fact(spark, sf_dir)).select("event_id", "device_type", "device_is_mobile")


@query(
    """SELECT utm_source, count(*) as events FROM fact_events WHERE geo_country IN ('NATION_3', 'NATION_8')
    AND device_type = 'Mobile' AND event_type IN ('conversion', 'view') GROUP BY utm_source"""
)
def dashboard_filters(spark, sf_dir):
    chosen = {"geo_country": ["NATION_3", "NATION_8"], "device_type": "Mobile", "event_type": ["conversion", "view"]}
    return agg.count_by(filters.dashboard_filters(inputs.fact(spark, sf_dir), chosen), "utm_source")


# Joins


def _joined_oracle(columns: str, table: str, key: str, relation: str = "") -> str:
    return f"""SELECT b.event_id, b.click_id, {oracle._filled('r', columns)}
    FROM events_browser_raw b LEFT JOIN {relation or table} r ON b.{key} = r.{key}"""


def _events(spark, sf_dir):
    return inputs.staging(spark, sf_dir).read(BROWSER.table).select("event_id", "click_id")


@query(_joined_oracle(DEVICE_COLUMNS, "events_device_raw", "click_id"))
def join_device(spark, sf_dir):
    return joins.join_device(_events(spark, sf_dir), inputs.staging(spark, sf_dir).read(DEVICE.table))


@query(_joined_oracle(DEVICE_COLUMNS, "events_device_raw", "click_id", "device_dup"))
def join_device_all_matches(spark, sf_dir):
    """Every match of a click with two device rows is kept."""
    return joins.join_device(_events(spark, sf_dir), fixtures.device_dup(spark, sf_dir), dedup=False)


@query(_joined_oracle(GEO_COLUMNS, "events_geo_raw", "click_id"))
def join_geo(spark, sf_dir):
    return joins.join_geo(_events(spark, sf_dir), inputs.staging(spark, sf_dir).read(GEO.table))


@query(_joined_oracle(LOCATION_COLUMNS, "events_location_raw", "event_id"))
def join_location(spark, sf_dir):
    return joins.join_location(_events(spark, sf_dir), inputs.staging(spark, sf_dir).read(LOCATION.table))


@query(f"SELECT {_FACT} FROM fact_events")
def fact_events(spark, sf_dir):
    return fact_plan.fact_events(*_staged(spark, sf_dir), as_of=fixtures.CLOCK).select(*FACT_COLUMNS)


@query(f"SELECT {_FACT} FROM ({oracle.fact_over('browser_dup', 'device_dup')})")
def fact_events_all_matches(spark, sf_dir):
    """The fact over repeated deliveries and repeated device rows, every match kept."""
    _, _, geo, location = _staged(spark, sf_dir)
    dirty = (fixtures.browser_dup(spark, sf_dir), fixtures.device_dup(spark, sf_dir))
    return fact_plan.fact_events(*dirty, geo, location, dedup=False, as_of=fixtures.CLOCK).select(*FACT_COLUMNS)


@query(f"SELECT {BROWSER_COLUMNS} FROM second_batch WHERE event_id NOT IN (SELECT event_id FROM first_batch)")
def new_events_only(spark, sf_dir):
    first, second = fixtures.two_batches(spark, sf_dir)
    return joins.new_events_only(second, first).select(*BROWSER.columns)


@query(f"SELECT {BROWSER_COLUMNS} FROM events_browser_raw WHERE event_id NOT IN (SELECT event_id FROM first_batch)")
def orphans_browser(spark, sf_dir):
    """Staged events while only the first batch has been loaded."""
    staged = inputs.staging(spark, sf_dir).read(BROWSER.table)
    return joins.orphans_browser(staged, fixtures.two_batches(spark, sf_dir)[0]).select(*BROWSER.columns)


@query(
    f"SELECT click_id, {DEVICE_COLUMNS} FROM device_orphan WHERE click_id NOT IN (SELECT click_id FROM fact_events)"
)
def orphans_device(spark, sf_dir):
    orphans = joins.orphans_device(fixtures.device_orphan(spark, sf_dir), inputs.fact(spark, sf_dir))
    return orphans.select(*DEVICE.columns)


@query(
    """SELECT event_type, count(*) as events, (SELECT count(*) FROM fact_events) as total
    FROM fact_events GROUP BY event_type"""
)
def scalar_total(spark, sf_dir):
    fact = inputs.fact(spark, sf_dir)
    total = fact.agg(F.count(F.lit(1))).scalar()
    return agg.count_by(fact, "event_type").withColumn("total", total)


# Aggregates


@query("SELECT event_type, browser_name, count(*) as events FROM fact_events GROUP BY ALL")
def count_by(spark, sf_dir):
    return agg.count_by(inputs.fact(spark, sf_dir), "event_type", "browser_name")


@query(
    """SELECT geo_country, cast(count_if(event_type = 'conversion') as bigint) as conversions
    FROM fact_events GROUP BY geo_country"""
)
def count_if(spark, sf_dir):
    return agg.count_if(inputs.fact(spark, sf_dir), ["geo_country"], F.col("event_type") == "conversion", "conversions")


@query(
    """SELECT user_domain_id, min(event_timestamp) as min_event_timestamp, max(event_timestamp) as max_event_timestamp
    FROM fact_events GROUP BY user_domain_id"""
)
def min_max(spark, sf_dir):
    return agg.min_max(inputs.fact(spark, sf_dir), ["user_domain_id"], "event_timestamp")


@query(
    """SELECT user_domain_id, arg_min(device_type, (event_timestamp, event_id)) as device_type,
    arg_min(os_name, (event_timestamp, event_id)) as os_name FROM fact_events GROUP BY user_domain_id"""
)
def any_value(spark, sf_dir):
    return agg.any_value(inputs.fact(spark, sf_dir), ["user_domain_id"], ["device_type", "os_name"])


@query(
    """SELECT utm_source, count(distinct user_domain_id) as users, count(distinct click_id) as clicks
    FROM fact_events GROUP BY utm_source"""
)
def uniq_exact(spark, sf_dir):
    columns = {"users": "user_domain_id", "clicks": "click_id"}
    return agg.uniq_exact(inputs.fact(spark, sf_dir), ["utm_source"], columns)


@query("SELECT utm_source, true as users_close, true as clicks_close FROM fact_events GROUP BY utm_source")
def uniq_approx(spark, sf_dir):
    """Estimates lie within their error bound of the exact counts."""
    fact = inputs.fact(spark, sf_dir)
    approx = agg.uniq_approx(fact, ["utm_source"], {"users": "user_domain_id", "clicks": "click_id"})
    exact = agg.uniq_exact(fact, ["utm_source"], {"exact_users": "user_domain_id", "exact_clicks": "click_id"})
    return approx.join(exact, "utm_source").select(
        "utm_source",
        close("users", "exact_users").alias("users_close"),
        close("clicks", "exact_clicks").alias("clicks_close"),
    )


@query("SELECT utm_source, cast(sum(total_events) as bigint) as events FROM agg_traffic_sources GROUP BY utm_source")
def sum_measure(spark, sf_dir):
    state = inputs.warehouse(spark, sf_dir).read("agg_traffic_sources")
    return agg.sum_measure(state, ["utm_source"], {"events": "total_events"})


@query("SELECT user_domain_id, count(*) as events FROM fact_events GROUP BY user_domain_id HAVING events > 60")
def having(spark, sf_dir):
    return agg.having(agg.count_by(inputs.fact(spark, sf_dir), "user_domain_id"), F.col("events") > 60)


@query(
    f"""SELECT device_type, events, users, {half_up('events', 'users')} as events_per_user FROM
    (SELECT device_type, count(*) as events, count(distinct user_domain_id) as users
    FROM fact_events GROUP BY device_type)"""
)
def ratio_of_aggs(spark, sf_dir):
    counted = inputs.fact(spark, sf_dir).groupBy("device_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_domain_id").alias("users")
    )
    return counted.withColumn("events_per_user", ratio(F.col("events"), F.col("users")))


@query("SELECT * FROM agg_events_hourly")
def agg_events_hourly(spark, sf_dir):
    return rollups.agg_events_hourly(inputs.fact(spark, sf_dir))


@query("SELECT * FROM agg_traffic_sources")
def agg_traffic_sources(spark, sf_dir):
    return rollups.agg_traffic_sources(inputs.fact(spark, sf_dir))


@query(f"SELECT {', '.join(HOURLY_KEYS)}, total_events, true as users_close FROM agg_events_hourly")
def rollup_state(spark, sf_dir):
    """The states as written: exact counts, and sketches that estimate each group's users."""
    fact = inputs.fact(spark, sf_dir)
    state = rollups.hourly_state(fact).withColumn("users", F.hll_sketch_estimate("unique_users"))
    exact = rollups.agg_events_hourly(fact).select(*HOURLY_KEYS, F.col("unique_users").alias("exact_users"))
    both = state.join(exact, HOURLY_KEYS)
    return both.select(*HOURLY_KEYS, "total_events", close("users", "exact_users").alias("users_close"))


@query(
    """SELECT event_type, utm_source, count(*) as total_events, true as users_close, true as clicks_close
    FROM fact_events GROUP BY event_type, utm_source"""
)
def rollup_merge(spark, sf_dir):
    """Stored states merged over two of their seven keys."""
    wh = inputs.warehouse(spark, sf_dir)
    keys = ["event_type", "utm_source"]
    merged = rollups.merge(wh.read("agg_events_hourly"), keys)
    distinct = {"exact_users": "user_domain_id", "exact_clicks": "click_id"}
    both = merged.join(agg.uniq_exact(wh.read("fact_events"), keys, distinct), keys)
    return both.select(
        *keys,
        "total_events",
        close("unique_users", "exact_users").alias("users_close"),
        close("unique_clicks", "exact_clicks").alias("clicks_close"),
    )


@query("SELECT event_hour, event_type, cast(sum(total_events) as bigint) as total_events FROM agg_events_hourly GROUP BY ALL")
def rollup_incremental(spark, sf_dir):
    """Two loads, the second repeating a day of the first: their partials merge to the full aggregate."""
    first, second = fixtures.two_batches(spark, sf_dir)
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "two-loads"), sf_dir, browser=first)
    wh.load("one", as_of=fixtures.CLOCK)
    wh.stage(BROWSER, second, "second")
    wh.load("two", as_of=fixtures.CLOCK)
    return wh.read("agg_events_hourly").groupBy("event_hour", "event_type").agg(
        F.sum("total_events").alias("total_events")
    )


@query("SELECT * FROM dim_users")
def dim_users(spark, sf_dir):
    return dims.dim_users(inputs.fact(spark, sf_dir))


@query("SELECT * FROM dim_geo")
def dim_geo(spark, sf_dir):
    return dims.dim_geo(inputs.fact(spark, sf_dir))


@query("SELECT * FROM dim_users")
def dim_users_from_state(spark, sf_dir):
    """The dimension from the partials of every load."""
    return dims.users_from(inputs.warehouse(spark, sf_dir).read("dim_users_state"))


@query("SELECT * FROM dim_geo")
def dim_geo_from_state(spark, sf_dir):
    return dims.geo_from(inputs.warehouse(spark, sf_dir).read("dim_geo_state"))


@query(
    f"""SELECT click_id, {DEVICE_COLUMNS}, inserted_at FROM device_dup
    QUALIFY row_number() OVER (PARTITION BY click_id ORDER BY inserted_at DESC) = 1"""
)
def latest_per_key(spark, sf_dir):
    return dedup.latest_per_key(fixtures.device_dup(spark, sf_dir), "click_id")


@query("SELECT DISTINCT * FROM browser_dup")
def dedup_by_key(spark, sf_dir):
    return dedup.dedup_by_key(fixtures.browser_dup(spark, sf_dir), "event_id")


@query(
    """SELECT event_id, count(*) as cnt FROM browser_dup GROUP BY event_id HAVING count(*) > 1
    ORDER BY event_id LIMIT 10"""
)
def duplicate_keys(spark, sf_dir):
    return dedup.duplicate_keys(fixtures.browser_dup(spark, sf_dir), "event_id")


# Sorts and top lists


@query(
    """SELECT cast(event_timestamp as date) as date, utm_source, count(*) as events FROM fact_events
    GROUP BY ALL ORDER BY date DESC, events DESC, utm_source"""
)
def sort_multi(spark, sf_dir):
    counted = agg.count_by(inputs.fact(spark, sf_dir), F.to_date("event_timestamp").alias("date"), "utm_source")
    return agg.sort_multi(counted, {"date": "desc", "events": "desc", "utm_source": "asc"})


@query(
    """SELECT user_domain_id, count(*) as events FROM fact_events GROUP BY user_domain_id
    ORDER BY events DESC, user_domain_id LIMIT 20"""
)
def top_k(spark, sf_dir):
    return agg.top_k(agg.count_by(inputs.fact(spark, sf_dir), "user_domain_id"), "events", 20, ["user_domain_id"])


@query(
    """SELECT event_id, date_trunc('hour', event_timestamp) as event_hour, cast(event_timestamp as date) as day,
    cast(year(event_timestamp) * 100 + month(event_timestamp) as int) as month,
    date_trunc('second', event_timestamp) as second, cast(hour(event_timestamp) as int) as hour_of_day,
    event_timestamp - INTERVAL 7 DAY as week_before,
    date_diff('microsecond', event_timestamp, TIMESTAMP '2024-01-31 00:00:00') / 3.6e9::double as age_hours,
    concat(geo_country, '_', geo_region_name) as geo_id FROM fact_events"""
)
def scalar_functions(spark, sf_dir):
    """The time and text functions the other queries are made of, on every event."""
    from footfall.functions import clock

    return inputs.fact(spark, sf_dir).select(
        "event_id",
        clock.event_hour().alias("event_hour"),
        clock.event_day().alias("day"),
        clock.event_month().alias("month"),
        clock.whole_seconds("event_timestamp").alias("second"),
        F.hour("event_timestamp").alias("hour_of_day"),
        clock.before(F.col("event_timestamp"), days=7).alias("week_before"),
        clock.age_hours("event_timestamp", fixtures.CLOCK).alias("age_hours"),
        F.concat("geo_country", F.lit("_"), "geo_region_name").alias("geo_id"),
    )
