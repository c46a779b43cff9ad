"""Report queries over the fact. Each takes the fact, the clock where it looks back, and dashboard filters.

Distinct counts are exact over the fact. The dataset reports also accept the stored states in its place: then
they merge partials instead of reading events, and their distinct counts are estimates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.clock import before, event_day, event_hour, moment, since
from footfall.functions.values import merged_estimate, percent, ratio
from footfall.operators import rollups
from footfall.operators.aggregates import count_by, having, sort_multi, sum_measure, top_k
from footfall.operators.filters import dashboard_filters, filter_in_list, filter_nonempty
from footfall.schemas import HOURLY_KEYS

USER = "user_domain_id"

# The pages of the funnel, in step order.
FUNNEL_PAGES = ("/home", "/product_a", "/product_b", "/checkout")


def _events_and_users(rows: DataFrame, keys: Sequence[str], events: str = "events", users: str = "users"):
    """Events and distinct users per group: counted in a fact, merged from a state."""
    if "total_events" in rows.columns:
        merged = rollups.merge(rows.select(*keys, "total_events", "unique_users"), keys)
        return merged.withColumnsRenamed({"total_events": events, "unique_users": users})
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(events), F.count_distinct(USER).alias(users))


def _with_hour(rows: DataFrame) -> DataFrame:
    return rows if "event_hour" in rows.columns else rows.withColumn("event_hour", event_hour())


def _with_day(rows: DataFrame) -> DataFrame:
    return rows if "date" in rows.columns else rows.withColumn("date", event_day())


def _recent_hours(rows: DataFrame, as_of, hours: int) -> DataFrame:
    """Rows of the full hours that began within the last ``hours``."""
    cutoff = before(as_of, hours=hours)
    narrowed = rows if "event_hour" in rows.columns else since(rows, cutoff)
    return since(_with_hour(narrowed), cutoff, "event_hour")


# Datasets


def ds_hourly_events(fact, as_of=None, filters=None):
    rows = _with_hour(dashboard_filters(fact, filters))
    keys = ["event_hour", "event_type", "geo_country", "utm_source"]
    counted = _events_and_users(rows, keys, "total_events", "unique_users")
    return sort_multi(counted, {"event_hour": "desc"})


def ds_traffic_sources(fact, as_of=None, filters=None):
    rows = _with_day(dashboard_filters(fact, filters))
    keys = ["date", "utm_source", "utm_medium", "utm_campaign"]
    counted = _events_and_users(rows, keys, "total_events", "unique_users")
    return sort_multi(counted, {"date": "desc", "total_events": "desc"})


def traffic_stats(fact, as_of=None, filters=None):
    rows = dashboard_filters(fact, filters)
    counted = _events_and_users(rows, ["utm_source", "utm_campaign"], "total_events", "unique_users")
    return sort_multi(counted, {"total_events": "desc"})


def events_last_24h(fact, as_of=None, filters=None):
    recent = _recent_hours(dashboard_filters(fact, filters), as_of, 24)
    return sort_multi(_events_and_users(recent, ["event_hour", "event_type"]), {"event_hour": "desc"})


# Overview


def total_events(fact, as_of=None, filters=None):
    return dashboard_filters(fact, filters).agg(F.count(F.lit(1)).alias("total_events"))


def unique_users(fact, as_of=None, filters=None):
    return dashboard_filters(fact, filters).agg(F.count_distinct(USER).alias("unique_users"))


def events_by_type(fact, as_of=None, filters=None):
    return count_by(dashboard_filters(fact, filters), "event_type")


def events_timeline(fact, as_of=None, filters=None):
    return count_by(dashboard_filters(fact, filters), event_hour().alias("event_hour"))


def top_browsers(fact, as_of=None, filters=None):
    return top_k(count_by(dashboard_filters(fact, filters), "browser_name"), "events", 10, ["browser_name"])


def device_distribution(fact, as_of=None, filters=None):
    return count_by(dashboard_filters(fact, filters), "device_type")


# Traffic


def traffic_breakdown(fact, as_of=None, filters=None):
    """Sums over the traffic dataset. ``user_days`` counts a user once a day, not once."""
    daily = ds_traffic_sources(fact, as_of, filters)
    keys = ["utm_source", "utm_medium", "utm_campaign"]
    return sum_measure(daily, keys, {"total_events": "total_events", "user_days": "unique_users"})


def source_performance(fact, as_of=None, filters=None):
    return _events_and_users(dashboard_filters(fact, filters), ["utm_source"])


def campaigns_by_source(fact, as_of=None, filters=None):
    return count_by(dashboard_filters(fact, filters), "utm_campaign", "utm_source")


def traffic_trend(fact, as_of=None, filters=None):
    return count_by(dashboard_filters(fact, filters), event_day().alias("date"), "utm_source")


def utm_matrix(fact, as_of=None, filters=None):
    keys = ["utm_source", "utm_medium", "utm_campaign"]
    rows = filter_nonempty(dashboard_filters(fact, filters), "utm_source")
    counted = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct(USER).alias("unique_users"),
        F.count_distinct("click_id").alias("unique_sessions"),
    )
    per_session = ratio(F.col("total_events"), F.col("unique_sessions"))
    return top_k(counted.withColumn("events_per_session", per_session), "total_events", 20, keys)


# Geography


def top_countries(fact, as_of=None, filters=None):
    return top_k(count_by(dashboard_filters(fact, filters), "geo_country"), "events", 10, ["geo_country"])


def top_locations(fact, as_of=None, filters=None):
    keys = ["geo_country", "geo_region_name"]
    return top_k(_events_and_users(dashboard_filters(fact, filters), keys), "events", 20, keys)


def geo_hierarchy(fact, as_of=None, filters=None):
    """Events per country and region with the country's own total, for a nested chart."""
    regions = count_by(dashboard_filters(fact, filters), "geo_country", "geo_region_name")
    nested = regions.rollup("geo_country", "geo_region_name").agg(
        F.grouping_id().alias("level"), F.sum("events").alias("events")
    )
    depth = F.when(F.col("level") == 0, "region").when(F.col("level") == 1, "country").otherwise("all")
    return nested.withColumn("level", depth)


def events_map(fact, dim_geo, as_of=None, filters=None):
    """Events per known country with the coordinates of its first region that has any."""
    countries = filter_nonempty(count_by(dashboard_filters(fact, filters), "geo_country"), "geo_country")
    point = F.struct(
        F.col("geo_latitude").try_cast("double").alias("latitude"),
        F.col("geo_longitude").try_cast("double").alias("longitude"),
    )
    points = dim_geo.select("geo_country", "geo_id", point.alias("p"))
    located = points.filter("p.latitude is not null and p.longitude is not null")
    chosen = located.groupBy("geo_country").agg(F.min(F.struct("geo_id", "p")).alias("first"))
    placed = countries.join(chosen, "geo_country", "left")
    return placed.select("geo_country", "events", "first.p.latitude", "first.p.longitude")


def country_device(fact, as_of=None, filters=None):
    return count_by(dashboard_filters(fact, filters), "geo_country", "device_type")


def geo_performance(fact, as_of=None, filters=None, min_events: int = 50):
    counted = dashboard_filters(fact, filters).groupBy("geo_country").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct(USER).alias("users"),
        F.count_if(F.col("event_type") == "conversion").alias("conversions"),
    )
    rated = having(counted, F.col("events") > min_events).select(
        "geo_country",
        "events",
        "users",
        ratio(F.col("events"), F.col("users")).alias("events_per_user"),
        "conversions",
        percent(F.col("conversions"), F.col("events")).alias("conversion_rate"),
    )
    return top_k(rated, "events", 15, ["geo_country"])


# Behavior


def top_pages(fact, as_of=None, filters=None):
    return top_k(count_by(dashboard_filters(fact, filters), "page_url_path"), "events", 15, ["page_url_path"])


def referrer_flow(fact, as_of=None, filters=None):
    return count_by(dashboard_filters(fact, filters), "referer_medium", "utm_source")


def user_journey(fact, as_of=None, filters=None, min_value: int = 10):
    edges = count_by(
        dashboard_filters(fact, filters),
        F.col("utm_source").alias("source"),
        F.col("page_url_path").alias("target"),
        name="value",
    )
    return top_k(having(edges, F.col("value") > min_value), "value", 50, ["source", "target"])


def referer_page_flow(fact, as_of=None, filters=None):
    return count_by(dashboard_filters(fact, filters), "referer_medium", "page_url_path")


def funnel_share(fact, as_of=None, filters=None, pages: Sequence[str] = FUNNEL_PAGES):
    """Events of the funnel pages and their share of all events. ``users`` is an event count."""
    rows = dashboard_filters(fact, filters)
    steps = count_by(filter_in_list(rows, "page_url_path", pages), F.col("page_url_path").alias("step"), name="users")
    everything = total_events(rows).scalar()
    return sort_multi(steps.withColumn("percentage", percent(F.col("users"), everything)), {"users": "desc"})


def funnel_ordered(fact, as_of=None, filters=None, pages: Sequence[str] = FUNNEL_PAGES):
    """Users who reached each page after the one before it.

    A user's minute is summed up as an array: the step reached by its end for each step reached before it. Minutes in
    order of time then give the step a user reaches. So the fact is scanned once, distinct visits are shuffled by user and
    minute, summaries by user, and the length of either list is bounded by the clock, not by the visits of a user.
    """
    rows = filter_nonempty(dashboard_filters(fact, filters), USER)
    at_step = [
        F.when((F.col("page_url_path") == page) & (F.col("event_timestamp").isNotNull() | F.lit(number == 1)), number)
        for number, page in enumerate(pages, start=1)
    ]
    visits = filter_in_list(rows, "page_url_path", pages).select(
        USER, "event_timestamp", F.explode(F.array_compact(F.array(*at_step))).alias("step")
    )
    # Visits without a time come last and count for the first step only. Of visits at one time the higher step comes
    # first, so that none follows on another.
    minute = F.date_trunc("minute", "event_timestamp").alias("minute")
    visit = F.struct(F.col("event_timestamp").isNull().alias("timeless"), "event_timestamp", (-F.col("step")).alias("back"))
    minutes = visits.groupBy(USER, minute).agg(F.array_sort(F.collect_set(visit)).alias("visits"))
    start = F.sequence(F.lit(0), F.lit(len(pages)))
    after = F.aggregate(
        "visits", start, lambda reached, v: F.transform(reached, lambda s: F.when(s + 1 == -v["back"], s + 1).otherwise(s))
    )
    summary = F.struct(F.col("minute").isNull().alias("timeless"), "minute", after.alias("after"))
    users = minutes.select(USER, summary.alias("summary")).groupBy(USER)
    ordered = users.agg(F.array_sort(F.collect_list("summary")).alias("summaries"))
    furthest = F.aggregate("summaries", F.lit(0), lambda step, m: F.element_at(m["after"], step + 1)).alias("furthest")
    reached = [F.count_if(F.col("furthest") >= n).alias(f"_{n}") for n in range(1, len(pages) + 1)]
    steps = [
        F.struct(F.lit(n).alias("step"), F.lit(page).alias("page"), F.col(f"_{n}").alias("users"))
        for n, page in enumerate(pages, start=1)
    ]
    return ordered.select(furthest).agg(*reached).select(F.inline(F.array(*steps)))


def retention_cohort(fact, as_of=None, filters=None):
    """Per day of first event: users seen again after each number of days.

    A user's days are collected as a set, which the calendar bounds however many events the user has.
    """
    rows = filter_nonempty(dashboard_filters(fact, filters), USER).withColumn("day", event_day())
    per_user = rows.groupBy(USER).agg(F.min("day").alias("cohort"), F.collect_set("day").alias("days"))
    seen = per_user.select("cohort", F.explode("days").alias("day"))
    offset = F.date_diff("day", "cohort").alias("day_offset")
    return count_by(seen, "cohort", offset, name="users")


def daily_cohort(fact, as_of=None, filters=None):
    """Events and users per day and device type since midnight seven days before the clock's day."""
    cutoff = F.date_sub(F.to_date(moment(as_of)), 7).cast("timestamp_ntz")
    rows = since(dashboard_filters(fact, filters), cutoff).withColumn("date", event_day())
    counted = _events_and_users(rows, ["date", "device_type"], "events", "unique_users")
    per_user = ratio(F.col("events"), F.col("unique_users"))
    return sort_multi(counted.withColumn("events_per_user", per_user), {"date": "desc", "device_type": "asc"})


# Live monitoring


def _event_count(rows: DataFrame, name: str = "events"):
    """The number of events: of a fact's rows, or of the events a state's rows stand for."""
    counted = F.sum("total_events") if "total_events" in rows.columns else F.count(F.lit(1))
    return counted.alias(name)


def activity_24h(hourly, as_of=None, filters=None):
    """Events per hour of the last 24 hours and their total, from the hourly state."""
    recent = _recent_hours(dashboard_filters(hourly, filters), as_of, 24)
    per_hour = recent.groupBy("event_hour").agg(_event_count(recent))
    with_total = per_hour.rollup("event_hour").agg(F.sum("events").alias("events"))
    return with_total.filter(F.col("events").isNotNull())


def activity_heatmap(hourly, as_of=None, filters=None):
    """Events per hour of day and type, from the hourly state."""
    rows = _with_hour(dashboard_filters(hourly, filters))
    return rows.groupBy(F.hour("event_hour").alias("hour"), "event_type").agg(_event_count(rows))


def active_users_48h(fact, as_of=None, filters=None):
    """Per hour of the last 48: the dataset's user counts summed, and the true distinct users beside it.

    Over the hourly state both are estimates from merged partials.
    """
    recent = _recent_hours(dashboard_filters(fact, filters), as_of, 48)
    if "total_events" in recent.columns:
        groups = rollups.collapse(recent.select(*HOURLY_KEYS, "total_events", "unique_users"), HOURLY_KEYS)
        return groups.groupBy("event_hour").agg(
            F.sum(F.hll_sketch_estimate("unique_users")).alias("summed_users"),
            merged_estimate("unique_users").alias("distinct_users"),
        )
    # One pass: distinct users of each dataset group, then their sum and the distinct users of the hour.
    pairs = recent.select("event_hour", "event_type", "geo_country", "utm_source", USER).distinct()
    return pairs.groupBy("event_hour").agg(
        F.count(F.lit(1)).alias("summed_users"), F.count_distinct(USER).alias("distinct_users")
    )
