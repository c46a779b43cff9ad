"""The wide fact: one row per event with its device, geography and page, blanks where a side is missing."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.clock import moment
from footfall.functions.values import fill_blanks, is_blank
from footfall.operators import skew
from footfall.operators.dedup import latest_per_key
from footfall.operators.joins import join_device, join_geo, join_location, new_events_only
from footfall.operators.sieve import thinned
from footfall.schemas import (
    BROWSER,
    DEVICE,
    DEVICE_COLUMNS,
    FACT_COLUMNS,
    GEO,
    GEO_COLUMNS,
    LOCATION,
    LOCATION_COLUMNS,
    Feed,
)

#: The feeds that enrich an event, and the fact columns of each.
SIDES: tuple[tuple[Feed, list[str]], ...] = (
    (DEVICE, DEVICE_COLUMNS),
    (GEO, GEO_COLUMNS),
    (LOCATION, LOCATION_COLUMNS),
)


def project_fact(joined: DataFrame, as_of=None) -> DataFrame:
    """The 28 data columns in order, and the build time."""
    created = F.date_trunc("second", moment(as_of)).cast("timestamp_ntz")
    return joined.select(*FACT_COLUMNS, created.alias("created_at"))


def fact_events(
    browser: DataFrame,
    device: DataFrame,
    geo: DataFrame,
    location: DataFrame,
    fact: DataFrame | None = None,
    *,
    dedup: bool = True,
    as_of=None,
) -> DataFrame:
    """Fact rows of the browser events that ``fact`` does not hold yet.

    With ``dedup`` repeated deliveries count once and the latest row per join key enriches an event; without
    it every match is kept, so repeated rows multiply. Both event_id steps come first and share one shuffle,
    then both click_id joins share another.
    """
    hot_clicks = skew.hot_keys(browser, "click_id")
    events = _with_pages(browser, location, fact, dedup)
    events = skew.spread(events, "click_id", hot_clicks)
    events = join_device(events, device, dedup=dedup, hot=hot_clicks)
    events = join_geo(events, geo, dedup=dedup, hot=hot_clicks)
    return project_fact(skew.gather(events), as_of)


def _with_pages(browser: DataFrame, location: DataFrame, fact: DataFrame | None, dedup: bool) -> DataFrame:
    if not dedup:
        events = fill_blanks(browser.select(*BROWSER.columns))
        hot_ids = skew.hot_keys(events, "event_id")
        if fact is not None:
            events = new_events_only(events, fact.filter(F.col("event_id") != ""), hot_ids, browser)
        return join_location(events, location, dedup=False, hot=hot_ids)

    rows = browser.select(*BROWSER.columns, "inserted_at")
    named = latest_per_key(rows.filter(F.col("event_id") != ""), "event_id").drop("inserted_at")
    # The id itself has no blanks to fill, and as it is the aggregate's partitioning serves the next joins.
    named = fill_blanks(named, BROWSER.columns[1:])
    if fact is not None:
        named = new_events_only(named, fact.filter(F.col("event_id") != ""), skew.HotKeys(), browser)
    named = join_location(named, location, hot=skew.HotKeys())

    # Events without an id cannot be told apart: all are kept, of every load, and they meet at most one page row. A
    # batch is read by one finished load only, so none of them comes twice.
    nameless = fill_blanks(rows.filter(is_blank(rows, "event_id")).drop("inserted_at"))
    page = latest_per_key(location.filter(F.col("event_id") == ""), "event_id").select(*LOCATION.columns)
    nameless = fill_blanks(nameless.join(F.broadcast(page), "event_id", "left"), LOCATION_COLUMNS)
    return named.unionByName(nameless)


def _side_is_blank(columns: list[str]) -> Column:
    blank = [~F.col(c) if c == "device_is_mobile" else F.col(c) == "" for c in columns]
    return reduce(and_, blank)


def late_rows(fact: DataFrame, side: DataFrame, feed: Feed, columns: list[str]) -> DataFrame:
    """The latest row of ``side`` for every key of a fact row without any of its ``columns``, and for a few other keys.

    The feed is thinned out by a bitmap of the keys asked for, so that of a feed of any size hardly more is shuffled than
    what fact rows lack.
    """
    asking = fact.filter(_side_is_blank(columns))
    rows = thinned(side.select(*feed.columns, "inserted_at"), asking, feed.key)
    return latest_per_key(fill_blanks(rows), feed.key)


def lacks_side() -> Column:
    """True for a fact row without any device, geography or page value."""
    return reduce(or_, [_side_is_blank(columns) for _, columns in SIDES])


def repair_fact(fact: DataFrame, device: DataFrame, geo: DataFrame, location: DataFrame) -> DataFrame:
    """Fact rows with their blank sides filled from rows that arrived later, and whether that ``changed`` them."""
    sides = [(side, feed, columns, f"_{feed.name}") for side, (feed, columns) in zip((device, geo, location), SIDES)]
    hot = skew.hot_keys_of(fact, ("click_id", "event_id"))
    rows = fact
    for side, feed, columns, found in sides:
        latest = latest_per_key(fill_blanks(side.select(*feed.columns, "inserted_at")), feed.key)
        arrived = latest.select(feed.key, F.struct(*columns).alias(found))
        rows = skew.join(rows, arrived, feed.key, "left", hot[feed.key])
        rows = rows.withColumn(found, F.when(_side_is_blank(columns), F.col(found)))
    filled = {c: F.coalesce(F.col(f"{found}.{c}"), F.col(c)) for _, _, columns, found in sides for c in columns}
    changed = reduce(or_, [F.col(found).isNotNull() for *_, found in sides])
    return rows.select(*[filled.get(c, F.col(c)).alias(c) for c in fact.columns], changed.alias("changed"))
