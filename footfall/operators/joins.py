"""The enrichment joins, the incremental anti-join and the orphan checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.values import fill_blanks
from footfall.operators.dedup import latest_per_key
from footfall.operators.sieve import thinned
from footfall.operators.skew import HotKeys, join
from footfall.schemas import DEVICE, GEO, LOCATION, Feed


def _enrich(events: DataFrame, side: DataFrame, feed: Feed, dedup: bool, hot: HotKeys | None) -> DataFrame:
    """Left join on the feed's key; events without a match get blanks, as do NULL fields of a match."""
    wanted = [*feed.columns, "inserted_at"] if dedup else feed.columns
    rows = side.select(*wanted)
    if dedup:
        rows = latest_per_key(rows, feed.key).drop("inserted_at")
    joined = join(events, rows, feed.key, "left", hot)
    return fill_blanks(joined, [c for c in feed.columns if c != feed.key])


def join_device(events: DataFrame, device: DataFrame, *, dedup: bool = True, hot: HotKeys | None = None):
    """Add device columns by click_id. ``dedup=False`` keeps every match of a repeated key."""
    return _enrich(events, device, DEVICE, dedup, hot)


def join_geo(events: DataFrame, geo: DataFrame, *, dedup: bool = True, hot: HotKeys | None = None):
    """Add geography columns by click_id."""
    return _enrich(events, geo, GEO, dedup, hot)


def join_location(events: DataFrame, location: DataFrame, *, dedup: bool = True, hot: HotKeys | None = None):
    """Add page and campaign columns by event_id."""
    return _enrich(events, location, LOCATION, dedup, hot)


def new_events_only(
    events: DataFrame, fact: DataFrame, hot: HotKeys | None = None, ids: DataFrame | None = None
) -> DataFrame:
    """Events whose id is not in the fact yet.

    One column of the fact is scanned and thinned out by a bitmap of the events' ids, so that of the fact hardly more is
    shuffled than the ids that come again. ``ids`` holds the events' ids and perhaps others, where it is cheaper to read
    than ``events``.
    """
    loaded = thinned(fact.select("event_id"), events if ids is None else ids, "event_id")
    return join(events, loaded.distinct(), "event_id", "left_anti", hot)


def orphans_browser(browser: DataFrame, fact: DataFrame) -> DataFrame:
    """Browser staging rows whose event never reached the fact."""
    return join(browser, fact.select("event_id").distinct(), "event_id", "left_anti")


def orphans_device(device: DataFrame, fact: DataFrame) -> DataFrame:
    """Device staging rows whose click occurs in no event."""
    return join(device, fact.select("click_id").distinct(), "click_id", "left_anti")


def orphan_count(rows: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """How many ``rows`` have a key the fact lacks; a row without a key has none there.

    Both sides are counted per key in one aggregation, so there is one shuffle, no join, and no key is heavy.
    """
    per_key = tallies([(rows, key, "staged", key), (fact, key, "loaded", key)], ("staged", "loaded"))
    return per_key.agg(F.coalesce(F.sum(unmatched()), F.lit(0)).alias("count"))


def tallies(parts: Sequence[tuple[DataFrame, str, str, str]], sides: Sequence[str]) -> DataFrame:
    """``kind``, ``id`` and how often each of ``sides`` holds it, in one aggregation over all ``parts``.

    A part is a frame, the column that holds its ids, the side it counts for, and the kind of its ids. Parts of the same
    frame and side are read in one scan.
    """
    frames: dict[tuple[int, str], tuple[DataFrame, str, list[Column]]] = {}
    for df, ids, side, kind in parts:
        entry = frames.setdefault((id(df), side), (df, side, []))
        entry[2].append(F.struct(F.lit(kind).alias("kind"), F.col(ids).cast("string").alias("id")))
    rows = None
    for df, side, keys in frames.values():
        one = df.select(F.inline(F.array(*keys))) if len(keys) > 1 else df.select(keys[0].alias("k")).select("k.*")
        one = one.select("kind", "id", *[F.lit(int(s == side)).cast("long").alias(s) for s in sides])
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("kind", "id").agg(*[F.sum(s).alias(s) for s in sides])


def unmatched() -> Column:
    """Staged rows of one tally whose id the fact lacks."""
    return F.when((F.col("loaded") == 0) | F.col("id").isNull(), F.col("staged")).otherwise(F.lit(0))
