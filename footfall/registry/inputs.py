"""Stored inputs for the registered queries: staging, warehouse and topics, derived once per test folder.

They are written by the same jobs a user runs, into the shared folder, and reused within one application as
long as the test tables do not change. A query's own output is never reused.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.plans.fact import fact_events
from footfall.plans.warehouse import LAYOUTS, Warehouse
from footfall.schemas import FEEDS, Feed
from footfall.sources import fixtures
from footfall.sources.messages import publish_lines
from footfall.workspace import fresh_folder, side_by_side

_MADE: dict[tuple, object] = {}


def _signature(spark: SparkSession, sf_dir: str) -> tuple:
    parts = []
    for table in ("events", "nation"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        summary = fs.getContentSummary(path)
        parts.append((summary.getLength(), summary.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return (spark.sparkContext.applicationId, sf_dir, *parts)


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    key = (name, *_signature(spark, sf_dir))
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def new_warehouse(spark: SparkSession, purpose: str) -> Warehouse:
    return Warehouse(spark, fresh_folder(spark, purpose))


def stage_feeds(wh: Warehouse, sf_dir: str, batch_id: str = "first", **replaced: DataFrame) -> Warehouse:
    """Stage the four clean feeds, or the frames given by feed name in their place."""

    def stage(feed: Feed) -> None:
        rows = replaced.get(feed.name)
        wh.stage(feed, fixtures.FEED_BUILDERS[feed.name](wh.spark, sf_dir) if rows is None else rows, batch_id)

    side_by_side(stage, FEEDS.values())
    return wh


def staging(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with the four clean feeds staged."""
    return _once(spark, sf_dir, "staging", lambda: stage_feeds(new_warehouse(spark, "staging"), sf_dir))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with fact, states and dimensions of the clean feeds."""

    def make() -> Warehouse:
        wh = stage_feeds(new_warehouse(spark, "warehouse"), sf_dir)
        wh.load("first", as_of=fixtures.CLOCK)
        wh.rebuild_dims()
        return wh

    return _once(spark, sf_dir, "warehouse", make)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).read("fact_events")


def dirty_fact(spark: SparkSession, sf_dir: str, name: str, browser: Callable[[SparkSession, str], DataFrame]):
    """A stored fact over a dirty browser feed, every delivery kept."""

    def make() -> str:
        wh = staging(spark, sf_dir)
        sides = [wh.read(feed.table) for feed in list(FEEDS.values())[1:]]
        path = fresh_folder(spark, name)
        fact_events(browser(spark, sf_dir), *sides, dedup=False, as_of=fixtures.CLOCK).write.parquet(path)
        return path

    path = _once(spark, sf_dir, name, make)
    return spark.read.schema(LAYOUTS["fact_events"].schema).parquet(path).drop("event_month", "load_id")


def topic(spark: SparkSession, sf_dir: str, name: str) -> str:
    """One clean feed published as a folder of JSON lines; no other feed is built for it."""

    def make() -> str:
        path = f"{fresh_folder(spark, 'topics')}/{FEEDS[name].topic}"
        publish_lines(fixtures.FEED_BUILDERS[name](spark, sf_dir), FEEDS[name], path)
        return path

    return _once(spark, sf_dir, f"topic {name}", make)


def topics(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The four clean feeds published as folders of JSON lines."""
    return dict(zip(FEEDS, side_by_side(lambda name: topic(spark, sf_dir, name), FEEDS)))


def bad_topic(spark: SparkSession, sf_dir: str, name: str) -> str:
    """One feed as JSON lines with odd lines among them."""

    def make() -> str:
        path = f"{fresh_folder(spark, 'bad-topics')}/{FEEDS[name].topic}"
        fixtures.bad_json(spark, sf_dir, FEEDS[name]).write.text(path)
        return path

    return _once(spark, sf_dir, f"bad topic {name}", make)


def bad_topics(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The four feeds as JSON lines with odd lines among them."""
    return dict(zip(FEEDS, side_by_side(lambda name: bad_topic(spark, sf_dir, name), FEEDS)))
