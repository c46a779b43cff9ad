"""The four feeds and their dirty overlays, derived from the test tables ``events`` and ``nation``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.schemas import Feed
from footfall.sources.messages import keyed_messages

# Fixed value: the moment reports over the fixtures take as now.
CLOCK = "2024-01-31 00:00:00"
SECOND_BATCH_FROM = "2024-01-16 00:00:00"
REPLAYED_DAY = "2024-01-15"

_PAGE = (
    "case k % 6 when 0 then '/home' when 1 then '/product_a' when 2 then '/product_b' "
    "when 3 then '/cart' when 4 then '/checkout' else '/confirmation' end"
)


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "cast(event_id as string) as event_id",
        "event_id as n",
        "ts",
        "user_id",
        "event_type",
        "concat('c', cast(user_id as string), '-', cast(cast(ts as date) as string)) as click_id",
        "user_id * 31 + day(ts) as ch",
        "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k",
    )


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ev(spark, sf_dir).groupBy("click_id", "user_id", "ch").agg(F.min("ts").alias("first_ts"))


def _browser_with_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ev(spark, sf_dir).selectExpr(
        "event_id",
        "ts as event_timestamp",
        "case when event_type = 'purchase' then 'conversion' else event_type end as event_type",
        "click_id",
        "case user_id % 5 when 0 then 'Chrome' when 1 then 'Safari' when 2 then 'Firefox' "
        "when 3 then 'Edge' else 'Opera' end as browser_name",
        "concat('Mozilla/5.0 ua', cast(user_id % 7 as string)) as browser_user_agent",
        "case user_id % 3 when 0 then 'en' when 1 then 'de' else 'ru' end as browser_language",
        "ts as inserted_at",
        "n",
    )


def browser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _browser_with_n(spark, sf_dir).drop("n")


def _device_with_ch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clicks(spark, sf_dir).filter("ch % 10 <> 0").selectExpr(
        "click_id",
        "case when user_id % 4 < 2 then 'mobile-os' else 'desktop-os' end as os",
        "case user_id % 4 when 0 then 'Android' when 1 then 'iOS' when 2 then 'Windows' else 'Linux' end as os_name",
        "case when user_id % 2 = 0 then 'Europe/Berlin' else 'America/New_York' end as os_timezone",
        "case user_id % 3 when 0 then 'Mobile' when 1 then 'Desktop' else 'Tablet' end as device_type",
        "(user_id % 3 = 0) <> (user_id % 29 = 0) as device_is_mobile",
        "concat('cust', cast(user_id as string)) as user_custom_id",
        "concat('u', cast(user_id as string)) as user_domain_id",
        "first_ts as inserted_at",
        "ch",
        "user_id",
    )


def device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _device_with_ch(spark, sf_dir).drop("ch", "user_id")


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    clicks = _clicks(spark, sf_dir).filter("ch % 20 <> 1")
    return clicks.join(nation, F.expr("n_nationkey = user_id % 25")).selectExpr(
        "click_id",
        "cast(user_id % 90 as string) as geo_latitude",
        "cast(user_id % 180 as string) as geo_longitude",
        "n_name as geo_country",
        "concat('TZ', cast(user_id % 25 as string)) as geo_timezone",
        "concat(n_name, '-R', cast(user_id % 4 as string)) as geo_region_name",
        "concat('10.0.', cast(user_id % 256 as string), '.1') as ip_address",
        "first_ts as inserted_at",
    )


def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ev(spark, sf_dir).filter("n % 17 <> 0").selectExpr(
        "event_id",
        f"concat('https://shop.example', {_PAGE}) as page_url",
        f"{_PAGE} as page_url_path",
        "concat('https://ref', cast(k % 4 as string), '.example') as referer_url",
        "case k % 4 when 0 then 'search' when 1 then 'social' when 2 then 'internal' else 'unknown' end "
        "as referer_medium",
        "case k % 3 when 0 then 'cpc' when 1 then 'social' else 'email' end as utm_medium",
        "case k % 5 when 0 then 'google' when 1 then 'facebook' when 2 then '' when 3 then 'newsletter' "
        "else 'tiktok' end as utm_source",
        "concat('content_', cast(k % 8 as string)) as utm_content",
        "concat('camp_', cast(k % 4 as string)) as utm_campaign",
        "ts as inserted_at",
    )


FEED_BUILDERS = {"browser": browser, "device": device, "geo": geo, "location": location}


# Overlays, each with one defect


def browser_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some events delivered twice."""
    rows = _browser_with_n(spark, sf_dir)
    return rows.unionByName(rows.filter("n % 500 = 0")).drop("n")


def device_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some clicks with a second, later device row."""
    rows = _device_with_ch(spark, sf_dir)
    later = rows.filter("user_id % 40 = 0").withColumns(
        {"os_name": F.lit("Other"), "inserted_at": F.expr("inserted_at + interval 1 hour")}
    )
    return rows.unionByName(later).drop("ch", "user_id")


def device_orphan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device rows of clicks that no event has."""
    users = _ev(spark, sf_dir).filter("user_id % 50 = 0").groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    orphans = users.selectExpr(
        "concat('orphan-', cast(user_id as string)) as click_id",
        "'desktop-os' as os",
        "'Windows' as os_name",
        "'Europe/Berlin' as os_timezone",
        "'Desktop' as device_type",
        "false as device_is_mobile",
        "'' as user_custom_id",
        "concat('u', cast(user_id as string)) as user_domain_id",
        "first_ts as inserted_at",
    )
    return device(spark, sf_dir).unionByName(orphans)


def late_device(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The device feed without some clicks, and those clicks' rows, which arrive later."""
    rows = _device_with_ch(spark, sf_dir)
    late = F.col("ch") % 10 == 5
    return rows.filter(~late).drop("ch", "user_id"), rows.filter(late).drop("ch", "user_id")


def two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The browser feed in two deliveries, the second repeating a day of the first."""
    rows = browser(spark, sf_dir)
    start = F.lit(SECOND_BATCH_FROM).cast("timestamp_ntz")
    replayed = F.to_date("event_timestamp") == F.lit(REPLAYED_DAY).cast("date")
    return rows.filter(F.col("event_timestamp") < start), rows.filter((F.col("event_timestamp") >= start) | replayed)


def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The browser feed with some ids NULL or blank and one timestamp NULL."""
    blanked = F.when(F.col("n") % 97 == 0, F.lit(None)).when(F.col("n") % 89 == 0, "").otherwise(F.col("event_id"))
    stamp = F.when(F.col("n") == 5, F.lit(None)).otherwise(F.col("event_timestamp"))
    rows = _browser_with_n(spark, sf_dir)
    return rows.withColumns({"event_id": blanked, "event_timestamp": stamp}).drop("n")


def odd_lines(feed: Feed) -> list[str]:
    """Lines a parser must cope with: cut short, blank, a record lacking a field, a record with a further one."""
    record = {f.name: _odd_value(f) for f in feed.schema.fields}
    lacking = {**record, feed.key: "lacking-1"}
    del lacking[feed.columns[-1]]
    further = {**record, feed.key: "further-1", "surprise": 1}
    cut = json.dumps(record)[:25]
    return [cut, "", json.dumps(lacking), json.dumps(further)]


def _odd_value(field: T.StructField):
    if isinstance(field.dataType, T.BooleanType):
        return True
    if isinstance(field.dataType, T.TimestampNTZType):
        return "2024-01-02T03:04:05"
    return "odd"


def bad_json(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    """The feed as JSON lines, with the odd lines among them."""
    clean = keyed_messages(FEED_BUILDERS[feed.name](spark, sf_dir), feed).select("value")
    return clean.unionByName(spark.createDataFrame([(line,) for line in odd_lines(feed)], "value string"))
