"""Feed, fact and state layouts. Column names, types and orders here are fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(**columns: str) -> T.StructType:
    types = {
        "string": T.StringType(),
        "boolean": T.BooleanType(),
        "timestamp": T.TimestampNTZType(),
        "date": T.DateType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "binary": T.BinaryType(),
    }
    return T.StructType([T.StructField(name, types[kind]) for name, kind in columns.items()])


@dataclass(frozen=True)
class Feed:
    """One event feed: where it comes from, what identifies a record, and how it is stored."""

    name: str
    topic: str
    table: str
    key: str
    schema: T.StructType
    partitions: tuple[str, ...]
    sort: tuple[str, ...]
    ttl_column: str

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored_schema(self) -> T.StructType:
        extra = _struct(inserted_at="timestamp", inserted_on="date", batch_id="string", event_month="int")
        kept = ["inserted_at", *self.partitions]
        return T.StructType(self.schema.fields + [extra[name] for name in kept])


BROWSER = Feed(
    name="browser",
    topic="browser_events",
    table="events_browser_raw",
    key="event_id",
    schema=_struct(
        event_id="string",
        event_timestamp="timestamp",
        event_type="string",
        click_id="string",
        browser_name="string",
        browser_user_agent="string",
        browser_language="string",
    ),
    partitions=("event_month", "inserted_on", "batch_id"),
    sort=("event_timestamp", "event_id"),
    ttl_column="event_timestamp",
)

DEVICE = Feed(
    name="device",
    topic="device_events",
    table="events_device_raw",
    key="click_id",
    schema=_struct(
        click_id="string",
        os="string",
        os_name="string",
        os_timezone="string",
        device_type="string",
        device_is_mobile="boolean",
        user_custom_id="string",
        user_domain_id="string",
    ),
    partitions=("inserted_on", "batch_id"),
    sort=("click_id", "user_domain_id"),
    ttl_column="inserted_at",
)

GEO = Feed(
    name="geo",
    topic="geo_events",
    table="events_geo_raw",
    key="click_id",
    schema=_struct(
        click_id="string",
        geo_latitude="string",
        geo_longitude="string",
        geo_country="string",
        geo_timezone="string",
        geo_region_name="string",
        ip_address="string",
    ),
    partitions=("inserted_on", "batch_id"),
    sort=("click_id", "geo_country"),
    ttl_column="inserted_at",
)

LOCATION = Feed(
    name="location",
    topic="location_events",
    table="events_location_raw",
    key="event_id",
    schema=_struct(
        event_id="string",
        page_url="string",
        page_url_path="string",
        referer_url="string",
        referer_medium="string",
        utm_medium="string",
        utm_source="string",
        utm_content="string",
        utm_campaign="string",
    ),
    partitions=("inserted_on", "batch_id"),
    sort=("event_id", "utm_source"),
    ttl_column="inserted_at",
)

FEEDS: dict[str, Feed] = {feed.name: feed for feed in (BROWSER, DEVICE, GEO, LOCATION)}

DEVICE_COLUMNS = [c for c in DEVICE.columns if c != "click_id"]
GEO_COLUMNS = [c for c in GEO.columns if c != "click_id"]
LOCATION_COLUMNS = [c for c in LOCATION.columns if c != "event_id"]

# The 28 data columns of the wide fact, in order.
FACT_COLUMNS = BROWSER.columns + DEVICE_COLUMNS + GEO_COLUMNS + LOCATION_COLUMNS
FACT_PARTITIONS = ("event_month", "load_id")
FACT_SORT = ("event_timestamp", "event_id", "user_domain_id")

_BY_NAME = {f.name: f for feed in FEEDS.values() for f in feed.schema.fields}

FACT_SCHEMA = T.StructType(
    [_BY_NAME[name] for name in FACT_COLUMNS]
    + _struct(created_at="timestamp", event_month="int", load_id="string").fields
)

DIM_USERS_SCHEMA = _struct(
    user_domain_id="string",
    user_custom_id="string",
    first_seen="timestamp",
    last_seen="timestamp",
    total_events="long",
    device_type="string",
    os_name="string",
)

DIM_GEO_SCHEMA = _struct(
    geo_id="string",
    geo_country="string",
    geo_region_name="string",
    geo_latitude="string",
    geo_longitude="string",
    geo_timezone="string",
)

HOURLY_KEYS = [
    "event_hour",
    "event_type",
    "browser_name",
    "device_type",
    "geo_country",
    "utm_source",
    "utm_campaign",
]
TRAFFIC_KEYS = ["date", "utm_source", "utm_medium", "utm_campaign", "utm_content", "referer_medium"]

HOURLY_STATE_SCHEMA = _struct(
    event_hour="timestamp",
    **{name: "string" for name in HOURLY_KEYS[1:]},
    total_events="long",
    unique_users="binary",
    unique_clicks="binary",
    event_month="int",
    load_id="string",
)
TRAFFIC_STATE_SCHEMA = _struct(
    date="date",
    **{name: "string" for name in TRAFFIC_KEYS[1:]},
    total_events="long",
    unique_users="binary",
    unique_sessions="binary",
    event_month="int",
    load_id="string",
)

# Keys of the dimensions, and the attributes each takes from its earliest event.
USER_KEYS = ["user_domain_id"]
USER_ATTRIBUTES = ["user_custom_id", "device_type", "os_name"]
GEO_KEYS = ["geo_country", "geo_region_name"]
GEO_ATTRIBUTES = ["geo_latitude", "geo_longitude", "geo_timezone"]


def _dim_state(keys: list[str], attributes: list[str]) -> T.StructType:
    earliest = _struct(event_timestamp="timestamp", event_id="string", **{c: "string" for c in attributes})
    times = _struct(first_seen="timestamp", last_seen="timestamp", total_events="long")
    return T.StructType(
        _struct(**{c: "string" for c in keys}).fields
        + [T.StructField("first", earliest)]
        + times.fields
        + _struct(event_month="int", load_id="string").fields
    )


DIM_USERS_STATE_SCHEMA = _dim_state(USER_KEYS, USER_ATTRIBUTES)
DIM_GEO_STATE_SCHEMA = _dim_state(GEO_KEYS, GEO_ATTRIBUTES)

# One row per load whose fact rows and both states are stored in full, with the browser batches it covers.
LOAD_LOG_SCHEMA = _struct(load_id="string", rows="long", committed_at="timestamp").add(
    "batches", T.ArrayType(T.StringType())
).add("folders", T.ArrayType(T.StringType()))

# One row per micro-batch of a topic: what it consumed and what became of it. Old ones are summed by run.
INGEST_LOG_SCHEMA = _struct(
    run_id="string", consumed="long", inserted="long", failed="long", skipped="long", stored_at="timestamp",
    topic="string", batch_id="string",
)
INGEST_LOG_PARTITIONS = ("topic", "batch_id")

# Days kept: staging and warehouse time-to-live, and the shorter staging clear-out after a build.
STAGING_TTL_DAYS = 90
WAREHOUSE_TTL_DAYS = 365
STAGING_CLEAR_DAYS = 7
