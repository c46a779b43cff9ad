"""Hand-written feed rows for tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from footfall.schemas import BROWSER, DEVICE, GEO, LOCATION
from footfall.sources.tables import conform


def moment(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(spark, feed, records: list[dict], inserted_at: str = "2024-01-01 00:00:00"):
    """A feed frame from dicts; absent columns blank, ``inserted_at`` as given or by record."""
    schema = feed.schema.simpleString()[len("struct<") : -1] + ",inserted_at:timestamp_ntz"
    names = [*feed.columns, "inserted_at"]
    filled = [{"inserted_at": inserted_at, **r} for r in records]
    for record in filled:
        for name in ("inserted_at", "event_timestamp"):
            if isinstance(record.get(name), str):
                record[name] = moment(record[name])
    frame = spark.createDataFrame([tuple(r.get(n) for n in names) for r in filled], schema)
    return frame


def staged(spark, feed, records, **kw):
    """Rows as staging holds them: blanks instead of NULL."""
    frame = rows(spark, feed, records, **kw)
    return conform(frame, frame.schema)


def event(event_id, ts="2024-01-01 10:00:00", click="c1", kind="view", **more):
    return {"event_id": event_id, "event_timestamp": ts, "click_id": click, "event_type": kind, **more}


def feeds(spark, browser=(), device=(), geo=(), location=()):
    return (
        staged(spark, BROWSER, list(browser)),
        staged(spark, DEVICE, list(device)),
        staged(spark, GEO, list(geo)),
        staged(spark, LOCATION, list(location)),
    )


def as_set(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def total(df, column="total_events"):
    return df.agg(F.sum(column)).first()[0]
