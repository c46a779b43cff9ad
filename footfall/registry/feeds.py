"""Registered queries: sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall.plans.warehouse import STAGING_TABLES, table_counts
from footfall.registry import inputs
from footfall.registry.book import Book
from footfall.registry.oracle import BROWSER_COLUMNS, DEVICE_COLUMNS, GEO_COLUMNS, LOCATION_COLUMNS
from footfall.schemas import BROWSER, DEVICE, FEEDS, HOURLY_STATE_SCHEMA, Feed
from footfall.sources import fixtures, messages, tables
from footfall.streaming.ingest import QUARANTINE, ingest_stream as drain, ingest_topics
from footfall.streaming.rollup import stream_hourly_rollup as rollup_stream
from footfall.workspace import fresh_folder

BOOK = Book()
query = BOOK.query

_TOPIC_COUNTS = """SELECT 'browser_events' as topic, (SELECT count(*) FROM events_browser_raw) as n UNION ALL
  SELECT 'device_events', (SELECT count(*) FROM events_device_raw) UNION ALL
  SELECT 'geo_events', (SELECT count(*) FROM events_geo_raw) UNION ALL
  SELECT 'location_events', (SELECT count(*) FROM events_location_raw)"""

# Each feed's odd lines: two records that load, one corrupt line, one blank line.
_ODD_RECORDS, _SKIPPED = 2, 2


@query(
    f"""SELECT {BROWSER_COLUMNS} FROM events_browser_raw UNION ALL
    SELECT 'lacking-1', TIMESTAMP '2024-01-02 03:04:05', 'odd', 'odd', 'odd', 'odd', '' UNION ALL
    SELECT 'further-1', TIMESTAMP '2024-01-02 03:04:05', 'odd', 'odd', 'odd', 'odd', 'odd'"""
)
def read_jsonl(spark, sf_dir):
    return messages.read_jsonl(spark, inputs.bad_topic(spark, sf_dir, "browser"), BROWSER)


@query(
    """SELECT topic, problem, cast(1 as bigint) as lines FROM (SELECT unnest(['browser_events', 'device_events',
    'geo_events', 'location_events']) as topic), (SELECT unnest(['blank', 'corrupt']) as problem)"""
)
def quarantine(spark, sf_dir):
    rejected = None
    for name, path in inputs.bad_topics(spark, sf_dir).items():
        part = messages.quarantined(
            messages.parse_lines(messages.read_lines(spark, path), FEEDS[name]), FEEDS[name]
        )
        rejected = part if rejected is None else rejected.unionByName(part)
    return rejected.groupBy("topic", "problem").agg(F.count(F.lit(1)).alias("lines"))


@query(
    """SELECT 'browser_events' as topic, event_id as key FROM events_browser_raw UNION ALL
    SELECT 'device_events', click_id FROM events_device_raw UNION ALL
    SELECT 'geo_events', click_id FROM events_geo_raw UNION ALL
    SELECT 'location_events', event_id FROM events_location_raw"""
)
def publish_keyed(spark, sf_dir):
    wh = inputs.staging(spark, sf_dir)
    keyed = None
    for feed in FEEDS.values():
        part = messages.keyed_messages(wh.read(feed.table), feed).select("topic", "key")
        keyed = part if keyed is None else keyed.unionByName(part)
    return keyed


def _drained(spark, sf_dir, feed: Feed):
    wh = inputs.new_warehouse(spark, f"ingest-{feed.name}")
    lines = messages.read_lines(spark, inputs.topic(spark, sf_dir, feed.name), stream=True)
    drain(lines, feed, wh, f"{wh.root}/_checkpoints", as_of=fixtures.CLOCK).awaitTermination()
    return wh.read(feed.table).select(*feed.columns)


@query(f"SELECT {BROWSER_COLUMNS} FROM events_browser_raw")
def ingest_browser(spark, sf_dir):
    return _drained(spark, sf_dir, FEEDS["browser"])


@query(f"SELECT click_id, {DEVICE_COLUMNS} FROM events_device_raw")
def ingest_device(spark, sf_dir):
    return _drained(spark, sf_dir, FEEDS["device"])


@query(f"SELECT click_id, {GEO_COLUMNS} FROM events_geo_raw")
def ingest_geo(spark, sf_dir):
    return _drained(spark, sf_dir, FEEDS["geo"])


@query(f"SELECT event_id, {LOCATION_COLUMNS} FROM events_location_raw")
def ingest_location(spark, sf_dir):
    return _drained(spark, sf_dir, FEEDS["location"])


def _drain_bad_topics(spark, sf_dir, purpose: str):
    wh = inputs.new_warehouse(spark, purpose)
    paths = inputs.bad_topics(spark, sf_dir)
    lines = {name: messages.read_lines(spark, path, stream=True) for name, path in paths.items()}
    ingest_topics(lines, wh, f"{wh.root}/_checkpoints", as_of=fixtures.CLOCK)
    return wh


@query(f"SELECT topic, n + {_ODD_RECORDS} as staged, cast({_SKIPPED} as bigint) as skipped FROM ({_TOPIC_COUNTS})")
def ingest_stream(spark, sf_dir):
    """Four topics with bad lines, drained together: rows staged and lines set aside."""
    wh = _drain_bad_topics(spark, sf_dir, "ingest")
    kept = None
    for feed in FEEDS.values():
        part = wh.read(feed.table).select(F.lit(feed.topic).alias("topic"), F.lit(True).alias("good"))
        kept = part if kept is None else kept.unionByName(part)
    aside = spark.read.parquet(wh.path(QUARANTINE)).select("topic", F.lit(False).alias("good"))
    both = kept.unionByName(aside).groupBy("topic")
    return both.agg(F.count_if("good").alias("staged"), F.count_if(~F.col("good")).alias("skipped"))


@query(f"SELECT click_id, {DEVICE_COLUMNS.replace('user_custom_id', repr('') + ' as user_custom_id')} FROM "
       f"events_device_raw WHERE device_is_mobile UNION ALL SELECT click_id, {DEVICE_COLUMNS} "
       "FROM events_device_raw WHERE NOT device_is_mobile")
def append_batch(spark, sf_dir):
    """Two inserts by column name: one lacking a column, one in another order with a further column."""
    device = inputs.staging(spark, sf_dir).read(DEVICE.table)
    path = fresh_folder(spark, "append")
    tables.append_batch(device.filter("device_is_mobile").drop("user_custom_id"), path, DEVICE.schema)
    shuffled = device.filter("not device_is_mobile").select(*reversed(DEVICE.columns), F.lit(1).alias("further"))
    tables.append_batch(shuffled, path, DEVICE.schema)
    return tables.read(spark, path, DEVICE.schema)


@query(f"SELECT click_id, {DEVICE_COLUMNS} FROM events_device_raw")
def backfill_from_files(spark, sf_dir):
    """A staging table that already holds rows, emptied and loaded from JSON lines."""
    wh = inputs.new_warehouse(spark, "backfill")
    records = messages.read_jsonl(spark, inputs.topic(spark, sf_dir, "device"), DEVICE)
    wh.stage(DEVICE, records, "earlier", fixtures.CLOCK)
    wh.backfill(DEVICE, records, fixtures.CLOCK)
    return wh.read(DEVICE.table).select(*DEVICE.columns)


@query(f"SELECT replace(topic, '_events', '') as feed, n as rows FROM ({_TOPIC_COUNTS})")
def backfill_from_topics(spark, sf_dir):
    wh = inputs.new_warehouse(spark, "backfill-all")
    for name, path in inputs.topics(spark, sf_dir).items():
        wh.backfill(FEEDS[name], messages.read_jsonl(spark, path, FEEDS[name]), fixtures.CLOCK)
    counts = table_counts({name: wh.read(feed.table) for name, feed in FEEDS.items()})
    return counts.withColumnRenamed("table_name", "feed")


@query(
    """SELECT event_id, TIMESTAMP '2024-01-31 00:00:00' as inserted_at, DATE '2024-01-31' as inserted_on
    FROM events_browser_raw"""
)
def stamp_insert_time(spark, sf_dir):
    records = inputs.staging(spark, sf_dir).read(BROWSER.table).select("event_id")
    return tables.stamp_insert_time(records, fixtures.CLOCK)


@query("SELECT least(10, count(*)) as messages, least(10, count(*)) as of_the_topic FROM events_browser_raw")
def peek_topic(spark, sf_dir):
    """Ten messages as they come; which ones is not defined, but all are messages of the topic."""
    lines = messages.read_lines(spark, inputs.topic(spark, sf_dir, "browser"))
    # Stored, since a limit may pick other lines when it runs again; the topic is scanned for just these, not sorted.
    path = fresh_folder(spark, "peeked")
    messages.peek(lines).write.parquet(path)
    peeked = spark.read.schema(lines.schema).parquet(path)
    found = lines.join(F.broadcast(peeked.distinct()), "value", "left_semi").distinct()
    known = found.withColumn("known", F.lit(True))
    peeked = peeked.join(known, "value", "left")
    return peeked.agg(F.count(F.lit(1)).alias("messages"), F.count_if("known").alias("of_the_topic"))


@query(
    f"""SELECT coalesce(topic, 'TOTAL') as topic, cast(sum(n + {_ODD_RECORDS}) as bigint) as total,
    cast(sum(n + {_ODD_RECORDS}) as bigint) as success, cast(0 as bigint) as failed,
    cast(sum({_SKIPPED}) as bigint) as skipped, 'passed' as status
    FROM ({_TOPIC_COUNTS}) GROUP BY ROLLUP (topic)"""
)
def load_audit(spark, sf_dir):
    paths = inputs.bad_topics(spark, sf_dir)
    return messages.load_audit(
        {name: messages.parse_lines(messages.read_lines(spark, path), FEEDS[name]) for name, path in paths.items()}
    )


@query(
    f"""SELECT coalesce(topic, 'TOTAL') as topic, cast(sum(n + {_ODD_RECORDS + _SKIPPED}) as bigint) as consumed,
    cast(sum(n + {_ODD_RECORDS}) as bigint) as inserted, cast(0 as bigint) as failed,
    cast(sum({_SKIPPED}) as bigint) as skipped, 'ok' as status
    FROM ({_TOPIC_COUNTS}) GROUP BY ROLLUP (topic)"""
)
def ingest_audit(spark, sf_dir):
    """What one run took in, by its entries in the ingest log, after staging has been cleared and the log merged."""
    wh = inputs.new_warehouse(spark, "ingest-audit")
    paths = inputs.bad_topics(spark, sf_dir)
    lines = {n: messages.read_lines(spark, path, stream=True, files_per_batch=3) for n, path in paths.items()}
    run = ingest_topics(lines, wh, f"{wh.root}/_checkpoints", as_of=fixtures.CLOCK)
    wh.retention_delete("2024-06-01 00:00:00")
    wh.compact()
    return messages.ingest_audit(wh.read("ingest_log"), FEEDS, run)


@query(
    """SELECT 'browser_events' as topic, count(*) as sent, cast(count_if(event_id = '') as bigint) as keyless FROM null_keys
    UNION ALL SELECT 'device_events', count(*), 0 FROM events_device_raw UNION ALL
    SELECT 'geo_events', count(*), 0 FROM events_geo_raw UNION ALL
    SELECT 'location_events', count(*), 0 FROM events_location_raw"""
)
def publish_counts(spark, sf_dir):
    """What a run of publishing has sent, some events of which have lost their id."""
    root, counts = fresh_folder(spark, "published"), []
    for name, build in fixtures.FEED_BUILDERS.items():
        rows = fixtures.null_keys(spark, sf_dir) if name == "browser" else build(spark, sf_dir)
        sent = messages.publish_lines(rows, FEEDS[name], f"{root}/{name}")
        counts.append(F.struct(F.lit(FEEDS[name].topic).alias("topic"), F.lit(sent.sent).cast("long").alias("sent"),
                               F.lit(sent.keyless).cast("long").alias("keyless")))
    return spark.range(1).select(F.inline(F.array(*counts)))


@query(
    """SELECT 'events_browser_raw' as table_name, count(*) as rows FROM events_browser_raw UNION ALL
    SELECT 'events_device_raw', count(*) FROM events_device_raw UNION ALL
    SELECT 'events_geo_raw', count(*) FROM events_geo_raw UNION ALL
    SELECT 'events_location_raw', count(*) FROM events_location_raw""",
    name="table_counts",
)
def count_tables(spark, sf_dir):
    wh = inputs.staging(spark, sf_dir)
    return table_counts({table: wh.read(table) for table in STAGING_TABLES})


@query(
    """SELECT geo_country, event_type, count(*) as events FROM fact_events
    WHERE browser_name = 'Chrome' AND event_timestamp >= TIMESTAMP '2024-01-10 00:00:00'
    GROUP BY geo_country, event_type"""
)
def run_sql(spark, sf_dir):
    """SQL over the stored tables, with named parameters."""
    inputs.warehouse(spark, sf_dir).register_views()
    return spark.sql(
        """SELECT geo_country, event_type, count(*) AS events FROM fact_events
        WHERE browser_name = :browser AND event_timestamp >= cast(:since AS timestamp_ntz)
        GROUP BY geo_country, event_type""",
        args={"browser": "Chrome", "since": "2024-01-10 00:00:00"},
    )


_BY_MONTH = """SELECT cast(year(event_timestamp) * 100 + month(event_timestamp) as int) as event_month,
    count(*) as rows FROM events_browser_raw GROUP BY 1"""


@query(_BY_MONTH)
def month_partitioned_write(spark, sf_dir):
    rows = tables.with_month(fixtures.browser(spark, sf_dir))
    path = fresh_folder(spark, "by-month")
    tables.write_by_partition(rows, path, ["event_month"], BROWSER.sort)
    return spark.read.parquet(path).groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


@query(_BY_MONTH)
def clustered_write(spark, sf_dir):
    rows = tables.with_month(fixtures.browser(spark, sf_dir))
    path = fresh_folder(spark, "clustered")
    tables.write_clustered(rows, path, ["event_month"], BROWSER.sort)
    return spark.read.parquet(path).groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


# Streams


@query("SELECT 1 as run, count(*) as added FROM events_browser_raw UNION ALL SELECT 2, 0")
def stream_microbatch(spark, sf_dir):
    """Two drains of the same topic: the second resumes at the end and adds nothing."""
    wh = inputs.new_warehouse(spark, "resume")
    runs = []
    for run in (1, 2):
        before = {row["batch_id"] for row in wh.read(BROWSER.table).select("batch_id").distinct().collect()}
        lines = messages.read_lines(spark, inputs.topic(spark, sf_dir, "browser"), stream=True, files_per_batch=4)
        drain(lines, BROWSER, wh, f"{wh.root}/_checkpoints", as_of=fixtures.CLOCK).awaitTermination()
        added = wh.read(BROWSER.table).filter(~F.col("batch_id").isin(list(before)))
        runs.append(added.select(F.lit(run).alias("run")).agg(F.lit(run).alias("run"), F.count(F.lit(1)).alias("added")))
    return runs[0].unionByName(runs[1])


@query(f"SELECT topic, n as rows FROM ({_TOPIC_COUNTS})")
def stream_four_topics(spark, sf_dir):
    wh = inputs.new_warehouse(spark, "four-topics")
    paths = inputs.topics(spark, sf_dir)
    lines = {name: messages.read_lines(spark, path, stream=True) for name, path in paths.items()}
    ingest_topics(lines, wh, f"{wh.root}/_checkpoints", as_of=fixtures.CLOCK)
    counts = table_counts({feed.topic: wh.read(feed.table) for feed in FEEDS.values()})
    return counts.withColumnRenamed("table_name", "topic")


@query("SELECT event_hour, event_type, cast(sum(total_events) as bigint) as total_events FROM agg_events_hourly GROUP BY ALL")
def stream_hourly_rollup(spark, sf_dir):
    """Finished loads streamed into partial states, with a compaction between two drains, then merged."""
    first, second = fixtures.two_batches(spark, sf_dir)
    wh = inputs.stage_feeds(inputs.new_warehouse(spark, "streamed"), sf_dir, browser=first)
    path = fresh_folder(spark, "stream-rollup")
    wh.load("one", as_of=fixtures.CLOCK)
    rollup_stream(wh, f"{path}/state", f"{path}/_checkpoints").awaitTermination()
    wh.stage(BROWSER, second, "second")
    wh.load("two", as_of=fixtures.CLOCK)
    wh.compact()
    rollup_stream(wh, f"{path}/state", f"{path}/_checkpoints").awaitTermination()
    state = tables.read(spark, f"{path}/state", HOURLY_STATE_SCHEMA)
    return state.groupBy("event_hour", "event_type").agg(F.sum("total_events").alias("total_events"))


@query(f"SELECT {BROWSER_COLUMNS} FROM events_browser_raw")
def stream_dedup(spark, sf_dir):
    """A topic with repeated deliveries, staged without the repeats."""
    wh = inputs.new_warehouse(spark, "dedup")
    messages.publish_lines(fixtures.browser_dup(spark, sf_dir), BROWSER, wh.path("topic"))
    lines = messages.read_lines(spark, wh.path("topic"), stream=True)
    drain(lines, BROWSER, wh, f"{wh.root}/_checkpoints", dedup_within="1 hour").awaitTermination()
    return wh.read(BROWSER.table).select(*BROWSER.columns)
