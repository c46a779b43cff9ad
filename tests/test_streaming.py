"""Drains: resuming, bad lines, repeats, repeated micro-batches."""

from __future__ import annotations

import json

import pytest
from feeds import as_set, event, moment, staged
from pyspark.sql import functions as F

from footfall.plans.warehouse import Warehouse
from footfall.schemas import BROWSER, DEVICE, FEEDS, HOURLY_STATE_SCHEMA
from footfall.sources import messages, tables
from footfall.sources.fixtures import odd_lines
from footfall.streaming.ingest import QUARANTINE, ingest_stream, ingest_topics
from footfall.streaming.rollup import stream_hourly_rollup
from footfall.workspace import fresh_folder


@pytest.fixture
def wh(spark):
    return Warehouse(spark, fresh_folder(spark, "stream"))


def put(wh, name, lines):
    """Add one file to the topic folder."""
    path = wh.path(f"topic/{name}")
    wh.spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def drain(wh, feed=BROWSER, **options):
    lines = messages.read_lines(wh.spark, wh.path("topic/*"), stream=True)
    ingest_stream(lines, feed, wh, wh.path("_checkpoints"), **options).awaitTermination()


def line(event_id, **more):
    return json.dumps({**event(event_id), **more})


def test_resumes_where_it_stopped(wh):
    put(wh, "a", [line("1"), line("2")])
    drain(wh)
    assert wh.read(BROWSER.table).count() == 2
    drain(wh)
    assert wh.read(BROWSER.table).count() == 2
    put(wh, "b", [line("3")])
    drain(wh)
    assert as_set(wh.read(BROWSER.table), "event_id") == [("1",), ("2",), ("3",)]


def test_bad_lines_go_to_quarantine(wh):
    put(wh, "a", [line("1"), *odd_lines(BROWSER), "[]", "42", line(""), line("2", event_timestamp="soon")])
    drain(wh)
    assert as_set(wh.read(BROWSER.table), "event_id") == [("1",), ("further-1",), ("lacking-1",)]
    aside = wh.spark.read.parquet(wh.path(QUARANTINE))
    problems = sorted(r["problem"] for r in aside.collect())
    assert problems == ["blank", "corrupt", "corrupt", "corrupt", "corrupt", "keyless"]
    assert "42" in {r["raw"] for r in aside.collect()}


def test_missing_fields_become_blank(wh):
    put(wh, "a", [json.dumps({"click_id": "c"})])
    drain(wh, DEVICE)
    row = wh.read(DEVICE.table).first()
    assert (row["os"], row["device_is_mobile"]) == ("", False)


def test_time_with_and_without_fraction_and_t(wh):
    put(wh, "a", [line("1", event_timestamp="2024-01-01T10:00:00.123456"), line("2", event_timestamp="2024-01-01 10:00:00")])
    drain(wh)
    got = dict(as_set(wh.read(BROWSER.table), "event_id", "event_timestamp"))
    assert got == {"1": moment("2024-01-01 10:00:00.123456"), "2": moment("2024-01-01 10:00:00")}


def test_repeats_within_the_delay_are_dropped_and_bad_lines_kept(wh):
    put(wh, "a", [line("1"), line("1"), line("2"), "{", "{"])
    drain(wh, dedup_within="1 hour")
    put(wh, "b", [line("2"), line("3")])
    drain(wh, dedup_within="1 hour")
    assert as_set(wh.read(BROWSER.table), "event_id") == [("1",), ("2",), ("3",)]
    assert wh.spark.read.parquet(wh.path(QUARANTINE)).count() == 2


def test_events_of_any_age_survive_repeat_dropping(wh):
    put(wh, "a", [line("new", event_timestamp="2024-06-01 00:00:00")])
    drain(wh, dedup_within="1 minute")
    put(wh, "b", [line("old", event_timestamp="2020-01-01 00:00:00")])
    drain(wh, dedup_within="1 minute")
    assert wh.read(BROWSER.table).count() == 2


def test_a_repeated_batch_replaces_itself(wh):
    batch = staged(wh.spark, BROWSER, [event("1"), event("2")])
    wh.stage(BROWSER, batch, "7")
    wh.stage(BROWSER, batch, "7")
    wh.stage(BROWSER, batch, "8")
    assert wh.read(BROWSER.table).count() == 4


def test_topics_drain_together_and_audit(wh):
    paths = {}
    for name, feed in FEEDS.items():
        paths[name] = wh.path(f"topics/{name}")
        lines = odd_lines(feed) if name != "geo" else []
        wh.spark.createDataFrame([(text,) for text in lines], "value string").write.text(paths[name])
    lines = {name: messages.read_lines(wh.spark, path, stream=True) for name, path in paths.items()}
    first = ingest_topics(lines, wh, wh.path("_checkpoints"))
    second = ingest_topics(lines, wh, wh.path("_checkpoints"))
    log, columns = wh.read("ingest_log"), ("topic", "consumed", "inserted", "skipped", "status")
    assert as_set(messages.ingest_audit(log, FEEDS, first), *columns) == [
        ("TOTAL", 12, 6, 6, "ok"),
        ("browser_events", 4, 2, 2, "ok"),
        ("device_events", 4, 2, 2, "ok"),
        ("geo_events", 0, 0, 0, "no data"),
        ("location_events", 4, 2, 2, "ok"),
    ]
    # nothing new came, and that run says so
    assert {row["status"] for row in messages.ingest_audit(log, FEEDS, second).collect()} == {"no data"}


def test_a_batch_that_comes_again_is_logged_once(wh):
    counts = wh.spark.sql("select 4L as consumed, 3L as inserted, 0L as failed, 1L as skipped")
    for batch, run in (("0", "a"), ("1", "a"), ("1", "b")):
        wh.log_batch(BROWSER, counts, batch, run)
    assert as_set(wh.read("ingest_log"), "batch_id", "run_id", "consumed") == [("0", "a", 4), ("1", "b", 4)]


def test_merging_the_ingest_log_keeps_every_count_and_the_last_batch(wh):
    counts = wh.spark.sql("select 4L as consumed, 3L as inserted, 0L as failed, 1L as skipped")
    for batch in range(4):
        wh.log_batch(BROWSER, counts, str(batch), "a")
    wh.log_batch(DEVICE, counts, "0", "a")
    before = as_set(messages.ingest_audit(wh.read("ingest_log"), FEEDS), "topic", "consumed", "inserted", "status")
    wh.compact()
    assert as_set(wh.read("ingest_log"), "topic", "batch_id", "consumed") == [
        ("browser_events", "3", 4),
        ("browser_events", "merged", 12),
        ("device_events", "0", 4),
    ]
    assert as_set(messages.ingest_audit(wh.read("ingest_log"), FEEDS), "topic", "consumed", "inserted", "status") == before


def test_a_topic_comes_in_bounded_batches(wh):
    for n in range(4):
        put(wh, f"f{n}", [line(f"{n}-{k}") for k in range(5)])
    lines = messages.read_lines(wh.spark, wh.path("topic/*"), stream=True, bytes_per_batch=1)
    ingest_stream(lines, BROWSER, wh, wh.path("_checkpoints")).awaitTermination()
    assert sorted(row["consumed"] for row in wh.read("ingest_log").collect()) == [5, 5, 5, 5]
    assert wh.read(BROWSER.table).count() == 20


def test_a_batch_is_parsed_to_disk_not_held_in_memory(wh, monkeypatch):
    held = lambda: len(wh.spark.sparkContext._jsc.getPersistentRDDs())
    before, during, log = held(), [], Warehouse.log_batch

    def seen(self, *args):
        during.append(held())
        log(self, *args)

    monkeypatch.setattr(Warehouse, "log_batch", seen)
    put(wh, "a", [line("1"), " ", '{"event_id": "2', line("")])
    drain(wh)
    assert during == [before]
    assert as_set(wh.read(BROWSER.table), "event_id") == [("1",)]
    aside = wh.spark.read.parquet(wh.path(QUARANTINE))
    assert as_set(aside, "problem", "raw") == [("blank", " "), ("corrupt", '{"event_id": "2'), ("keyless", line(""))]
    assert as_set(wh.read("ingest_log"), "consumed", "inserted", "failed", "skipped") == [(4, 1, 1, 2)]
    assert not tables.exists(wh.spark, wh.path("_staged/events_browser_raw-batch-0"))


def test_publishing_tells_what_it_sent(wh):
    rows = staged(wh.spark, BROWSER, [event("1"), event("2"), event("")])
    assert messages.publish_lines(rows, BROWSER, wh.path("topic/a")) == messages.Published(sent=3, keyless=1)
    none = messages.publish_lines(rows.filter("false"), BROWSER, wh.path("topic/b"))
    assert none == messages.Published(sent=0, keyless=0)


def test_load_audit_warns_of_keyless_records(spark):
    lines = spark.createDataFrame([(line("1"),), (line(""),), ("",)], "value string")
    audit = messages.load_audit({"browser": messages.parse_lines(lines, BROWSER)})
    assert as_set(audit, "topic", "total", "success", "failed", "skipped", "status") == [
        ("TOTAL", 2, 1, 1, 1, "warning"),
        ("browser_events", 2, 1, 1, 1, "warning"),
    ]


def test_stream_rollup_adds_each_load_once_whatever_upkeep_does(wh):
    state = wh.path("state")
    drain_loads = lambda: stream_hourly_rollup(wh, state, wh.path("_rollup")).awaitTermination()
    for n, ts in enumerate(["2024-01-01 10:05:00", "2024-01-01 10:50:00", "2024-01-01 11:00:00"]):
        wh.stage(BROWSER, staged(wh.spark, BROWSER, [event(str(n), ts=ts)]), f"b{n}")
        wh.load(f"l{n}")
        if n < 2:
            drain_loads()
    wh.compact()  # before the last load has been streamed
    wh.sweep()
    drain_loads()
    wh.compact()
    drain_loads()
    merged = tables.read(wh.spark, state, HOURLY_STATE_SCHEMA).groupBy("event_hour").agg(F.sum("total_events").alias("n"))
    assert as_set(merged, "event_hour", "n") == [
        (moment("2024-01-01 10:00:00"), 2),
        (moment("2024-01-01 11:00:00"), 1),
    ]


def test_a_half_written_batch_is_not_staged(wh):
    wh.stage(BROWSER, staged(wh.spark, BROWSER, [event("a")]), "b0")
    broken = staged(wh.spark, BROWSER, [event("b"), event("c")]).repartition(2)
    broken = broken.withColumn("event_type", F.when(F.col("event_id") == "c", F.raise_error(F.lit("no"))).otherwise("view").cast("string"))
    with pytest.raises(Exception, match="no"):
        wh.stage(BROWSER, broken, "b1")
    assert wh.open_batches() == ["b0"]
    assert as_set(wh.read(BROWSER.table), "event_id") == [("a",)]


def test_repeats_are_equal_rows_and_updates_are_kept(wh):
    rows = [{"click_id": "c", "os": "old"}, {"click_id": "c", "os": "old"}, {"click_id": "c", "os": "new"}]
    put(wh, "a", [json.dumps(r) for r in rows] + ["[]", "[]"])
    drain(wh, DEVICE, dedup_within="1 hour")
    assert as_set(wh.read(DEVICE.table), "click_id", "os") == [("c", "new"), ("c", "old")]
    assert wh.spark.read.parquet(wh.path(QUARANTINE)).count() == 2


def test_kafka_options():
    options = messages.kafka_options(FEEDS["geo"], "host:9092", minPartitions="64")
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "geo_events",
        "startingOffsets": "earliest",
        "minPartitions": "64",
    }
