"""The physical plans: what reaches the scan, what is shuffled, what is never used."""

from __future__ import annotations

import pytest

from footfall import registry
from footfall.plans import quality, reports
from footfall.registry import inputs
from footfall.sources import fixtures
from footfall.sources.fixtures import CLOCK

WRITERS = {  # run their own jobs and read back a table
    "ingest_browser", "ingest_device", "ingest_geo", "ingest_location", "ingest_stream", "ingest_audit",
    "stream_microbatch", "stream_four_topics", "stream_hourly_rollup", "stream_dedup", "rollup_incremental",
    "truncate_reload", "retention_delete", "ttl_expire", "compact", "repair_fact", "backfill_from_files",
    "backfill_from_topics", "append_batch", "month_partitioned_write", "clustered_write",
    "compact_contents", "overlapping_loads", "retention_contents", "dedup_stored", "dedup_stored_states",
    "publish_counts",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - WRITERS))
def test_no_cross_join_nested_loop_or_python(spark, small_dir, name):
    text = plan(registry.queries()[name](spark, small_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window ["):
        assert operator not in text


def test_reports_read_only_their_columns(spark, small_dir):
    text = plan(reports.events_by_type(inputs.fact(spark, small_dir)))
    assert "ReadSchema: struct<event_type:string>" in text


def test_look_back_prunes_months_and_pushes_the_time(spark, small_dir):
    text = plan(reports.daily_cohort(inputs.fact(spark, small_dir), CLOCK))
    assert "PartitionFilters: [isnotnull(event_month" in text
    assert "GreaterThanOrEqual(event_timestamp," in text
    hourly = inputs.warehouse(spark, small_dir).read("agg_events_hourly")
    assert "PartitionFilters: [isnotnull(event_month" in plan(reports.activity_24h(hourly, CLOCK))


def test_top_lists_keep_only_k_rows_per_task(spark, small_dir):
    assert "TakeOrderedAndProject" in plan(reports.top_pages(inputs.fact(spark, small_dir)))


def test_a_peek_builds_one_topic_and_looks_only_for_what_it_saw(spark, small_dir, monkeypatch):
    monkeypatch.setattr(inputs, "_MADE", {})
    monkeypatch.setattr(fixtures, "FEED_BUILDERS", {"browser": fixtures.browser})
    text = plan(registry.queries()["peek_topic"](spark, small_dir))
    assert "LeftSemi, BuildRight" in text  # the topic meets the broadcast lines before anything of it is shuffled


def test_fact_shuffles_each_side_once(spark, small_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.queries()["fact_events"](spark, small_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # browser, location, the joined events by click, device, geo; the last is the one page row without an id
    assert text.count("Exchange hashpartitioning") == 6


def test_the_fact_is_thinned_out_before_its_ids_are_shuffled(spark, small_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.queries()["new_events_only"](spark, small_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text
    assert text.index("SortMergeJoin") < text.index("BroadcastHashJoin")
    assert "bitmap_construct_agg" in text


def test_the_ordered_funnel_reads_the_fact_once(spark, small_dir):
    text = plan(reports.funnel_ordered(inputs.fact(spark, small_dir)))
    assert text.count("FileScan parquet") == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert "Join" not in text


def test_counting_reports_aggregate_before_the_shuffle(spark, small_dir):
    text = plan(reports.campaigns_by_source(inputs.fact(spark, small_dir)))
    assert "partial_count" in text


def test_the_quality_report_shuffles_ids_once(spark, small_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staging, fact = inputs.staging(spark, small_dir), inputs.fact(spark, small_dir)
        stored = {t: staging.read(t) for t in ("events_browser_raw", "events_device_raw")}
        users = inputs.warehouse(spark, small_dir).read("dim_users")
        text = plan(quality.dq_report({"fact_events": fact, "dim_users": users, **stored}, CLOCK))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("FileScan parquet") == 5
    assert text.count("Exchange hashpartitioning(kind") == 1
    assert "Join" not in text
