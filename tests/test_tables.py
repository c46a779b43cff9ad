"""Stored tables: column alignment, layout, swaps."""

from __future__ import annotations

import pytest
from feeds import as_set, event, staged
from pyspark.sql import functions as F

from footfall import workspace
from footfall.schemas import BROWSER, DEVICE
from footfall.sources import fixtures, tables
from footfall.workspace import fresh_folder, shared_root, side_by_side


def test_columns_align_by_name(spark):
    rows = spark.createDataFrame([(1, None, "c")], "further int, os string, click_id string")
    got = tables.conform(rows, DEVICE.schema)
    assert got.columns == DEVICE.columns
    assert (got.first()["click_id"], got.first()["os"], got.first()["device_is_mobile"]) == ("c", "", False)


def test_reading_an_absent_table_gives_no_rows(spark):
    got = tables.read(spark, fresh_folder(spark, "none"), DEVICE.schema)
    assert got.columns == DEVICE.columns
    assert got.isEmpty()


def test_partition_write_replaces_only_its_partitions(spark):
    path = fresh_folder(spark, "parts")
    for month, value in ((1, "a"), (2, "b"), (1, "c")):
        rows = spark.createDataFrame([(month, value)], "m int, v string")
        tables.write_by_partition(rows, path, ["m"])
    assert as_set(spark.read.parquet(path), "m", "v") == [(1, "c"), (2, "b")]


def test_files_of_a_clustered_table_do_not_overlap(spark, small_dir):
    path = fresh_folder(spark, "clustered")
    rows = fixtures.browser(spark, small_dir)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(tables.with_month(rows), path, ["event_month"], BROWSER.sort)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi"))
        .sort("lo")
        .collect()
    )
    assert len(spans) > 1
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))


def test_rows_inside_a_file_are_sorted(spark, small_dir):
    path = fresh_folder(spark, "sorted")
    tables.write_by_partition(tables.with_month(fixtures.browser(spark, small_dir)), path, ["event_month"], BROWSER.sort)
    for file in spark.read.parquet(path).inputFiles():
        stamps = [r[0] for r in spark.read.parquet(file).select("event_timestamp").collect()]
        assert stamps == sorted(stamps)


def test_reload_replaces_and_reads_its_own_table(spark):
    path, schema = f"{fresh_folder(spark, 'reload')}/t", DEVICE.schema
    tables.truncate_reload(staged(spark, DEVICE, [{"click_id": c} for c in "abc"]), path, schema)
    tables.truncate_reload(tables.read(spark, path, schema).filter("click_id <> 'b'"), path, schema)
    assert as_set(tables.read(spark, path, schema), "click_id") == [("a",), ("c",)]


def test_reload_with_nothing_empties_the_table(spark):
    path = f"{fresh_folder(spark, 'reload')}/t"
    tables.truncate_reload(staged(spark, DEVICE, [{"click_id": "a"}]), path, DEVICE.schema)
    tables.truncate_reload(staged(spark, DEVICE, []), path, DEVICE.schema)
    assert tables.read(spark, path, DEVICE.schema).count() == 0


def test_failed_reload_leaves_the_old_version(spark):
    path = f"{fresh_folder(spark, 'reload')}/t"
    tables.truncate_reload(staged(spark, DEVICE, [{"click_id": "a"}]), path, DEVICE.schema)
    broken = staged(spark, DEVICE, [{"click_id": "b"}]).withColumn("os", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        tables.truncate_reload(broken, path, DEVICE.schema)
    assert as_set(tables.read(spark, path, DEVICE.schema), "click_id") == [("a",)]


def test_insert_time_is_in_whole_seconds(spark):
    rows = tables.stamp_insert_time(staged(spark, BROWSER, [event("1")]).drop("inserted_at"), "2024-01-02 03:04:05.6")
    assert str(rows.first()["inserted_at"]) == "2024-01-02 03:04:05"
    assert str(rows.first()["inserted_on"]) == "2024-01-02"
    now = tables.stamp_insert_time(staged(spark, BROWSER, [event("1")]).drop("inserted_at"))
    age = F.timestamp_diff("SECOND", "inserted_at", F.current_timestamp())
    assert now.select(age.alias("a")).first()["a"] < 60


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_folder(spark, "x").startswith(shared_root(spark))
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


class _Cluster:
    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        workspace.shared_root(_Cluster)


def test_of_many_writers_at_once_each_commit_counts(spark):
    path = fresh_folder(spark, "commits")
    side_by_side(lambda n: tables.commit(spark, path, [f"f{n}"], lambda folder: False), range(24))
    assert sorted(tables.live(spark, path)) == sorted(f"f{n}" for n in range(24))


def test_a_name_is_taken_once(spark):
    path = f"{fresh_folder(spark, 'once')}/x.json"
    won = side_by_side(lambda n: tables.create_once(spark, path, str(n)), range(16))
    assert sum(won) == 1
    assert tables.text_of(spark, path) == str(won.index(True))


def test_a_file_of_compaction_stays_small_enough_to_sort_in_one_task():
    """One task sorts the rows of one file, in some fifteen times the bytes of the file."""
    assert tables.files_for(1) == 1
    for size in (128 << 20, 10 << 30):
        assert 15 * size / tables.files_for(size) <= 512 << 20
