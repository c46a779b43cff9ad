"""Edges of the fact join: blanks, repeats, blank keys, empty feeds, hot keys."""

from __future__ import annotations

import pytest
from feeds import as_set, event, feeds, staged
from pyspark.sql import functions as F

from footfall.operators import sieve, skew
from footfall.operators.joins import join_device, new_events_only, orphan_count, orphans_device
from footfall.plans.fact import fact_events, repair_fact
from footfall.schemas import BROWSER, DEVICE, FACT_COLUMNS
from footfall.sources import fixtures


def test_empty_feeds(spark):
    assert fact_events(*feeds(spark)).count() == 0
    assert fact_events(*feeds(spark), dedup=False).count() == 0


def test_missing_sides_are_blank_not_null(spark):
    row = fact_events(*feeds(spark, [event("e1")])).first().asDict()
    assert [c for c in FACT_COLUMNS if row[c] is None] == []
    assert row["device_is_mobile"] is False
    assert row["geo_country"] == row["utm_source"] == ""


def test_null_fields_of_a_match_are_blank(spark):
    device = staged(spark, DEVICE, [{"click_id": "c1", "os": None, "device_is_mobile": None}])
    browser, _, geo, location = feeds(spark, [event("e1")])
    row = fact_events(browser, device, geo, location).first()
    assert (row["os"], row["device_is_mobile"]) == ("", False)


def test_repeated_deliveries_count_once_and_latest_row_wins(spark):
    device = [
        {"click_id": "c1", "os_name": "Old", "inserted_at": "2024-01-01 00:00:00"},
        {"click_id": "c1", "os_name": "New", "inserted_at": "2024-01-02 00:00:00"},
    ]
    got = feeds(spark, [event("e1"), event("e1")], device)
    assert as_set(fact_events(*got), "event_id", "os_name") == [("e1", "New")]
    every = fact_events(*got, dedup=False)
    assert as_set(every, "os_name") == [("New",), ("New",), ("Old",), ("Old",)]


@pytest.mark.parametrize("dedup", [True, False])
def test_events_without_an_id_are_all_kept(spark, dedup):
    browser = [event(None, click="a"), event("", click="b"), event("", click="b"), event("e1")]
    location = [{"event_id": "", "page_url": "nowhere"}, {"event_id": "e1", "page_url": "home"}]
    got = fact_events(*feeds(spark, browser, location=location), dedup=dedup)
    assert as_set(got, "event_id", "page_url") == [("", "nowhere")] * 3 + [("e1", "home")]


@pytest.mark.parametrize("dedup", [True, False])
def test_loaded_ids_are_not_loaded_again(spark, dedup):
    """Events without an id are no one's copies: unlike in a plain NOT IN, those of a later load are kept."""
    loaded = fact_events(*feeds(spark, [event("e1"), event("", click="a")]))
    again = feeds(spark, [event("e1"), event("e2"), event("", click="z")])
    assert as_set(fact_events(*again, loaded, dedup=dedup), "event_id") == [("",), ("e2",)]


def test_new_events_with_null_ids_do_not_empty_the_result(spark):
    fact = staged(spark, BROWSER, [event("e1")]).withColumn("event_id", F.lit(None).cast("string"))
    assert new_events_only(staged(spark, BROWSER, [event("e2")]), fact).count() == 1


def test_repair_fills_only_blank_sides(spark):
    browser, device, geo, location = feeds(
        spark,
        [event("e1", click="a"), event("e2", click="b"), event("e3", click="c")],
        [{"click_id": "a", "os": "kept"}],
    )
    fact = fact_events(browser, device, geo, location)
    arrived = staged(spark, DEVICE, [{"click_id": "a", "os": "other"}, {"click_id": "b", "os": "late"}])
    fixed = repair_fact(fact, arrived, geo, location)
    assert as_set(fixed, "event_id", "os", "changed") == [
        ("e1", "kept", False),
        ("e2", "late", True),
        ("e3", "", False),
    ]


@pytest.fixture
def low_threshold(monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)


def test_hot_keys_finds_heavy_keys_only(spark, low_threshold):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    (key, slices), *others = skew.hot_keys(rows, "k").slices
    assert (key, others) == ("hot", [])
    assert slices == 6  # twice its share of 8 partitions, rounded up
    assert not skew.hot_keys(rows.limit(0), "k")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_equals_plain_join(spark, low_threshold, how):
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, "gone")
        .when(F.col("id") % 100 == 2, None)
        .otherwise((F.col("id") % 50).cast("string"))
        .alias("k"),
    )
    right = spark.range(40).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    right = right.unionByName(spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)], "k string, v long"))
    hot = skew.hot_keys(left, "k")
    assert {key for key, _ in hot.slices} == {"hot", "gone"}
    sliced, plain = skew.join(left, right, "k", how, hot), left.join(right, "k", how)
    assert sliced.columns == plain.columns
    assert sorted(map(str, sliced.collect())) == sorted(map(str, plain.collect()))


def test_right_and_full_joins_are_refused(spark):
    with pytest.raises(ValueError):
        skew.join(spark.range(1), spark.range(1), "id", "full")


def test_hot_key_is_spread_over_tasks(spark, low_threshold):
    left = spark.range(20000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    hot = skew.hot_keys(left, "k")
    sliced = skew.spread(left, "k", hot).filter("k = 'hot'").groupBy("_slice").count().collect()
    assert len(sliced) == dict(hot.slices)["hot"]
    assert max(r["count"] for r in sliced) < 20000 / 8


def test_equal_rows_of_a_hot_key_are_spread_and_all_come_back(spark, low_threshold):
    left = spark.range(3000).select(F.when(F.col("id") < 1001, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.lit(1).alias("x"))
    hot = skew.hot_keys(left, "k")
    slices = skew.spread(left, "k", hot).filter("k = 'hot'").groupBy("_slice").agg(F.sum("_copies").alias("n")).collect()
    assert len(slices) == dict(hot.slices)["hot"]
    assert sorted(r["n"] for r in slices)[-1] - sorted(r["n"] for r in slices)[0] <= 1
    right = spark.createDataFrame([("hot", 7)], "k string, v int")
    joined = skew.join(left, right, "k", "left", hot)
    assert joined.filter("v = 7").count() == 1001
    assert joined.count() == 3000


def test_fact_with_a_third_of_events_on_one_click(spark, small_dir, low_threshold):
    staged_feeds = [build(spark, small_dir) for build in fixtures.FEED_BUILDERS.values()]
    browser = staged_feeds[0]
    target = staged_feeds[1].select("click_id").sort("click_id").first()[0]
    third = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    skewed = browser.withColumn("click_id", F.when(third, target).otherwise(F.col("click_id")))
    assert skew.hot_keys(skewed, "click_id")
    got = fact_events(skewed, *staged_feeds[1:]).select(*FACT_COLUMNS)
    skew_off = skewed.join(staged_feeds[1].drop("inserted_at"), "click_id", "left")
    assert got.count() == skewed.count() == skew_off.count()
    plain = as_set(skew_off.na.fill(""), "event_id", "click_id", "os_name")
    assert as_set(got, "event_id", "click_id", "os_name") == plain


def test_third_of_feed_is_copies_of_one_event(spark, small_dir):
    staged_feeds = [build(spark, small_dir) for build in fixtures.FEED_BUILDERS.values()]
    browser = staged_feeds[0]
    one = browser.sort("event_id").limit(1)
    copied = browser.unionByName(one.crossJoin(spark.range(500)).drop("id"))
    assert fact_events(copied, *staged_feeds[1:]).count() == browser.count()


def test_fan_out_keeps_every_match(spark):
    browser, device, *_ = feeds(spark, [event("e1")], [{"click_id": "c1", "os": o} for o in "ab"])
    assert as_set(join_device(browser, device, dedup=False), "os") == [("a",), ("b",)]
    assert join_device(browser, device).count() == 1


def test_orphan_count_is_zero_not_null_on_empty_input(spark):
    browser, *_ = feeds(spark)
    assert orphan_count(browser, browser, "event_id").first()["count"] == 0


def test_narrowing_a_skewed_feed_to_a_loads_keys(spark, low_threshold):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 700).cast("string")).alias("click_id")
    )
    assert skew.hot_keys(rows, "click_id")
    keys = rows.filter("click_id = 'hot' or id < 50").select("click_id").distinct()
    exact = as_set(rows.join(keys, "click_id", "left_semi"), "id")
    assert len(exact) > 1000
    assert as_set(sieve.thinned(rows, keys, "click_id"), "id") == exact


@pytest.mark.parametrize("bits", [1 << 10, 1 << 15, 1 << 27])
def test_a_bitmap_keeps_every_key_and_lets_few_others_pass(spark, bits, monkeypatch):
    monkeypatch.setattr(sieve, "BITS", bits)
    keys = spark.range(300).select(F.concat(F.lit("k"), "id").alias("k")).union(spark.createDataFrame([(None,)], "k string"))
    rows = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    rows = rows.union(spark.createDataFrame([(None, -1), ("", -2)], "k string, id long"))
    got = {r["id"] for r in sieve.thinned(rows, keys, "k").collect()}
    assert {-2, -1, *range(300)} <= got
    assert len(got) - 302 <= 20000 * 300 / bits * 1.5
    assert sieve.thinned(rows, keys.limit(0), "k").count() == 0


@pytest.mark.parametrize("bits", [8, 1 << 27])
def test_new_events_do_not_hang_on_the_bitmap(spark, bits, monkeypatch):
    monkeypatch.setattr(sieve, "BITS", bits)
    events = staged(spark, BROWSER, [event(str(i)) for i in range(40)])
    assert new_events_only(events, events.filter("event_id < '2'")).count() == events.filter("event_id >= '2'").count()


def test_orphans_of_one_click_are_all_found(spark, low_threshold):
    device, fact = (
        staged(spark, DEVICE, [{"click_id": c}]).crossJoin(spark.range(n)).select("click_id", "id")
        for c, n in (("lost", 1000), ("known", 10))
    )
    rows = device.unionByName(fact)
    assert orphans_device(rows, fact).count() == 1000
    assert orphan_count(rows, fact, "click_id").first()["count"] == 1000
