"""Report details that the fixtures do not reach."""

from __future__ import annotations

import random

import pytest
from feeds import as_set, event, feeds, moment
from pyspark.sql import functions as F

from footfall.functions.values import merged_estimate, ratio, sketch
from footfall.operators import skew
from footfall.operators.aggregates import min_max, top_k
from footfall.operators.filters import dashboard_filters
from footfall.plans import reports
from footfall.plans.fact import fact_events
from footfall.registry import inputs

CLOCK = "2024-01-31 00:00:00"


def visits(spark, *steps):
    """A fact from (user, page, minute) triples."""
    browser = [event(str(i), ts=f"2024-01-01 10:{m:02d}:00", click=u) for i, (u, _, m) in enumerate(steps)]
    device = [{"click_id": u, "user_domain_id": u} for u, _, _ in steps]
    location = [{"event_id": str(i), "page_url_path": p} for i, (_, p, _) in enumerate(steps)]
    return fact_events(*feeds(spark, browser, device, location=location))


STEPS = [
    # reaches the third page, in order, with detours
    ("a", "/home", 1), ("a", "/cart", 2), ("a", "/product_a", 3), ("a", "/home", 4), ("a", "/product_b", 5),
    # second page before the first, and again at the same minute as the first
    ("b", "/product_a", 1), ("b", "/home", 2), ("b", "/product_a", 2),
    # no first page
    ("c", "/product_a", 1), ("c", "/checkout", 2),
    # unknown user
    ("", "/home", 1),
]


def test_funnel_counts_strictly_later_steps(spark):
    got = as_set(reports.funnel_ordered(visits(spark, *STEPS)), "step", "users")
    assert got == [(1, 2), (2, 1), (3, 1), (4, 0)]


def test_funnel_with_one_user_holding_most_visits(spark, monkeypatch):
    fact = visits(spark, *STEPS)
    many = fact.unionByName(fact.filter("user_domain_id = 'a'").crossJoin(spark.range(400)).drop("id"))
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    assert skew.hot_keys(many, "user_domain_id")
    assert as_set(reports.funnel_ordered(many), "step", "users") == [(1, 2), (2, 1), (3, 1), (4, 0)]


def test_funnel_equals_a_plain_walk_over_each_users_visits(spark):
    """Many visits at one time, across minutes, and a page that stands twice in the funnel."""
    chance = random.Random(5)
    pages = ["/home", "/product_a", "/home", "/checkout"]
    steps = [(f"u{chance.randrange(60)}", chance.choice([*pages, "/x"]), chance.randrange(8)) for _ in range(500)]
    expected = [0] * len(pages)
    for user in {u for u, _, _ in steps}:
        at = None
        for n, page in enumerate(pages):
            times = [m for u, p, m in steps if u == user and p == page and (at is None or m > at)]
            if not times:
                break
            at = min(times)
            expected[n] += 1
    got = as_set(reports.funnel_ordered(visits(spark, *steps), pages=pages), "step", "users")
    assert got == list(enumerate(expected, start=1))
    assert expected[-1] > 0


def test_funnel_visits_without_a_time_count_for_the_first_step_only(spark):
    rows = [("a", "/home", None), ("a", "/product_a", None), ("b", "/home", 1), ("b", "/product_a", None)]
    fact = spark.createDataFrame(rows, "user_domain_id string, page_url_path string, minute int")
    time = F.expr("timestamp_ntz '2024-01-01 10:00:00' + make_interval(0, 0, 0, 0, 0, minute, 0)")
    got = as_set(reports.funnel_ordered(fact.withColumn("event_timestamp", time)), "step", "users")
    assert got == [(1, 2), (2, 0), (3, 0), (4, 0)]


def test_ratios_survive_zero_and_round_half_up(spark):
    rows = spark.createDataFrame([(107, 40), (1, 0), (1, 8)], "a long, b long")
    got = [r[0] for r in rows.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [2.68, None, 0.13]


def test_ties_are_broken_by_key(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, n int")
    assert [r["k"] for r in top_k(rows, "n", 2, ["k"]).collect()] == ["c", "a"]


def test_look_back_includes_its_first_moment(spark):
    browser = [event("in", ts="2024-01-30 00:00:00"), event("out", ts="2024-01-29 23:59:59.999999")]
    fact = fact_events(*feeds(spark, browser))
    got = as_set(reports.events_last_24h(fact, CLOCK), "event_hour", "events")
    assert got == [(moment("2024-01-30 00:00:00"), 1)]


def test_unknown_filter_is_refused(spark, small_dir):
    with pytest.raises(ValueError):
        dashboard_filters(inputs.fact(spark, small_dir), {"browser_name": "Opera"})


def test_filters_apply_to_reports(spark, small_dir):
    fact = inputs.fact(spark, small_dir)
    mobile = reports.total_events(fact, filters={"device_type": "Mobile"}).first()[0]
    assert mobile == fact.filter("device_type = 'Mobile'").count() < fact.count()


def test_activity_is_the_same_from_fact_and_state(spark, small_dir):
    wh = inputs.warehouse(spark, small_dir)
    fact, state = wh.read("fact_events"), wh.read("agg_events_hourly")
    chosen = {"event_type": ["view", "click"]}
    for report in (reports.activity_24h, reports.activity_heatmap):
        columns = report(fact).columns
        got = [sorted(map(str, report(rows, CLOCK, chosen).select(*columns).collect())) for rows in (fact, state)]
        assert got[0] == got[1] != []


def test_latest_moment_of_a_table(spark, small_dir):
    fact = inputs.fact(spark, small_dir)
    assert min_max(fact, [], "event_timestamp").first()[1] == fact.agg(F.max("event_timestamp")).first()[0]


def test_reports_over_an_empty_fact(spark):
    fact = fact_events(*feeds(spark))
    assert reports.total_events(fact).first()[0] == 0
    assert reports.unique_users(fact).first()[0] == 0
    assert reports.funnel_share(fact).count() == 0
    assert reports.retention_cohort(fact).count() == 0
    assert as_set(reports.funnel_ordered(fact), "users") == [(0,)] * 4


def test_blank_counts_as_a_value_in_exact_and_sketched_counts(spark):
    rows = spark.createDataFrame([("",), ("u",), ("u",)], "u string")
    got = rows.agg(F.count_distinct("u"), F.hll_sketch_estimate(sketch("u"))).first()
    assert tuple(got) == (2, 2)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_merged_sketches_stay_within_five_percent(spark, parts):
    users = spark.range(200000).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
    both = users.unionByName(users.withColumn("part", (F.col("part") + 1) % parts))
    states = both.groupBy("part").agg(sketch(F.col("id").cast("string")).alias("s"))
    estimate = states.agg(merged_estimate("s")).first()[0]
    assert abs(estimate - 200000) < 0.05 * 200000
