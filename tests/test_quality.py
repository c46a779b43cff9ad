"""Checks and their scoring."""

from __future__ import annotations

import pytest
from feeds import as_set, event, feeds

from footfall.plans import dims, quality
from footfall.plans.fact import fact_events
from footfall.operators.filters import filter_blank
from footfall.sources import fixtures


def report_on(spark, browser, device=(), location=(), as_of="2024-01-01 10:30:00"):
    got = feeds(spark, browser, device, location=location)
    fact = fact_events(*got, dedup=False)
    tables = {
        "fact_events": fact,
        "dim_users": dims.dim_users(fact),
        "events_browser_raw": got[0],
        "events_device_raw": got[1],
    }
    return quality.dq_report(tables, as_of)


@pytest.mark.parametrize(
    "as_of, status",
    [("2024-01-01 12:00:00", "passed"), ("2024-01-01 12:00:01", "failed"), ("2024-01-01 09:00:00", "passed")],
)
def test_freshness_limit_is_two_hours(spark, as_of, status):
    browser, *_ = feeds(spark, [event("1", ts="2024-01-01 10:00:00")])
    assert quality.dq_freshness(browser, as_of).first()["status"] == status


def test_empty_fact_is_a_warning_not_an_issue(spark):
    lines = {r["check_name"]: (r["count"], r["status"]) for r in report_on(spark, []).collect()}
    assert lines["freshness"] == (None, "warning")
    assert lines["overall"] == (0, "passed")


def test_clean_data_passes(spark):
    report = report_on(
        spark,
        [event("1")],
        [{"click_id": "c1", "device_type": "Mobile", "device_is_mobile": True, "user_domain_id": "u"}],
        [{"event_id": "1", "page_url": "p"}],
    )
    assert {r["status"] for r in report.collect()} == {"passed"}
    assert quality.raise_on_issues(report) == 0


def test_every_defect_is_counted(spark):
    report = report_on(
        spark,
        [event("1"), event("1"), event(None, click=""), event("2", ts=None)],
        [
            {"click_id": "c1", "device_type": "Mobile", "device_is_mobile": False},
            {"click_id": "other", "device_type": "Desktop"},
        ],
        as_of="2024-01-02 10:00:00",
    )
    status = {r["check_name"]: (r["count"], r["status"]) for r in report.collect()}
    assert status["freshness"] == (None, "failed")
    assert status["null_event_id"] == (1, "warning")
    assert status["null_event_timestamp"] == (1, "warning")
    assert status["null_click_id"] == (1, "warning")
    assert status["duplicate_event_ids"] == (1, "failed")
    assert status["device_events_orphaned"] == (1, "warning")
    assert status["missing_location_data"] == (4, "warning")
    assert status["device_type_inconsistency"] == (3, "warning")
    assert status["overall"] == (8, "failed")
    assert quality.raise_on_issues(report) == 8
    with pytest.raises(quality.QualityError):
        quality.raise_on_issues(report, max_issues=7)


def test_blank_means_null_only_for_other_types(spark):
    browser, *_ = feeds(spark, [event("1", ts=None), event("2")])
    assert as_set(filter_blank(browser, "event_timestamp"), "event_id") == [("1",)]
    assert filter_blank(browser, "event_id").count() == 0


def test_duplicates_report_both_counts(spark, small_dir):
    browser = fixtures.browser(spark, small_dir).limit(30)
    row = quality.dq_duplicates(browser.unionByName(browser)).first()
    assert (row["duplicate_count"], row["true_count"], row["status"]) == (10, 30, "failed")
    assert len(row["samples"].split(",")) == 5
    clean = quality.dq_duplicates(browser).first()
    assert (clean["duplicate_count"], clean["true_count"], clean["samples"], clean["status"]) == (0, 0, "", "passed")
