"""Loads, failures, upkeep."""

from __future__ import annotations

import pytest
from feeds import as_set, event, feeds, moment, staged, total
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.operators import rollups, sieve
from footfall.operators.filters import dashboard_filters
from footfall.plans import dims, lease, reports
from footfall.plans import warehouse as wh_module
from footfall.plans.fact import fact_events
from footfall.plans.warehouse import Warehouse
from footfall.registry.inputs import stage_feeds
from footfall.schemas import BROWSER, DEVICE, FACT_COLUMNS, FEEDS, HOURLY_KEYS, LOCATION
from footfall.sources import fixtures, tables
from footfall.workspace import fresh_folder, side_by_side

CLOCK = fixtures.CLOCK


@pytest.fixture
def wh(spark):
    return Warehouse(spark, fresh_folder(spark, "test"))


def hourly(wh):
    return sorted(map(tuple, rollups.merge(wh.read("agg_events_hourly"), HOURLY_KEYS).collect()))


def fact_rows(wh):
    return sorted(map(str, wh.read("fact_events").select(*FACT_COLUMNS).collect()))


@pytest.fixture(scope="module")
def full(spark, small_dir):
    wh = stage_feeds(Warehouse(spark, fresh_folder(spark, "full")), small_dir)
    wh.load("all", as_of=CLOCK)
    return fact_rows(wh), hourly(wh)


def dimensions(wh):
    """Both dimensions as kept from partials, after checking them against the fact."""
    wh.rebuild_dims()
    fact = wh.read("fact_events")
    kept = []
    for table, whole in (("dim_users", dims.dim_users(fact)), ("dim_geo", dims.dim_geo(fact))):
        kept.append(as_set(wh.read(table), *whole.columns))
        assert kept[-1] == as_set(whole, *whole.columns)
    return kept


def two_loads(wh, small_dir):
    first, second = fixtures.two_batches(wh.spark, small_dir)
    stage_feeds(wh, small_dir, browser=first)
    assert wh.load("one", as_of=CLOCK) == 520
    wh.stage(BROWSER, second, "second")
    assert wh.load("two", as_of=CLOCK) == 480
    return wh


def test_loads_in_parts_equal_one_load(wh, small_dir, full):
    two_loads(wh, small_dir)
    assert (fact_rows(wh), hourly(wh)) == full
    assert [len(rows) for rows in dimensions(wh)] == [15, 15]


def test_loads_whose_keys_fill_the_bitmap(wh, small_dir, full, monkeypatch):
    monkeypatch.setattr(sieve, "BITS", 8)
    two_loads(wh, small_dir)
    assert (fact_rows(wh), hourly(wh)) == full


def test_loads_that_keep_every_match(wh, small_dir, full):
    first, second = fixtures.two_batches(wh.spark, small_dir)
    stage_feeds(wh, small_dir, browser=first)
    wh.load("one", dedup=False, as_of=CLOCK)
    wh.stage(BROWSER, second, "second")
    assert wh.load("two", dedup=False, as_of=CLOCK) == 480
    assert (fact_rows(wh), hourly(wh)) == full


def test_a_repeated_load_adds_nothing(wh, small_dir, full):
    two_loads(wh, small_dir)
    assert wh.load("two", as_of=CLOCK) == 0
    assert wh.load("three", as_of=CLOCK) == 0
    assert (fact_rows(wh), hourly(wh)) == full


def test_only_open_batches_are_read(wh, small_dir):
    first, second = fixtures.two_batches(wh.spark, small_dir)
    stage_feeds(wh, small_dir, browser=first)
    assert wh.open_batches() == ["first"]
    wh.load("one", as_of=CLOCK)
    assert wh.open_batches() == []
    wh.stage(BROWSER, second, "second")
    assert wh.open_batches() == ["second"]


def test_failure_between_fact_and_states_is_made_good(wh, small_dir, full):
    first, second = fixtures.two_batches(wh.spark, small_dir)
    stage_feeds(wh, small_dir, browser=first)
    wh.load("one", as_of=CLOCK)
    wh.stage(BROWSER, second, "second")
    wh.load_fact("two", as_of=CLOCK)  # and then the job dies
    wh.compact()  # must leave the unfinished load alone
    wh.rebuild_dims()
    assert wh.read("dim_users").agg(F.sum("total_events")).first()[0] < 520
    assert wh.load("two", as_of=CLOCK) == 480
    assert (fact_rows(wh), hourly(wh)) == full


def test_a_dead_load_is_made_good_by_one_of_another_id(wh, small_dir, full):
    stage_feeds(wh, small_dir)
    wh.load_fact("20240131T0015", as_of=CLOCK)  # and then the job dies
    with pytest.raises(lease.Busy):
        wh.load("20240131T0030", as_of=CLOCK)  # which nobody can know before its lease is old
    wh.lease_seconds = 0
    assert wh.load("20240131T0030", as_of=CLOCK) == 1000
    assert (fact_rows(wh), hourly(wh)) == full
    assert {r.load_id for r in wh.read("fact_events").select("load_id").distinct().collect()} == {"20240131T0030"}


def test_failure_between_the_two_states_is_made_good(wh, small_dir, full, monkeypatch):
    stage_feeds(wh, small_dir)
    monkeypatch.setattr(rollups, "traffic_state", lambda fact: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        wh.load("all", as_of=CLOCK)
    monkeypatch.undo()
    assert wh.load("all", as_of=CLOCK) == 1000
    assert (fact_rows(wh), hourly(wh)) == full
    assert total(wh.read("agg_traffic_sources")) == 1000
    dimensions(wh)


def test_compaction_keeps_every_row_and_merges_states(wh, small_dir, full):
    two_loads(wh, small_dir)
    wh.rebuild_dims()
    users = as_set(wh.read("dim_users"), *wh.read("dim_users").columns)
    before = {t: wh.read(t).count() for t in ("agg_events_hourly", "agg_traffic_sources")}
    assert wh.compact()
    assert (fact_rows(wh), hourly(wh)) == full
    assert as_set(wh.read("dim_users"), *wh.read("dim_users").columns) == users
    assert dimensions(wh)[0] == users
    assert wh.read("dim_users_state").count() == len(users)
    assert wh.read("agg_traffic_sources").count() <= before["agg_traffic_sources"]
    keys = wh.read("agg_events_hourly").groupBy(*HOURLY_KEYS).count()
    assert keys.filter("count > 1").count() == 0
    assert as_set(wh.read("fact_events").select("load_id").distinct(), "load_id") == [("merged",)]
    assert wh.load("two", as_of=CLOCK) == 0
    assert wh.load("four", as_of=CLOCK) == 0
    for folder in wh.folders("fact_events"):
        assert tables.data_files(wh.spark, f"{wh.path('fact_events')}/{folder}")[0] == 1


def test_a_month_is_not_copied_for_a_few_new_files(wh, small_dir, monkeypatch):
    two_loads(wh, small_dir)
    files, size = map(sum, zip(*(tables.data_files(wh.spark, f"{wh.path('fact_events')}/{f}") for f in wh.folders("fact_events"))))
    monkeypatch.setattr(tables, "FILE_BYTES", size // 8)
    assert tables.files_for(size) >= 8 > files
    assert not [f for f in wh.compact() if "fact_events" in f]


def test_a_compacted_month_has_files_of_the_wanted_size(wh, small_dir, full, monkeypatch):
    two_loads(wh, small_dir)
    month = wh.folders("fact_events")[0].split("/")[0]
    wh._merge("fact_events", [f for f in wh.folders("fact_events") if f.startswith(month)], 4)
    (merged,) = [f for f in wh.folders("fact_events") if f.startswith(month)]
    assert tables.data_files(wh.spark, f"{wh.path('fact_events')}/{merged}")[0] == 4
    assert fact_rows(wh) == full[0]


def test_repair_after_late_rows(wh, small_dir, full):
    early, late = fixtures.late_device(wh.spark, small_dir)
    stage_feeds(wh, small_dir, device=early)
    wh.load("one", as_of=CLOCK)
    wh.stage(DEVICE, late, "late")
    assert wh.repair(CLOCK, days=31) == 84
    assert (fact_rows(wh), hourly(wh)) == full
    dimensions(wh)
    assert wh.repair(CLOCK, days=31) == 0


def test_repair_looks_up_only_what_blank_sides_ask_for(wh, small_dir, full, monkeypatch):
    """Of the feeds only rows of keys that a fact row lacks reach the joins with it."""
    early, late = fixtures.late_device(wh.spark, small_dir)
    stage_feeds(wh, small_dir, device=early)
    wh.load("one", as_of=CLOCK)
    wh.stage(DEVICE, late, "late")
    seen, look_up = [], wh_module.repair_fact

    def counting(fact, *sides):
        seen.extend(side.count() for side in sides)
        return look_up(fact, *sides)

    monkeypatch.setattr(wh_module, "repair_fact", counting)
    assert wh.repair(CLOCK, days=31) == 84
    assert seen == [late.count(), 0, 0]  # every other click, and every page, is in the fact already or never came
    assert (fact_rows(wh), hourly(wh)) == full


def test_repair_of_repeated_and_nameless_events(spark, tmp_path):
    """Events twice, without a click and without an id, and late rows twice: all as if the rows had been there in time;
    in a merged month too."""
    browser = [event("a", click="c1")] * 2 + [event("b", click=None), event(None, click="c2"), event("", click="c2"), event("d", click="c9")]
    device = [{"click_id": "c1", "os": "x"}, {"click_id": None, "os": "y"}, {"click_id": "c2", "os": "z"}, {"click_id": "c7", "os": "w"}]
    location = [{"event_id": "d", "page_url": "p"}, {"event_id": "", "page_url": "q"}]
    for merged in (False, True):
        got = []
        for before_load in (True, False):
            wh = Warehouse(spark, str(tmp_path / f"{merged}-{before_load}"))
            wh.stage(BROWSER, staged(spark, BROWSER, browser), "b")
            sides = [(DEVICE, staged(spark, DEVICE, device)), (LOCATION, staged(spark, LOCATION, location))]
            if before_load:
                [wh.stage(feed, rows, "s") for feed, rows in sides]
            wh.load("one", dedup=False, as_of=CLOCK)
            if merged:
                wh._merge("fact_events", wh.folders("fact_events"), 1)
            if not before_load:
                [wh.stage(feed, rows, n) for n in ("s", "again") for feed, rows in sides]
                assert wh.repair(CLOCK, days=60) == 6
            got.append((fact_rows(wh), hourly(wh)))
        assert got[0] == got[1]


def test_repair_that_dies_before_the_states(wh, small_dir, full, monkeypatch):
    early, late = fixtures.late_device(wh.spark, small_dir)
    stage_feeds(wh, small_dir, device=early)
    wh.load("one", as_of=CLOCK)
    wh.stage(DEVICE, late, "late")
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_rebuild_states", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            wh.repair(CLOCK, days=31)
    assert hourly(wh) != full[1]
    wh.recover()
    assert (fact_rows(wh), hourly(wh)) == full


def contents(wh):
    """Every table as rows, the states merged and loads left out."""
    fact = sorted(map(str, wh.read("fact_events").select(*FACT_COLUMNS).collect()))
    return fact, hourly(wh), *(sorted(map(str, wh.read(t).drop("load_id").collect())) for t in ("events_browser_raw", "dim_users"))


class Died(Exception):
    pass


def stops(monkeypatch, names=("create_once", "delete", "touch", "commit", "write_by_partition", "write_clustered")):
    """Counts the file operations of ``tables`` from now on; the one with the given number is the last to succeed."""
    state = {"done": 0, "last": None}

    def wrap(run):
        def counted(*args, **options):
            if state["last"] is not None and state["done"] >= state["last"]:
                raise Died
            state["done"] += 1
            return run(*args, **options)

        return counted

    for name in names:
        monkeypatch.setattr(tables, name, wrap(getattr(tables, name)))
    return state


def test_a_stop_after_any_file_operation_loses_nothing(spark, monkeypatch):
    """Loads, upkeep and reload, stopped after each of their file operations, then run again and compared by content."""
    days = ["2023-01-10", "2024-01-02", "2024-01-03"]

    def prepared():
        wh = Warehouse(spark, fresh_folder(spark, "stops"))
        for n, day in enumerate(days[:2]):
            wh.stage(BROWSER, staged(spark, BROWSER, [event(f"{n}{k}", ts=f"{day} 10:00:00", click=f"c{k}") for k in range(3)]), f"b{n}")
        wh.stage(DEVICE, staged(spark, DEVICE, [{"click_id": "c1", "user_domain_id": "u"}]), "b")
        wh.load("one", as_of=CLOCK)
        wh.stage(BROWSER, staged(spark, BROWSER, [event("x", ts=f"{days[2]} 10:00:00")]), "b2")
        return wh

    def work(wh):
        wh.load("two", as_of=CLOCK)
        wh.rebuild_dims()
        wh.compact()
        wh.backfill(DEVICE, staged(spark, DEVICE, [{"click_id": "c2", "user_domain_id": "v"}]))
        wh.ttl_expire("2024-01-05 12:00:00")

    whole = prepared()
    with monkeypatch.context() as patch:
        state = stops(patch)
        work(whole)
        operations = state["done"]
    expected = contents(whole)
    assert len(expected[0]) == 7 and operations > 25
    for last in sorted({1, operations // 5, operations // 2, operations * 4 // 5}):
        wh = prepared()
        with monkeypatch.context() as patch:
            state = stops(patch)
            state["last"] = last
            with pytest.raises(Died):
                work(wh)
        assert len(fact_rows(wh)) in (6, 7)  # readers see one state or the next
        wh.lease_seconds = 0
        work(wh)
        assert contents(wh) == expected, last
        wh.sweep(older_than=0)
        assert contents(wh) == expected, last


def test_a_load_that_runs_is_not_taken_for_one_that_died(wh, small_dir, full):
    stage_feeds(wh, small_dir)
    batches = wh.load_fact("a", as_of=CLOCK)
    with pytest.raises(lease.Busy):
        wh.load_fact("b", as_of=CLOCK)
    assert wh.finish_load("a", batches, as_of=CLOCK) == 1000
    assert wh.load("c", as_of=CLOCK) == 0
    assert (fact_rows(wh), hourly(wh)) == full


def test_a_load_that_was_taken_over_is_not_logged(wh, small_dir, full):
    stage_feeds(wh, small_dir)
    batches = wh.load_fact("a", as_of=CLOCK)
    wh.lease_seconds = 0
    wh.load_fact("b", as_of=CLOCK)  # takes a's lease, discards its rows, and dies
    with pytest.raises(lease.Lost):
        wh.finish_load("a", batches, as_of=CLOCK)
    assert wh.committed(["a", "b"]) == set()
    assert wh.load("c", as_of=CLOCK) == 1000
    assert (fact_rows(wh), hourly(wh)) == full


def test_a_load_whose_rows_are_gone_is_not_logged(wh, small_dir, full):
    stage_feeds(wh, small_dir)
    batches = wh.load_fact("a", as_of=CLOCK)
    tables.commit(wh.spark, wh.path("fact_events"), (), lambda folder: folder == wh.folders("fact_events")[0])
    with pytest.raises(wh_module.Incomplete):
        wh.finish_load("a", batches, as_of=CLOCK)
    assert wh.load("b", as_of=CLOCK) == 1000
    assert (fact_rows(wh), hourly(wh)) == full


def test_commits_at_the_same_time_all_count(spark):
    path = fresh_folder(spark, "pointer")
    side_by_side(lambda n: tables.commit(spark, path, [f"version={n}"], lambda folder: False), range(12), at_once=6)
    assert sorted(tables.live(spark, path)) == sorted(f"version={n}" for n in range(12))
    with pytest.raises(tables.Conflict):
        tables.commit(spark, path, ["version=x"], lambda folder: False, ["version=1", "version=gone"])
    assert "version=x" not in tables.live(spark, path)


def test_a_pointer_whose_writer_died_is_passed_over(spark, monkeypatch):
    path = fresh_folder(spark, "pointer")
    tables.commit(spark, path, ["version=a"], lambda folder: False)
    tables.create_once(spark, f"{path}/{tables.POINTER}/{2:012d}.json", '{"fold')
    assert tables.live(spark, path) == ("version=a",)
    monkeypatch.setattr(tables, "UNWRITTEN_SECONDS", 0)
    tables.commit(spark, path, ["version=b"], lambda folder: False)
    assert tables.live(spark, path) == ("version=a", "version=b")


def test_readers_keep_what_was_replaced_until_it_is_swept(wh, small_dir):
    two_loads(wh, small_dir)
    held = wh.read("fact_events")
    wh.compact()
    assert held.count() == 1000
    assert wh.sweep() == []
    assert wh.sweep(older_than=0)
    assert wh.read("fact_events").count() == 1000


def test_a_batch_staged_again_after_midnight_counts_once(wh):
    records = staged(wh.spark, BROWSER, [event("a")]).drop("inserted_at", "inserted_on")
    for clock in ("2024-01-30 23:59:00", "2024-01-31 00:01:00"):
        wh.stage(BROWSER, records, "7", as_of=clock)
    assert wh.read(BROWSER.table).count() == 1


def test_active_users_from_the_hourly_state(wh, small_dir):
    stage_feeds(wh, small_dir)
    wh.load("all", as_of=CLOCK)
    over_fact = reports.active_users_48h(wh.read("fact_events"), CLOCK)
    over_state = reports.active_users_48h(wh.read("agg_events_hourly"), CLOCK)
    columns = ("event_hour", "distinct_users")
    assert over_fact.count() > 0
    assert as_set(over_state, *columns) == as_set(over_fact, *columns)


def test_retention_counts_and_keeps_the_right_rows(wh, small_dir):
    stage_feeds(wh, small_dir)
    deleted = wh.retention_delete(CLOCK)
    assert deleted["events_browser_raw"] == 793
    for table in deleted:
        oldest = wh.read(table).agg(F.min("inserted_at")).first()[0]
        assert oldest >= moment("2024-01-24 00:00:00")
    assert set(wh.retention_delete(CLOCK).values()) == {0}


def test_retention_rewrites_the_boundary_day(wh):
    records = [event(str(h), inserted_at=f"2024-01-24 {h:02d}:30:00") for h in range(24)]
    wh.stage(BROWSER, staged(wh.spark, BROWSER, records), "b")
    assert wh.retention_delete("2024-01-31 12:00:00")["events_browser_raw"] == 12
    assert as_set(wh.read(BROWSER.table), "event_id") == sorted((str(h),) for h in range(12, 24))


def test_time_to_live_of_fact_and_states(wh):
    days = ["2023-01-10", "2023-01-20", "2023-06-01", "2024-01-05"]
    browser = [event(str(i), ts=f"{day} 10:00:00") for i, day in enumerate(days)]
    device = [{"click_id": "c1", "user_domain_id": "u"}]
    for feed, frame in zip(FEEDS.values(), feeds(wh.spark, browser, device)):
        wh.stage(feed, frame, "b")
    wh.load("l", as_of=CLOCK)
    deleted = wh.ttl_expire("2024-01-15 00:00:00")
    assert {deleted[t] for t in ("fact_events", "agg_events_hourly", "agg_traffic_sources")} == {1}
    assert as_set(wh.read("fact_events"), "event_id") == [("1",), ("2",), ("3",)]
    assert deleted["events_browser_raw"] == 3
    assert deleted["events_device_raw"] == 0
    ((user, _, first_seen, _, events, *_),) = dimensions(wh)[0]
    assert (user, first_seen, events) == ("u", moment("2023-01-20 10:00:00"), 3)


def test_refresh_runs_everything_in_order(wh, small_dir):
    stage_feeds(wh, small_dir)
    rows = {r["table_name"]: r["rows"] for r in wh.refresh("night-1", as_of=CLOCK).collect()}
    assert rows == {
        "fact_events": 1000,
        "dim_users": 15,
        "dim_geo": 15,
        "agg_events_hourly": 1000,
        "agg_traffic_sources": 835,
    }
    assert wh.read(BROWSER.table).count() == 1000 - 793


def test_summary_of_an_empty_warehouse_warns(wh):
    status = {r["table_name"]: r["status"] for r in wh.dwh_summary().collect()}
    assert status["fact_events"] == "warning"
    assert status["dim_users"] == "passed"


def test_events_without_a_time_are_kept(wh):
    for feed, frame in zip(FEEDS.values(), feeds(wh.spark, [event("a", ts=None), event("b")])):
        wh.stage(feed, frame, "b")
    assert wh.load("l", as_of=CLOCK) == 2
    wh.compact()
    assert wh.read("fact_events").count() == 2


def test_backfill_is_loaded_again_but_adds_only_new_events(wh):
    browser, *rest = feeds(wh.spark, [event("a")])
    for feed, frame in zip(FEEDS.values(), (browser, *rest)):
        wh.stage(feed, frame, "b")
    wh.load("one", as_of=CLOCK)
    wh.backfill(BROWSER, staged(wh.spark, BROWSER, [event("a"), event("c")]))
    assert wh.load("two", as_of=CLOCK) == 1
    assert as_set(wh.read("fact_events"), "event_id") == [("a",), ("c",)]


@pytest.mark.parametrize("bad", ["a/b", "a b", "", wh_module.MERGED])
def test_unusable_load_ids(wh, bad):
    with pytest.raises(ValueError):
        wh.load(bad)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(cuts=st.lists(st.integers(0, 3), min_size=1000, max_size=1000))
def test_states_merge_the_same_however_events_are_split(spark, small_dir, cuts):
    feeds_ = [build(spark, small_dir) for build in fixtures.FEED_BUILDERS.values()]
    part = spark.createDataFrame([(str(i), c) for i, c in enumerate(cuts)], "event_id string, part int")
    fact = fact_events(*feeds_).join(part, "event_id")
    whole = rollups.merge(rollups.hourly_state(fact), ["event_type", "utm_source"])
    parts = None
    for n in range(4):
        state = rollups.hourly_state(fact.filter(F.col("part") == n))
        parts = state if parts is None else parts.unionByName(state)
    merged = rollups.merge(parts, ["event_type", "utm_source"])
    collapsed = rollups.merge(rollups.collapse(parts, HOURLY_KEYS), ["event_type", "utm_source"])
    expected = sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, merged.collect())) == expected
    assert sorted(map(tuple, collapsed.collect())) == expected


def test_deduplicating_a_table_rewrites_only_months_with_repeats(wh):
    rows = [("a", "2024-01-05"), ("a", "2024-02-05"), ("b", "2024-02-06"), ("c", "2024-03-01"), ("", "2024-02-07"), ("", "2024-02-07")]
    events = [event(key, ts=f"{day} 10:00:00") for key, day in rows]
    wh.stage(BROWSER, staged(wh.spark, BROWSER, events), "b0")
    wh.load("one", dedup=False)
    before = set(wh.folders("fact_events"))
    assert wh.deduplicate("fact_events", "event_id") == 1
    kept = wh.read("fact_events")
    assert as_set(kept, "event_id", "event_timestamp") == [
        ("", moment("2024-02-07 10:00:00")),
        ("", moment("2024-02-07 10:00:00")),
        ("a", moment("2024-02-05 10:00:00")),
        ("b", moment("2024-02-06 10:00:00")),
        ("c", moment("2024-03-01 10:00:00")),
    ]
    same = before & set(wh.folders("fact_events"))
    assert [f.split("/")[0] for f in same] == ["event_month=202403"]
    assert sum(n for *_, n in as_set(rollups.merge(wh.read("agg_events_hourly"), HOURLY_KEYS), "event_hour", "total_events")) == 5
    assert wh.deduplicate("fact_events", "event_id") == 0


def test_deduplicating_leaves_loads_that_run_alone(wh):
    wh.stage(BROWSER, staged(wh.spark, BROWSER, [event("a"), event("a")]), "b0")
    batches = wh.load_fact("one", dedup=False)
    assert wh.deduplicate("fact_events", "event_id") == 0
    assert wh.finish_load("one", batches) == 2
    assert wh.deduplicate("fact_events", "event_id") == 1


def test_deduplicating_a_feed_keeps_the_latest_row(wh):
    for n, os in enumerate(["old", "new"]):
        records = [{"click_id": "c", "os": os}, {"click_id": f"d{n}", "os": os}]
        wh.stage(DEVICE, staged(wh.spark, DEVICE, records, inserted_at=f"2024-01-0{n + 1} 00:00:00"), f"b{n}")
    assert wh.deduplicate(DEVICE.table, "click_id", "inserted_at") == 1
    assert as_set(wh.read(DEVICE.table), "click_id", "os") == [("c", "new"), ("d0", "old"), ("d1", "new")]


def test_deduplicating_an_empty_table(wh):
    assert wh.deduplicate("fact_events", "event_id") == 0


def test_filters_on_states_name_the_column_they_lack(wh):
    with pytest.raises(ValueError, match="geo_country"):
        dashboard_filters(wh.read("agg_traffic_sources"), {"geo_country": "FRANCE"})


def test_a_month_that_expires_whole_leaves_the_dimensions(wh):
    for n, day in enumerate(["2023-01-05", "2024-01-05"]):
        wh.stage(BROWSER, staged(wh.spark, BROWSER, [event(str(n), ts=f"{day} 10:00:00", click=f"c{n}")]), f"b{n}")
        wh.stage(DEVICE, staged(wh.spark, DEVICE, [{"click_id": f"c{n}", "user_domain_id": f"u{n}"}]), f"b{n}")
        wh.load(f"l{n}")
    wh.rebuild_dims()
    assert as_set(wh.read("dim_users"), "user_domain_id") == [("u0",), ("u1",)]
    wh.ttl_expire("2024-06-01 00:00:00")
    wh.rebuild_dims()
    assert as_set(wh.read("dim_users"), "user_domain_id") == [("u1",)]
