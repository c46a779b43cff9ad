"""Data-quality checks. Each returns rows; ``dq_report`` runs them all and scores the result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.clock import age_hours
from footfall.functions.values import is_blank
from footfall.operators.dedup import key_counts
from footfall.operators.filters import contradicts
from footfall.operators.joins import orphan_count, tallies, unmatched

# Hours before data counts as stale, reported duplicate keys and samples, tolerated issues.
STALE_HOURS = 2
DUPLICATE_CAP = 10
DUPLICATE_SAMPLES = 5
MAX_ISSUES = 10

FACT_KEYS = ("event_id", "event_timestamp", "click_id")
USER_KEYS = ("user_domain_id",)


class QualityError(RuntimeError):
    """More issues than tolerated."""


def _status(count: Column) -> Column:
    return F.when(count == 0, "passed").otherwise("warning")


def dq_freshness(fact: DataFrame, as_of=None) -> DataFrame:
    """Age of the newest event: failed above two hours, warning for an empty fact."""
    newest = fact.agg(F.max("event_timestamp").alias("latest_ts"))
    return newest.withColumn("age_hours", age_hours("latest_ts", as_of)).withColumn(
        "status", _freshness_status(F.col("age_hours"))
    )


def _freshness_status(age: Column) -> Column:
    return F.when(age.isNull(), "warning").when(age > STALE_HOURS, "failed").otherwise("passed")


def _blank_counts(df: DataFrame, columns) -> list[Column]:
    return [F.count_if(is_blank(df, c)).alias(f"blank_{c}") for c in columns]


def _null_rows(counts: DataFrame, table: str, columns) -> DataFrame:
    """One row per checked column from the one-row counts."""
    cells = ", ".join(f"'{c}', blank_{c}" for c in columns)
    long = counts.selectExpr("total_count", f"stack({len(columns)}, {cells}) as (column_name, null_count)")
    share = F.when(F.col("total_count") > 0, F.col("null_count") / F.col("total_count") * 100).otherwise(F.lit(0.0))
    return long.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "null_count",
        "total_count",
        share.alias("null_percent"),
        _status(F.col("null_count")).alias("status"),
    )


def dq_nulls(fact: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Blank key columns: one scan per table."""
    parts = []
    for table, df, columns in (("fact_events", fact, FACT_KEYS), ("dim_users", dim_users, USER_KEYS)):
        counts = df.agg(F.count(F.lit(1)).alias("total_count"), *_blank_counts(df, columns))
        parts.append(_null_rows(counts, table, columns))
    return parts[0].unionByName(parts[1])


def dq_duplicates(fact: DataFrame) -> DataFrame:
    """Repeated event ids: the capped count, the true count beside it, and the first few ids."""
    repeated = key_counts(fact, "event_id")
    first = repeated.orderBy("event_id").limit(DUPLICATE_SAMPLES).agg(
        F.concat_ws(",", F.sort_array(F.collect_list("event_id"))).alias("samples")
    )
    counted = repeated.agg(F.count(F.lit(1)).alias("true_count"))
    return counted.select(
        F.when(F.col("true_count") > 0, "failed").otherwise("passed").alias("status"),
        F.least("true_count", F.lit(DUPLICATE_CAP)).cast("bigint").alias("duplicate_count"),
        "true_count",
        first.scalar().alias("samples"),
    )


def _check(counted: DataFrame, name: str) -> DataFrame:
    return counted.select(F.lit(name).alias("check_name"), "count", _status(F.col("count")).alias("status"))


def dq_orphans_browser(browser: DataFrame, fact: DataFrame) -> DataFrame:
    return _check(orphan_count(browser, fact, "event_id"), "browser_events_orphaned")


def dq_orphans_device(device: DataFrame, fact: DataFrame) -> DataFrame:
    return _check(orphan_count(device, fact, "click_id"), "device_events_orphaned")


def _missing_location(fact: DataFrame) -> Column:
    return is_blank(fact, "page_url")


def dq_missing_location(fact: DataFrame) -> DataFrame:
    return _check(fact.agg(F.count_if(_missing_location(fact)).alias("count")), "missing_location_data")


def _wrong_device() -> Column:
    return contradicts("device_is_mobile", "device_type", "Mobile")


def dq_device_consistency(fact: DataFrame) -> DataFrame:
    return _check(fact.agg(F.count_if(_wrong_device()).alias("count")), "device_type_inconsistency")


def dq_report(tables: Mapping[str, DataFrame], as_of=None) -> DataFrame:
    """All checks as (check_name, object, count, status) and a summary row with the number of issues.

    Checks of the fact's own columns share one scan, and repeated and orphaned keys one aggregation over all ids.
    """
    fact, users = tables["fact_events"], tables["dim_users"]
    scan = fact.agg(
        F.max("event_timestamp").alias("latest"),
        *_blank_counts(fact, FACT_KEYS),
        F.count_if(_missing_location(fact)).alias("missing_location"),
        F.count_if(_wrong_device()).alias("wrong_device"),
    )
    fresh = _freshness_status(age_hours("latest", as_of))
    rows = [
        ("freshness", "fact_events", F.lit(None).cast("bigint"), fresh),
        *[(f"null_{c}", "fact_events", F.col(f"blank_{c}"), _status(F.col(f"blank_{c}"))) for c in FACT_KEYS],
        ("missing_location_data", "fact_events", F.col("missing_location"), _status(F.col("missing_location"))),
        ("device_type_inconsistency", "fact_events", F.col("wrong_device"), _status(F.col("wrong_device"))),
    ]
    line = [
        F.struct(
            F.lit(name).alias("check_name"), F.lit(table).alias("object"), count.alias("count"), status.alias("status")
        )
        for name, table, count, status in rows
    ]
    checks = scan.select(F.explode(F.array(*line)).alias("c")).select("c.*")

    def labelled(counted: DataFrame, name: str, table: str, status: Column) -> DataFrame:
        return counted.select(F.lit(name).alias("check_name"), F.lit(table).alias("object"), "count", status.alias("status"))

    warn = _status(F.col("count"))
    blank_users = users.agg(F.count_if(is_blank(users, "user_domain_id")).alias("count"))
    checks = checks.unionByName(labelled(blank_users, "null_user_domain_id", "dim_users", warn))
    return _scored(checks.unionByName(_key_checks(fact, tables["events_browser_raw"], tables["events_device_raw"])))


def _key_checks(fact: DataFrame, browser: DataFrame, device: DataFrame) -> DataFrame:
    """Repeated event ids of the fact and staged keys that it lacks: three scans, one shuffle of ids."""
    per_key = tallies(
        [
            (fact, "event_id", "loaded", "event"),
            (fact, "click_id", "loaded", "click"),
            (browser, "event_id", "staged", "event"),
            (device, "click_id", "staged", "click"),
        ],
        ("loaded", "staged"),
    )
    event = F.col("kind") == "event"
    counts = per_key.agg(
        F.count_if(event & (F.col("loaded") > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(event, unmatched())), F.lit(0)).alias("browser"),
        F.coalesce(F.sum(F.when(~event, unmatched())), F.lit(0)).alias("device"),
    )
    failed = F.when(F.col("repeated") > 0, "failed").otherwise("passed")
    rows = [
        ("duplicate_event_ids", "fact_events", "repeated", failed),
        ("browser_events_orphaned", "events_browser_raw", "browser", _status(F.col("browser"))),
        ("device_events_orphaned", "events_device_raw", "device", _status(F.col("device"))),
    ]
    line = [
        F.struct(F.lit(n).alias("check_name"), F.lit(t).alias("object"), F.col(c).alias("count"), s.alias("status"))
        for n, t, c, s in rows
    ]
    return counts.select(F.inline(F.array(*line)))


def _scored(checks: DataFrame) -> DataFrame:
    """The checks and, as one more grouped row, how many of them count as an issue."""
    # A stale fact is an issue, an empty one only a warning.
    issue = F.when(F.col("check_name") == "freshness", F.col("status") == "failed").otherwise(
        F.col("status") != "passed"
    )
    lines = F.explode(F.array(F.lit(False), F.lit(True)))
    both = checks.withColumn("issue", issue).withColumn("summary", lines)
    keep = {c: F.when(~F.col("summary"), F.col(c)) for c in ("check_name", "object", "status")}
    grouped = both.groupBy("summary", *[e.alias(c) for c, e in keep.items()]).agg(
        F.max("count").alias("count"), F.count_if("issue").alias("issues")
    )
    overall = F.when(F.col("issues") == 0, "passed").otherwise("failed")
    return grouped.select(
        F.when(F.col("summary"), "overall").otherwise(F.col("check_name")).alias("check_name"),
        F.when(F.col("summary"), "all").otherwise(F.col("object")).alias("object"),
        F.when(F.col("summary"), F.col("issues")).otherwise(F.col("count")).alias("count"),
        F.when(F.col("summary"), overall).otherwise(F.col("status")).alias("status"),
    )


def raise_on_issues(report: DataFrame, max_issues: int = MAX_ISSUES) -> int:
    """The number of issues; an error above ``max_issues``. The checks here can find ten at most."""
    issues = report.filter(F.col("check_name") == "overall").first()["count"]
    if issues > max_issues:
        raise QualityError(f"{issues} data-quality issues, {max_issues} tolerated")
    return issues
