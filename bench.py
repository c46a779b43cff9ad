"""Times every registered query and prints one JSON line.

BENCH_SF_DIR is the folder of test tables, BENCH_CPUS the cores. ``queries`` holds the warm seconds of each
query: building its plan, running any job it consists of, and computing every result row. ``cold`` holds the
first run, which for some includes deriving the shared stored inputs. ``replicated`` times three queries over
the fact's events repeated BENCH_COPIES times; 0 leaves them out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from footfall import registry  # noqa: E402
from footfall.operators import rollups  # noqa: E402
from footfall.plans import reports  # noqa: E402
from footfall.plans.fact import fact_events  # noqa: E402
from footfall.plans.warehouse import STAGING_TABLES  # noqa: E402
from footfall.registry import inputs  # noqa: E402
from footfall.workspace import fresh_folder  # noqa: E402


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def copies(df: DataFrame, n: int, *ids: str) -> DataFrame:
    """``df`` repeated ``n`` times with ids of its own in each repetition."""
    repeated = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n))))
    renamed = {c: F.concat(c, F.lit("#"), F.col("copy").cast("string")) for c in ids}
    return repeated.withColumns(renamed).drop("copy")


def replicated(spark: SparkSession, sf_dir: str, n: int) -> dict[str, float]:
    wh, root = inputs.staging(spark, sf_dir), fresh_folder(spark, "copies")
    for table, ids in zip(STAGING_TABLES, (("event_id", "click_id"), ("click_id",), ("click_id",), ("event_id",))):
        copies(wh.read(table).drop("batch_id", "inserted_on", "event_month"), n, *ids).write.parquet(f"{root}/{table}")
    feeds = [spark.read.parquet(f"{root}/{table}") for table in STAGING_TABLES]
    seconds = {"fact_events": timed(lambda: fact_events(*feeds))}
    fact_events(*feeds).write.parquet(f"{root}/fact")
    fact = spark.read.parquet(f"{root}/fact")
    rollups.hourly_state(fact).write.parquet(f"{root}/state")
    state = spark.read.parquet(f"{root}/state")
    seconds["rollup_merge"] = timed(lambda: rollups.merge(state, ["event_type", "utm_source"]))
    seconds["user_journey"] = timed(lambda: reports.user_journey(fact))
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    n = int(os.environ.get("BENCH_COPIES", "50"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("footfall-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm, failed = {}, {}, {}
    for name, query in registry.queries().items():
        try:
            cold[name] = timed(lambda: query(spark, sf_dir))
            warm[name] = timed(lambda: query(spark, sf_dir))
        except Exception as error:  # a failing query must not hide the times of the others
            failed[name] = str(error)[:200]
    result = {
        "metric": "total_warm_seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if n:
        result["replicated"] = {"copies": n, **replicated(spark, sf_dir, n)}
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
