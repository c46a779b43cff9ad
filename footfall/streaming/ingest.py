"""Topics to staging: bounded drains that resume where the last one stopped."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.plans.warehouse import Warehouse
from footfall.schemas import FEEDS, Feed
from footfall.sources import tables
from footfall.sources.messages import accepted, outcome_counts, parse_lines, quarantined

QUARANTINE = "quarantine"


def drop_repeats(records: DataFrame, feed: Feed, delay: str) -> DataFrame:
    """Records that did not arrive, equal in every column of the feed, within ``delay`` before; a changed row of a key
    and every line that cannot be loaded are kept. The event time here is the arrival time, which only grows, so that
    no late event is ever dropped; repeats further apart are left to the fact build."""
    arrived = records.withColumn("_arrived", F.col("inserted_at").cast("timestamp"))
    arrived = arrived.withColumn("_own", F.when(F.col("problem").isNotNull(), F.uuid()))
    same = [*feed.columns, "_own"]
    return arrived.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(same).drop("_arrived", "_own")


def ingest_stream(
    lines: DataFrame,
    feed: Feed,
    warehouse: Warehouse,
    checkpoint: str,
    *,
    as_of=None,
    dedup_within: str | None = None,
    run_id: str | None = None,
) -> StreamingQuery:
    """Drain what a topic holds into its staging table, and lines that cannot be loaded into quarantine.

    The checkpoint is the consumer's position. A micro-batch repeated after a failure replaces its own
    partitions, so no failure stores a message twice. Checkpoint and tables belong together: reset both or neither.
    Each batch enters the ingest log under ``run_id`` with its counts; repeats that ``dedup_within`` drops are in none.
    """
    run_id = run_id or uuid4().hex[:12]
    parsed = tables.stamp_insert_time(parse_lines(lines, feed), as_of)
    if dedup_within:
        parsed = drop_repeats(parsed, feed, dedup_within)

    def store(batch: DataFrame, batch_id: int) -> None:
        # Parsed once for both tables, and stored: one micro-batch is as large as the source's limit per trigger, which no
        # executor's memory holds. The text of a line is kept where it cannot be loaded. The same batch again replaces it.
        scratch = f"{tables.beside(warehouse.path(feed.table), tables.STAGED)}-batch-{batch_id}"
        found = batch.withColumn("value", F.when(F.col("problem").isNotNull(), F.col("value")))
        try:
            found.write.mode("overwrite").parquet(scratch)
            rows = tables.read(warehouse.spark, scratch, found.schema)
            warehouse.stage(feed, accepted(rows, feed, keep=["inserted_at"]), str(batch_id))
            rejected = quarantined(rows, feed).withColumn("batch_id", F.lit(str(batch_id)))
            tables.write_by_partition(rejected, warehouse.path(QUARANTINE), ["topic", "batch_id"])
            # Counted over the stored parse, not observed in the write: a map task that runs again would count twice.
            warehouse.log_batch(feed, rows.agg(*outcome_counts("consumed")), str(batch_id), run_id)
        finally:
            tables.delete(warehouse.spark, scratch)

    writer = parsed.writeStream.trigger(availableNow=True)
    return writer.option("checkpointLocation", f"{checkpoint}/{feed.topic}").foreachBatch(store).start()


def ingest_topics(sources: Mapping[str, DataFrame], warehouse: Warehouse, checkpoint: str, **options) -> str:
    """Drain several topics at the same time and wait for all of them; the run's id in the ingest log."""
    options = {**options, "run_id": options.get("run_id") or uuid4().hex[:12]}
    running = [ingest_stream(lines, FEEDS[name], warehouse, checkpoint, **options) for name, lines in sources.items()]
    for query in running:
        query.awaitTermination()
    return options["run_id"]
