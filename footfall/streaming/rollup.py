"""The hourly aggregate kept up to date by a stream of finished loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.rollups import hourly_state
from footfall.plans.warehouse import LAYOUTS, Warehouse
from footfall.schemas import HOURLY_STATE_SCHEMA, LOAD_LOG_SCHEMA
from footfall.sources import tables


def finished_loads(spark: SparkSession, warehouse: Warehouse, at_once: int = 100) -> DataFrame:
    """Entries of the load log as they are added, from at most ``at_once`` files a batch. Upkeep that writes the log
    anew shows entries again; they say the same."""
    source = spark.readStream.schema(LOAD_LOG_SCHEMA).option("maxFilesPerTrigger", at_once)
    return source.parquet(warehouse.path("load_log"))


def stream_hourly_rollup(warehouse: Warehouse, state_path: str, checkpoint: str) -> StreamingQuery:
    """Each finished load adds its partial state, once, whatever upkeep does to fact and log in between.

    A load is read from the folders it has written, as its log entry names them; they are kept for a while after
    compaction has replaced them. A load that arrives again replaces its own state.
    """
    spark, layout = warehouse.spark, LAYOUTS["fact_events"]

    def add_partials(batch: DataFrame, batch_id: int) -> None:
        loads = batch.select("load_id", "folders").dropDuplicates(["load_id"]).collect()  # one row for each load
        logged = warehouse.committed([load_id for load_id, _ in loads])  # a log entry whose writer died says nothing
        state = None
        for load_id, folders in loads:
            if load_id not in logged:
                continue
            gone = [f for f in folders or () if not tables.exists(spark, f"{warehouse.path('fact_events')}/{f}")]
            if gone:
                raise LookupError(f"load {load_id} was swept before it was streamed: {gone[:2]}")
            rows = tables.read(spark, warehouse.path("fact_events"), layout.schema, folders or ())
            part = hourly_state(rows).withColumn("load_id", F.lit(f"stream-{load_id}"))
            state = part if state is None else state.unionByName(part)
        if state is not None:
            rows = tables.with_month(state, "event_hour").select(*HOURLY_STATE_SCHEMA.fieldNames())
            tables.write_by_partition(rows, state_path, ["event_month", "load_id"])

    stream = finished_loads(spark, warehouse)
    return stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(add_partials).start()
