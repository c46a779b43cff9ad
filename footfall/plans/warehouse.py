"""The stored warehouse: where its tables are, how a load enters it, and its upkeep.

Every load has an id, and its fact rows and its state rows carry it. The load log names the loads that are stored in
full. What a load that failed midway has written is removed by the next load, under the same id or another, which
reads its batches again: nothing is counted twice or lost. Loads run one after the other: each holds the warehouse's
lease, and none is logged unless it still has it and the fact holds as many rows as it wrote.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import schemas
from footfall.functions.clock import before, event_month, moment
from footfall.operators import rollups
from footfall.operators.dedup import key_counts, latest_per_key
from footfall.operators.sieve import thinned
from footfall.plans import dims, lease
from footfall.plans.fact import SIDES, fact_events, lacks_side, late_rows, repair_fact
from footfall.sources import tables
from footfall.workspace import side_by_side

# A month of finished loads is worth merging in a regular run from this many files on.
SMALL_FILES = 100

# Folder of notes: the loads that have written their fact rows and not yet their entry in the load log.
_LOADS = "_loads"

# Seconds without a sign of life after which a load counts as dead, and for which replaced folders are kept.
LEASE_SECONDS = 6 * 3600
KEEP_SECONDS = 7 * 24 * 3600

# Folder of notes: months whose fact was repaired and whose states are still to be rebuilt.
_REPAIRED = "_repaired_months"

# Load id of rows that upkeep has merged; their loads are complete and never run again.
MERGED = "merged"


@dataclass(frozen=True)
class Layout:
    """How one table is stored."""

    schema: T.StructType
    partitions: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()
    expires_by: str | None = None
    expires_after_days: int | None = None


LAYOUTS: dict[str, Layout] = {
    **{
        feed.table: Layout(feed.stored_schema, feed.partitions, feed.sort, feed.ttl_column, schemas.STAGING_TTL_DAYS)
        for feed in schemas.FEEDS.values()
    },
    "fact_events": Layout(
        schemas.FACT_SCHEMA,
        schemas.FACT_PARTITIONS,
        schemas.FACT_SORT,
        "event_timestamp",
        schemas.WAREHOUSE_TTL_DAYS,
    ),
    "dim_users": Layout(schemas.DIM_USERS_SCHEMA, sort=("user_domain_id",)),
    "dim_geo": Layout(schemas.DIM_GEO_SCHEMA, sort=("geo_id",)),
    "agg_events_hourly": Layout(
        schemas.HOURLY_STATE_SCHEMA,
        schemas.FACT_PARTITIONS,
        tuple(schemas.HOURLY_KEYS),
        "event_hour",
        schemas.WAREHOUSE_TTL_DAYS,
    ),
    "agg_traffic_sources": Layout(
        schemas.TRAFFIC_STATE_SCHEMA,
        schemas.FACT_PARTITIONS,
        tuple(schemas.TRAFFIC_KEYS),
        "date",
        schemas.WAREHOUSE_TTL_DAYS,
    ),
    "dim_users_state": Layout(
        schemas.DIM_USERS_STATE_SCHEMA, schemas.FACT_PARTITIONS, tuple(schemas.USER_KEYS)
    ),
    "dim_geo_state": Layout(schemas.DIM_GEO_STATE_SCHEMA, schemas.FACT_PARTITIONS, tuple(schemas.GEO_KEYS)),
    "load_log": Layout(schemas.LOAD_LOG_SCHEMA),
    "ingest_log": Layout(schemas.INGEST_LOG_SCHEMA, schemas.INGEST_LOG_PARTITIONS),
}

STAGING_TABLES = tuple(feed.table for feed in schemas.FEEDS.values())
DWH_TABLES = ("fact_events", "dim_users", "dim_geo", "agg_events_hourly", "agg_traffic_sources")
STATE_KEYS = {"agg_events_hourly": schemas.HOURLY_KEYS, "agg_traffic_sources": schemas.TRAFFIC_KEYS}


@dataclass(frozen=True)
class State:
    """A table of partials: how fact rows become partials, and partials of one month one row per key."""

    build: Callable[[DataFrame], DataFrame]
    collapse: Callable[[DataFrame], DataFrame]


STATES: dict[str, State] = {
    "agg_events_hourly": State(
        lambda fact: tables.with_month(rollups.hourly_state(fact), "event_hour"),
        lambda partials: rollups.collapse(partials, schemas.HOURLY_KEYS),
    ),
    "agg_traffic_sources": State(
        lambda fact: tables.with_month(rollups.traffic_state(fact), "date"),
        lambda partials: rollups.collapse(partials, schemas.TRAFFIC_KEYS),
    ),
    "dim_users_state": State(dims.users_state, dims.collapse_users),
    "dim_geo_state": State(dims.geo_state, dims.collapse_geo),
}


_ID = re.compile(r"[A-Za-z0-9_.-]+")


def _checked_id(value: str) -> str:
    """Load and batch ids are folder names, so only characters that need no escaping."""
    if not _ID.fullmatch(value):
        raise ValueError(f"not usable as an id: {value!r}")
    return value


def _value(folder: str, column: str) -> str:
    """The value of a partition column in a folder's name."""
    return next(part.split("=", 1)[1] for part in folder.split("/") if part.startswith(f"{column}="))


class Incomplete(RuntimeError):
    """The fact does not hold the rows a load wrote; the load is not logged, and its batches are read again."""


class Warehouse:
    """The tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, lease_seconds: float = LEASE_SECONDS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.lease_seconds = lease_seconds

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        return tables.read(self.spark, self.path(table), LAYOUTS[table].schema)

    def folders(self, table: str) -> tuple[str, ...]:
        """The folders that hold a table now."""
        return tables.live(self.spark, self.path(table))

    def stored(self, table: str) -> bool:
        return bool(self.folders(table))

    # Staging

    def stage(self, feed: schemas.Feed, records: DataFrame, batch_id: str, as_of=None) -> None:
        """Add one batch of records to a staging table; the same batch again replaces itself, whatever its day.

        A batch is staged once its last row is written, and not before.
        """
        rows = self._staged_rows(feed, records, batch_id, as_of)
        same = lambda folder: _value(folder, "batch_id") == batch_id
        tables.put(rows, self.path(feed.table), feed.partitions, feed.sort, drop=same)

    def log_batch(self, feed: schemas.Feed, counts: DataFrame, batch_id: str, run_id: str) -> None:
        """Enter a micro-batch's counts, one row, into the ingest log; the same batch again replaces its entry."""
        entry = counts.withColumns({"topic": F.lit(feed.topic), "batch_id": F.lit(_checked_id(batch_id))})
        entry = entry.withColumns({"run_id": F.lit(run_id), "stored_at": F.current_timestamp()})
        mine = f"topic={feed.topic}/batch_id={batch_id}/"
        layout = LAYOUTS["ingest_log"]
        rows = tables.conform(entry, layout.schema)
        tables.put(rows, self.path("ingest_log"), layout.partitions, drop=lambda folder: folder.startswith(mine))

    def backfill(self, feed: schemas.Feed, records: DataFrame, as_of=None) -> None:
        """Replace a staging table by ``records``, as a batch no load has covered."""
        rows = self._staged_rows(feed, records, f"backfill-{uuid4().hex[:12]}", as_of)
        tables.truncate_reload(rows, self.path(feed.table), feed.stored_schema, feed.partitions, feed.sort)

    def _staged_rows(self, feed: schemas.Feed, records: DataFrame, batch_id: str, as_of) -> DataFrame:
        rows = records if "inserted_at" in records.columns else tables.stamp_insert_time(records, as_of)
        rows = rows.withColumn("inserted_on", F.to_date("inserted_at"))
        rows = rows.withColumn("batch_id", F.lit(_checked_id(batch_id)))
        if "event_month" in feed.partitions:
            rows = tables.with_month(rows)
        return tables.conform(rows, feed.stored_schema)

    # Loads

    def committed(self, load_ids: Sequence[str]) -> set[str]:
        """Those of ``load_ids`` that are stored in full."""
        log = self.read("load_log").filter(F.col("load_id").isin(list(load_ids))).select("load_id").distinct()
        return {row["load_id"] for row in log.collect()}

    def load(self, load_id: str, *, dedup: bool = True, as_of=None) -> int:
        """Bring the staged events the fact lacks into the fact and both states; the number of rows added."""
        if _checked_id(load_id) == MERGED:
            raise ValueError(f"{MERGED} is reserved")
        self.recover()
        if self.committed([load_id]):
            return 0
        batches = self.load_fact(load_id, dedup=dedup, as_of=as_of)
        return self.finish_load(load_id, batches, as_of=as_of)

    def open_batches(self) -> list[str]:
        """Staged browser batches that no finished load covers."""
        staged = {_value(f, "batch_id") for f in self.folders(schemas.BROWSER.table)}
        covered = self.read("load_log").select(F.explode("batches").alias("batch_id"))
        seen = covered.filter(F.col("batch_id").isin(list(staged))).distinct().collect() if staged else []
        return sorted(staged - {row["batch_id"] for row in seen})

    def load_fact(self, load_id: str, *, dedup: bool = True, as_of=None) -> list[str]:
        """First half of a load: takes the lease and writes the new fact rows; the batches covered.

        Batches of finished loads are not read again. Once there is a fact, the other feeds and the fact's ids are
        thinned out by bitmaps of this load's keys, so that hardly a row without such a key is shuffled.
        A failure gives the lease back; what was written is discarded by the next load.
        """
        token = lease.acquire(self.spark, self.root, load_id, self.lease_seconds)
        try:
            self.discard_unfinished()
            batches = self.open_batches()
            browser, *sides = [self.read(table) for table in STAGING_TABLES]
            browser = browser.filter(F.col("batch_id").isin(batches))
            others = None
            if self.stored("fact_events"):
                others = self.read("fact_events").filter(F.col("load_id") != load_id)
                keys = [feed.key for feed in list(schemas.FEEDS.values())[1:]]
                sides = [thinned(s, browser, k) for s, k in zip(sides, keys)]
            new = fact_events(browser, *sides, others, dedup=dedup, as_of=as_of)
            lease.renew(self.spark, self.root, token)
            added = self._write("fact_events", tables.with_month(new).withColumn("load_id", F.lit(load_id)))
            rows = tables.read(self.spark, self.path("fact_events"), LAYOUTS["fact_events"].schema, added).count()
            tables.delete(self.spark, self._note(load_id))
            tables.create_once(self.spark, self._note(load_id), json.dumps({"token": token, "rows": rows}))
            return batches
        except BaseException:
            lease.release(self.spark, self.root, token)
            raise

    def _note(self, load_id: str) -> str:
        return f"{self.root}/{_LOADS}/{load_id}.json"

    def finish_load(self, load_id: str, batches: Sequence[str], *, as_of=None) -> int:
        """Second half: the states of the load's stored fact rows, then the entry in the load log.

        ``lease.Lost`` if another load has taken over, ``Incomplete`` if rows are not there: then nothing is logged.
        """
        told = tables.text_of(self.spark, self._note(load_id))
        if told is None:
            raise lease.Lost(f"load {load_id} has not written its fact rows, or another load has discarded them")
        token, written = json.loads(told)["token"], json.loads(told)["rows"]
        try:
            lease.renew(self.spark, self.root, token)
            mine = [f for f in self.folders("fact_events") if _value(f, "load_id") == load_id]
            facts = tables.read(self.spark, self.path("fact_events"), LAYOUTS["fact_events"].schema, mine)

            def write_state(table: str) -> None:
                rows = STATES[table].build(facts).withColumn("load_id", F.lit(load_id))
                self._write(table, rows, drop=lambda folder: _value(folder, "load_id") == load_id)

            side_by_side(write_state, STATES)
            rows = facts.count()
            if rows != written:
                raise Incomplete(f"load {load_id} wrote {written} rows, the fact holds {rows}")
            entry = self.spark.range(1).select(
                F.lit(load_id).alias("load_id"),
                F.lit(rows).alias("rows"),
                moment(as_of).alias("committed_at"),
                F.array(*[F.lit(b) for b in batches]).cast("array<string>").alias("batches"),
                F.array(*[F.lit(f) for f in mine]).cast("array<string>").alias("folders"),
            )
            lease.renew(self.spark, self.root, token)
            tables.append_batch(entry, self.path("load_log"), schemas.LOAD_LOG_SCHEMA)
            tables.delete(self.spark, self._note(load_id))
            return rows
        finally:
            lease.release(self.spark, self.root, token)

    def discard_unfinished(self) -> None:
        """Remove the rows of every load that died, whatever its id: the next load reads their batches again.

        For the holder of the lease only: to anyone else a load that runs looks like one that died.
        """
        held = {t: {_value(f, "load_id") for f in self.folders(t)} - {MERGED} for t in ("fact_events", *STATES)}
        ids = set().union(*held.values())
        dead = ids - self.committed(sorted(ids)) if ids else set()
        for table in (*STATES, "fact_events"):
            if held[table] & dead:
                tables.commit(self.spark, self.path(table), (), lambda folder: _value(folder, "load_id") in dead)
        for load_id in dead:
            tables.delete(self.spark, self._note(load_id))

    def _write(self, table: str, rows: DataFrame, **options) -> list[str]:
        layout = LAYOUTS[table]
        ordered = rows.select(*layout.schema.fieldNames())
        return tables.put(ordered, self.path(table), layout.partitions, layout.sort, **options)

    def refresh(self, load_id: str, *, dedup: bool = True, as_of=None) -> DataFrame:
        """One whole run: load, time-to-live, dimensions, compaction, and only then the staging clear-out; the summary."""
        self.load(load_id, dedup=dedup, as_of=as_of)
        self.ttl_expire(as_of)
        self.rebuild_dims()
        self.compact(max_files=SMALL_FILES)
        self.retention_delete(as_of)
        self.sweep()
        return self.dwh_summary()

    # Dimensions

    def rebuild_dims(self) -> None:
        """Replace both dimensions by the merged partials of all loads."""
        merged = {
            "dim_users": dims.users_from(self._done("dim_users_state")),
            "dim_geo": dims.geo_from(self._done("dim_geo_state")),
        }
        side_by_side(lambda t: tables.truncate_reload(merged[t], self.path(t), LAYOUTS[t].schema), merged)

    def _done(self, table: str) -> DataFrame:
        """Rows of finished loads."""
        ids = self.read("load_log").select("load_id").distinct().unionByName(
            self.spark.range(1).select(F.lit(MERGED).alias("load_id"))
        )
        return self.read(table).join(ids, "load_id", "left_semi")

    def register_views(self) -> None:
        """Name every stored table for SQL."""
        for table in LAYOUTS:
            if self.stored(table):
                self.read(table).createOrReplaceTempView(table)

    # Upkeep

    def recover(self) -> None:
        """After a crash: redo states whose fact was repaired. All other changes take effect whole or not at all."""
        for note in tables.subfolders(self.spark, f"{self.root}/{_REPAIRED}"):
            self._rebuild_states(note.rsplit("/", 1)[1])
            tables.delete(self.spark, note)

    def sweep(self, older_than: float = KEEP_SECONDS) -> list[str]:
        """Delete what was replaced, or written by jobs that died, more than ``older_than`` seconds ago."""
        return [f for swept in side_by_side(lambda t: tables.sweep(self.spark, self.path(t), older_than), LAYOUTS) for f in swept]

    def _expire(self, table: str, column: str, cutoff, bound) -> list:
        """Take out rows whose ``column`` lies before ``cutoff``, in one step; a row per partition that lost some.

        Partitions that are wholly expired are dropped; only those the cutoff falls into are written anew.
        ``bound`` is a condition on partition columns that no expired row fails.
        """
        layout = LAYOUTS[table]
        before_ = self.folders(table)
        df = tables.read(self.spark, self.path(table), layout.schema, before_).filter(bound)
        expired = F.coalesce(F.col(column) < cutoff, F.lit(False))
        # One row per partition folder: bounded by the calendar and the batches kept.
        touched = (
            df.groupBy(*layout.partitions)
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if(expired).alias("expired"))
            .filter(F.col("expired") > 0)
            .collect()
        )
        losing = {self._partition(row, layout.partitions) for row in touched}
        cut = {self._partition(row, layout.partitions) for row in touched if row["rows"] > row["expired"]}
        stale = [f for f in before_ if f.rsplit("/", 1)[0] in losing]
        if not stale:
            return []
        boundary = [f for f in stale if f.rsplit("/", 1)[0] in cut]
        if boundary:
            kept = tables.read(self.spark, self.path(table), layout.schema, boundary).filter(~expired)
            self._write(table, kept, replaces=stale, clustered=True)
        else:
            tables.commit(self.spark, self.path(table), (), lambda folder: False, stale)
        return touched

    def _partition(self, row, partitions: Sequence[str]) -> str:
        def text(value) -> str:
            return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)

        return "/".join(f"{p}={text(row[p])}" for p in partitions)

    def retention_delete(self, as_of=None, days: int = schemas.STAGING_CLEAR_DAYS) -> dict[str, int]:
        """Clear staging rows inserted more than ``days`` ago; rows deleted per table."""
        cutoff = before(as_of, days=days)
        bound = F.col("inserted_on") <= F.to_date(cutoff)
        touched = side_by_side(lambda t: self._expire(t, "inserted_at", cutoff, bound), STAGING_TABLES)
        return {table: sum(row["expired"] for row in rows) for table, rows in zip(STAGING_TABLES, touched)}

    def ttl_expire(self, as_of=None) -> dict[str, int]:
        """Apply each table's time-to-live; rows deleted per table.

        The partials of the dimensions are rebuilt for the months that lost events.
        """

        def expire(table: str) -> int:
            layout = LAYOUTS[table]
            cutoff = before(as_of, days=layout.expires_after_days)
            if "event_month" in layout.partitions:
                bound = F.col("event_month") <= event_month(cutoff)
            else:
                bound = F.col("inserted_on") <= F.to_date(cutoff)
            touched = self._expire(table, layout.expires_by, cutoff, bound)
            if table == "fact_events":
                for month in sorted({self._partition(row, ["event_month"]) for row in touched}):
                    self._rebuild_states(month, ("dim_users_state", "dim_geo_state"))
            return sum(row["expired"] for row in touched)

        expiring = [table for table, layout in LAYOUTS.items() if layout.expires_by]
        return dict(zip(expiring, side_by_side(expire, expiring)))

    def compact(self, max_files: int = 1) -> list[str]:
        """Merge the many small files of finished loads; the folders rewritten.

        A month is rewritten once its finished loads have more than ``max_files`` files and half as many again
        as their size calls for, so that a large month is not copied for a few new files. States are merged to
        one row per group, dimensions to the latest row per key. A load that is not in the load log stays.
        """
        live = {table: self.folders(table) for table in ("fact_events", *STATES)}
        months = sorted({(table, f.split("/", 1)[0]) for table, folders in live.items() for f in folders})
        merged = side_by_side(lambda m: self._compact_month(*m, live[m[0]], max_files), months)
        rewritten = [f"{self.path(table)}/{month}" for (table, month), done in zip(months, merged) if done]
        for table, key, version in (("dim_users", "user_domain_id", "last_seen"), ("dim_geo", "geo_id", None)):
            if self._scattered(table, self.folders(table), max_files):
                rows = latest_per_key(self.read(table), key, version) if version else self.read(table)
                tables.truncate_reload(rows.sort(key), self.path(table), LAYOUTS[table].schema)
                rewritten.append(self.path(table))
        self._merge_ingest_log(max_files)
        log = self.folders("load_log")
        if self._scattered("load_log", log, max_files):
            rows = tables.read(self.spark, self.path("load_log"), schemas.LOAD_LOG_SCHEMA, log)
            tables.put(rows.coalesce(1), self.path("load_log"), replaces=log)
        return rewritten

    def _merge_ingest_log(self, max_files: int) -> None:
        """Sum the entries of the ingest log by run, but for each topic's last batch, which alone may come again."""
        folders = self.folders("ingest_log")
        last: dict[str, int] = {}
        for folder in folders:
            if _value(folder, "batch_id") != MERGED:
                topic = _value(folder, "topic")
                last[topic] = max(last.get(topic, -1), int(_value(folder, "batch_id")))
        old = [f for f in folders if _value(f, "batch_id") != str(last.get(_value(f, "topic")))]
        if len(old) <= max(max_files, len(last)):
            return
        rows = tables.read(self.spark, self.path("ingest_log"), schemas.INGEST_LOG_SCHEMA, old)
        sums = [F.sum(c).alias(c) for c in ("consumed", "inserted", "failed", "skipped")]
        merged = rows.groupBy("topic", "run_id").agg(*sums, F.max("stored_at").alias("stored_at"))
        self._write("ingest_log", merged.withColumn("batch_id", F.lit(MERGED)), replaces=old)

    def _compact_month(self, table: str, month: str, live: Collection[str], max_files: int) -> bool:
        own = [f for f in live if f.startswith(f"{month}/")]
        loads = {_value(f, "load_id") for f in own}
        ready = self.committed(sorted(loads)) | {MERGED}
        finished = [f for f in own if _value(f, "load_id") in ready]
        target = self._scattered(table, finished, max_files)
        if target:
            self._merge(table, finished, target)
        return target > 0

    def _scattered(self, table: str, folders: Collection[str], max_files: int) -> int:
        """The number of files the folders' data should be kept in, or 0 where it is not worth a rewrite."""
        sizes = [tables.data_files(self.spark, f"{self.path(table)}/{folder}") for folder in folders]
        files, target = sum(n for n, _ in sizes), tables.files_for(sum(size for _, size in sizes))
        return target if files > max(max_files, 1.5 * target) else 0

    def _merge(self, table: str, folders: Collection[str], files: int) -> None:
        """Replace folders of one month by their merged rows in ``files`` files; other folders stay as they are."""
        rows = tables.read(self.spark, self.path(table), LAYOUTS[table].schema, folders)
        if table in STATES:
            month = _value(next(iter(folders)), "event_month")
            rows = STATES[table].collapse(rows.drop("event_month")).withColumn("event_month", self._month_value(month))
        self._write(table, rows.withColumn("load_id", F.lit(MERGED)), replaces=folders, clustered=True, files=files)

    def _month_value(self, month: str):
        return F.lit(None if month == "__HIVE_DEFAULT_PARTITION__" else int(month)).cast("int")

    def _month(self, table: str, month: str) -> tuple[DataFrame, list[str]]:
        """The rows of one month of a table, such as ``event_month=202401``, and the folders that hold them."""
        own = [f for f in self.folders(table) if f.startswith(f"{month}/")]
        return tables.read(self.spark, self.path(table), LAYOUTS[table].schema, own), own

    def dwh_summary(self) -> DataFrame:
        """Rows of the five warehouse tables, the states counted as merged; an empty fact is a warning."""
        return summary({t: self.read(t) for t in DWH_TABLES})

    def repair(self, as_of=None, days: int = schemas.STAGING_CLEAR_DAYS) -> int:
        """Fill fact rows whose enrichment arrived after them, and rebuild the states of their months.

        Looks at the rows with a blank side of the last ``days``, as long as staging keeps the other feeds. The feeds'
        rows that such a row asks for are stored first, so that the feeds are not shuffled as a whole.
        """
        # Read once: what is looked up and what is kept as it is must be told apart by the same clock.
        clock = self.spark.range(1).select(before(as_of, days=days).cast("string")).first()[0]
        window = F.lit(clock).cast("timestamp_ntz")
        recent = self.read("fact_events").filter(F.col("event_month") >= event_month(window))
        recent = recent.filter(F.col("event_timestamp") >= window)
        open_rows = F.coalesce(lacks_side() & (F.col("event_timestamp") >= window), F.lit(False))
        scratch = tables.staging_path(self.path("fact_events"))

        def store_late(side) -> DataFrame:
            feed, columns = side
            rows, path = late_rows(recent, self.read(feed.table), feed, columns), f"{scratch}/{feed.name}"
            rows.write.parquet(path)
            return tables.read(self.spark, path, rows.schema)

        late = side_by_side(store_late, SIDES)
        repair_fact(recent.filter(open_rows), *late).write.partitionBy("event_month").parquet(f"{scratch}/looked_up")
        schema = T.StructType([*schemas.FACT_SCHEMA.fields, T.StructField("changed", T.BooleanType())])
        result = tables.read(self.spark, f"{scratch}/looked_up", schema)
        # One row per month of the window.
        months = result.groupBy("event_month").agg(F.count_if("changed").alias("n")).filter("n > 0").collect()
        for row in months:
            month = self._partition(row, ["event_month"])
            rows, own = self._month("fact_events", month)
            renewed = result.filter(F.col("event_month").eqNullSafe(row["event_month"])).select(*rows.columns)
            whole = rows.filter(~open_rows).unionByName(renewed)
            files = tables.files_for(sum(tables.data_files(self.spark, f"{self.path('fact_events')}/{f}")[1] for f in own))
            # Noted first, so that a failure before the states are rebuilt is made good by ``recover``.
            note = f"{self.root}/{_REPAIRED}/{month}"
            tables.make_folder(self.spark, note)
            self._write("fact_events", whole, replaces=own, clustered=True, files=files)
            self._rebuild_states(month)
            tables.delete(self.spark, note)
        tables.delete(self.spark, scratch)
        return sum(row["n"] for row in months)

    def deduplicate(self, table: str = "fact_events", key: str = "event_id", version: str = "created_at") -> int:
        """Keep one row per key of a stored table, that of the highest ``version``, ties broken by the other columns;
        rows without a key stay. The number of rows taken out.

        Keys are counted in one pass over one column. Only partitions that hold a repeated key are written anew, all of
        them in one step, and the states of their months after them. Rows of loads that are not finished are left alone.
        """
        layout, path = LAYOUTS[table], self.path(table)
        own = list(self.folders(table))
        loaded = "load_id" in layout.partitions
        if loaded:
            done = self.committed(sorted({_value(f, "load_id") for f in own})) | {MERGED}
            own = [f for f in own if _value(f, "load_id") in done]
        rows = tables.read(self.spark, path, layout.schema, own)
        known = F.coalesce(F.col(key).cast("string"), F.lit("")) != ""
        looked_up = tables.staging_path(path)
        key_counts(rows.select(key).filter(known), key).write.parquet(looked_up)
        keys = T.StructType([layout.schema[key], T.StructField("cnt", T.LongType())])
        repeated = tables.read(self.spark, looked_up, keys)
        surplus = repeated.agg(F.sum(F.col("cnt") - 1).alias("n")).first()["n"] or 0
        if surplus:
            again = rows.join(repeated.select(key), key, "left_semi").select(*rows.columns)
            # One row per partition folder: bounded by the calendar, the loads and the batches kept.
            where = again.select(*layout.partitions).distinct().collect()
            touched = {self._partition(row, layout.partitions) for row in where}
            stale = [f for f in own if f.rsplit("/", 1)[0] in touched]
            others = tables.read(self.spark, path, layout.schema, stale).join(repeated.select(key), key, "left_anti")
            best = latest_per_key(again, key, version)
            self._change_months(table, others.select(*rows.columns).unionByName(best), stale)
        tables.delete(self.spark, looked_up)
        return surplus

    def _change_months(self, table: str, rows: DataFrame, stale: Sequence[str]) -> None:
        """Replace folders by ``rows``; of the fact, rebuild the states of their months, noted first for ``recover``."""
        months = sorted({f.split("/", 1)[0] for f in stale}) if table == "fact_events" else []
        notes = [f"{self.root}/{_REPAIRED}/{month}" for month in months]
        for note in notes:
            tables.make_folder(self.spark, note)
        size = sum(tables.data_files(self.spark, f"{self.path(table)}/{f}")[1] for f in stale)
        self._write(table, rows, replaces=stale, clustered=True, files=max(len(stale), tables.files_for(size)))
        for month, note in zip(months, notes):
            self._rebuild_states(month)
            tables.delete(self.spark, note)

    def _rebuild_states(self, month: str, states: Sequence[str] = tuple(STATES)) -> None:
        """States of one month from its finished loads; an unfinished load writes its own when it finishes.

        A load whose last event of the month is gone is named by its states alone, which go too.
        """
        rows, own = self._month("fact_events", month)
        held = [*own, *[f for table in states for f in self.folders(table) if f.startswith(f"{month}/")]]
        done = self.committed(sorted({_value(f, "load_id") for f in held})) | {MERGED}
        finished = rows.filter(F.col("load_id").isin(list(done)))

        def rebuild(table: str) -> None:
            ours = [f for f in self._month(table, month)[1] if _value(f, "load_id") in done]
            partials = STATES[table].build(finished).withColumn("load_id", F.lit(MERGED))
            self._write(table, partials, replaces=ours, clustered=True)

        side_by_side(rebuild, states)


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = part if counts is None else counts.unionByName(part)
    return counts


def summary(frames: Mapping[str, DataFrame]) -> DataFrame:
    merged = {
        name: df.select(*STATE_KEYS[name]).distinct() if name in STATE_KEYS else df for name, df in frames.items()
    }
    empty_fact = (F.col("table_name") == "fact_events") & (F.col("rows") == 0)
    return table_counts(merged).withColumn("status", F.when(empty_fact, "warning").otherwise("passed"))
