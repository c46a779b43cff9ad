"""Feeds as messages: JSON lines from files or a topic, parsed by one tolerant parser, and keyed publishing."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.values import fill_blanks
from footfall.schemas import FEEDS, Feed

_CORRUPT = "_corrupt_record"

# Written with microseconds; the parser takes any ISO form.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# What one micro-batch takes unless the caller says otherwise, so that a first drain comes in bounded batches.
ROWS_PER_BATCH = 20_000_000
BYTES_PER_BATCH = 16 << 30


def kafka_options(feed: Feed, servers: str, **extra: str) -> dict[str, str]:
    """Options to read a feed's topic from its beginning. Needs the Kafka connector on the cluster."""
    return {"kafka.bootstrap.servers": servers, "subscribe": feed.topic, "startingOffsets": "earliest", **extra}


def read_topic(spark: SparkSession, feed: Feed, servers: str, *, stream: bool = False, **extra: str) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    limit = {"maxOffsetsPerTrigger": str(ROWS_PER_BATCH)} if stream else {}
    rows = reader.format("kafka").options(**kafka_options(feed, servers, **{**limit, **extra})).load()
    return rows.select(F.col("value").cast("string").alias("value"))


def read_lines(
    spark: SparkSession,
    path: str,
    *,
    stream: bool = False,
    files_per_batch: int | None = None,
    bytes_per_batch: int = BYTES_PER_BATCH,
):
    """A topic kept as a folder of JSONL files: one message per line.

    A stream takes whole files, up to ``bytes_per_batch`` or, where given, ``files_per_batch`` at once.
    """
    if not stream:
        return spark.read.text(path)
    if files_per_batch:
        return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return spark.readStream.option("maxBytesPerTrigger", bytes_per_batch).text(path)


def peek(lines: DataFrame, n: int = 10) -> DataFrame:
    """Some ``n`` messages, to look at."""
    return lines.limit(n)


def parse_lines(lines: DataFrame, feed: Feed) -> DataFrame:
    """One row per line: the feed's columns, the raw ``value``, and why it cannot be loaded (``problem``)."""
    schema = T.StructType([*feed.schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    record = F.from_json("value", schema, options)
    parsed = lines.select("value", record.alias("r")).select("value", "r.*")
    problem = (
        F.when(F.trim("value") == "", "blank")
        .when(F.col(_CORRUPT).isNotNull(), "corrupt")
        .when(F.col(feed.key).isNull() | (F.col(feed.key) == ""), "keyless")
    )
    return parsed.withColumn("problem", problem).drop(_CORRUPT)


def accepted(parsed: DataFrame, feed: Feed, keep: Sequence[str] = ()) -> DataFrame:
    """The loadable records, blanks filled, with any further columns to ``keep``."""
    return fill_blanks(parsed.filter(F.col("problem").isNull()).select(*feed.columns, *keep))


def quarantined(parsed: DataFrame, feed: Feed) -> DataFrame:
    """The rejected lines with their raw text."""
    rows = parsed.filter(F.col("problem").isNotNull())
    return rows.select(F.lit(feed.topic).alias("topic"), "problem", F.col("value").alias("raw"))


def read_jsonl(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    return accepted(parse_lines(read_lines(spark, path), feed), feed)


def keyed_messages(records: DataFrame, feed: Feed) -> DataFrame:
    """(topic, key, value): what a Kafka sink takes."""
    body: Column = F.to_json(F.struct(*[F.col(c) for c in feed.columns]), {"timestampNTZFormat": TIME_FORMAT})
    return records.select(
        F.lit(feed.topic).alias("topic"), F.col(feed.key).cast("string").alias("key"), body.alias("value")
    )


@dataclass(frozen=True)
class Published:
    """What one run has published: messages sent, and how many of them have no key and so no fixed partition."""

    sent: int
    keyless: int


def _published(messages: DataFrame, write: Callable[[DataFrame], None]) -> Published:
    """Write messages, counted on the way: the write has no shuffle, so each task's count enters once."""
    counts = Observation()
    keyless = F.count_if(F.coalesce(F.col("key"), F.lit("")) == "")
    write(messages.observe(counts, F.count(F.lit(1)).alias("sent"), keyless.alias("keyless")))
    return Published(counts.get["sent"], counts.get["keyless"])


def publish_kafka(records: DataFrame, feed: Feed, servers: str) -> Published:
    def write(rows: DataFrame) -> None:
        rows.write.format("kafka").option("kafka.bootstrap.servers", servers).save()

    return _published(keyed_messages(records, feed), write)


def publish_lines(records: DataFrame, feed: Feed, path: str) -> Published:
    """Publish to a topic kept as JSONL files."""
    return _published(keyed_messages(records, feed), lambda rows: rows.select("value").write.mode("append").text(path))


def _with_total(per_topic: DataFrame) -> DataFrame:
    """The per-topic counts, one row a topic, and their sum as a row named TOTAL."""
    measures = [c for c in per_topic.columns if c != "topic"]
    summed = per_topic.rollup("topic").agg(*[F.sum(c).alias(c) for c in measures])
    return summed.withColumn("topic", F.coalesce("topic", F.lit("TOTAL")))


_SKIPPED = ("blank", "corrupt")


def outcome_counts(total: str) -> list[Column]:
    """Counts of parsed lines: ``total``, and those ``inserted``, ``failed`` (no key) and ``skipped`` (unreadable)."""
    problem = F.col("problem")
    return [
        F.count(F.lit(1)).alias(total),
        F.count_if(problem.isNull()).alias("inserted"),
        F.count_if(problem == "keyless").alias("failed"),
        F.count_if(problem.isin(*_SKIPPED)).alias("skipped"),
    ]


def load_audit(parsed: dict[str, DataFrame]) -> DataFrame:
    """Per feed and in total: well-formed records, those loadable, those not, and lines skipped as unreadable."""
    problems = None
    for name, rows in parsed.items():
        part = rows.select(F.lit(FEEDS[name].topic).alias("topic"), "problem")
        problems = part if problems is None else problems.unionByName(part)
    counted = problems.groupBy("topic").agg(*outcome_counts("lines"))
    counted = counted.select(
        "topic", (F.col("lines") - F.col("skipped")).alias("total"), F.col("inserted").alias("success"), "failed", "skipped"
    )
    status = F.when(F.col("failed") > 0, "warning").otherwise("passed")
    return _with_total(counted).withColumn("status", status)


def ingest_audit(log: DataFrame, feeds: Collection[str], run_id: str | None = None) -> DataFrame:
    """Per topic and in total, what a run (or all runs) took in, by the ingest log: messages consumed, rows inserted,
    records without a key, lines skipped, and topics that brought nothing. Neither topics nor staging are read."""
    rows = log if run_id is None else log.filter(F.col("run_id") == run_id)
    measures = ("consumed", "inserted", "failed", "skipped")
    seen = rows.groupBy("topic").agg(*[F.sum(c).alias(c) for c in measures])
    topics = F.array(*[F.lit(FEEDS[name].topic) for name in feeds])
    expected = log.sparkSession.range(1).select(F.explode(topics).alias("topic"))
    audit = expected.join(seen, "topic", "left").fillna(0, list(measures))
    return _with_total(audit).withColumn("status", F.when(F.col("consumed") == 0, "no data").otherwise("ok"))
