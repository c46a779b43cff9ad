"""Parquet tables by path: typed reads, plain partition writes, and changes that take effect all at once.

A job never overwrites what it reads. Each ``put`` writes folders of its own (``version=...`` below the partitions), and
only the table's pointer, a small numbered file that names the live folders, makes them the table: it is written last,
under a number nobody else has taken. A job that dies before leaves the table as it was, wherever it dies, and a reader
never sees half a change. Folders that no pointer names stay for readers that still hold them until ``sweep``.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.clock import event_month, moment
from footfall.functions.values import fill_blanks

# Folders whose name starts with an underscore are invisible to Spark's file listing.
STAGED = "_staged"
POINTER = "_pointer"

# The last partition column of every pointed-to folder; readers drop it.
VERSION = "version"

# A pointer that is still incomplete after so long was left by a writer that died.
UNWRITTEN_SECONDS = 30

# Pointers kept behind the newest one: whoever read one of them may still read its folders.
KEPT_POINTERS = 20

# Size of a data file after compaction. One task sorts the rows of one file, which take some fifteen times its bytes in
# memory: 128 MB of the fact took 2 GB.
FILE_BYTES = 32 << 20


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one already; whether this call has written it."""
    fs, p = _fs(spark, path)
    if fs.getUri().getScheme() == "file":
        return _link_once(p.toUri().getPath(), text)
    try:
        out = fs.create(p, False)
    except Exception as error:  # the gateway's error, with the file system's inside
        if fs.exists(p):
            return False
        raise OSError(f"cannot create {path}") from error
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def _link_once(path: str, text: str) -> bool:
    """``create_once`` on a local disk, where Hadoop's exclusive create looks first and writes later, so that two writers
    may both succeed: a file written beforehand gets its name in one step, if nobody has it."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    draft = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
    with open(draft, "w", encoding="utf-8") as out:
        out.write(text)
    try:
        os.link(draft, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def text_of(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8", "replace")
    finally:
        stream.close()


def age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file or folder was last changed, or None where there is none."""
    fs, p = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000 if fs.exists(p) else None


def subfolders(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Folder paths below ``path`` matching ``pattern``, such as the month folders of a table."""
    fs, p = _fs(spark, f"{path}/{pattern}")
    found = fs.globStatus(p) or []
    return sorted(s.getPath().toString() for s in found if s.isDirectory())


def data_files(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Number and bytes of the data files in ``folder``, at any depth of partition folders."""
    fs, p = _fs(spark, folder)
    files = size = 0
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        below = data_files(spark, status.getPath().toString()) if status.isDirectory() else (1, status.getLen())
        files, size = files + below[0], size + below[1]
    return files, size


def files_for(size: int) -> int:
    """How many files ``size`` bytes are best kept in."""
    return max(1, ceil(size / FILE_BYTES))


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.setTimes(p, int(time.time() * 1000), -1)


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: the folders that hold it, such as ``event_month=202401/load_id=a/version=...``."""

    number: int
    folders: tuple[str, ...]


def _pointers(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, f"{path}/{POINTER}/*.json")
    return sorted(int(s.getPath().getName()[: -len(".json")]) for s in fs.globStatus(p) or [])


def _pointed(spark: SparkSession, path: str, number: int) -> Snapshot | None:
    """What a pointer names; None for one whose writer died over it."""
    try:
        told = json.loads(text_of(spark, f"{path}/{POINTER}/{number:012d}.json") or "")
    except ValueError:
        return None
    return Snapshot(number, tuple(told["folders"]))


def snapshot(spark: SparkSession, path: str) -> Snapshot | None:
    """The newest complete state of a table, or None of a folder without pointers."""
    for number in reversed(_pointers(spark, path)):
        found = _pointed(spark, path, number)
        if found:
            return found
    return None


def live(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The folders that are the table now."""
    found = snapshot(spark, path)
    return found.folders if found else ()


class Conflict(RuntimeError):
    """What a job has read and meant to replace was replaced by another meanwhile; nothing was changed."""


def commit(
    spark: SparkSession, path: str, add: Collection[str], drop: Callable[[str], bool], replaces: Collection[str] = ()
) -> None:
    """Make ``add`` live and whatever ``drop`` picks not, in one step, after whoever commits at the same time.

    ``replaces`` are folders whose rows are in ``add``: unless all are still live, ``Conflict``.
    """
    while True:
        now = snapshot(spark, path) or Snapshot(0, ())
        gone = set(replaces)
        if not gone <= set(now.folders):
            raise Conflict(f"{path}: {sorted(gone - set(now.folders))[:3]} changed meanwhile")
        folders = [f for f in now.folders if f not in gone and not drop(f)]
        numbers = _pointers(spark, path)
        number = max([now.number, *numbers]) + 1
        if number > now.number + 1 and (age(spark, f"{path}/{POINTER}/{number - 1:012d}.json") or 0) < UNWRITTEN_SECONDS:
            time.sleep(0.05)  # somebody is writing the one before
            continue
        text = json.dumps({"folders": [*folders, *add]})
        # a number is taken once; who comes second looks again
        if now == (snapshot(spark, path) or Snapshot(0, ())) and create_once(spark, f"{path}/{POINTER}/{number:012d}.json", text):
            for old in numbers[: -KEPT_POINTERS or None]:
                delete(spark, f"{path}/{POINTER}/{old:012d}.json")
            return


def put(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    sort: Sequence[str] = (),
    *,
    drop: Callable[[str], bool] = lambda folder: False,
    replaces: Collection[str] = (),
    files: int | None = None,
    clustered: bool = False,
) -> list[str]:
    """Add rows to a table and take folders out of it, in one step; the folders added."""
    spark, version = df.sparkSession, uuid.uuid4().hex[:12]
    rows = df.withColumn(VERSION, F.lit(version))
    write = write_clustered if clustered else write_by_partition
    write(rows, path, [*partitions, VERSION], sort, **({"files": files} if clustered else {}))
    pattern = "/".join([*[f"{p}=*" for p in partitions], f"{VERSION}={version}"])
    added = [_below(path, f) for f in subfolders(spark, path, pattern)]
    commit(spark, path, added, drop, replaces)
    return added


def _below(path: str, folder: str) -> str:
    """``folder`` as seen from ``path``; listings name the file system, paths need not."""
    return folder.split(path.split("://")[-1].rstrip("/") + "/", 1)[1]


def sweep(spark: SparkSession, path: str, older_than: float) -> list[str]:
    """Delete folders that neither the table nor a kept pointer names and that are ``older_than`` seconds old."""
    numbers = _pointers(spark, path)
    named = {f for n in numbers for f in (_pointed(spark, path, n) or Snapshot(n, ())).folders}
    if not numbers:
        return []
    now = snapshot(spark, path)
    swept = []
    for depth in range(4):
        for folder in subfolders(spark, path, "/".join([*["*=*"] * depth, f"{VERSION}=*"])):
            leaf = _below(path, folder)
            kept = now.folders if now else ()
            if leaf not in kept and (age(spark, folder) or 0) >= older_than and (leaf not in named or older_than <= 0):
                delete(spark, folder)
                swept.append(leaf)
    return swept


def read(spark: SparkSession, path: str, schema: T.StructType, folders: Collection[str] | None = None) -> DataFrame:
    """The stored table, or only ``folders`` of it; a plain folder of Parquet files; no rows where nothing was written."""
    if folders is None:
        found = snapshot(spark, path)
        if found is None and exists(spark, path):
            return spark.read.schema(schema).parquet(path)
        folders = found.folders if found else ()
    if not folders:
        nothing = spark.range(1).filter(F.lit(False))
        return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
    return rows.select(*schema.fieldNames())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name in schema order: extras dropped, missing ones blank, NULL text blank."""
    have = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    return fill_blanks(df.select(*columns), schema.fieldNames())


def stamp_insert_time(df: DataFrame, as_of=None) -> DataFrame:
    """Add the load time in whole seconds, and its day for partitioning."""
    return df.withColumn("inserted_at", F.date_trunc("second", moment(as_of)).cast("timestamp_ntz")).withColumn(
        "inserted_on", F.to_date("inserted_at")
    )


def with_month(df: DataFrame, column: str = "event_timestamp") -> DataFrame:
    return df.withColumn("event_month", event_month(column))


def write_by_partition(df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str] = ()) -> None:
    """Write the partitions present in ``df``, replacing earlier files of exactly those partitions.

    With a batch or load id among the partitions this is an append that can be repeated safely. Rebalancing
    gives a few well-sized files per partition and lets AQE split a partition that holds most of the rows.
    """
    balanced = df.hint("rebalance", *[F.col(c) for c in partitions])
    ordered = balanced.sortWithinPartitions(*partitions, *sort) if sort else balanced
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_clustered(
    df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str], files: int | None = None
) -> None:
    """Rewrite with every file covering one narrow range of the sort columns.

    A range exchange, not one task per month: a month of any size spreads over ``files`` files, or over as
    many as AQE sees fit.
    """
    keys = [*partitions, *sort]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    writer = ranged.sortWithinPartitions(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


def append_batch(df: DataFrame, path: str, schema: T.StructType, partitions: Sequence[str] = ()) -> list[str]:
    """Insert rows by column name into a table of ``schema``."""
    return put(conform(df, schema), path, partitions)


def beside(path: str, kind: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/{kind}/{name}"


def staging_path(path: str) -> str:
    """A folder for what a job needs on the way to a new version of ``path``."""
    return f"{beside(path, STAGED)}-{uuid.uuid4().hex[:12]}"


def truncate_reload(
    df: DataFrame, path: str, schema: T.StructType, partitions: Sequence[str] = (), sort: Sequence[str] = ()
) -> list[str]:
    """Replace a table's content; until the new one is complete ``read`` gives the old version."""
    return put(conform(df, schema), path, partitions, sort, drop=lambda folder: True)
