"""What the operators of this subpackage share: reading tables, stored steps, the training fold, per-text functions."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import footfall
from footfall.workspace import fresh_folder

#: A word, where a contract speaks of words: ASCII white space separates, nothing else does.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a source may all lie on one key; joins against a table with a row per key deal them over so many slices.
SLICES = 64


_SHIPPED: set[str] = set()


#: Rows that a Python worker holds at once. Texts are long; the usual 10,000 are some hundred megabytes a worker.
BATCH_ROWS = "1000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Gives every Python worker this package, as ``--py-files`` would; the driver hands the archive out. Batches to the
    workers get ``BATCH_ROWS`` rows where the session still has the default."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root, folder = Path(footfall.__file__).resolve().parent, tempfile.mkdtemp(prefix="footfall-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # only the driver reads it, as long as it lives
        archive = f"{folder}/footfall_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: the lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    folder = fresh_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def own_name(stem: str) -> str:
    """A column name that no table of a user holds."""
    return f"__{stem}_{uuid.uuid4().hex[:8]}"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training: the checksum of its id as text is divisible by five. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labels_to_learn(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id``, ``label`` of the labels that may be learned from; an id with both labels counts as 1."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & ~held_out())
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def sample_texts(docs: DataFrame, labels: DataFrame, label: str, at_most: int) -> DataFrame:
    """``label``, ``text`` of at most ``at_most`` labelled ids of each label, those of the smallest hashes: the same ids
    at each run. The ids are bounded, so they go to where the texts are."""
    known = labels_to_learn(labels, label)
    first = [known.where(F.col("label") == x).orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(at_most) for x in (0, 1)]
    ids = first[0].unionByName(first[1])
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), "doc_id")
    return rows.select("label", "text").dropDuplicates()


def per_text(make: Callable[[], Callable[[str], tuple]], schema: str, names: list[str]):
    """A column function over texts. ``make`` runs once per task; what it returns maps a text to a tuple."""

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = make()
        for texts in batches:
            yield pd.DataFrame([one(t) if isinstance(t, str) else one("") for t in texts], columns=names)

    return run
