"""A training corpus from documents: toxic texts go, lines and documents are deduplicated, sources mixed, texts encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import lines, mixing, pieces, simhash, toxicity
from footfall.llm.common import ship, stored, table
from footfall.llm.queries import tokenizer_path


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model is learned from the labelled rows."""
    ship(spark)
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines near to one that stands earlier in the corpus and stays are taken out of the texts; no document goes."""
    ship(spark)
    return lines.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the smallest id."""
    ship(spark)
    return simhash.kept(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target weights: a document stands as often as the mix takes it."""
    ship(spark)
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    ship(spark)
    return pieces.round_trip(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_texts),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_duplicates),
    ("source mix", source_mix),
    ("piece encoding", encoding),
]

#: SQL has no support vector machines, edit joins or piece encoders; a test holds the rows of ``run`` against the stages
#: done plainly on a small folder of tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
