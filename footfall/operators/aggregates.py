"""Grouped measures, sorts and top lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str | Column, name: str = "events") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_if(df: DataFrame, keys: Sequence[str], condition: Column, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(condition).alias(name))


def min_max(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def first_values(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str], *measures: Column
) -> DataFrame:
    """One value of each column per group: that of the earliest row by ``order``, other columns breaking ties."""
    picked = F.min(F.struct(*order, *columns)).alias("_first")
    grouped = df.groupBy(*keys).agg(picked, *measures)
    rest = [c for c in grouped.columns if c not in (*keys, "_first")]
    return grouped.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in columns], *rest)


def any_value(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return first_values(df, keys, columns, ["event_timestamp", "event_id"])


def uniq_exact(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Exact distinct counts, ``columns`` mapping output name to input column."""
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(name) for name, c in columns.items()])


def uniq_approx(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], error: float = 0.01) -> DataFrame:
    """Approximate distinct counts in one pass with fixed memory per group."""
    return df.groupBy(*keys).agg(*[F.approx_count_distinct(c, error).alias(name) for name, c in columns.items()])


def sum_measure(df: DataFrame, keys: Sequence[str | Column], measures: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(name) for name, c in measures.items()])


def having(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on the aliases of an aggregate."""
    return df.filter(condition)


def sort_multi(df: DataFrame, order: Mapping[str, str]) -> DataFrame:
    """Sort by several columns, each ``asc`` or ``desc``."""
    return df.orderBy(*[F.desc(c) if way == "desc" else F.asc(c) for c, way in order.items()])


def top_k(df: DataFrame, measure: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` largest by ``measure``; the group keys decide between equals."""
    return df.orderBy(F.desc(measure), *[F.asc(c) for c in ties]).limit(k)
