"""One row per key. Every choice is by a total order, so a rerun picks the same row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: str | Sequence[str], version: str = "inserted_at") -> DataFrame:
    """The row of highest ``version`` per key, ties broken by the other columns.

    An aggregate rather than a ranking window: duplicates are dropped before the shuffle, so a key with any
    number of copies costs one row per map task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys and c != version]
    best = F.max(F.struct(version, *rest)).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def dedup_by_key(df: DataFrame, keys: str | Sequence[str], version: str = "inserted_at") -> DataFrame:
    """One row per key, the latest. Rows whose key is entirely blank have no identity and are all kept."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    anonymous = F.lit(True)
    for key in keys:
        anonymous = anonymous & (F.coalesce(F.col(key).cast("string"), F.lit("")) == "")
    return latest_per_key(df.filter(~anonymous), keys, version).unionByName(df.filter(anonymous))


def key_counts(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Every key that occurs more than once, with its count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def duplicate_keys(df: DataFrame, keys: str | Sequence[str], limit: int = 10) -> DataFrame:
    """The first ``limit`` repeated keys in key order."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return key_counts(df, keys).orderBy(*keys).limit(limit)
