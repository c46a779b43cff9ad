"""Joins that stay balanced when one key holds a large share of the rows.

``hot_keys`` finds such keys with a bounded sketch over one column. ``join`` then gives every hot key a
number of slices: the left rows spread over them and the right rows are copied once per slice, so that no
task receives more than about half an average partition of one key. With no hot key the join is a plain one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SLICE = "_slice"
# How many equal rows a row of a spread side stands for.
_COPIES = "_copies"

# A key is hot from this share of the rows on, so that there are at most 1 / share hot keys to broadcast.
HOT_SHARE = 0.001
# Below this many rows a key fits in one task whatever its share.
HOT_ROWS = 1_000_000
# Keys the sketch tracks while it scans: ten times those it may report.
_TRACKED = 10_000


@dataclass(frozen=True)
class HotKeys:
    """At most ``1 / HOT_SHARE`` keys with the number of slices of each."""

    slices: tuple[tuple[str | None, int], ...] = ()

    def __bool__(self) -> bool:
        return bool(self.slices)

    def frame(self, spark: SparkSession, key: str, key_type: T.DataType) -> DataFrame:
        schema = T.StructType([T.StructField(key, key_type), T.StructField("_slices", T.IntegerType())])
        return spark.createDataFrame(list(self.slices), schema)


def hot_keys(df: DataFrame, key: str, *, share: float | None = None, min_rows: int | None = None) -> HotKeys:
    """The keys of ``df`` that would outgrow an average shuffle partition on their own.

    One pass over one column with a sketch of fixed size. Which keys it finds affects the balance of a join
    only, never its result. The slices of all keys together are about twice the number of partitions.
    """
    return hot_keys_of(df, [key], share=share, min_rows=min_rows)[key]


def hot_keys_of(
    df: DataFrame, keys: Sequence[str], *, share: float | None = None, min_rows: int | None = None
) -> dict[str, HotKeys]:
    """``hot_keys`` of several columns, in one pass over all of them."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = HOT_SHARE if share is None else share
    min_rows = HOT_ROWS if min_rows is None else min_rows
    limit = ceil(1 / share)
    tops = [F.expr(f"approx_top_k(`{key}`, {limit}, {max(_TRACKED, limit)})") for key in keys]
    total, *found = df.agg(F.count(F.lit(1)), *tops).first()
    if total < min_rows:
        return {key: HotKeys() for key in keys}
    least = max(min_rows, share * total, total / partitions)
    return {
        key: HotKeys(
            tuple(
                (entry["item"], max(2, ceil(2 * partitions * entry["count"] / total)))
                for entry in top or []
                if entry["item"] is not None and entry["count"] >= least
            )
        )
        for key, top in zip(keys, found)
    }


def join(left: DataFrame, right: DataFrame, key: str, how: str, hot: HotKeys | None = None) -> DataFrame:
    """Equi-join on ``key`` keeping the left rows' balance; ``how`` is inner, left, left_semi or left_anti.

    No job runs here: without ``hot`` it is a plain join, balanced by the engine alone. A left side that ``spread``
    has already sliced keeps its slices, so that several joins on one key share one shuffle of it.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a right row may be copied, so {how} is not supported")
    if not hot:
        return left.join(right, key, how)
    if _SLICE in left.columns:
        return left.join(copies(right, key, hot), [key, _SLICE], how)
    return gather(spread(left, key, hot).join(copies(right, key, hot), [key, _SLICE], how))


def spread(left: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """Rows of a hot key dealt over its slices; all other rows in slice 0. Unchanged without hot keys.

    Equal rows of a hot key become one row per slice with the number of rows it stands for, which ``gather`` expands:
    a hash alone would put all of them into one slice, and a number by position would change when a task runs again.
    """
    if not hot:
        return left
    marked = _marked(left, key, hot)
    plain = marked.filter(F.col("_slices").isNull())
    plain = plain.select(*left.columns, F.lit(0).alias(_SLICE), F.lit(1).cast("long").alias(_COPIES))
    equal = marked.filter(F.col("_slices").isNotNull()).groupBy(*left.columns, "_slices")
    equal = equal.agg(F.count(F.lit(1)).alias("_rows")).withColumn("_parts", F.least("_rows", "_slices"))
    dealt = equal.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    share = F.floor(F.col("_rows") / F.col("_parts")) + (F.col("_part") < F.col("_rows") % F.col("_parts")).cast("long")
    number = F.pmod(F.pmod(row_hash, "_slices") + F.col("_part"), "_slices").cast("int")
    return plain.unionByName(dealt.select(*left.columns, number.alias(_SLICE), share.alias(_COPIES)))


def copies(right: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """One copy of a hot key's rows per slice, which adds at most a few rows per shuffle partition."""
    every = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    return _marked(right, key, hot).withColumn(_SLICE, F.explode(every)).drop("_slices")


def gather(df: DataFrame) -> DataFrame:
    """Rows as often as they stand for, without the slice number."""
    if _COPIES in df.columns:
        df = df.withColumn(_COPIES, F.explode(F.sequence(F.lit(1).cast("long"), _COPIES)))
    return df.drop(_SLICE, _COPIES)


def _marked(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    marks = hot.frame(df.sparkSession, key, df.schema[key].dataType)
    return df.join(F.broadcast(marks), key, "left")
