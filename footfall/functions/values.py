"""Column expressions for blanks, ratios and distinct-count sketches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# log2 of the sketch registers: a standard error near 0.8 %.
SKETCH_LG_K = 14


def is_blank(df: DataFrame, column: str) -> Column:
    """NULL, or '' for a string. Other types have no empty value to compare with."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column).isNull() | (F.col(column) == "")
    return F.col(column).isNull()


def default_of(data_type: T.DataType) -> Column | None:
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    return None


def fill_blanks(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Replace NULL by '' or false. Stored tables have no NULL text, so '' counts as a value of its own."""
    wanted = set(df.columns if columns is None else columns)
    filled = []
    for field in df.schema.fields:
        default = default_of(field.dataType)
        if field.name in wanted and default is not None:
            filled.append(F.coalesce(F.col(field.name), default).alias(field.name))
        else:
            filled.append(F.col(field.name))
    return df.select(*filled)


def ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """Rounded quotient; NULL where the denominator is 0."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), places)


def sketch(column: str | Column) -> Column:
    """Mergeable distinct-count state. Hashed first, because the sketch itself would skip ''."""
    return F.hll_sketch_agg(F.xxhash64(column), F.lit(SKETCH_LG_K))


def merged_estimate(state: str | Column) -> Column:
    return F.hll_sketch_estimate(F.hll_union_agg(state))


def merged_sketch(state: str | Column) -> Column:
    return F.hll_union_agg(state)
