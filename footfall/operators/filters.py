"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.clock import before, since
from footfall.functions.values import is_blank

DASHBOARD_COLUMNS = ("geo_country", "utm_source", "device_type", "event_type")


def filter_nonempty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) != "")


def filter_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_blank(df, column))


def filter_in_list(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def filter_since(
    df: DataFrame, as_of=None, *, days: int = 0, hours: int = 0, column: str = "event_timestamp"
) -> DataFrame:
    """Rows of the last ``days`` and ``hours`` before the clock."""
    return since(df, before(as_of, days=days, hours=hours), column)


def contradicts(flag: str, column: str, value: str):
    """True where a boolean column disagrees with another column being ``value``."""
    return (F.col(flag) & (F.col(column) != value)) | (~F.col(flag) & (F.col(column) == value))


def filter_bool_pair(
    df: DataFrame, flag: str = "device_is_mobile", column: str = "device_type", value: str = "Mobile"
) -> DataFrame:
    return df.filter(contradicts(flag, column, value))


def dashboard_filters(df: DataFrame, filters: Mapping[str, str | Iterable[str]] | None = None) -> DataFrame:
    """Narrow a report to given values of the four dashboard columns; no filters keep every row.

    Stored states lack some of the columns: a filter on one of those is an error that names it, to be asked of the fact.
    """
    if not filters:
        return df
    unknown = set(filters) - set(DASHBOARD_COLUMNS)
    if unknown:
        raise ValueError(f"not a dashboard filter: {sorted(unknown)}")
    lacking = set(filters) - set(df.columns)
    if lacking:
        raise ValueError(f"{sorted(lacking)} not kept in these rows; filter a report over the fact")
    conditions = [
        F.col(column).isin([wanted] if isinstance(wanted, str) else list(wanted))
        for column, wanted in filters.items()
    ]
    return df.filter(reduce(and_, conditions))
