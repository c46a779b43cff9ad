"""Collects queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.registry.oracle import with_feeds

Query = Callable[[SparkSession, str], DataFrame]


def close(estimate: str, exact: str) -> Column:
    """Whether an estimate lies within 5 % of the exact count, or within one of a small count."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), F.lit(0.05) * F.col(exact))


class Book:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None, *, name: str | None = None):
        """Register a function, under its own name unless given one. ``sql`` reads the fixtures' relations."""

        def register(fn: Query) -> Query:
            key = name or fn.__name__
            self.queries[key] = fn
            if sql is not None:
                self.oracles[key] = with_feeds(sql)
            return fn

        return register
