"""The registered queries: each operator run over whole test tables, with the SQL that gives the same rows."""

from __future__ import annotations

from footfall.registry import feeds, operators, quality, reports, upkeep

_PARTS = (feeds, operators, reports, quality, upkeep)


def queries():
    return {name: fn for part in _PARTS for name, fn in part.BOOK.queries.items()}


def oracle_sql():
    return {name: sql for part in _PARTS for name, sql in part.BOOK.oracles.items()}
