"""The queries by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from brandbook.session import tidied

QUERIES: dict[str, Callable[..., DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, folder) under its name, with its SQL; what it writes on the way is deleted."""

    def add(function):
        QUERIES[function.__name__] = tidied(function)
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def epoch(c: str) -> Column:
    """Whole seconds of a time without zone, taken as UTC."""
    return F.unix_timestamp(F.col(c).cast("timestamp"))
