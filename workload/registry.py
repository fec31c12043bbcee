"""Where queries and their oracle SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its key, with SQL that gives the same rows."""

    def add(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"registered twice: {key}")
        QUERIES[key] = function
        if oracle is not None:
            ORACLES[key] = oracle
        return function

    return add


def time_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_time(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S.%f')"
