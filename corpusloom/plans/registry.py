"""A query and its SQL side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of a folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of Tables under its name, with the DuckDB SQL that gives the same rows."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- SQL fragments ----------------------------------------------------------------------------------------------------

_WS = r"E' \t\n\r\f\x0b'"


def s_text(c: str) -> str:
    return f"trim(coalesce({c}, ''), {_WS})"


def s_number(c: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({c}, '[0-9]+'), '') AS BIGINT)"


def s_list(c: str, sep: str = "|") -> str:
    return f"list_filter(list_transform(string_split(coalesce({c}, ''), '{sep}'), lambda x: trim(x, {_WS})), lambda x: x <> '')"


def s_set(c: str, sep: str = "|") -> str:
    """Distinct values in order of first occurrence."""
    inner = s_list(c, sep)
    return f"list_filter({inner}, lambda x, i: list_position({inner}, x) = i)"


def s_year(c: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(coalesce({c}, ''), '\\b(\\d{{4}})\\b', 1), '') AS INTEGER)"
