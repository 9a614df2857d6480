"""All queries outside the subpackage for language-model corpora, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import documents, relational, reports, roundtrips, streams, training, xml  # noqa: F401 - importing a module registers its queries
from .registry import QUERIES, SQL


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return training.p1_found(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return training.queries() | QUERIES


def oracle_sql() -> dict[str, str]:
    return dict(SQL) | training.oracle_sql()
