"""Connectors to outside services as pluggable functions, with retry, batches, and a cache of what is there already.

No service is built in: callers pass a function, tests pass recorded answers.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import batch_number

RETRYABLE_STATUS = frozenset([408, 429])


class ServiceError(RuntimeError):
    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


def is_retryable(e: Exception) -> bool:
    if isinstance(e, ServiceError):
        return e.status is None or e.status in RETRYABLE_STATUS or e.status >= 500
    return isinstance(e, (TimeoutError, ConnectionError))


def with_retry(call: Callable, *args, attempts: int = 4, base: float = 1.0, least: float = 0.0, sleep: Callable[[float], None] = time.sleep):
    """The call's result; waits max(least, base * 2**(n-1)) after the n-th failure; other errors stop at once."""
    for n in range(1, attempts + 1):
        try:
            return call(*args)
        except Exception as e:
            if n == attempts or not is_retryable(e):
                raise
            sleep(max(least, base * 2 ** (n - 1)))


def safe_message(e: Exception) -> str:
    status = f"status {e.status}: " if isinstance(e, ServiceError) and e.status else ""
    return " ".join(f"{status}{type(e).__name__}: {e}".split())


def batches(ids: DataFrame, size: int, key: str = "id") -> DataFrame:
    """(batch, ids): fixed-size batches in order of the id; one distinct id once."""
    d = ids.select(F.col(key).cast("string").alias("id")).where("id is not null").distinct()
    return batch_number(d, [F.col("id")], size).groupBy("batch").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def fetch(batched: DataFrame, call: Callable[[list[str]], dict[str, str]], attempts: int = 4, base: float = 1.0, tasks: int = 1) -> DataFrame:
    """(id, content, error, attempts) of each requested id; a failed batch gives its error for each id, other batches go on."""
    out = "id string, content string, error string, attempts int"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for ids in pdf["ids"]:
                tries = [0]

                def counted(x, tries=tries):
                    tries[0] += 1
                    return call(x)

                try:
                    got, error = with_retry(counted, list(ids), attempts=attempts, base=base), None
                except Exception as e:  # noqa: BLE001 - any failure of a service is a row, not the end of the job
                    got, error = {}, safe_message(e)
                rows += [(i, got.get(i), error if error else (None if i in got else "not in the answer"), tries[0]) for i in ids]
            yield pd.DataFrame(rows, columns=["id", "content", "error", "attempts"])

    return batched.coalesce(tasks).mapInPandas(run, out)


def outstanding(wanted: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Distinct wanted ids that are not done yet."""
    return wanted.select(key).where(F.col(key).isNotNull()).distinct().join(done.select(key), key, "left_anti")


def search_hits(answers: DataFrame) -> DataFrame:
    """(query_id, id, rank) of (query_id, ids): the place of each hit in its answer, from 1."""
    return answers.select("query_id", F.posexplode("ids").alias("p", "id")).select("query_id", "id", (F.col("p") + 1).alias("rank"))


def first_success(attempts: DataFrame, group: str, order: str, ok: str = "n_results") -> DataFrame:
    """Per group the attempts up to and with the first that had results."""
    first = F.min(F.when(F.col(ok) > 0, F.col(order))).over(Window.partitionBy(group))
    return attempts.withColumn("_first", first).where(F.col("_first").isNull() | (F.col(order) <= F.col("_first"))).drop("_first")


def lookup_terms(names: DataFrame, terms: DataFrame, name: str = "name") -> DataFrame:
    """Names with the heading of a terminology (label, heading) of the same label, case ignored; null where none."""
    t = terms.groupBy(F.lower(F.trim("label")).alias("_l")).agg(F.min("heading").alias("heading"))
    return names.join(t, F.lower(F.trim(name)) == F.col("_l"), "left").drop("_l")
