"""Queries that run a stream to its end and return what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming import ingest as S
from .registry import Tables, query


def _event_stream(t: Tables) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder of files."""
    reader = t.spark.readStream.schema(t.events.schema)
    path = t.spark._jvm.org.apache.hadoop.fs.Path(f"{t.folder}/events.parquet")
    status = path.getFileSystem(t.spark._jsc.hadoopConfiguration()).getFileStatus(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(t.folder) if status.isFile() else reader.parquet(path.toString())


@query("SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS check_sum FROM (SELECT DISTINCT event_id, event_type FROM events) GROUP BY 1")
def streaming_append_once(t: Tables) -> DataFrame:
    """Events appended by a stream that keeps each id once."""
    folder = S.work_folder(t.spark, "append")
    S.append_new(_event_stream(t).select("event_id", "event_type"), f"{folder}/out", f"{folder}/state", "event_id")
    return t.spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("check_sum"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def streaming_resume(t: Tables) -> DataFrame:
    """Micro-batches into a table; the same checkpoint again finds nothing new, a fresh one finds all rows stored."""
    folder = S.work_folder(t.spark, "resume")
    out = f"{folder}/out"

    def parse(batch: DataFrame) -> DataFrame:
        return batch.select(F.col("event_id").alias("id"), "event_type", F.lit(None).cast("string").alias("error"))

    first: list[int] = []

    def stored() -> DataFrame | None:
        return t.spark.read.parquet(out) if first else None

    def sink(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={len(first)}-{number}")
        first.append(number)

    S.ingest(_event_stream(t), parse, sink, f"{folder}/state1", stored=stored)
    resumed = S.ingest(_event_stream(t), parse, sink, f"{folder}/state1", stored=stored)
    again = S.ingest(_event_stream(t), parse, sink, f"{folder}/state2", stored=stored)
    if resumed.seen or again.stored:
        raise AssertionError("a repeated run stored rows again")
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))
