"""Incremental ingestion: resume, micro-batches, deduplication by id, failure isolation and progress."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import is_local
from ..sources.sinks import append_batch

BROADCAST_KEYS = 1_000_000  # keys of a batch that go to all tasks; more are joined by shuffle
EXAMPLES = 20  # error messages of a batch that Progress holds; all failed rows are in the table of failures


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stream's state and output beside the session's checkpoints, shared by all executors."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "corpusloom-streams")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stream_files(spark: SparkSession, path: str, glob: str = "*.xml", per_batch: int = 1000) -> DataFrame:
    """(source_file, content) of files as they arrive, at most `per_batch` at a time."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    files = raw.option("pathGlobFilter", glob).option("maxFilesPerTrigger", str(per_batch)).load(path)
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("source_file"), "content")


@dataclass
class Progress:
    """Counters of a run; the invariant is that nothing failed and every new point was stored.

    `problems` holds the messages of up to EXAMPLES failed rows a batch, as examples; `failures` is the table of all.
    """

    batches: int = 0
    seen: int = 0
    failed: int = 0
    skipped: int = 0
    stored: int = 0
    problems: list[str] = field(default_factory=list)
    failures: str = ""

    @property
    def successful(self) -> bool:
        return self.failed == 0 and self.seen == self.failed + self.skipped + self.stored

    def row(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.batches, self.seen, self.failed, self.skipped, self.stored, self.successful)], "batches int, seen long, failed long, skipped long, stored long, successful boolean")


def ingest(
    stream: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    key: str = "id",
    stored: Callable[[], DataFrame | None] = lambda: None,
    report: Callable[[Progress], None] | None = None,
    failures: str | None = None,
) -> Progress:
    """Run all waiting input in micro-batches and return the counters.

    `parse` gives rows with an `error` column, null for good ones; bad rows are counted and the stream goes on.  All bad
    rows, with every column that `parse` gives, go to the Parquet table `failures` under batch=<number>, by default
    beside the checkpoint as <checkpoint>-failures; there is no table if none failed.  A table belongs to one checkpoint,
    since a batch that is run again replaces its rows.

    Ids that repeat in a batch, or are stored already, are skipped; a batch that is run again after a failure therefore
    stores nothing twice.  State lives in `checkpoint`, so a later call goes on where this one ended.
    """
    progress = Progress(failures=failures or f"{checkpoint.rstrip('/')}-failures")

    def one(batch: DataFrame, number: int) -> None:
        rows = parse(batch).persist()
        try:
            good = rows.where("error is null").drop("error")
            new = good.where(F.col(key).isNotNull()).dropDuplicates([key])
            new = new.persist()
            n_all, n_good, n_new = rows.count(), good.count(), new.count()
            done = stored()
            if done is not None and n_new:
                # only the key column of what is stored is read, and it is not shuffled: the batch goes to it
                asked = F.broadcast(new.select(key)) if n_new <= BROADCAST_KEYS else new.select(key)
                there = done.select(key).join(asked, key, "left_semi").distinct()
                first, new = new, new.join(there, key, "left_anti").persist()
                n_new = new.count()
                first.unpersist()
            bad = rows.where("error is not null")
            if n_good < n_all:  # Parquet has no columns of nulls only
                append_batch(bad.select(*[c for c, kind in bad.dtypes if kind != "void"]), progress.failures, str(number))
            if n_new:
                sink(new, number)
            new.unpersist()
            progress.batches += 1
            progress.seen += n_all
            progress.failed += n_all - n_good
            progress.skipped += n_good - n_new
            progress.stored += n_new
            progress.problems += [r["error"] for r in bad.select("error").limit(EXAMPLES).collect()]
        finally:
            rows.unpersist()
        if report:
            report(progress)

    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return progress


def append_new(stream: DataFrame, path: str, checkpoint: str, key: str | None = None, at: str | None = None, late: str = "1 hour") -> StreamingQuery:
    """Append a stream to a table, each id once; with an event time the memory of ids is bounded by the watermark."""
    out = stream
    if key and at:
        out = out.withWatermark(at, late).dropDuplicatesWithinWatermark([key])
    elif key:
        out = out.dropDuplicates([key])
    q = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def windowed_counts(stream: DataFrame, at: str, key: str, width: str, path: str, checkpoint: str, late: str = "1 hour") -> None:
    """Counts per tumbling event-time window and key, appended as windows close."""
    counts = stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), key).agg(F.count("*").alias("n"))
    q = counts.select(F.col("w.start").alias("start"), key, "n").writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
