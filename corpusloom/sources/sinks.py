"""Sinks: create-only, replace and append tables, canonical JSON lines in shards, files by key, text reports."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, order: list | None = None, mode: str = "errorifexists", files: int | None = None) -> None:
    """CSV with a header.  `order` sorts over all files; `files` bounds their number (1 for a single file)."""
    out = df.orderBy(*order) if order else df
    if files:
        out = out.coalesce(files)
    kept = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    out.write.mode(mode).options(**kept).csv(path)


def _filesystem(df: DataFrame, path: str):
    jvm = df.sparkSession._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def replace_table(df: DataFrame, path: str, validate: Callable[[DataFrame], None] | None = None, fmt: str = "parquet") -> None:
    """Write beside the target, validate what was written, then swap; a failure leaves the old table as it was.

    Between the two renames of the swap the old table lies beside the target, where `current_table` finds it; so its
    readers, and a run after a crash, always see the old or the new table whole.
    """
    fs, target, Path = _filesystem(df, path)
    staging, old = Path(path.rstrip("/") + "._staging"), Path(path.rstrip("/") + "._old")
    fs.delete(staging, True)
    df.write.format(fmt).option("header", "true").mode("errorifexists").save(staging.toString())
    try:
        if validate:
            validate(df.sparkSession.read.format(fmt).option("header", "true").load(staging.toString()))
    except Exception:
        fs.delete(staging, True)
        raise
    if fs.exists(target):
        fs.delete(old, True)
        fs.rename(target, old)
    if not fs.rename(staging, target):
        raise OSError(f"{staging} could not be renamed to {target}")
    fs.delete(old, True)


def current_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table that `replace_table` wrote last; during a swap, or after one that broke off, the one before."""
    fs, target, Path = _filesystem(spark.range(0), path)
    old = Path(path.rstrip("/") + "._old")
    there = target if fs.exists(target) or not fs.exists(old) else old
    return spark.read.format(fmt).option("header", "true").load(there.toString())


def append_batch(df: DataFrame, path: str, batch: str, fmt: str = "parquet") -> None:
    """Append under batch=<batch>; writing the same batch again replaces it, so a repeated run adds nothing twice."""
    df.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch={batch}")


def canonical_lines(df: DataFrame, key: list[str], shard_size: int, columns: list[str] | None = None) -> DataFrame:
    """(shard, ordinal, line): rows as canonical JSON (sorted keys, compact, text kept), numbered by `key`, in shards of equal size.

    Numbering needs no global sort in one task: rows are range-partitioned by the key, and each partition begins where
    the counts of the ones before it end.
    """
    cols = columns or df.columns
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = df.select(F.struct(*[F.col(c) for c in key]).alias("_k"), F.struct(*[F.col(c) for c in sorted(cols)]).alias("_r")).repartitionByRange(int(n), "_k").sortWithinPartitions("_k")
    from ..session import cut_lineage

    parts = cut_lineage(ranged.select(F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i"), F.to_json("_r", {"ignoreNullFields": "false"}).alias("line")))
    # one number per range partition
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    starts = sizes.select("_p", "_first", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_start"))
    placed = parts.join(F.broadcast(starts), "_p").select((F.col("_start") + F.col("_i") - F.col("_first")).alias("ordinal"), "line")
    return placed.select(F.floor(F.col("ordinal") / shard_size).cast("int").alias("shard"), "ordinal", "line")


def export_shards(df: DataFrame, key: list[str], path: str, shard_size: int = 10_000, dry_run: bool = False) -> DataFrame:
    """JSON lines under path/shard=N; returns the manifest (shard, file, n_rows, sha256), written to path/manifest too.

    Each digest is over exactly the bytes of the shard's lines.  A dry run computes the manifest and writes nothing.
    """
    lines = canonical_lines(df, key, shard_size)

    def digest(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ordinal")
        data = "".join(x + "\n" for x in pdf["line"]).encode()
        s = int(pdf["shard"].iloc[0])
        return pd.DataFrame([(s, f"windows-{s:05d}.jsonl", len(pdf), hashlib.sha256(data).hexdigest())], columns=["shard", "file", "n_rows", "sha256"])

    manifest = lines.groupBy("shard").applyInPandas(digest, "shard int, file string, n_rows long, sha256 string")
    if not dry_run:
        lines.repartition("shard").sortWithinPartitions("shard", "ordinal").select("shard", F.col("line").alias("value")).write.partitionBy("shard").mode("errorifexists").text(f"{path}/lines")
        manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/manifest")
    return manifest


def write_payloads(df: DataFrame, folder: str, name: str = "source_file", content: str = "content", valid: Callable[[bytes], bool] | None = None) -> DataFrame:
    """One file per row under a shared folder; (name, bytes, written) tells which passed the check.

    Files are written beside their place and moved, through the file system that the folder's scheme names (local or
    mounted paths, hdfs, s3, gs, abfs).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(base, recursive=True)
        for pdf in batches:
            rows = []
            for n, data in zip(pdf["n"], pdf["c"]):
                ok = data is not None and (valid is None or valid(data))
                if ok:
                    final = f"{base.rstrip('/')}/{n}"
                    part = f"{final}.{uuid.uuid4().hex}.part"
                    with store.open_output_stream(part) as f:
                        f.write(data)
                    store.move(part, final)
                rows.append((n, len(data or b""), ok))
            yield pd.DataFrame(rows, columns=["name", "bytes", "written"])

    return df.select(F.col(name).alias("n"), F.col(content).alias("c")).mapInPandas(run, "name string, bytes long, written boolean")


def report_lines(sections: list[tuple[str, DataFrame]]) -> list[str]:
    """A text report: a heading per section, then all its rows as "a | b | c", in the order of the DataFrame.

    Sections are small aggregates; their lines are held in the driver.
    """
    out: list[str] = []
    for title, df in sections:
        out += [title, "-" * len(title)]
        out += [" | ".join("" if v is None else str(v) for v in r) for r in df.collect()]
        out.append("")
    return out


def canonical_json(value: dict) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
