"""Session helpers: building a session, cutting lineage, and sizing work from the cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


CLEAN = "spark.cleaner.referenceTracking.cleanCheckpoints"


def build_session(app: str = "corpusloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC timestamps, adaptive execution and Arrow transfer; cluster settings already given win."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` once in the shared checkpoint folder and return a DataFrame that reads it.

    The folder is the one the cluster names in spark.checkpoint.dir.  Only a single-JVM session without that
    setting gets a folder of its own; elsewhere a missing setting is an error, because a machine-local folder
    would be lost together with its executor.  Files go as soon as nothing refers to them any more, unless the session
    says otherwise.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    conf = sc._jsc.sc().conf()
    if not conf.contains(CLEAN):
        conf.set(CLEAN, "true")
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not is_local(spark):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = os.path.join(tempfile.gettempdir(), "corpusloom-checkpoints")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    """Number of reduce partitions for exchanges whose width the caller has to name (range partitioning)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once; executors fetch it from the driver."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
