"""Vector collections: one table per collection in hash buckets, opened or created, upserted by id, looked up and inspected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import canonical_json
from ..operators.vector import norm
from ..session import cut_lineage

VECTOR = T.ArrayType(T.FloatType())
BUCKETS = 64


def payload(fields: dict[str, Column], groups: dict[str, dict[str, Column]] | None = None) -> Column:
    """Payload of a point as canonical JSON: its fields, and under their names groups of more fields; nulls are kept."""
    nested = {name: F.struct(*[c.alias(k) for k, c in sorted(g.items())]) for name, g in (groups or {}).items()}
    return canonical_json(fields | nested)


class Collection:
    """A folder of (id, vector, norm, payload) rows; payload is a JSON string.  Collections are never mixed.

    Rows lie in folders bucket=<n> by a hash of their id, so an upsert rewrites only the buckets its ids fall into and a
    lookup reads only those.  The number of buckets belongs to the collection; choose it so that one bucket is a few
    hundred MB.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, dimension: int = 768, buckets: int = BUCKETS):
        if not name or isinstance(dimension, bool) or dimension <= 0 or buckets <= 0:
            raise ValueError("a collection needs a name, a positive dimension and a positive number of buckets")
        self.spark, self.name, self.dimension, self.buckets = spark, name, dimension, buckets
        self.path = f"{path.rstrip('/')}/{name}"
        self.schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("vector", VECTOR), T.StructField("norm", T.DoubleType()), T.StructField("payload", T.StringType())])
        self._stored = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        if not self.exists():
            spark.createDataFrame([], self._stored).write.partitionBy("bucket").parquet(self.path)

    def exists(self) -> bool:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _bucket(self, c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    def _read(self) -> DataFrame:
        return self.spark.read.schema(self._stored).parquet(self.path)

    def read(self) -> DataFrame:
        return self._read().drop("bucket")

    def upsert(self, points: DataFrame) -> int:
        """Insert or replace points (id, vector, payload); returns how many came.

        Repeated ids in one call and vectors of another dimension are errors; no points change nothing.  What a touched
        bucket is to hold is written to the checkpoint folder first and then put in its place, bucket by bucket; a run
        that breaks off in between is mended by the same upsert again.
        """
        p = points.select(F.col("id").cast("string"), F.col("vector").cast(VECTOR).alias("vector"), F.col("payload").cast("string").alias("payload"))
        p = cut_lineage(p.select("id", "vector", norm("vector").alias("norm"), "payload", self._bucket(F.col("id")).alias("bucket")))
        checks = p.agg(
            F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count(F.when(F.coalesce(F.size("vector"), F.lit(-1)) != self.dimension, 1)).alias("wrong"), F.collect_set("bucket").alias("touched")
        ).first()
        if checks["n"] == 0:
            return 0
        if checks["ids"] != checks["n"]:
            raise ValueError("ids repeat within one upsert")
        if checks["wrong"]:
            raise ValueError(f"{checks['wrong']} vectors don't have {self.dimension} dimensions")
        kept = self._read().where(F.col("bucket").isin(*checks["touched"]))
        new = cut_lineage(merged(kept, p).repartition(min(self.buckets, len(checks["touched"])), "bucket"))
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)
        return checks["n"]

    def lookup(self, ids: list[str]) -> DataFrame:
        """Points of a stated list of ids; ids that aren't there are absent."""
        if not ids:
            return self.read().limit(0)
        hashed = self.spark.createDataFrame([(i,) for i in ids], "id string").select(self._bucket(F.col("id")).alias("b")).distinct().collect()
        return self._read().where(F.col("bucket").isin(*[r["b"] for r in hashed]) & F.col("id").isin(*ids)).drop("bucket")

    def lookup_all(self, ids: DataFrame) -> DataFrame:
        """Points of a table of ids (id)."""
        wanted = ids.select(F.col("id").cast("string")).distinct().withColumn("bucket", self._bucket(F.col("id")))
        return self._read().join(wanted, ["bucket", "id"], "left_semi").drop("bucket")

    def inspect(self) -> DataFrame:
        """One row: name, n, least and greatest dimension, distance."""
        s = F.size("vector")
        return self.read().agg(F.lit(self.name).alias("name"), F.count("*").alias("n"), F.min(s).alias("least"), F.max(s).alias("greatest"), F.lit("cosine").alias("distance"))


def check_target(collection: Collection, name: str, dimension: int, forbidden: tuple[str, ...] = ()) -> None:
    """ValueError unless the collection is the one meant and none of the forbidden ones."""
    if collection.name in forbidden or collection.name != name or collection.dimension != dimension:
        raise ValueError(f"collection {collection.name} of dimension {collection.dimension} is not the target {name} of dimension {dimension}")


def merged(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Rows of `new`, and those of `old` whose key is not among them."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))
