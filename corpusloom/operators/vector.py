"""Cosine search, deterministic point ids, and an embedder that works offline."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.ids import canonical_json, uuid5

EMBED_ROWS = 1024
_WORD = re.compile("[a-z0-9]+")


def dot(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def check_top_k(k: int) -> None:
    if isinstance(k, bool) or not isinstance(k, int) or k <= 0:
        raise ValueError("top_k must be a positive integer")


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def _matrix(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows with a vector of the dimension, their vectors)."""
    sizes = np.nan_to_num(np.asarray(pa.compute.list_value_length(col).to_numpy(zero_copy_only=False), float), nan=-1)
    good = np.flatnonzero(sizes == dim)
    flat = pa.compute.list_flatten(col.take(pa.array(good))).to_numpy(zero_copy_only=False).astype(np.float64)
    return good, np.nan_to_num(flat).reshape(len(good), dim)


def cosine_top_k(points: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "id", vector: str = "vector", block: int = 2000, tile: int = 1 << 20) -> DataFrame:
    """(query_id, id, score, rank): the k most similar points of every query, exact.

    Queries (query_id, vector) are a stated set; they go to the tasks in blocks of `block`, as one matrix, and each
    batch of points keeps only its k best per query before anything is shuffled; at most `tile` scores are held at once.
    Scores are rounded to 12 digits before they are compared, here and in the final order, so ties go to the lesser id
    however the points are partitioned.  A zero vector scores 0; points without a vector of the queries' dimension are
    left out.
    """
    found = _near(points, queries, k, id_col, vector, block, tile)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(id_col))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _near(points: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vector: str = "vector", block: int = 2000, tile: int = 1 << 20) -> DataFrame:
    """(query_id, id, score): the k best of every batch of points, among them the k best of all."""
    check_top_k(k)
    spark = points.sparkSession
    q_rows = queries.select("query_id", "vector").where("query_id is not null and vector is not null")
    n = q_rows.count()
    blocks = max(1, -(-n // block))
    kind = points.schema[id_col].dataType
    out = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField(id_col, kind), T.StructField("score", T.DoubleType())])
    slim = points.select(F.col(id_col), F.col(vector).alias("v")).where(f"{id_col} is not null")
    found = None
    for b in range(blocks):
        part = q_rows if blocks == 1 else q_rows.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
        rows = part.collect()
        if not rows:
            continue
        ids = [r["query_id"] for r in rows]
        dim = len(rows[0]["vector"])
        unit = _unit(np.array([r["vector"] for r in rows], np.float64))

        id_type = to_arrow_type(out["query_id"].dataType)

        def run(batches: Iterator[pa.RecordBatch], ids=ids, unit=unit, dim=dim, id_type=id_type) -> Iterator[pa.RecordBatch]:
            import pyarrow.compute  # noqa: F401

            for batch in batches:
                good, m = _matrix(batch.column(1), dim)
                if not len(good):
                    continue
                keys = batch.column(0).take(pa.array(good))
                by_id = pa.compute.sort_indices(keys).to_numpy()
                place = np.empty(len(good), np.int64)
                place[by_id] = np.arange(len(good))
                take, points_unit = min(k, len(good)), _unit(m).T
                for lo in range(0, len(unit), max(1, tile // len(good))):
                    score = np.round(unit[lo : lo + max(1, tile // len(good))] @ points_unit, 12)
                    # everything at or above the k-th best score stays, so ties are settled by the order below
                    kth = np.partition(-score, take - 1, axis=1)[:, take - 1 : take]
                    qi, pi = np.nonzero(-score <= kth)
                    order = np.lexsort((place[pi], -score[qi, pi], qi))
                    qi, pi = qi[order], pi[order]
                    first = np.r_[0, np.flatnonzero(qi[1:] != qi[:-1]) + 1]
                    nth = np.arange(len(qi)) - np.repeat(first, np.diff(np.r_[first, len(qi)]))
                    qi, pi = qi[nth < take], pi[nth < take]
                    yield pa.RecordBatch.from_arrays([pa.array([ids[lo + i] for i in qi], id_type), keys.take(pa.array(pi)), pa.array(score[qi, pi])], names=out.names)

        got = slim.mapInArrow(run, out)
        found = got if found is None else found.unionByName(got)
    if found is None:
        found = spark.createDataFrame([], out)
    return found


def dual_top_k(first: DataFrame, second: DataFrame, query: DataFrame, k: int = 5, names: tuple[str, str] = ("symptom", "literature"), **kw) -> DataFrame:
    """(evidence_id, source, rank, id, score): k best of each collection, never ranked against each other, the first ahead."""
    a = _near(first, query, k, **kw).withColumn("source", F.lit(names[0])).withColumn("_o", F.lit(0))
    b = _near(second, query, k, **kw).withColumn("source", F.lit(names[1])).withColumn("_o", F.lit(1))
    # both collections share the exchange by query; each is ranked by itself
    each = Window.partitionBy("query_id", "_o").orderBy(F.col("score").desc(), F.col(kw.get("id_col", "id")))
    both = a.unionByName(b).repartition("query_id").withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= k)
    n = F.row_number().over(Window.partitionBy("query_id").orderBy("_o", "rank"))
    return both.withColumn("evidence_id", n).drop("_o")


def point_id(fields: dict[str, Column], spaced: bool = False) -> Column:
    """Version-5 UUID of the canonical JSON of the identifying fields."""
    return uuid5(canonical_json(fields, spaced))


def hashed_embedding(df: DataFrame, key: str, text: str, dimension: int = 64) -> DataFrame:
    """(key, vector): counts of words per hash bucket, scaled to length 1; blank texts have none.

    Bucket of a word: first eight hex digits of its MD5, modulo the dimension.  Each row is counted where it is read, so
    nothing is shuffled.
    """
    out = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("vector", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}  # buckets of the words of one task; dropped when there are many
        for b in batches:
            for lo in range(0, b.num_rows, EMBED_ROWS):
                part = b.slice(lo, EMBED_ROWS)
                rows, buckets = [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    for w in _WORD.findall(t):
                        at = known.get(w)
                        if at is None:
                            if len(known) > 1_000_000:
                                known.clear()
                            at = known[w] = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dimension
                        rows.append(i)
                        buckets.append(at)
                n = np.bincount(np.array(rows, np.int64) * dimension + np.array(buckets, np.int64), minlength=part.num_rows * dimension).reshape(part.num_rows, dimension).astype(np.float64)
                some = np.flatnonzero(n.any(axis=1))
                m = _unit(n[some]).astype(np.float32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, dimension), pa.int32()), pa.array(m.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(some)), lists], names=out.names)

    return df.select(key, F.lower(F.col(text)).alias("t")).where("t is not null").mapInArrow(run, out)


def embed(df: DataFrame, key: str, text: str, load, dimension: int, batch: int = 32) -> DataFrame:
    """(key, vector) by a pluggable model: `load()` runs once per worker and returns a function of a list of texts.

    A null or blank text, or a vector of another dimension, is an error.
    """
    out = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("vector", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for b in batches:
            for lo in range(0, b.num_rows, batch):
                part = b.slice(lo, batch)
                texts = part.column(1).to_pylist()
                if any(t is None or not t.strip() for t in texts):
                    raise ValueError("blank text can't be embedded")
                m = np.asarray(model(texts), np.float32)
                if m.shape != (len(texts), dimension):
                    raise ValueError(f"the model gave {m.shape}, not {(len(texts), dimension)}")
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, dimension), pa.int32()), pa.array(m.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=out.names)

    return df.select(key, text).mapInArrow(run, out)
