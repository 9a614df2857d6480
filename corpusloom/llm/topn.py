"""The N best items of every group, for millions of groups of any size.

Every partition knows a bound from its own rows: the score of its N-th best distinct item of a group, beyond which no
row of the group can be among the N best anywhere.  Rows beyond the own bound never leave their partition; the
strictest bound of each group, over all partitions, is joined to what is left and filters it again; the survivors are
ranked.  Without tie values the bound is that of the whole order, score and item.  The bounds of groups of which many
rows are left, as their items all tie, go to the rows, so these are not gathered by group.  The last ranking is limited
inside each partition once more before its shuffle, by the full order with ties, so such groups stay small too.

Order: lowest score, then lowest tie value (none last), then lowest item.  An item counts once per group, with its
lowest score.

Defined results: rows without a group number, item or score are left out; a null in another group column is a group of
its own; groups with fewer than N items keep them all; repeated rows count once; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

BUFFER = 200_000  # rows of a partition that are pruned together; bounds memory, not the result
HOT = 100_000  # rows of a group that partitions leave over, from which on its bound goes to the rows


def _bounded(n: int, names: list[str], groups: int, with_ties: bool):
    """mapInArrow function over (group columns, item, score): rows that may be among the n best, with their local bound."""

    def prune(table: pa.Table) -> pa.RecordBatch:
        code = np.zeros(table.num_rows, np.int64)
        for i in range(groups):
            part = table.column(i).combine_chunks().dictionary_encode(null_encoding="encode")
            code = code * (len(part.dictionary) + 1) + part.indices.to_numpy(zero_copy_only=False)
            code = np.unique(code, return_inverse=True)[1]
        item, score = table.column(groups).to_numpy(), table.column(groups + 1).to_numpy()
        order = np.lexsort((score, item, code))
        c, x = code[order], item[order]
        order = order[np.r_[True, (c[1:] != c[:-1]) | (x[1:] != x[:-1])]]  # the best row of each item
        order = order[np.lexsort((item[order], score[order], code[order]))]
        c, s = code[order], score[order]
        start = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        size = np.diff(np.r_[start, len(c)])
        bound = np.where(size >= n, s[np.minimum(start + n - 1, len(c) - 1)], np.iinfo(np.int64).max)
        bound = np.repeat(bound, size)
        keep = s <= bound if with_ties else np.arange(len(c)) - np.repeat(start, size) < n
        out = table.take(pa.array(order[keep])).combine_chunks()
        return pa.RecordBatch.from_arrays([*[k.combine_chunks() if isinstance(k, pa.ChunkedArray) else k for k in out.columns], pa.array(bound[keep])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
            if rows >= BUFFER:
                yield prune(pa.Table.from_batches(held))
                held, rows = [], 0
        if held:
            yield prune(pa.Table.from_batches(held))

    return run


def top_n(df: DataFrame, groups: list[str], item: str, score: str, n: int, ties: DataFrame | None = None, hot_rows: int = HOT) -> DataFrame:
    """(groups..., item, score, tie, place) of the n best items per group; item and score are bigint, lower is better.

    `ties` (item, tie) breaks equal scores; an item may have several rows there, the lowest counts.
    """
    if n <= 0:
        raise ValueError("n must be positive")
    g = [f"g{i}" for i in range(len(groups))]
    slim = df.select(*[F.col(c).alias(a) for c, a in zip(groups, g)], F.col(item).cast("bigint").alias("item"), F.col(score).cast("bigint").alias("score"))
    slim = slim.where("item is not null and score is not null")
    out = T.StructType([*slim.schema.fields, T.StructField("bound", T.LongType())])
    pruned = cut_lineage(slim.mapInArrow(_bounded(n, out.names, len(g), ties is not None), out))
    stats = pruned.groupBy(*g).agg(F.min("bound").alias("best"), F.count("*").alias("left")).select(*[F.col(c).alias(f"b_{c}") for c in g], "best", "left")
    same = F.lit(True)
    for c in g:
        same = same & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    hot = cut_lineage(stats.where(F.col("left") > hot_rows))
    survivors = pruned.join(stats, same).where("score <= best")
    if hot.count():
        # at most one in `hot_rows` rows is here, so these few bounds go to the rows, which stay where they are
        crowded = pruned.join(F.broadcast(hot), same).where("score <= best")
        rest = pruned.join(F.broadcast(hot), same, "left_anti").join(stats, same).where("score <= best")
        survivors = crowded.unionByName(rest)
    once = survivors.groupBy(*g, "item").agg(F.min("score").alias("score"))
    if ties is None:
        once = once.withColumn("tie", F.lit(None).cast("bigint"))
    else:
        low = ties.select(F.col("item").cast("bigint").alias("item"), F.col("tie").cast("bigint").alias("tie")).where("item is not null").groupBy("item").agg(F.min("tie").alias("tie"))
        once = once.join(low, "item", "left")
    w = Window.partitionBy(*g).orderBy(F.col("score"), F.col("tie").asc_nulls_last(), F.col("item"))
    placed = once.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
    return placed.select(*[F.col(a).alias(c) for c, a in zip(groups, g)], F.col("item").alias(item), F.col("score").alias(score), "tie", "place")
