"""Ranks, numbers, sorts, extremes and samples with complete tie rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def numeric_then_text(c: str) -> list[Column]:
    """Sort keys: numbers first and ascending, then other strings as such."""
    n = F.when(F.col(c).rlike(r"^\s*[0-9]+\s*$"), F.col(c).try_cast("bigint"))
    return [n.asc_nulls_last(), F.col(c).asc()]


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows of an order that has no ties; never a full sort (a bounded heap per task)."""
    return df.orderBy(*order).limit(n)


def most_common(df: DataFrame, value: str, seq: str, n: int) -> DataFrame:
    """(value, n) of the most frequent values; of equals the one seen first."""
    c = df.groupBy(value).agg(F.count("*").alias("n"), F.min(seq).alias("_first"))
    return c.orderBy(F.col("n").desc(), F.col("_first")).limit(n).select(value, "n")


def hash_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows that a digest of seed and key picks: the same rows however the table is partitioned, here and in SQL."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), F.col(key)).limit(n)


def evenly_spaced(df: DataFrame, order: list[Column], count: int = 5) -> DataFrame:
    """`count` rows at the places round(i * (n - 1) / (count - 1)) of a complete order, halves to even."""
    n = df.count()
    if n == 0 or count < 1:
        return df.limit(0)
    at = sorted({round(i * (n - 1) / (count - 1)) for i in range(count)} if count > 1 else {0})
    return numbered(df, order).where(F.col("_i").isin(at)).drop("_i")


def numbered(df: DataFrame, order: list[Column], out: str = "_i") -> DataFrame:
    """Rows with their place in a complete order, from 0, without a sort in one task.

    Rows are range-partitioned by the order and sorted within; each partition begins where the counts of the ones before
    it end (one number per partition).
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    parts = cut_lineage(ranged.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m")))
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_m").alias("_first"))
    starts = sizes.select("_p", "_first", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_start"))
    return parts.join(F.broadcast(starts), "_p").withColumn(out, F.col("_start") + F.col("_m") - F.col("_first")).drop("_p", "_m", "_first", "_start")


def first_of(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows; an error if there are fewer."""
    got = df.orderBy(*order).limit(n)
    have = got.count()
    if have < n:
        raise ValueError(f"{have} rows where {n} are needed")
    return got


def rank_within(df: DataFrame, group: str, order: list[Column], out: str, only: list[str] | None = None) -> DataFrame:
    """Place within the group from 1; null for groups that are not in `only`."""
    r = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn(out, F.when(F.col(group).isin(*only), r) if only else r)


def batch_number(df: DataFrame, order: list[Column], size: int, out: str = "batch") -> DataFrame:
    """Rows with the number of their batch of `size` rows in a complete order, from 0."""
    return numbered(df, order, out).withColumn(out, F.floor(F.col(out) / size))


def redundant_tail(chunks: DataFrame, group: list[str], index: str, text: str) -> DataFrame:
    """Flags chunks whose text the previous chunk of the same group already ends with."""
    before = F.lag(text).over(Window.partitionBy(*group).orderBy(index))
    return chunks.withColumn("redundant", F.coalesce(F.endswith(before, F.col(text)), F.lit(False)))


def winner(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """The first row of each group by a complete order; only one row per group and partition is shuffled."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def examples(df: DataFrame, key: str, order: list[Column], conditions: list[tuple[str, Column]]) -> DataFrame:
    """(label, key): per condition in turn the first row that fulfils it and was not taken by an earlier one.

    Only as many rows per condition as there are conditions can matter, so the choice runs over that few.
    """
    k = len(conditions)
    found = None
    for i, (label, cond) in enumerate(conditions):
        part = df.where(cond).orderBy(*order, F.col(key)).limit(k).select(F.lit(i).alias("i"), F.lit(label).alias("label"), F.col(key).alias("k"))
        part = part.withColumn("r", F.monotonically_increasing_id())
        found = part if found is None else found.unionByName(part)
    taken, out = set(), []
    for r in sorted(found.collect(), key=lambda r: (r["i"], r["r"])) if found is not None else []:  # at most k * k rows
        if r["k"] not in taken and r["label"] not in {x[0] for x in out}:
            taken.add(r["k"])
            out.append((r["label"], r["k"]))
    return df.sparkSession.createDataFrame(out, f"label string, {key} {dict(df.dtypes)[key]}")


def greedy_diverse(df: DataFrame, group: str, item: str, labels: str, prefer: list[tuple[str, bool]], n: int) -> DataFrame:
    """(group, item, place, new_labels): up to n items per group, each time the one that adds most labels not covered yet.

    Of equals the one first in `prefer` (column, descending) and then the least item.  An item can be picked only if it
    is among the first n in preference of those with its label set, so the candidates are cut to n per (group, label
    set) before the sequential choice, which keeps every choice and bounds a group by n times its label sets.
    """
    import pandas as pd

    slim = df.select(F.col(group).alias("g"), F.col(item).alias("i"), F.array_sort(F.array_distinct(F.coalesce(labels, F.array().cast("array<string>")))).alias("l"), *[c for c, _ in prefer if c not in (group, item)])
    order = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in prefer] + [F.col("i").asc()]
    w = Window.partitionBy("g", "l").orderBy(*order)
    cut = slim.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n)
    cut = cut.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy(*order))).select("g", "i", "l", "p")
    out = f"{group} {dict(df.dtypes)[group]}, {item} {dict(df.dtypes)[item]}, place int, new_labels int"

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(pdf["p"], pdf["i"], map(frozenset, pdf["l"])))
        covered: frozenset = frozenset()
        out = []
        while rows and len(out) < n:
            k = max(range(len(rows)), key=lambda j: (len(rows[j][2] - covered), -rows[j][0]))
            _, i, labels_ = rows.pop(k)
            out.append((pdf["g"].iloc[0], i, len(out) + 1, len(labels_ - covered)))
            covered |= labels_
        return pd.DataFrame(out, columns=[group, item, "place", "new_labels"])

    return cut.groupBy("g").applyInPandas(pick, out)


def greedy_balanced(df: DataFrame, group: str, item: str, labels: str, profile: str, prefer: list[tuple[str, bool]], n: int) -> DataFrame:
    """(group, item, place, label): up to n items per group, each time one for the label that the picked items hold least often.

    Of equally rare labels the first by name counts; of a label's items first one whose profile is not among the picked,
    then the one first in `prefer` (column, descending), then the least item.  The picks for a smaller n are the first
    of those for a larger one.  An item without labels is never picked.  Only the first n in preference of those with
    the same labels and profile can be picked, so the candidates are cut to them before the sequential choice.
    """
    import pandas as pd

    slim = df.select(
        F.col(group).alias("g"), F.col(item).alias("i"), F.array_sort(F.array_distinct(F.coalesce(labels, F.array().cast("array<string>")))).alias("l"), F.coalesce(profile, F.lit("")).alias("f"),
        *[c for c, _ in prefer if c not in (group, item)],
    ).where(F.size("l") > 0)
    order = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in prefer] + [F.col("i").asc()]
    cut = slim.withColumn("r", F.row_number().over(Window.partitionBy("g", "l", "f").orderBy(*order))).where(F.col("r") <= n)
    cut = cut.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy(*order))).select("g", "i", "l", "f", "p")
    out = f"{group} {dict(df.dtypes)[group]}, {item} {dict(df.dtypes)[item]}, place int, label string"

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        left = {p: (i, tuple(l), f) for p, i, l, f in zip(pdf["p"], pdf["i"], pdf["l"], pdf["f"])}
        held: dict[str, int] = {}
        seen: set[str] = set()
        out = []
        while left and len(out) < n:
            _, label, _, p = min((held.get(x, 0), x, f in seen, p) for p, (_, l, f) in left.items() for x in l)
            i, l, f = left.pop(p)
            out.append((pdf["g"].iloc[0], i, len(out) + 1, label))
            seen.add(f)
            for x in l:
                held[x] = held.get(x, 0) + 1
        return pd.DataFrame(out, columns=[group, item, "place", "label"])

    return cut.groupBy("g").applyInPandas(pick, out)
