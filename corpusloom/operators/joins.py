"""Lookup, bridge, gap and replacement joins.

Sides are never broadcast by hint: the planner does so below its own size threshold, and adaptive execution splits
skewed keys of the rest.  Joins that must not lose or double rows say so in their name and check it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse_ws, has_value, split_set, strip, text_or_empty


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str, default: Column | None = None) -> DataFrame:
    """Left join of one value; `default` where the key is absent, an error if there is no default."""
    d = dim.select(F.col(dim_key).alias("_k"), F.col(value).alias("_v"), F.lit(True).alias("_hit"))
    j = df.join(d, F.col(key) == F.col("_k"), "left")
    absent = default if default is not None else F.raise_error(F.concat(F.lit(f"unknown {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast(dim.schema[value].dataType)
    return j.withColumn(out, F.when(F.col("_hit"), F.col("_v")).otherwise(absent)).drop("_k", "_v", "_hit")


def bridge(df: DataFrame, keys: list[str], packed: str, out: str, sep: str = "|") -> DataFrame:
    """(keys..., out): one row per distinct value of a packed cell."""
    return df.select(*keys, F.explode(split_set(packed, sep)).alias(out))


def zero_filled(dim: DataFrame, key: str, counts: DataFrame, measures: list[str]) -> DataFrame:
    """Every row of the dimension with its measures, 0 where nothing was counted."""
    return dim.join(counts, key, "left").na.fill(0, measures)


def gaps(dim: DataFrame, key: str, used: DataFrame, used_key: str | None = None) -> DataFrame:
    """Rows of the dimension whose key is not used anywhere."""
    u = used.select(F.col(used_key or key).alias("_u"))
    return dim.join(u, F.col(key) == F.col("_u"), "left_anti")


def attach_all(df: DataFrame, facts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Inner join that must find facts for every row: a row without any raises an error."""
    f = facts.select(F.col(key).alias("_k"), *columns)
    j = df.join(f, F.col(key) == F.col("_k"), "left")
    ok = F.when(F.col("_k").isNull(), F.raise_error(F.concat(F.lit("no facts for "), F.col(key).cast("string"))).cast("string")).otherwise(F.col(key).cast("string"))
    return j.withColumn("_k", ok).where("_k is not null").drop("_k")


def replace_by_key(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """The base with every row replaced whose key is in the patch; order of columns as in the base."""
    p = patch.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_p_{c}") for c in base.columns if c != key])
    j = base.join(p, F.col(key) == F.col("_k"), "left")
    hit = F.col("_k").isNotNull()
    return j.select(*[F.col(c) if c == key else F.when(hit, F.col(f"_p_{c}")).otherwise(F.col(c)).alias(c) for c in base.columns])


def mismatches(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(field, n): cells that differ between two tables after stripping; rows of `a` without partner count as "missing"."""
    r = b.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    j = a.join(r, F.col(key) == F.col("_k"), "left")
    both = F.col("_k").isNotNull()
    sums = [F.count(F.when(both & (text_or_empty(F.col(c).cast("string")) != text_or_empty(F.col(f"_b_{c}").cast("string"))), 1)).alias(c) for c in columns]
    one = j.agg(*sums, F.count(F.when(~both, 1)).alias("missing"))
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n")) for c in [*columns, "missing"]])).alias("e")).select("e.field", "e.n")


def cross_categories(dim: DataFrame, categories: list[str], order: str) -> DataFrame:
    """Every row with every category of a fixed list, numbered from 1 by (order, category's place).

    The list is a literal array, so this is a projection and no join; the number is place * size + offset within an
    ordering that the rank of the dimension's rows gives.
    """
    from pyspark.sql import Window

    ranked = dim.withColumn("_r", F.row_number().over(Window.orderBy(order)))  # a dimension: one row per entity
    e = F.posexplode(F.array(*[F.lit(c) for c in categories])).alias("_p", "category")
    return ranked.select("*", e).withColumn("query_id", (F.col("_r") - 1) * len(categories) + F.col("_p") + 1).drop("_r", "_p")


def by_normal_name(a: DataFrame, a_name: str, b: DataFrame, b_name: str, b_value: str) -> DataFrame:
    """Left join on names with blanks collapsed and case ignored; of equal names in `b` the least value counts."""
    names = b.groupBy(F.lower(collapse_ws(b_name)).alias("_n")).agg(F.min(b_value).alias(b_value))
    return a.join(names, F.lower(collapse_ws(a_name)) == F.col("_n"), "left").drop("_n")


def exactly_one(df: DataFrame, condition: Column, what: str) -> DataFrame:
    """The single row that fulfils the condition; an error that names the count otherwise."""
    hit = df.where(condition)
    n = hit.limit(2).count()
    if n != 1:
        raise ValueError(f"{what}: {'none' if n == 0 else 'several'} found where one is needed")
    return hit


def multimap(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, values): sorted distinct non-blank values per non-blank key; a key with blank values only has none."""
    k, v = strip(key), strip(value)
    return df.where(has_value(key)).groupBy(k.alias(key)).agg(F.array_sort(F.collect_set(F.when(has_value(value), v))).alias("values"))


def set_relation(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: equal, subset (a in b), superset (b in a) as sets of keys, and same_counts as multisets; null keys don't count.

    Each side is counted per key before the join, so a hot key is one row.
    """
    per = lambda d, n: d.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(n))
    j = per(a, "_a").join(per(b, "_b"), key, "full")
    only_a, only_b = F.count(F.when(F.col("_b").isNull(), 1)), F.count(F.when(F.col("_a").isNull(), 1))
    differ = F.count(F.when(~F.col("_a").eqNullSafe(F.col("_b")), 1))
    return j.agg(((only_a == 0) & (only_b == 0)).alias("equal"), (only_a == 0).alias("subset"), (only_b == 0).alias("superset"), (differ == 0).alias("same_counts"))
