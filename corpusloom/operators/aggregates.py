"""Counts, completeness, distributions, provenance and skew.  All of them combine on the map side before a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_value, split_list, split_set, text_or_empty


def count_by(df: DataFrame, key: str, blank: str = "(empty)", out: str = "n") -> DataFrame:
    k = text_or_empty(F.col(key).cast("string"))
    return df.groupBy(F.when(k == "", blank).otherwise(k).alias(key)).agg(F.count("*").alias(out))


def count_packed(df: DataFrame, packed: str, distinct: bool = True, sep: str = "|") -> DataFrame:
    """(value, n) over a packed column; `distinct` counts a value once per row."""
    values = split_set(packed, sep) if distinct else split_list(packed, sep)
    return df.select(F.explode(values).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, filled, total, share) and a last row "(all)" over all cells."""
    one = df.agg(F.count("*").alias("_n"), *[F.count(F.when(has_value(F.col(f).cast("string")), 1)).alias(f) for f in fields])
    rows = [F.struct(F.lit(f).alias("field"), F.col(f).alias("filled"), F.col("_n").alias("total")) for f in fields]
    every = sum((F.col(f) for f in fields), F.lit(0))
    rows.append(F.struct(F.lit("(all)").alias("field"), every.cast("bigint").alias("filled"), (F.col("_n") * len(fields)).alias("total")))
    e = one.select(F.explode(F.array(*rows)).alias("e")).select("e.*")
    return e.withColumn("share", F.when(F.col("total") > 0, F.round(F.col("filled") / F.col("total"), 6)).otherwise(0.0))


def quadrants(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: rows with only a, only b, both and neither."""
    x, y = has_value(a), has_value(b)
    return df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in (("only_a", x & ~y), ("only_b", ~x & y), ("both", x & y), ("neither", ~x & ~y))])


def combinations(df: DataFrame, packed: str, declared: list[str] | None = None, sep: str = "|") -> DataFrame:
    """(combo, n): sets of values that occur together, "a + b", in sorted or declared order, "(none)" for no value."""
    values = split_set(packed, sep)
    if declared:
        low = F.transform(values, F.lower)
        values = F.filter(F.array(*[F.lit(c) for c in declared]), lambda c: F.array_contains(low, c))
    else:
        values = F.array_sort(values)
    combo = F.array_join(values, " + ")
    return df.groupBy(F.when(combo == "", "(none)").otherwise(combo).alias("combo")).agg(F.count("*").alias("n"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """One row: total, distinct, repeated values, extra rows, blanks (kept out of the other figures)."""
    k = F.col(key).cast("string")
    per = df.groupBy(F.when(has_value(k), k).alias("_k")).agg(F.count("*").alias("n"))
    some = F.col("_k").isNotNull()
    return per.agg(
        F.coalesce(F.sum(F.when(some, F.col("n"))), F.lit(0)).alias("total"),
        F.count("_k").alias("distinct_values"),
        F.count(F.when(some & (F.col("n") > 1), 1)).alias("repeated_values"),
        F.coalesce(F.sum(F.when(some, F.col("n") - 1)), F.lit(0)).alias("extra_rows"),
        F.coalesce(F.sum(F.when(~some, F.col("n"))), F.lit(0)).alias("blank"),
    )


def union_of_sets(df: DataFrame, key: str, packed: str, sep: str = "|") -> DataFrame:
    """(key, values): sorted union of the packed values of each group, packed again."""
    e = df.select(key, F.explode(split_set(packed, sep)).alias("v")).distinct()
    return e.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("v")), sep).alias("values"))


def provenance(df: DataFrame, key: str, sets: list[str], least: str | None = None, lists: dict[str, str] | None = None, seq: str = "seq") -> DataFrame:
    """Per key: each of `sets` as a sorted packed set, the least of a number, and `lists` packed in arrival order."""
    aggs: list[Column] = [F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), "|").alias(c) for c in sets]
    if least:
        aggs.append(F.min(least).alias(least))
    for c, out in (lists or {}).items():
        # equal pairs say the same, so a set holds them
        pairs = F.array_sort(F.collect_set(F.struct(F.col(seq), F.col(c).cast("string").alias("v"))))
        aggs.append(F.array_join(F.transform(pairs, lambda p: p["v"]), "|").alias(out))
    return df.groupBy(key).agg(*aggs)


def merge_packed(df: DataFrame, key: str, packed: dict[str, str], seq: str, least: str | None = None) -> DataFrame:
    """Per key: packed cells (column: separator) merged by first occurrence; the least of a digit-only number.

    Rows without a key are a group of their own.  What is gathered per key are its distinct values.
    """
    if least:
        n = F.when(F.trim(least).rlike("^[0-9]+$"), F.trim(least).try_cast("bigint"))
        out = df.groupBy(key).agg(F.min(n).alias(least))
    else:
        out = df.select(key).distinct()
    for c, sep in packed.items():
        # each distinct value once, with its first place, before anything is gathered
        values = df.select(F.col(key).alias("_k"), F.col(seq).alias("_s"), F.posexplode(split_list(c, sep)).alias("_p", "_v"))
        first = values.groupBy("_k", "_v").agg(F.min(F.struct("_s", "_p")).alias("_at"))
        one = first.groupBy("_k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda x: x["_v"]), sep).alias(c))
        out = out.join(one, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k").na.fill("", [c])
    return out.select(key, *packed, *([least] if least else []))


def keep_first(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The first row of each key in order of `seq`, found by a combinable aggregate instead of a sort of all rows."""
    rest = [c for c in df.columns if c not in keys]
    least = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("_r"))
    return least.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def distinct_pairs_per_label(df: DataFrame, text: str, label: str) -> DataFrame:
    """(label, rows, pairs): rows and distinct (text, label) pairs per label; blank texts are left out."""
    d = df.where(has_value(text)).groupBy(label, text).agg(F.count("*").alias("n"))
    return d.groupBy(label).agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_pairs"))


def describe(df: DataFrame, value: str, points: tuple[float, ...] = (0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """One row: n, min, max, mean, median and linearly interpolated percentiles."""
    p = [F.round(F.percentile(F.col(value), F.lit(x)), 6).alias(f"p{round(x * 100)}") for x in points]
    return df.agg(F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("greatest"), F.round(F.avg(value), 6).alias("mean"), F.round(F.median(value), 6).alias("median"), *p)


def histogram_median(freq: DataFrame, value: str, n: str) -> DataFrame:
    """One row: median of a value-to-frequency table."""
    return freq.agg(F.round(F.percentile(F.col(value), F.lit(0.5), F.col(n)), 6).alias("median"))


def skew(per_group: DataFrame, measure: str, order: str) -> DataFrame:
    """One row: share of the top tenth of the groups, max over median, and whether that is heavy (> 25 % or > 3)."""
    w = Window.orderBy(F.col(measure).desc(), F.col(order))  # one row per group of a finished aggregate
    n = F.count("*").over(Window.partitionBy(F.lit(1)))
    ranked = per_group.select(measure, F.row_number().over(w).alias("_r"), n.alias("_n"))
    one = ranked.agg(
        F.sum(F.when(F.col("_r") <= F.ceil(F.col("_n") * 0.1), F.col(measure)).otherwise(0)).alias("top"), F.sum(measure).alias("all"), F.max(measure).alias("most"), F.median(measure).alias("mid")
    )
    share = F.when(F.col("all") > 0, F.col("top") / F.col("all")).otherwise(0.0)
    ratio = F.when(F.col("mid") > 0, F.col("most") / F.col("mid")).when(F.col("most") > 0, F.lit(float("inf"))).otherwise(0.0)
    return one.select(F.round(share, 6).alias("top_decile_share"), F.round(ratio, 6).alias("max_to_median"), ((share > 0.25) | (ratio > 3)).alias("heavy"))


def bucket(value: Column, ranges: list[tuple[str, int | None, int | None]], default: str = "(other)") -> Column:
    """Label of the first inclusive range that holds the value; an open end is None."""
    out = None
    for label, lo, hi in ranges:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (value >= lo)
        if hi is not None:
            cond = cond & (value <= hi)
        cond = cond & value.isNotNull()
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def count_buckets(df: DataFrame, value: Column, ranges: list[tuple[str, int | None, int | None]]) -> DataFrame:
    """(bucket, n, share) of every range, 0 for empty ones, in one pass without a shuffle of the rows."""
    b = bucket(value, ranges)
    one = df.select(b.alias("_b")).agg(F.count("*").alias("_n"), *[F.count(F.when(F.col("_b") == label, 1)).alias(f"b{i}") for i, (label, _, _) in enumerate(ranges)])
    e = F.explode(F.array(*[F.struct(F.lit(label).alias("bucket"), F.col(f"b{i}").alias("n"), F.col("_n").alias("t")) for i, (label, _, _) in enumerate(ranges)])).alias("e")
    return one.select(e).select("e.bucket", "e.n", F.when(F.col("e.t") > 0, F.round(F.col("e.n") / F.col("e.t"), 6)).otherwise(0.0).alias("share"))


def duplicate_paths(sections: DataFrame, key: str, path: str) -> DataFrame:
    """(key, extra): sections whose path occurred before in the same article."""
    return sections.groupBy(key, path).agg(F.count("*").alias("n")).groupBy(key).agg(F.sum(F.col("n") - 1).alias("extra"))


def storage(df: DataFrame, dimension: int = 768, width: int = 4) -> DataFrame:
    """One row: n vectors, bytes, MiB."""
    return df.agg(F.count("*").alias("n")).select("n", (F.col("n") * dimension * width).alias("bytes"), F.round(F.col("n") * dimension * width / 1048576, 6).alias("mib"))


def funnel(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """(stage, name, n): rows left after each condition in turn, stage 0 all of them, in one pass."""
    aggs, so_far = [F.count("*").alias("s0")], F.lit(True)
    for i, (_, condition) in enumerate(stages, 1):
        so_far = so_far & F.coalesce(condition, F.lit(False))
        aggs.append(F.count(F.when(so_far, 1)).alias(f"s{i}"))
    names = ["all", *[n for n, _ in stages]]
    rows = F.array(*[F.struct(F.lit(i).alias("stage"), F.lit(n).alias("name"), F.col(f"s{i}").alias("n")) for i, n in enumerate(names)])
    return df.agg(*aggs).select(F.explode(rows).alias("e")).select("e.*")


def limited_with_total(df: DataFrame, order: list[Column], n: int) -> tuple[DataFrame, DataFrame]:
    """The first n rows, and the count of all of them."""
    return df.orderBy(*order).limit(n), df.agg(F.count("*").alias("n"))
