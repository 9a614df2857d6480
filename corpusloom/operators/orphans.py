"""References without a valid target: one linear merge of sorted references and target events.

Targets are valid from a begin to an end (null: still valid).  References and target begins become one stream of
events, partitioned by ranges of (key, time) and sorted inside each partition, so both sides of a key lie together in
order of time, and a hot key is cut at a time instead of filling one task.  The merge keeps two numbers per key, the
first begin and the latest end so far; a reference is in force exactly if the latest end among the targets that began
by then lies after it.  What a key has seen before its partition begins is carried in from one summary row per
partition.

reason: "missing" no target at all; "late" all targets begin after the reference; "deleted" otherwise.

Defined results: a reference without a number or without a time is no reference; a target without a begin counts as
valid from the start; an end at or before its begin never holds; repeated rows are judged one by one; an empty target
table makes every reference "missing".
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import first_number
from ..session import cut_lineage, shuffle_width

_NEVER, _ALWAYS = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_MARK, _TARGET, _REFERENCE = 0, 1, 2


@dataclass(frozen=True)
class Reference:
    """A column of `table` that refers to `target_field` of `target`, and the columns that say when either is valid."""

    name: str
    table: DataFrame
    field: str
    at: str
    target: DataFrame
    target_name: str
    target_field: str
    begin: str
    end: str
    record: str = "record_id"


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _targets(code: int, df: DataFrame, field: str, begin: str, end: str) -> DataFrame:
    rows = df.select(
        F.lit(code).alias("target"),
        first_number(F.col(field).cast("string")).alias("number"),
        F.coalesce(_micros(F.col(begin)), F.lit(_NEVER + 1)).alias("t"),
        F.coalesce(_micros(F.col(end)), F.lit(_ALWAYS)).alias("v"),
    ).where("number is not null")
    # of targets that begin together only the latest end counts, so a hot key shrinks before it is shuffled
    once = rows.groupBy("target", "number", "t").agg(F.max("v").alias("v"))
    begins = once.where("v > t").select("target", "number", "t", F.lit(_TARGET).alias("kind"), "v", *_no_record())
    # one mark per key, ahead of all its events, holds its first begin
    marks = once.groupBy("target", "number").agg(F.min("t").alias("v")).select("target", "number", F.lit(_NEVER).alias("t"), F.lit(_MARK).alias("kind"), "v", *_no_record())
    return begins.unionByName(marks)


def _no_record() -> list[Column]:
    return [F.lit(None).cast("bigint").alias("record_id"), F.lit(None).cast("int").alias("ref")]


def _references(code: int, ref: int, r: Reference) -> DataFrame:
    return r.table.select(
        F.lit(code).alias("target"),
        first_number(F.col(r.field).cast("string")).alias("number"),
        _micros(F.col(r.at)).alias("t"),
        F.lit(_REFERENCE).alias("kind"),
        F.lit(0).cast("bigint").alias("v"),
        F.col(r.record).cast("bigint").alias("record_id"),
        F.lit(ref).cast("int").alias("ref"),
    ).where("number is not null and t is not null")


_MERGED = T.StructType(
    [
        T.StructField("kind", T.ByteType()),  # 0 a summary of a partition's last key, 1 an unsettled reference
        T.StructField("part", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("t", T.LongType()),
        T.StructField("first_begin", T.LongType()),
        T.StructField("last_end", T.LongType()),
        T.StructField("record_id", T.LongType()),
        T.StructField("ref", T.IntegerType()),
    ]
)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """References that no target seen so far holds, with what their key has seen; one summary row per partition.

    Input columns: part, key, t, kind, v, record_id, ref; sorted by (key, t, kind).
    """
    key, begin, end, part = None, _ALWAYS, _NEVER, 0
    def rows(kind, part, keys, t, b, e, rec, ref):
        n = len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int8)), pa.array(np.full(n, part, np.int32)), pa.array(keys, pa.string()), pa.array(t, pa.int64()), pa.array(b, pa.int64()), pa.array(e, pa.int64()), pa.array(rec, pa.int64()), pa.array(ref, pa.int32())],
            names=_MERGED.names,
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(0)[0].as_py()
        codes = batch.column(1).dictionary_encode()
        names, seg = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        t, kind, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        if names[seg[0]] != key:
            begin, end = _ALWAYS, _NEVER
        carried = seg == seg[0]
        b = pd.Series(np.where(kind == _MARK, v, _ALWAYS)).groupby(seg).cummin().to_numpy()
        e = pd.Series(np.where(kind == _TARGET, v, _NEVER)).groupby(seg).cummax().to_numpy()
        b, e = np.where(carried, np.minimum(b, begin), b), np.where(carried, np.maximum(e, end), e)
        bad = np.flatnonzero((kind == _REFERENCE) & (e <= t))
        if len(bad):
            at = pa.array(bad)
            yield rows(1, part, batch.column(1).take(at).to_pylist(), t[bad], b[bad], e[bad], batch.column(5).take(at), batch.column(6).take(at))
        key, begin, end = names[seg[-1]], int(b[-1]), int(e[-1])
    if key is not None:
        yield rows(0, part, [key], [0], [begin], [end], [None], [None])


def find_orphans(references: list[Reference], partitions: int | None = None) -> DataFrame:
    """(ref_table, ref_field, record_id, at, reason) of the references that no valid target holds."""
    codes: dict[tuple, int] = {}
    stream: list[DataFrame] = []
    for i, r in enumerate(references):
        target = (r.target_name, r.target_field)
        if target not in codes:
            codes[target] = len(codes)
            stream.append(_targets(codes[target], r.target, r.target_field, r.begin, r.end))
        stream.append(_references(codes[target], i, r))
    events = stream[0]
    for s in stream[1:]:
        events = events.unionByName(s)
    spark = events.sparkSession
    n = partitions or shuffle_width(spark)
    order = ["key", "t", "kind", "record_id"]
    sorted_events = (
        events.select(F.concat_ws(":", "target", "number").alias("key"), "t", "kind", "v", "record_id", "ref")
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), "key", "t", "kind", "v", "record_id", "ref")
    )
    merged = cut_lineage(sorted_events.mapInArrow(_merge, _MERGED))
    # One row per range partition, their number is set above: what the last key of each partition had seen.  A key that
    # fills whole partitions is passed on through all of them.
    last = merged.where("kind = 0").select("part", "key", "first_begin", "last_end").collect()
    carry, state = [], {}
    for r in sorted(last, key=lambda r: r["part"]):
        b, e = state.get(r["key"], (_ALWAYS, _NEVER))
        state = {r["key"]: (min(b, r["first_begin"]), max(e, r["last_end"]))}
        carry.append((r["part"], r["key"], *state[r["key"]]))
    bad = merged.where("kind = 1")
    # partitions are ranges, so only the next one that is not empty can go on with a partition's last key
    into = spark.createDataFrame([(q, k, b, e) for (_, k, b, e), (q, *_) in zip(carry, carry[1:])], "part int, key string, b bigint, e bigint")
    j = bad.join(F.broadcast(into), ["part", "key"], "left")
    begin = F.least("first_begin", F.coalesce("b", F.lit(_ALWAYS)))
    end = F.greatest("last_end", F.coalesce("e", F.lit(_NEVER)))
    reason = F.when(begin == _ALWAYS, "missing").when(begin > F.col("t"), "late").otherwise("deleted")
    names = F.create_map(*[x for i, r in enumerate(references) for x in (F.lit(i), F.struct(F.lit(r.name).alias("ref_table"), F.lit(r.field).alias("ref_field")))])
    return (
        j.where(end <= F.col("t"))
        .select(F.element_at(names, F.col("ref")).alias("n"), "record_id", F.timestamp_micros("t").alias("at"), reason.alias("reason"))
        .select("n.ref_table", "n.ref_field", "record_id", "at", "reason")
    )


def orphans_by_month(found: DataFrame) -> DataFrame:
    """(ref_table, ref_field, month, reason, n): counts per table, field and month of the reference."""
    return found.groupBy("ref_table", "ref_field", F.date_format("at", "yyyy-MM").alias("month"), "reason").agg(F.count("*").alias("n"))
