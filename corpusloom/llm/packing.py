"""Filling containers of fixed capacity with documents, by minimum bin slack over the multiset of lengths.

Which document has a length doesn't matter, so the plan needs only how many items there are of each length: at most
`capacity` numbers, whatever the size of the corpus.  For the longest length left, a subset-sum dynamic program over a
bitset of reachable fills picks from the lengths left the multiset that comes closest to the capacity; backtracking
gives the counts, and the pattern is used as often as the counts allow.  Each pattern uses up a length but for less
than capacity/length items, so there are at most capacity * (1 + ln capacity) patterns, about 18,000 at 2,048; that
bounds the plan, which goes to all tasks.  Documents then take the slots of their length in turn.

Only items longer than the capacity are split, into full containers and one remainder.

Defined results: null and empty texts have 0 tokens and go to container 0; equal ids are packed each for itself;
an empty table gives an empty assignment.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

CAPACITY = 2048
SALTS = 64


#: where the vocabulary files of public tokenizers lie, if CORPUSLOOM_TOKENIZERS doesn't say otherwise
TOKENIZERS = "/opt/tokenizers"
# Fixed value: how the byte-level BPE cuts a text before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    """Path of the vocabulary file of a public byte-level BPE, as ranks; the file is part of the cluster's image."""
    return os.path.join(os.environ.get("CORPUSLOOM_TOKENIZERS", TOKENIZERS), "byte_bpe_50k.tiktoken")


@cache
def _encoding(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, key: str, text: str, tokenizer: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """(key, n_tokens) of every row, by the vocabulary file `tokenizer` and its pattern."""
    path = tokenizer or default_tokenizer()
    slim = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    out = T.StructType([T.StructField("key", T.LongType()), T.StructField("n_tokens", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path, pattern).encode_ordinary
        for b in batches:
            n = np.fromiter((len(encode(t)) if t else 0 for t in b.column(1).to_pylist()), np.int32, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n)], names=out.names)

    return slim.mapInArrow(run, out)


def _closest_fill(room: int, left: dict[int, int]) -> dict[int, int]:
    """Counts of lengths from `left` whose sum is as near to `room` as any multiset comes, and not above."""
    mask, bits = (1 << (room + 1)) - 1, 1
    stages: list[tuple[int, int, int]] = []  # length, copies, reachable before
    for length in sorted((x for x in left if x <= room and left[x] > 0), reverse=True):
        copies, take = min(left[length], room // length), 1
        while copies > 0:
            take = min(take, copies)
            stages.append((length, take, bits))
            bits |= (bits << (length * take)) & mask
            copies -= take
            take *= 2
        if bits >> room:
            break
    at, used = bits.bit_length() - 1, {}
    for length, copies, before in reversed(stages):
        if not (before >> at) & 1:
            used[length] = used.get(length, 0) + copies
            at -= length * copies
    return used


def plan_containers(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns (times, {length: count}) that use up all counts."""
    left, plan = {k: v for k, v in counts.items() if v > 0 and 0 < k <= capacity}, []
    while left:
        top = max(left)
        left[top] -= 1
        pattern = _closest_fill(capacity - top, left)
        left[top] += 1
        pattern[top] = pattern.get(top, 0) + 1
        times = min(left[k] // c for k, c in pattern.items())
        for k, c in pattern.items():
            left[k] -= times * c
            if not left[k]:
                del left[k]
        plan.append((times, pattern))
    return plan


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None, salts: int = SALTS) -> DataFrame:
    """(key, part_no, n_parts, n_tokens, container_id): an assignment of all rows to containers."""
    sized = cut_lineage(token_counts(df, key, text, tokenizer))
    n = F.col("n_tokens")
    parts = F.greatest(F.lit(1), F.ceil(n / F.lit(capacity)).cast("int"))
    size = F.when(F.col("part_no") < F.col("n_parts"), capacity).otherwise(n - (F.col("n_parts") - 1) * capacity).cast("int")
    items = (
        sized.select("key", "n_tokens", parts.alias("n_parts"))
        .select("key", "n_tokens", "n_parts", F.explode(F.sequence(F.lit(1), F.col("n_parts"))).alias("part_no"))
        .select("key", "part_no", "n_parts", size.alias("size"), F.pmod(F.xxhash64("key", "part_no"), F.lit(salts)).cast("int").alias("salt"))
    )
    # at most (capacity + 1) * salts rows, however many documents there are
    cells = {(r["size"], r["salt"]): r["n"] for r in items.groupBy("size", "salt").agg(F.count("*").alias("n")).collect()}
    counts: dict[int, int] = {}
    begin: dict[tuple[int, int], int] = {}
    for length, salt in sorted(cells):
        begin[length, salt] = counts.get(length, 0)
        counts[length] = counts.get(length, 0) + cells[length, salt]
    rows, base, used = [], 0, {}
    for times, pattern in plan_containers(counts, capacity):
        for length, c in pattern.items():
            rows.append((length, used.get(length, 0), base, c))
            used[length] = used.get(length, 0) + times * c
        base += times
    rows.sort()
    slot = np.array(rows, np.int64).reshape(-1, 4)
    start = np.zeros((capacity + 1, salts), np.int64)
    for (length, salt), v in begin.items():
        start[length, salt] = v
    out = T.StructType(
        [T.StructField(key, T.LongType()), *[T.StructField(c, T.IntegerType()) for c in ("part_no", "n_parts", "n_tokens")], T.StructField("container_id", T.LongType())]
    )
    turn = F.row_number().over(Window.partitionBy("size", "salt").orderBy("key", "part_no")) - 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.int64(1) << 40
        keys = slot[:, 0] * wide + slot[:, 1]
        for b in batches:
            size, salt, nth = (b.column(i).to_numpy() for i in (3, 4, 5))
            nth = start[size, salt] + nth
            at = np.searchsorted(keys, size * wide + nth, side="right") - 1
            container = np.zeros(b.num_rows, np.int64)
            some = size > 0
            at = at[some]
            container[some] = slot[at, 2] + (nth[some] - slot[at, 1]) // slot[at, 3]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(4)], pa.array(container)], names=out.names)

    return items.withColumn("nth", turn.cast("bigint")).select("key", "part_no", "n_parts", "size", "salt", "nth").mapInArrow(place, out)


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: items, split parts, tokens, containers, the fewest containers possible, mean fill and unused share."""
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("items"))
    return per.agg(
        F.sum("items").alias("n_items"),
        F.sum("t").alias("n_tokens"),
        F.count("*").alias("n_containers"),
        F.ceil(F.sum("t") / F.lit(capacity)).alias("fewest_containers"),
        F.max("t").alias("fullest"),
        F.round(F.avg("t") / F.lit(capacity), 6).alias("mean_fill"),
        F.sum(F.when(F.col("t") < capacity, 1).otherwise(0)).alias("not_full"),
    )
