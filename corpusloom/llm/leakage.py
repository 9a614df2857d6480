"""Passages of evaluation items inside documents: containment search by MinHash in partitions of equal size.

The passages of an item are its runs of `passage` words (the whole item if it has fewer); the items are partitioned by
that size.  The MinHash of a passage is the least hash among its runs of `shingle` words, one for each of two hash
functions.  The sketch of a document in a partition is the set of the minima of all its windows of that size: about two
in `size` of its shingles, whatever its length.  All shingles of a passage are in a document only if the minima of the
passage are in the document's sketch, side by side in one window; so the threshold of the search is full containment
and it misses none.  What the sketches let through is verified by the words themselves.

One pass over the documents, whatever the items: the minima of all passages are one bitmap of bounded size, and only
windows whose both minima are in it leave the scan, with their words.  They meet the passages in a join on the words;
neither items nor documents are collected.

Defined results: null texts hold nothing; items without words are never found; an item that comes twice is found
twice only under different ids; markup and punctuation separate words; documents of any length are searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import kernels as K

PASSAGE, SHINGLE = 12, 3
SIEVE_BITS = 1 << 27
_SALTS = [np.uint64(x) for x in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)]


def _sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """Least value of every n neighbours, in log n steps."""
    if len(x) < n:
        return x[:0]
    have = 1
    while have < n:
        step = min(have, n - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def minima(h: np.ndarray, size: int, shingle: int, salt: np.uint64) -> np.ndarray:
    """MinHash of every window of `size` words, regardless of the ends of texts; other sizes give other values."""
    k = min(shingle, size)
    _, _, s = K.sequences(np.zeros(len(h), np.int64), h, k)
    with np.errstate(over="ignore"):
        return K.mix(_sliding_least(K.mix(s ^ salt), size - k + 1) + np.uint64(size))


class _Block:
    """Words of a block of texts."""

    def __init__(self, texts: list[str]):
        cp, self.begin, self.end, self.owner, self.h = K.spans(texts, latin=True)
        self.text = cp.tobytes().decode("utf-32-le", "surrogatepass")

    def windows(self, size: int) -> np.ndarray:
        """First words of the windows that lie in one text."""
        n = len(self.h) - size + 1
        return np.flatnonzero(self.owner[:n] == self.owner[size - 1 :]) if n > 0 else np.zeros(0, np.int64)

    def passages(self, at: np.ndarray, size: int) -> list[str]:
        begin, end, text = self.begin.tolist(), self.end.tolist(), self.text
        return [" ".join(text[begin[i] : end[i]] for i in range(a, a + size)) for a in at.tolist()]


_PASSAGES = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("m1", T.LongType()), T.StructField("m2", T.LongType()), T.StructField("passage", T.StringType())]
)


def _rows(key: pa.Array, owner: np.ndarray, size: int, m1: np.ndarray, m2: np.ndarray, passages: list[str]) -> pa.RecordBatch:
    columns = [key.take(pa.array(owner)), pa.array(np.full(len(owner), size, np.int32)), pa.array(m1.view(np.int64)), pa.array(m2.view(np.int64)), pa.array(passages, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=_PASSAGES.names)


def item_passages(items: DataFrame, passage: int = PASSAGE, shingle: int = SHINGLE) -> DataFrame:
    """(id, size, m1, m2, passage) of all places of the items (id, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in K.blocks(texts):
                block = _Block(texts[lo:hi])
                length = np.bincount(block.owner, minlength=hi - lo)
                for size in np.unique(np.minimum(length[length > 0], passage)).tolist():
                    at = block.windows(size)
                    at = at[np.minimum(length[block.owner[at]], passage) == size]
                    m1, m2 = (minima(block.h, size, shingle, s)[at] for s in _SALTS)
                    yield _rows(b.column(0), block.owner[at] + lo, size, m1, m2, block.passages(at, size))

    return items.mapInArrow(run, _PASSAGES)


def _sieve(passages: DataFrame, most_bits: int) -> np.ndarray:
    """Bits of the minima of all passages: 32 a passage, `most_bits` (16 MB) at most; a fuller one lets more through."""
    n = passages.count()
    bits = min(most_bits, max(1 << 18, 1 << (64 * n).bit_length()))
    s = passages.select(F.explode(F.array("m1", "m2")).alias("m")).select((F.pmod("m", F.lit(bits)) + 1).alias("slot"))
    rows = s.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("map")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(r["map"], np.uint8)
        at = (r["bucket"] - 1) * len(part)
        out[at : at + len(part)] = part[: max(0, len(out) - at)]
    return out


def _in(sieve: np.ndarray, m: np.ndarray) -> np.ndarray:
    slot = m.view(np.int64) % np.int64(len(sieve) * 8)
    return (sieve[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _document_windows(docs: DataFrame, sizes: list[int], shingle: int, sieve) -> DataFrame:
    """(id, size, m1, m2, passage) of the windows of documents (id, t) whose minima are in the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sieve.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in K.blocks(texts):
                block = _Block(texts[lo:hi])
                for size in sizes:
                    at = block.windows(size)
                    m1 = minima(block.h, size, shingle, _SALTS[0])[at]
                    maybe = _in(bits, m1)
                    at, m1 = at[maybe], m1[maybe]
                    if not len(at):
                        continue
                    m2 = minima(block.h, size, shingle, _SALTS[1])[at]
                    maybe = _in(bits, m2)
                    at, m1, m2 = at[maybe], m1[maybe], m2[maybe]
                    if len(at):
                        yield _rows(b.column(0), block.owner[at] + lo, size, m1, m2, block.passages(at, size))

    return docs.mapInArrow(run, _PASSAGES)


def find_leaks(
    docs: DataFrame, items: DataFrame, passage: int = PASSAGE, shingle: int = SHINGLE, sieve_bits: int = SIEVE_BITS, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, passages, item_passages): how many of an item's passages a document holds, of how many."""
    d = docs.select(F.col(doc_key).cast("bigint").alias("id"), F.col(text).cast("string").alias("t")).where("t is not null")
    q = items.select(F.col(item_key).cast("bigint").alias("id"), F.col(text).cast("string").alias("t")).where("id is not null and t is not null")
    places = cut_lineage(item_passages(q, passage, shingle))
    sizes = sorted(r["size"] for r in places.select("size").distinct().collect())  # `passage` numbers at most
    sieve = docs.sparkSession.sparkContext.broadcast(_sieve(places, sieve_bits))
    known = places.groupBy(F.col("id").alias("item_id"), "size", "m1", "m2", "passage").agg(F.count("*").cast("int").alias("n"))
    total = places.groupBy(F.col("id").alias("item_id")).agg(F.count("*").cast("int").alias("item_passages"))
    windows = _document_windows(d, sizes, shingle, sieve)
    held = windows.join(known, ["size", "m1", "m2", "passage"]).select(F.col("id").alias("doc_id"), "item_id", "size", "passage", "n").distinct()
    found = held.groupBy("doc_id", "item_id").agg(F.sum("n").cast("int").alias("passages"))
    return found.join(total, "item_id").select("doc_id", "item_id", "passages", "item_passages")
