"""Near-duplicate records by BagMinHash signatures, banding, and an exact check of the overlap.

Signatures.  Every element of a text (a run of `width` words) with weight w stands for a Poisson process on
time x [0, w): the weights are cut into the levels [0,1), [1,2), [2,4), [4,8), ...; each level has its own process,
whose points come from a hash of (element, level), so they are the same in every text; in the topmost level a point
counts only if its height lies under w.  Each point belongs to one of m components by its hash, and a component's
value is the time of its first point.  Two texts agree in a component with the probability of their weighted Jaccard
similarity.  Points are made in order of time up to a horizon by which a text has most likely filled all components,
which takes about m ln m points however long the text is; texts with an empty component go on from there.

Candidates.  Texts with the same sequence of words form one class, so groups of exact copies of any size enter with
one row.  16 bits of each component are kept, and `rows` components make a band; classes that share one of the `bands`
are candidates.  With the default 28 bands of 3, a pair at similarity 0.6 is missed with probability 0.0011, at 0.65
with 0.0001, at 0.7 with 0.00001.  Candidates whose signatures agree in fewer components than a pair at the limit does
with probability 0.999999 are dropped before any text moves; the texts of the others are compared exactly.

Hot bands.  There is no cap on the size of a band.  Bands of more than about HOT classes are found on a hash sample
(which decides where pairs are made, never which), their classes are dealt into blocks, and every pair of blocks is a
join key of its own, so the pairs of one band are made by many tasks.  Classes of many copies are expanded in the same way.

Defined results: null texts and texts under `width` words are in no pair and form classes of their own; identical
texts of at least `width` words are pairs; a row that comes twice gives no pair with itself, and an id
that comes with several texts takes part with each of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import kernels as K

WIDTH, BANDS, ROWS = 3, 28, 3
TOUCHED_BITS = 1 << 27
HOT, HOT_SAMPLE = 2000, 64
BROADCAST_ROWS = 200_000  # of some 60 bytes
_FIRST, _MORE = 2.3, 3.0  # horizon beyond ln m: at first one text in ten has an empty component


def _uniform(h: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1]."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def _elements(owner: np.ndarray, h: np.ndarray, bag: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, seed, rate, base, weight) of each (element, level)."""
    if not bag:
        one = np.ones(len(h))
        return owner, h, one, np.zeros(len(h)), one
    order = np.lexsort((h, owner))
    o, e = owner[order], h[order]
    new = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (e[1:] != e[:-1])])
    w = np.diff(np.r_[new, len(o)])
    o, e = o[new], e[new]
    levels = 1 + np.ceil(np.log2(w)).astype(np.int64)
    row = np.repeat(np.arange(len(o)), levels)
    level = np.arange(len(row)) - np.repeat(np.cumsum(levels) - levels, levels)
    rate = np.where(level == 0, 1.0, 2.0 ** (level - 1))
    seed = K.mix(e[row] + level.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return o[row], np.where(level == 0, e[row], seed), rate, np.where(level == 0, 0.0, rate), w[row].astype(np.float64)


def signatures(owner: np.ndarray, h: np.ndarray, texts: int, m: int, bag: bool = False) -> np.ndarray:
    """(texts, m) times of the components' first points; infinite for texts without elements."""
    sig = np.full(texts * m, np.inf)
    if not len(h):
        return sig.reshape(texts, m)
    o, seed, rate, base, weight = _elements(owner, h, bag)
    # repeats of an element in a set have the same points, so for the horizon only the distinct ones count
    total = np.bincount(o, weights=np.minimum(rate, weight - base), minlength=texts)
    if not bag:
        total = np.maximum(1.0, total * 0.5)
    x = -np.log(_uniform(K.mix(seed))) / rate
    k = np.ones(len(o), np.uint64)
    horizon = np.zeros(texts)
    todo = np.unique(o)
    step = _FIRST if bag else 2 * _FIRST
    reach = np.log(m) + step
    while len(todo):
        horizon[todo] = horizon[todo] + reach * m / total[todo]
        mine = np.zeros(texts, bool)
        mine[todo] = True
        live = np.flatnonzero(mine[o] & (x <= horizon[o]))
        while len(live):
            with np.errstate(over="ignore"):
                r = K.mix(seed[live] ^ (k[live] * np.uint64(0xA0761D6478BD642F)))
                at = o[live] * m + (r >> np.uint64(32)).astype(np.int64) % m
                t = x[live]
                if bag:
                    under = base[live] + _uniform(K.mix(r)) * rate[live] <= weight[live]
                    np.minimum.at(sig, at[under], t[under])
                else:
                    np.minimum.at(sig, at, t)
                r = K.mix(r + np.uint64(0xE7037ED1A0B428DB))
            x[live] = t - np.log(_uniform(r)) / rate[live]
            k[live] += np.uint64(1)
            live = live[x[live] <= horizon[o[live]]]
        empty = np.isinf(sig.reshape(texts, m)[todo]).any(axis=1)
        todo, reach = todo[empty], _MORE
    return sig.reshape(texts, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) 64-bit keys: 16 bits of each of three components below the number of the band.

    With other numbers of rows a key is made of several such keys' hashes; `agreements` reads the components back only
    for three.
    """
    bits = K.mix(sig.view(np.uint64)).reshape(len(sig), bands, rows) & np.uint64(0xFFFF)
    if rows != 3:
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands))
        for r in range(rows):
            key = K.mix(key ^ bits[:, :, r])
        return key
    band = np.arange(bands, dtype=np.uint64) << np.uint64(48)
    return band | bits[:, :, 0] << np.uint64(32) | bits[:, :, 1] << np.uint64(16) | bits[:, :, 2]


def agreements(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal components of each pair of key rows."""
    x = a ^ b
    return sum((((x >> np.uint64(s)) & np.uint64(0xFFFF)) == 0).sum(axis=1) for s in (0, 16, 32))


def least_agreement(limit: float, m: int, miss: float = 1e-6) -> int:
    """The most components that a pair at the limit agrees in with a probability of at least 1 - miss."""
    below = 0.0
    for k in range(m + 1):
        below += math.comb(m, k) * limit**k * (1 - limit) ** (m - k)
        if below > miss:
            return k
    return m


def _sketches(df: DataFrame, width: int, bands: int, rows: int, bag: bool) -> DataFrame:
    """(src, id, fp, keys) of texts with at least `width` words; fp tells texts of other words apart."""
    out = T.StructType(
        [T.StructField("src", T.StringType()), T.StructField("id", T.LongType()), T.StructField("fp", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            for lo, hi in K.blocks(texts):
                owner, h = K.words(texts[lo:hi])
                n = hi - lo
                at, _, s = K.sequences(owner, h, width)
                have = np.unique(at)
                if not len(have):
                    continue
                keys = band_keys(signatures(at, s, n, bands * rows, bag)[have], bands, rows)
                # two sums over (word, place) make the fingerprint of the whole sequence
                first = np.searchsorted(owner, np.arange(n))
                place = (np.arange(len(h)) - first[owner]).astype(np.uint64)
                ends = np.searchsorted(owner, have, side="right")
                fp = np.empty((len(have), 3), np.uint64)
                with np.errstate(over="ignore"):
                    for i, salt in enumerate((0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)):
                        c = np.r_[np.uint64(0), np.cumsum(K.mix(h + (place + np.uint64(1)) * np.uint64(salt)))]
                        fp[:, i] = c[ends] - c[first[have]]
                fp[:, 2] = ends - first[have]
                take = pa.array(have + lo)
                flat = pa.array(keys.reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array([f.tobytes() for f in fp], pa.binary()), lists], names=out.names)

    return df.mapInArrow(run, out)


def _overlaps(width: int, bag: bool, limit: float):
    """mapInArrow function over (src, a, b, text_a, text_b): the pairs whose exact similarity reaches the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            both = [x for p in zip(a, b) for x in p]
            sim = np.zeros(len(a))
            for lo, hi in K.blocks([x + y for x, y in zip(a, b)]):
                owner, h = K.words(both[2 * lo : 2 * hi])
                at, _, s = K.sequences(owner, h, width)
                pair, side = at // 2, at % 2
                order = np.lexsort((side, s, pair))
                pair, side, s = pair[order], side[order], s[order]
                new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (s[1:] != s[:-1])]) if len(s) else np.zeros(0, np.int64)
                left = np.add.reduceat((side == 0).astype(np.int64), new) if len(new) else new
                right = np.add.reduceat((side == 1).astype(np.int64), new) if len(new) else new
                if not bag:
                    left, right = np.minimum(left, 1), np.minimum(right, 1)
                both_n = np.bincount(pair[new], np.minimum(left, right), hi - lo)
                any_n = np.bincount(pair[new], np.maximum(left, right), hi - lo)
                sim[lo:hi] = np.divide(both_n, any_n, out=np.zeros(hi - lo), where=any_n > 0)
            keep = pa.array(np.flatnonzero(sim >= limit - 1e-12))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(keep) for i in range(3)] + [pa.array(sim).take(keep)], names=["src", "a", "b", "similarity"])

    return run


def _cells(df: DataFrame, key: str, blocks: str) -> DataFrame:
    """Rows dealt into `blocks` blocks by `key`, one copy (block, cell) for each pair of blocks theirs is in."""
    n, mine = F.col(blocks), F.pmod(F.xxhash64(key), F.col(blocks))
    other = F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))
    d = df.withColumn("block", mine.cast("int")).withColumn("other", other)
    return d.withColumn("cell", F.least("block", "other") * n + F.greatest("block", "other")).drop("other")


#: of two rows that share a group and a cell: whether this is the one cell where they meet
_MEET = "l.block <> r.block or l.cell = l.block * (l.blocks + 1)"


def _hot_bands(classes: DataFrame, hot: int, sample: int) -> DataFrame:
    """(src, key, blocks) of bands with more than about `hot` classes, by the classes whose hashed id falls in the sample."""
    some = classes.where(F.pmod(F.xxhash64("id"), F.lit(sample)) == 0).select("src", F.explode("keys").alias("key"))
    n = some.groupBy("src", "key").agg((F.count("*") * sample).alias("n")).where(F.col("n") > hot)
    return n.select("src", "key", F.ceil(F.col("n") / hot).cast("int").alias("blocks"))


def _bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it has at most that many rows."""
    return F.broadcast(df) if df.count() <= most else df


def _agreeing(need: int):
    """mapInArrow function over (src, a, b, keys_a, keys_b): the pairs whose signatures agree in enough components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if not x.num_rows:
                continue
            a, b = (x.column(i).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(x.num_rows, -1) for i in (3, 4))
            keep = pa.array(np.flatnonzero(agreements(a, b) >= need))
            yield pa.RecordBatch.from_arrays([x.column(i).take(keep) for i in range(3)], names=["src", "a", "b"])

    return run


def near_duplicates(
    df: DataFrame, limit: float = 0.8, width: int = 5, bands: int = BANDS, rows: int = ROWS, bag: bool = False, hot: int = HOT, hot_sample: int = HOT_SAMPLE
) -> tuple[DataFrame, DataFrame]:
    """(members, links) of a table (src, id, text); only rows of the same src are compared.

    members (src, id, rep): one row per text with at least `width` words; rep is the least id of its class of equal
    word sequences.  links (src, a, b, similarity): pairs of different representatives, a < b, at or above the limit.
    Both read tables written once in the shared checkpoint folder.
    """
    rows_in = df.select(F.col("src").cast("string"), F.col("id").cast("bigint"), F.col("text").cast("string")).where("id is not null and text is not null")
    sk = cut_lineage(_sketches(rows_in, width, bands, rows, bag))
    reps = sk.groupBy("src", "fp").agg(F.min("id").alias("rep"))
    members = cut_lineage(sk.select("src", "id", "fp").join(reps, ["src", "fp"]).select("src", "id", "fp", "rep").distinct())
    copies = members.where("id <> rep").select("src", "id", "fp")
    classes = sk.join(_bounded(copies), ["src", "id", "fp"], "left_anti").select("src", "id", "keys")
    crowded = cut_lineage(_hot_bands(classes, hot, hot_sample))
    banded, on, meet = classes.select("src", F.explode("keys").alias("key"), "id"), ["src", "key"], "true"
    if not crowded.isEmpty():
        banded = banded.join(_bounded(crowded), ["src", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        banded, on, meet = _cells(banded, "id", "blocks"), ["src", "key", "cell"], _MEET
    banded = banded.hint("merge")  # a hash join holds all pairs of one row of its input at once
    # both sides are one and the same plan, so the exchange by band is written once and read twice
    same = banded.alias("l").join(banded.alias("r"), on).where(f"l.id < r.id and ({meet})")
    candidates = cut_lineage(same.select("src", F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct())
    if rows == 3:
        touched = _only_touched(classes, candidates)
        pairs = candidates.join(touched.select("src", F.col("id").alias("a"), F.col("keys").alias("ka")), ["src", "a"])
        pairs = pairs.join(touched.select("src", F.col("id").alias("b"), F.col("keys").alias("kb")), ["src", "b"]).select("src", "a", "b", "ka", "kb")
        need = least_agreement(limit, bands * rows)
        candidates = cut_lineage(pairs.mapInArrow(_agreeing(need), "src string, a bigint, b bigint").distinct())
    texts = _only_touched(rows_in, candidates)
    schema = "src string, a bigint, b bigint, similarity double"
    links = (
        candidates.join(texts.select("src", F.col("id").alias("a"), F.col("text").alias("ta")), ["src", "a"])
        .join(texts.select("src", F.col("id").alias("b"), F.col("text").alias("tb")), ["src", "b"])
        .select("src", "a", "b", "ta", "tb")
        .mapInArrow(_overlaps(width, bag, limit), schema)
        .groupBy("src", "a", "b")
        .agg(F.max("similarity").alias("similarity"))
    )
    return members.select("src", "id", "rep"), cut_lineage(links)


def _only_touched(rows: DataFrame, pairs: DataFrame, most_bits: int = TOUCHED_BITS) -> DataFrame:
    """Rows (src, id, ...) that occur in the pairs, and a few others: a bitmap of hashed ids tells most of the rest before any shuffle.

    The bitmap has 32 bits a pair, and never more than `most_bits` (16 MB), however many pairs there are; if it fills
    up, more rows pass.
    """
    bits = min(most_bits, max(1 << 18, 1 << (32 * pairs.count()).bit_length()))

    def slot(src: str, key: str):
        return F.pmod(F.xxhash64(F.col(src), F.col(key)), F.lit(bits)) + 1

    ids = pairs.select("src", F.explode(F.array("a", "b")).alias("id")).select(slot("src", "id").alias("slot"))
    bitmap = ids.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("map"))
    t = rows.withColumn("slot", slot("src", "id"))
    t = t.withColumn("bucket", F.bitmap_bucket_number("slot")).withColumn("at", F.bitmap_bit_position("slot").cast("int"))
    octet = F.conv(F.hex(F.substring("map", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    t = t.join(F.broadcast(bitmap), "bucket").where(F.getbit(octet, F.col("at") % 8) == 1)
    return t.select(*rows.columns)


def pairs_of_rows(members: DataFrame, links: DataFrame, hot: int = HOT) -> DataFrame:
    """(src, id_a, id_b): all pairs of rows that the links and the classes of equal texts stand for.

    The joins are merge joins whatever the sizes: a hash join holds all pairs of one row of its input at once.

    This is the expanded form, with the same meaning at every size: the rows of a class are pairs, and so are the rows
    of two linked classes.  It is as long as it has pairs, n * (n - 1) / 2 for n copies; `members` and `links` say the
    same in as many rows as there are texts and links of different texts.
    """
    m = members.select("src", "rep", "id").distinct()
    sizes = m.groupBy("src", "rep").agg(F.count("*").alias("n")).where("n > 1")
    copies = m.join(sizes, ["src", "rep"]).select("src", "rep", "id", F.ceil(F.col("n") / hot).cast("int").alias("blocks"))
    dealt = _cells(copies, "id", "blocks").hint("merge")
    within = dealt.alias("l").join(dealt.alias("r"), ["src", "rep", "cell"]).where(f"l.id < r.id and ({_MEET})").select("src", F.col("l.id").alias("id_a"), F.col("r.id").alias("id_b"))
    across = (
        links.select("src", "a", "b")
        .join(m.select("src", F.col("rep").alias("a"), F.col("id").alias("x")).hint("merge"), ["src", "a"])
        .join(m.select("src", F.col("rep").alias("b"), F.col("id").alias("y")).hint("merge"), ["src", "b"])
        .select("src", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    )
    return within.unionByName(across)


def groups_of_rows(members: DataFrame, links: DataFrame) -> DataFrame:
    """(src, id, group_id, links): one row per text; group_id is the least id that chains of links reach.

    links counts the other rows of the own class and of the linked classes.  Components come from rounds of the large
    and small star; every round is one shuffle of the edges and is written to the checkpoint folder.
    """
    members = members.select("src", "id", "rep").distinct()
    edges = cut_lineage(links.select("src", F.col("b").alias("u"), F.col("a").alias("v")).distinct())
    while True:
        both = edges.unionByName(edges.select("src", F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("src", "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, ["src", "u"]).where("v > u").select("src", F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.unionByName(large.groupBy("src", "u").agg(F.min("v").alias("v")))
        down = low.groupBy("src", "u").agg(F.min("v").alias("m"))
        small = low.join(down, ["src", "u"]).select("src", F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = cut_lineage(small.select("src", "e.u", "e.v").where("u <> v").distinct())
        if now.exceptAll(edges).isEmpty() and edges.exceptAll(now).isEmpty():
            break
        edges = now
    sizes = members.groupBy("src", "rep").agg(F.count("*").alias("n"))
    linked = (
        links.select("src", F.explode(F.array(F.struct(F.col("a").alias("rep"), F.col("b").alias("other")), F.struct(F.col("b").alias("rep"), F.col("a").alias("other")))).alias("e"))
        .select("src", "e.rep", F.col("e.other").alias("other"))
        .join(sizes.select("src", F.col("rep").alias("other"), "n"), ["src", "other"])
        .groupBy("src", "rep")
        .agg(F.sum("n").alias("across"))
    )
    root = now.groupBy("src", F.col("u").alias("rep")).agg(F.min("v").alias("root"))
    per_class = sizes.join(linked, ["src", "rep"], "left").join(root, ["src", "rep"], "left").select(
        "src", "rep", F.coalesce("root", "rep").alias("group_id"), (F.col("n") - 1 + F.coalesce("across", F.lit(0))).alias("links")
    )
    return members.join(per_class, ["src", "rep"]).select("src", "id", "group_id", "links")
