"""Chunks and windows of texts as generators: fixed size with overlap, packed paragraphs, bounded token windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_value, strip


def check_size(size: int, overlap: int) -> None:
    if isinstance(size, bool) or size <= 0 or not 0 <= overlap < size:
        raise ValueError("size must be positive and 0 <= overlap < size")


def chunk_starts(text: Column, size: int, overlap: int) -> Column:
    """Offsets of the chunks: step size - overlap, ending with the first chunk that reaches the end."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / F.lit(step)).cast("int")) * step
    return F.sequence(F.lit(0), last, F.lit(step))


def fixed_chunks(df: DataFrame, keys: list[str], text: str, size: int = 1000, overlap: int = 100) -> DataFrame:
    """(keys..., chunk_index, chunk_text): blank texts give none; texts are not stripped; indexes count from 0."""
    check_size(size, overlap)
    d = df.where(has_value(text)).select(*keys, F.col(text).alias("_t"), F.posexplode(chunk_starts(F.col(text), size, overlap)).alias("chunk_index", "_s"))
    return d.select(*keys, "chunk_index", F.substring(F.col("_t"), F.col("_s") + 1, F.lit(size)).alias("chunk_text"))


def split_fixed(text: Column, size: int, overlap: int) -> Column:
    return F.transform(chunk_starts(text, size, overlap), lambda s: F.substring(text, s + 1, F.lit(size)))


def paragraphs(text: Column) -> Column:
    """Stripped paragraphs between blank lines, empty ones dropped."""
    unified = strip(F.regexp_replace(text, r"\r\n?", "\n"))
    return F.filter(F.transform(F.split(unified, r"\n\s*\n+"), strip), lambda p: p != "")


def packed_paragraphs(text: Column, size: int = 1000, overlap: int = 150) -> Column:
    """Paragraphs joined by a blank line while they fit; a longer one ends the group and is cut with overlap."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def flush(a: Column) -> Column:
        return F.when(a["cur"] == "", a["done"]).otherwise(F.concat(a["done"], F.array(a["cur"])))

    def step(a: Column, p: Column) -> Column:
        fits = F.length(a["cur"]) + 2 + F.length(p) <= size
        return (
            F.when(F.length(p) > size, F.struct(F.concat(flush(a), split_fixed(p, size, overlap)).alias("done"), F.lit("").alias("cur")))
            .when(a["cur"] == "", F.struct(a["done"].alias("done"), p.alias("cur")))
            .when(fits, F.struct(a["done"].alias("done"), F.concat(a["cur"], F.lit("\n\n"), p).alias("cur")))
            .otherwise(F.struct(flush(a).alias("done"), p.alias("cur")))
        )

    return F.aggregate(paragraphs(text), start, step, flush)


def section_chunks(articles: DataFrame, keys: list[str], size: int = 1000, overlap: int = 150) -> DataFrame:
    """Chunks of all sections, abstract first: (keys..., section_no, title, section_path, source, chunk_index, chunk_text).

    chunk_index starts again with each section; sections without text give none.
    """
    check_size(size, overlap)
    kind = articles.schema["abstract_sections"].dataType
    sides = [F.coalesce(F.col(c), F.array().cast(kind)) for c in ("abstract_sections", "body_sections")]
    s = articles.select(*keys, F.posexplode(F.concat(*sides)).alias("_n", "_s"))
    s = s.where(has_value("_s.text")).select(*keys, (F.col("_n") + 1).alias("section_no"), "_s")
    c = s.select(*keys, "section_no", "_s", F.posexplode(packed_paragraphs(F.col("_s.text"), size, overlap)).alias("chunk_index", "chunk_text"))
    return c.select(*keys, "section_no", F.col("_s.title").alias("section_title"), F.col("_s.section_path").alias("section_path"), F.col("_s.source").alias("source"), "chunk_index", "chunk_text")


def token_windows(df: DataFrame, keys: list[str], text: str, capacity: int) -> DataFrame:
    """(keys..., window_index, window_count, window_text) of at most `capacity` blank-separated tokens each.

    White space stays at the end of the window before it, so the windows joined give the text again.
    """
    if capacity <= 0:
        raise ValueError("capacity must be positive")
    tokens = F.regexp_extract_all(F.col(text), F.lit(r"(^\s*\S+\s*|\S+\s*)"), F.lit(1))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_k"), F.lit(1)), F.lit(capacity))
    windows = F.transform(starts, lambda s: F.array_join(F.slice("_k", s, F.lit(capacity)), ""))
    d = df.where(has_value(text)).select(*keys, tokens.alias("_k")).select(*keys, windows.alias("_w"))
    return d.select(*keys, F.size("_w").alias("window_count"), F.posexplode("_w").alias("window_index", "window_text"))


def tokenizer_windows(df: DataFrame, keys: list[str], text: str, offsets, capacity: int) -> DataFrame:
    """As token_windows for any tokenizer: `offsets(texts)` gives per text the (begin, end, word) of each token.

    A word's tokens stay together; a word over the capacity is an error; the next window begins where its first token
    does.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    slim = df.where(has_value(text)).select(*keys, F.col(text).alias("_t"))
    out = T.StructType([*slim.schema.fields[:-1], T.StructField("window_index", T.IntegerType()), T.StructField("window_count", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("window_text", T.StringType())])
    n = len(keys)

    def cut(t: str, tokens: list[tuple[int, int, int]]) -> list[tuple[int, str]]:
        words: list[list[int]] = []  # begin, number of tokens
        last = None
        for b, _, w in tokens:
            if w is not None and w == last:
                words[-1][1] += 1
            else:
                words.append([b, 1])
            last = w
        windows: list[list[int]] = []
        for b, k in words:
            if k > capacity:
                raise ValueError("a single word has more tokens than a window holds")
            if windows and windows[-1][1] + k <= capacity:
                windows[-1][1] += k
            else:
                windows.append([b if windows else 0, k])
        ends = [w[0] for w in windows[1:]] + [len(t)]
        return [(k, t[b:e]) for (b, k), e in zip(windows, ends)]

    def run(batches):
        for batch in batches:
            texts = batch.column(n).to_pylist()
            at, cols = [], [[], [], [], []]
            for i, (t, tok) in enumerate(zip(texts, offsets(texts))):
                got = cut(t, tok)
                for j, (k, w) in enumerate(got):
                    at.append(i)
                    for c, v in zip(cols, (j, len(got), k, w)):
                        c.append(v)
            idx = pa.array(at, pa.int32())
            made = [pa.array(c, pa.int32()) for c in cols[:3]] + [pa.array(cols[3], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(i).take(idx) for i in range(n)] + made, names=out.names)

    return slim.mapInArrow(run, out)


def blank_tokens(texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Offsets of a tokenizer whose tokens are the words between blanks."""
    import re

    return [[(m.start(), m.end(), i) for i, m in enumerate(re.finditer(r"\S+", t))] for t in texts]
