"""Cutting oversized texts at natural boundaries.

The sizes of a text's tokens (or characters) form prefix sums; the ends of its paragraphs, sentences and words are
sorted arrays of the same scale.  Each piece ends at the last paragraph end under the limit, if that lies in the second
half of the piece, else at such a sentence end, else at the last word end, else hard at the limit; a binary search
finds each.  The next piece begins `overlap` characters (or tokens) before the cut.

Defined results: null texts and texts within the limit give no rows here (see pieces_of_all); blanks, tabs and line
breaks at both ends are no part of a text; a text without blanks or sentence marks is cut hard; whole texts are
processed, however long; repeated rows are cut each for itself.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters between tokens, also dropped at both ends of a text.
BLANKS = " \t\r\n"
_TOKEN = re.compile(r"[^ \t\r\n]+")
_SENTENCE = re.compile(r"[.!?…。！？]+[\"'”’)\]]*(?=[ \t\r\n])")
#: scripts without blanks end sentences with marks of their own; only counted in characters, as they lie inside a token
_SENTENCE_ANYWHERE = re.compile(_SENTENCE.pattern + r"|[。！？]+[”’」』）]*")
# Abbreviations behind which a sentence goes on.
_GOES_ON = re.compile(r"(?:^|[\s(\[])(?:e\.g|i\.e|approx|vs|figs?|nos?|cf|ca|resp|et al|incl|viz|dr|mr|mrs|prof|st|p|pp|vol|eds?|z\.B|bzw|p\.ej)\.$", re.I)
_PARAGRAPH = re.compile(r"[ \t]*\r?\n[ \t]*(?:\r?\n[ \t]*)+")

CHARS, TOKENS = "chars", "tokens"


def cut(text: str, limit: int, overlap: int, unit: str = CHARS) -> list[tuple[int, int, str]]:
    """(begin, end, kind of boundary at the end) of each piece of a stripped text; one piece if it is within the limit.

    limit and overlap count characters, or tokens.  Without overlap a piece begins exactly where the one before ended.
    """
    n, by_token = len(text), unit == TOKENS
    spans = [m.span() for m in _TOKEN.finditer(text)] if by_token or n > limit else []
    if (len(spans) if by_token else n) <= limit:
        return [(0, n, "end")]
    words = [e for _, e in spans]
    ends = (m.end() for m in (_SENTENCE if by_token else _SENTENCE_ANYWHERE).finditer(text))
    sentences = [e for e in ends if not _GOES_ON.search(text, max(0, e - 12), e)]
    paragraphs = [m.start() for m in _PARAGRAPH.finditer(text)]
    out, begin = [], 0
    while True:
        # `most` is the limit, `half` the middle of the piece; a cut at or before `least` would not get on
        if by_token:
            done = bisect_right(words, begin)
            if len(words) - done <= limit:
                break
            most, half, least = words[done + limit - 1], words[done + (limit - 1) // 2], words[done + overlap - 1] if overlap else begin
        else:
            if n - begin <= limit:
                break
            most, half, least = begin + limit, begin + limit // 2, begin + overlap
        at, kind = most, "hard"
        for bounds, name, low in ((paragraphs, "paragraph", half), (sentences, "sentence", half), (words, "word", least)):
            k = bisect_right(bounds, most) - 1
            if k >= 0 and bounds[k] > max(low, least):
                at, kind = bounds[k], name
                break
        out.append((begin, at, kind))
        begin = at if not overlap else spans[bisect_right(words, at) - overlap][0] if by_token else at - overlap
    out.append((begin, n, "end"))
    return out


def split_oversized(df: DataFrame, keys: list[str], text: str, limit: int, overlap: int = 0, unit: str = CHARS, with_text: bool = True) -> DataFrame:
    """Pieces of the texts above the limit: (keys..., piece_no, n_pieces, begin, end, boundary[, piece]).

    begin and end count code points of the stripped text; piece_no counts from 1.
    """
    if not (limit > 0 and 0 <= overlap < limit):
        raise ValueError("limit must be positive and overlap below it")
    body = F.btrim(F.col(text).cast("string"), F.lit(BLANKS))
    slim = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], body.alias("body"))
    # what cannot be above the limit never leaves the JVM: a token and its blank take two characters at least
    slim = slim.where(F.length("body") > (limit if unit == CHARS else 2 * limit))
    n = len(keys)
    fields = [T.StructField(k, slim.schema[f"k{i}"].dataType) for i, k in enumerate(keys)]
    fields += [T.StructField(c, T.IntegerType()) for c in ("piece_no", "n_pieces", "begin", "end")] + [T.StructField("boundary", T.StringType())]
    out = T.StructType(fields + ([T.StructField("piece", T.StringType())] if with_text else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, cols = [], [[] for _ in range(6)]
            for i, t in enumerate(b.column(n).to_pylist()):
                pieces = cut(t, limit, overlap, unit)
                if len(pieces) == 1:
                    continue
                for no, (lo, hi, kind) in enumerate(pieces, 1):
                    rows.append(i)
                    for c, v in zip(cols, (no, len(pieces), lo, hi, kind, t[lo:hi] if with_text else None)):
                        c.append(v)
            at = pa.array(rows, pa.int32())
            made = [pa.array(c, pa.int32()) for c in cols[:4]] + [pa.array(cols[4], pa.string())]
            if with_text:
                made.append(pa.array(cols[5], pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(i).take(at) for i in range(n)] + made, names=out.names)

    return slim.mapInArrow(run, out)
