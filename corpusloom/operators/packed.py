"""Several values packed in one cell: dictionary-guided segmentation into one row per value.

A cell is first cut by the plain rule: at its hard separators (bars, semicolons, tabs, line breaks, and per field more,
e.g. "+") outside double quotes, or, if it has none, at its commas.  Any separator may also belong to a value
("Clinical Trial, Phase II", "Study Protocol; Amended").  So whole values are learned from the cells of the same
column that leave no doubt: pieces in quotes, pieces between hard separators of one kind, and cells in one piece.  A known value
that the plain rule would cut is worth as many points as it has parts that are not known as values themselves; where all
parts are known, the rule stands.  A multi-pattern automaton finds every place where such a value stands whole between
two cuts, and dynamic programming picks the cover of the cell with the most points; separators inside a chosen value
are protected.  Where nothing is known the plain rule decides.

Defined results: null, empty and blank cells give no row; a cell of separators only gives no row; an unbalanced quote
protects up to the end of the cell; brackets count only where one pair holds the whole cell; repeated values and
repeated rows stay; texts of any length are cut whole.  Columns of the input that are not named are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

# Separators outside double quotes; the second of each pair is the full-width form.
HARD_SEPARATORS = "|｜;；\t\n\r\x0b\x0c\x85\u2028\u2029"
SOFT_SEPARATOR = ","

#: The dictionary holds only values that the plain rule would cut; a larger one goes through a join, not to every task.
MAX_DICTIONARY_BYTES = 16 << 20


def _unwrap(cell: str) -> str:
    """The cell without one pair of square brackets that holds all of it; quoted brackets don't count."""
    s = cell.strip()
    if len(s) < 2 or s[0] != "[" or s[-1] != "]":
        return s
    depth, quoted = 0, False
    for i, ch in enumerate(s):
        if ch == '"':
            quoted = not quoted
        elif not quoted:
            depth += (ch == "[") - (ch == "]")
            if depth == 0 and i < len(s) - 1:
                return s
    return s[1:-1]


def _unquote(piece: str) -> str:
    v = piece.strip()
    if len(v) >= 2 and v[0] == '"' and v[-1] == '"':
        v = v[1:-1].replace('""', '"').strip()
    return v


def _cuts(cell: str, pattern: re.Pattern) -> list[tuple[int, int]]:
    """Begin and end of the pieces between the pattern's separators outside double quotes."""
    out, start, quoted = [], 0, False
    for m in pattern.finditer(cell):
        if m.group() == '"':
            quoted = not quoted
        elif not quoted:
            out.append((start, m.start()))
            start = m.end()
    out.append((start, len(cell)))
    return out


@cache
def _hard_pattern(extra: str) -> re.Pattern:
    return re.compile("[" + re.escape('"' + HARD_SEPARATORS + extra) + "]")


_SOFT_PATTERN = re.compile('[",]')


def _plain_cuts(body: str, extra: str) -> tuple[list[tuple[int, int]], bool]:
    """(pieces by the plain rule, whether they leave no doubt: one piece, or one kind of hard separator)."""
    hard = _cuts(body, _hard_pattern(extra))
    if len(hard) > 1:
        return hard, len({body[hi].replace("\r", "\n") for _, hi in hard[:-1]}) == 1
    soft = _cuts(body, _SOFT_PATTERN)
    return soft, len(soft) == 1


def _automaton(words: dict[str, int]):
    """Automaton over known values and their points."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for w, points in words.items():
        a.add_word(w, (len(w), points))
    if words:
        a.make_automaton()
    return a


def _spans_by_automaton(body: str, pieces: list[tuple[int, int]], automaton) -> dict[tuple[int, int], int]:
    """Points of every run of pieces i..j-1 that is a known whole value."""
    begins, ends = {}, {}
    for i, (lo, hi) in enumerate(pieces):
        text = body[lo:hi]
        begins[lo + len(text) - len(text.lstrip())] = i
        ends[lo + len(text.rstrip())] = i + 1
    found = {}
    for last, (size, points) in automaton.iter(body):
        i, j = begins.get(last + 1 - size), ends.get(last + 1)
        if i is not None and j is not None and j - i > 1:
            found[i, j] = points
    return found


def _best_cover(n: int, known: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Cover of pieces 0..n-1 by known runs and single pieces with the most points; of equals the one with longer runs first."""
    by_start: dict[int, list[tuple[int, int]]] = {}
    for (i, j), points in known.items():
        by_start.setdefault(i, []).append((j, points))
    best, step = [0] * (n + 1), [0] * n
    for i in range(n - 1, -1, -1):
        best[i], step[i] = best[i + 1], i + 1
        for j, points in sorted(by_start.get(i, [])):
            if points + best[j] >= best[i]:
                best[i], step[i] = points + best[j], j
    out, i = [], 0
    while i < n:
        out.append((i, step[i]))
        i = step[i]
    return out


def segment_cell(cell: str, extra_separators: str = "", automaton=None, known: dict[tuple[int, int], int] | None = None) -> list[str]:
    """Values of one cell in order."""
    body = _unwrap(cell)
    pieces, _ = _plain_cuts(body, extra_separators)
    if len(pieces) > 1:
        if known is None:
            known = _spans_by_automaton(body, pieces, automaton) if automaton is not None and len(automaton) else {}
        if known:
            pieces = [(pieces[i][0], pieces[j - 1][1]) for i, j in _best_cover(len(pieces), known)]
    return [v for v in (_unquote(body[lo:hi]) for lo, hi in pieces) if v]


_MINED = T.StructType([T.StructField("field", T.StringType()), T.StructField("value", T.StringType()), T.StructField("parts", T.ArrayType(T.StringType()))])


def whole_values(cells: DataFrame, extra: dict[str, str]) -> DataFrame:
    """(field, value, parts): distinct values of cells that leave no doubt; parts are the pieces the plain rule makes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: set[tuple[str, str]] = set()
            for field, cell in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                body = _unwrap(cell)
                pieces, sure = _plain_cuts(body, extra.get(field, ""))
                for lo, hi in pieces:
                    raw = body[lo:hi].strip()
                    if (v := _unquote(raw)) and (sure or v != raw):
                        seen.add((field, v))
            rows = sorted(seen)
            parts = [[v[lo:hi].strip() for lo, hi in _plain_cuts(v, extra.get(f, ""))[0]] for f, v in rows]
            columns = [pa.array([f for f, _ in rows], pa.string()), pa.array([v for _, v in rows], pa.string()), pa.array(parts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=_MINED.names)

    return cells.mapInArrow(run, _MINED).groupBy("field", "value").agg(F.first("parts").alias("parts"))


def _with_points(values: DataFrame) -> DataFrame:
    """(field, value, points) of the values that the plain rule would cut and of which some part is no known value."""
    values = cut_lineage(values)
    single = values.where("size(parts) = 1").select("field", F.col("value").alias("part"), F.lit(1).alias("known"))
    parts = values.where("size(parts) > 1").select("field", "value", F.explode("parts").alias("part")).where("part <> ''")
    points = parts.join(single, ["field", "part"], "left").groupBy("field", "value").agg(F.count(F.when(F.col("known").isNull(), 1)).alias("points"))
    return points.where("points > 0")


def long_cells(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, cell), one row per non-blank cell."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("cell")) for f in fields])
    e = df.select(F.col(key).alias("key"), F.explode(each).alias("e"))
    return e.select("key", "e.field", "e.cell").where(F.col("cell").isNotNull() & (F.trim("cell") != ""))


def split_packed(
    df: DataFrame,
    key: str,
    fields: list[str],
    extra_separators: dict[str, str] | None = None,
    dictionary: DataFrame | None = None,
    max_dictionary_bytes: int = MAX_DICTIONARY_BYTES,
) -> DataFrame:
    """One row (key, field, pos, value) per value; pos counts from 1 within a cell.

    `dictionary` (field, value) adds known whole values.  Up to `max_dictionary_bytes` the values that the plain rule
    would cut go to every task as an automaton; more are joined with the candidate runs of the cells.
    """
    extra = extra_separators or {}
    cells = long_cells(df, key, fields)
    values = whole_values(cells, extra)
    if dictionary is not None:
        given = dictionary.select(F.lit(0).alias("key"), "field", F.concat(F.lit('"'), F.replace("value", F.lit('"'), F.lit('""')), F.lit('"')).alias("cell")).where("cell is not null")
        values = values.unionByName(whole_values(given, extra)).groupBy("field", "value").agg(F.first("parts").alias("parts"))
    out = T.StructType(
        [T.StructField(key, cells.schema["key"].dataType), T.StructField("field", T.StringType()), T.StructField("pos", T.IntegerType()), T.StructField("value", T.StringType())]
    )
    known = cut_lineage(_with_points(values))  # small beside the cells, and read more than once
    sized = known.agg(F.coalesce(F.sum(F.octet_length("value") + 48), F.lit(0)).alias("bytes")).first()["bytes"]
    if sized > max_dictionary_bytes:
        return _by_join(cells, known, extra, out)
    words: dict[str, dict[str, int]] = {}
    for r in known.collect():
        words.setdefault(r["field"], {})[r["value"]] = r["points"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = {f: _automaton(w) for f, w in words.items()}
        for b in batches:
            yield _emit(b, out, lambda cell, field, _: segment_cell(cell, extra.get(field, ""), automata.get(field)))

    return cells.mapInArrow(run, out)


def _emit(batch: pa.RecordBatch, out: T.StructType, values_of) -> pa.RecordBatch:
    rows, pos, values = [], [], []
    spans = batch.column(3).to_pylist() if batch.num_columns > 3 else [None] * batch.num_rows
    for i, (field, cell, known) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), spans)):
        got = values_of(cell, field, known)
        rows += [i] * len(got)
        pos += range(1, len(got) + 1)
        values += got
    at = pa.array(rows, pa.int32())
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(at), batch.column(1).take(at), pa.array(pos, pa.int32()), pa.array(values, pa.string())], names=out.names
    )


def _by_join(cells: DataFrame, known: DataFrame, extra: dict[str, str], out: T.StructType) -> DataFrame:
    """The way for a dictionary without a size bound: candidate runs meet the dictionary in a shuffle join.

    A known value of n parts can only match a run of n pieces, so runs are no longer than the longest value of the
    dictionary, which loses none.
    """
    most = known.agg(F.coalesce(F.max(F.length(F.regexp_replace("value", "[^" + re.escape(HARD_SEPARATORS + SOFT_SEPARATOR + "".join(extra.values())) + "]", ""))), F.lit(0)).alias("n")).first()["n"] + 1
    run_type = T.StructType(
        [T.StructField("field", T.StringType()), T.StructField("cell", T.StringType()), T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("value", T.StringType())]
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for field, cell in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                body = _unwrap(cell)
                pieces, _ = _plain_cuts(body, extra.get(field, ""))
                for i in range(len(pieces)):
                    for j in range(i + 2, min(len(pieces), i + most) + 1):
                        for c, v in zip(cols, (field, cell, i, j, body[pieces[i][0] : pieces[j - 1][1]].strip())):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k in (2, 3) else pa.string()) for k, c in enumerate(cols)], names=run_type.names)

    found = (
        cells.select("field", "cell")
        .distinct()
        .mapInArrow(runs, run_type)
        .join(known, ["field", "value"])
        .groupBy("field", "cell")
        .agg(F.collect_set(F.struct("i", "j", "points")).alias("known"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _emit(b, out, lambda cell, field, k: segment_cell(cell, extra.get(field, ""), known={(x["i"], x["j"]): x["points"] for x in k or []}))

    return cells.join(found, ["field", "cell"], "left").select("key", "field", "cell", "known").mapInArrow(cut, out)
