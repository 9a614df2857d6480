"""Nested section trees as flat tables with parent links, by Arrow buffers.

Lists are flattened by their offsets: the child values of a whole batch are one array, the parent of each child is
its list's row (list_parent_indices), and keys reach the children by a vectorised take.  No row is turned into
Python objects.  A record that is a JSON string is read the same way: `json_arrays` makes offsets and parent indices of
the bytes of a whole block, and the same kernels make rows of them; records of any depth and size are read whole.

Defined results: null or empty lists give no rows; a null entry of a list of sections keeps its place and counts as a
section without a path, a null entry of a JSON list is no section; a null or empty path has no parent and is none; null
path elements count as empty text; articles that appear twice under different keys stay apart.  Columns that are not
named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .json_arrays import ARRAY, OBJECT, STRING, Documents, blocks, spliced

_US = "\x1f"


def normal_elements(flat: pa.Array) -> pa.Array:
    """Path elements as they are compared: trimmed, blanks collapsed, case ignored."""
    s = pc.fill_null(flat.cast(pa.string()), "")
    s = pc.replace_substring_regex(pc.utf8_trim_whitespace(s), r"\s+", " ")
    return pc.utf8_lower(s)


def _list_parts(col: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(parent row of each child, children) of a list column; null lists have none."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.list_parent_indices(col).to_numpy(zero_copy_only=False), pc.list_flatten(col)


def _numbers(owner: np.ndarray) -> np.ndarray:
    """1, 2, ... within each run of equal owners."""
    if not len(owner):
        return np.zeros(0, np.int32)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    return (np.arange(len(owner)) - np.repeat(starts, np.diff(np.r_[starts, len(owner)])) + 1).astype(np.int32)


def path_parents(owner: np.ndarray, number: np.ndarray, paths: pa.Array) -> np.ndarray:
    """Parent number of each section by its path, 0 where there is none.

    The parent is an earlier section of the same owner whose path is a proper leading part of the section's path: the
    longest such path, then the latest such section.  Works level by level over the whole batch: prefix codes of level
    d are looked up among the full-path codes by one sorted search.
    """
    n = len(owner)
    parent = np.zeros(n, np.int32)
    if not n:
        return parent
    paths = pc.if_else(pc.is_valid(paths), paths, pa.scalar([], paths.type))
    depth = pc.list_value_length(paths).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.r_[0, np.cumsum(depth)[:-1]]
    elements = normal_elements(pc.list_flatten(paths))
    deepest = int(depth.max(initial=0))
    # prefix[d]: for the sections that are deeper than d, the text of their first d elements
    texts: list[tuple[np.ndarray, pa.Array]] = []
    rows = np.flatnonzero(depth >= 1)
    text = pc.take(elements, pa.array(starts[rows])) if len(rows) else pa.array([], pa.string())
    for d in range(1, deepest + 1):
        texts.append((rows, text))
        keep = np.flatnonzero(depth[rows] > d)
        rows = rows[keep]
        text = pc.binary_join_element_wise(pc.take(text, pa.array(keep)), pc.take(elements, pa.array(starts[rows] + d)), _US) if len(rows) else pa.array([], pa.string())
    # one code per (owner, prefix text), over all levels
    spread = pa.concat_arrays([t for _, t in texts]) if texts else pa.array([], pa.string())
    codes = spread.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(spread) else np.zeros(0, np.int64)
    wide = int(codes.max(initial=0)) + 1
    level, at = [], 0
    for r, t in texts:
        level.append((r, owner[r].astype(np.int64) * wide + codes[at : at + len(t)]))
        at += len(t)
    full = np.full(n, -1, np.int64)
    for d, (r, code) in enumerate(level, 1):
        own = depth[r] == d
        full[r[own]] = code[own]
    have = np.flatnonzero(full >= 0)
    # sections by (code, place); places grow with the section number inside one owner
    order = have[np.lexsort((have, full[have]))]
    sorted_codes, open_rows = full[order], np.ones(n, bool)
    span = np.int64(n + 1)
    keys = np.unique(sorted_codes, return_inverse=True)
    dense, uniq = keys[1].astype(np.int64), keys[0]
    ranked = dense * span + order
    for d in range(deepest - 1, 0, -1):
        r, code = level[d - 1]
        pick = (depth[r] > d) & open_rows[r]
        r, code = r[pick], code[pick]
        k = np.searchsorted(uniq, code)
        hit = (k < len(uniq)) & (uniq[np.minimum(k, len(uniq) - 1)] == code) if len(uniq) else np.zeros(len(r), bool)
        r, k = r[hit], k[hit]
        before = np.searchsorted(ranked, k * span + r) - 1
        ok = (before >= 0) & (ranked[np.maximum(before, 0)] // span == k)
        r, found = r[ok], order[before[ok]]
        parent[r] = number[found]
        open_rows[r] = False
    return parent


_SECTIONS = T.StructType(
    [T.StructField("source_file", T.StringType()), T.StructField("section_no", T.IntegerType()), T.StructField("parent_no", T.IntegerType())]
)


def sections_by_path(df: DataFrame, key: str = "source_file", sections: str = "body_sections") -> DataFrame:
    """(source_file, section_no, parent_no) of an array<struct<..., section_path>> column.

    Only the paths leave the scan.
    """
    slim = df.select(F.col(key).cast("string").alias("k"), F.col(sections).getField("section_path").alias("paths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, paths = _list_parts(b.column(1))
            number = _numbers(owner)
            parent = path_parents(owner, number, paths)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner)), pa.array(number), pa.array(parent)], names=_SECTIONS.names)

    return slim.mapInArrow(run, _SECTIONS)


def _read(texts: list[bytes]) -> tuple[Documents, np.ndarray, np.ndarray, np.ndarray]:
    """(documents, section tokens, the objects that hold them, tokens of `secs` that are still strings)."""
    d = Documents(texts)
    body = d.get(d.get(d.roots, "article"), "body")
    body = body[body >= 0]
    holder, secs = d.members("secs")
    sections, up = _section_tokens(d, body, holder, secs)
    strings = d.kind[secs] == STRING
    return d, sections, up, secs[strings][np.isin(holder[strings], np.r_[body, sections])]


def _decoded(texts: list[bytes]) -> tuple[Documents, np.ndarray, np.ndarray, np.ndarray]:
    """(documents, section tokens, number, parent number) of a block of records.

    A `secs` that is a JSON string is replaced by the text it holds, if that is an object or an array, and such records
    are read again, until none is left; each round takes one level of encoding off.
    """
    d, sections, up, coded = _read(texts)
    if len(coded):
        texts, todo, part, left = list(texts), np.arange(len(texts)), d, coded
        while len(left):
            changed = np.unique(part.doc[left])
            new = _unwrapped([texts[i] for i in todo[changed].tolist()], changed, part, left)
            todo = todo[changed]
            for i, t in zip(todo.tolist(), new):
                texts[i] = t
            part, _, _, left = _read(new)
        d, sections, up, _ = _read(texts)
    order = np.argsort(sections, kind="stable")
    sections, up = sections[order], up[order]
    number = _numbers(d.doc[sections])
    at = np.minimum(np.searchsorted(sections, up), max(len(sections) - 1, 0))
    parent = np.where(sections[at] == up, number[at], 0).astype(np.int32) if len(sections) else np.zeros(0, np.int32)
    return d, sections, number, parent


def _unwrapped(texts: list[bytes], docs: np.ndarray, d: Documents, coded: np.ndarray) -> list[bytes]:
    """The texts of those documents with their coded sections in plain."""
    inner = [t.encode("utf-8", "surrogatepass") for t in d.strings(coded)]
    fit = Documents(inner)
    ok = fit.roots >= 0
    ok[ok] = np.isin(fit.kind[fit.roots[ok]], (OBJECT, ARRAY))
    at = np.searchsorted(docs, d.doc[coded])
    begin, end = d.begin[coded] - 1 - d.first[d.doc[coded]], d.end[coded] + 1 - d.first[d.doc[coded]]
    begins, ends, news = [[] for _ in texts], [[] for _ in texts], [[] for _ in texts]
    for i, lo, hi, new, good in zip(at.tolist(), begin.tolist(), end.tolist(), inner, ok.tolist()):
        begins[i].append(lo)
        ends[i].append(hi)
        news[i].append(new if good else b"null")
    return spliced(texts, begins, ends, news)


def _section_tokens(d: Documents, bodies: np.ndarray, holder: np.ndarray, secs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section, the object whose `secs` holds it), for the sections under the bodies.

    Every object in a `secs` points to its holder; pointers are doubled until they end at a body or nowhere.
    """
    row, entry = d.items(secs)
    is_object = d.kind[entry] == OBJECT
    child, up = entry[is_object], holder[row[is_object]]
    reach = np.full(len(d.kind) + 1, len(d.kind), np.int64)
    reach[bodies] = bodies
    reach[child] = up
    while True:
        further = reach[reach]
        if (further == reach).all():
            break
        reach = further
    body = np.zeros(len(d.kind) + 1, bool)
    body[bodies] = True
    under = body[reach[child]]
    return child[under], up[under]


def _run_records(make):
    """mapInArrow function over (key, record): `make` gives the columns of a block, the row of the key first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            for lo, hi in blocks(texts):
                names, (owner, *columns) = make(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner + lo)), *columns], names=names)

    return run


def _records(df: DataFrame, key: str, record: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("k"), F.col(record).cast("string").alias("r"))


def sections_of_records(df: DataFrame, key: str = "source_file", record: str = "record") -> DataFrame:
    """(source_file, section_no, parent_no) of JSON records; a record that is not valid JSON yields nothing."""

    def make(texts: list[bytes]):
        d, sections, number, parent = _decoded(texts)
        return _SECTIONS.names, (d.doc[sections], pa.array(number, pa.int32()), pa.array(parent, pa.int32()))

    return _records(df, key, record).mapInArrow(_run_records(make), _SECTIONS)


_FAILED = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("reason", T.StringType())])


def failed_records(df: DataFrame, key: str = "source_file", record: str = "record") -> DataFrame:
    """(source_file, reason) of the records that yield nothing: missing, invalid (not JSON) or no object."""

    def make(texts: list[bytes]):
        d = Documents(texts)
        none = np.flatnonzero((d.roots < 0) | (d.kind[d.roots] != OBJECT)) if len(d.kind) else np.arange(len(texts))
        reasons = ["missing" if not texts[i].strip() else "invalid" if d.roots[i] < 0 else "no object" for i in none]
        return _FAILED.names, (none, pa.array(reasons, pa.string()))

    return _records(df, key, record).mapInArrow(_run_records(make), _FAILED)


_PARTS = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("section_no", T.IntegerType()),
        T.StructField("part_no", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
PART_KINDS = ("title", "label", "p", "figs", "note")


def parts_of_records(df: DataFrame, key: str = "source_file", record: str = "record") -> DataFrame:
    """(source_file, section_no, part_no, kind, text): title, label, paragraphs, figures and notes of each section.

    A value may be a string, a number, a list of them or an object with a text-like member; values without a text
    are no parts.
    """

    def make(texts: list[bytes]):
        d, sections, number, _ = _decoded(texts)
        at, kind, token = [], [], []
        for k, name in enumerate(PART_KINDS):
            row, entry = d.items(d.get(sections, name))
            at.append(row)
            kind.append(np.full(len(row), k))
            token.append(entry)
        at, kind, token = map(np.concatenate, (at, kind, token))
        order = np.lexsort((token, kind, at))
        at, kind, token = at[order], kind[order], token[order]
        text = d.texts(token)
        have = np.array([t is not None for t in text], bool)
        at, kind = at[have], kind[have]
        return _PARTS.names, (
            d.doc[sections[at]], pa.array(number[at], pa.int32()), pa.array(_numbers(at), pa.int32()), pa.array(PART_KINDS).take(pa.array(kind)), pa.array([t for t in text if t is not None], pa.string())
        )

    return _records(df, key, record).mapInArrow(_run_records(make), _PARTS)


_ARTICLES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("source_file", "pmid", "pmcid", "doi", "title", "year", "authors", "license")]
    + [T.StructField(c, T.IntegerType()) for c in ("n_refs", "n_sections")]
)


def articles_of_records(df: DataFrame, key: str = "source_file", record: str = "record") -> DataFrame:
    """(source_file, pmid, pmcid, doi, title, year, authors, license, n_refs, n_sections) of JSON records that are objects.

    Of several ids of a kind the last counts, of several dates the first with a year.
    """

    def make(texts: list[bytes]):
        d, sections, _, _ = _decoded(texts)
        docs = np.flatnonzero(d.roots >= 0)
        docs = docs[d.kind[d.roots[docs]] == OBJECT]
        n = len(docs)
        article = d.get(d.roots[docs], "article")
        front = d.get(article, "front")

        def members(name: str) -> tuple[np.ndarray, np.ndarray]:
            row, entry = d.items(d.get(front, name))
            return row, entry

        ids: list[dict[str, str | None]] = [{} for _ in range(n)]
        row, entry = members("ids")
        for i, k, v in zip(row.tolist(), d.texts(d.get(entry, "type")), d.texts(d.get(entry, "value"))):
            if k is not None:
                ids[i][k] = v
        names: list[list[str]] = [[] for _ in range(n)]
        row, entry = members("contribs")
        is_object = d.kind[entry] == OBJECT
        name = np.where(is_object, d.get(entry, "name"), entry)
        last, given, whole, group = d.texts(d.get(name, "surname")), d.texts(d.get(name, "given")), d.texts(name), d.texts(d.get(entry, "collab"))
        for i, t, a, b, w, g in zip(row.tolist(), name.tolist(), last, given, whole, group):
            if who := (" ".join(filter(None, (a, b))) if t >= 0 and d.kind[t] == OBJECT else w) or g:
                names[i].append(who)
        years: list[str | None] = [None] * n
        row, entry = members("dates")
        for i, y in zip(row.tolist(), d.texts(d.get(entry, "year"))):
            years[i] = years[i] or y or None
        lic = d.get(front, "license")
        inner = d.get(lic, "type")
        lic = d.texts(np.where((lic >= 0) & (d.kind[lic] == OBJECT), inner, lic)) if n else []
        refs = np.bincount(d.items(d.get(d.get(article, "back"), "refs"))[0], minlength=n)
        count = np.bincount(d.doc[sections], minlength=len(texts))[docs]
        columns = [[x.get("pmid") for x in ids], [x.get("pmc") or x.get("pmcid") for x in ids], [x.get("doi") for x in ids], d.texts(d.get(front, "title")), years, ["; ".join(x) or None for x in names], lic]
        return _ARTICLES.names, (docs, *[pa.array(c, pa.string()) for c in columns], pa.array(refs, pa.int32()), pa.array(count, pa.int32()))

    return _records(df, key, record).mapInArrow(_run_records(make), _ARTICLES)


def parts_by_path(df: DataFrame, key: str = "source_file", sections: str = "body_sections") -> DataFrame:
    """As parts_of_records for a nested column: title, and the text's paragraphs (cut at blank lines)."""
    s = df.select(F.col(key).cast("string").alias("source_file"), F.posexplode(sections).alias("i", "s"))
    pieces = F.filter(F.split(F.coalesce(F.col("s.text"), F.lit("")), r"\r?\n\s*\r?\n"), lambda x: F.btrim(x, F.lit(" \t\r\n")) != "")
    title = F.when(F.btrim(F.coalesce(F.col("s.title"), F.lit(""))) != "", F.array(F.struct(F.lit("title").alias("kind"), F.col("s.title").alias("text"))))
    paragraphs = F.transform(pieces, lambda x: F.struct(F.lit("p").alias("kind"), F.btrim(x, F.lit(" \t\r\n")).alias("text")))
    both = F.concat(F.coalesce(title, F.array().cast("array<struct<kind:string,text:string>>")), paragraphs)
    return s.select("source_file", (F.col("i") + 1).cast("int").alias("section_no"), F.posexplode(both).alias("j", "e")).select(
        "source_file", "section_no", (F.col("j") + 1).cast("int").alias("part_no"), "e.kind", "e.text"
    )


def body_claims(acquired: DataFrame, articles: DataFrame, raw: DataFrame) -> DataFrame:
    """Whether the claim has_body of each acquisition row agrees with the bodies that are there.

    (record_id, claimed, actual, verdict); claimed is null where the flag is missing or unreadable, actual is null where
    no article with that number is there.  verdict: agrees, contradicts, unclaimed, unknown.
    """
    from ..functions.text import first_number, text_or_empty

    flag = F.lower(text_or_empty("has_body"))
    claimed = F.when(flag.isin("true", "t", "yes", "y", "1"), True).when(flag.isin("false", "f", "no", "n", "0"), False)
    nested = articles.select(
        first_number("pmcid").alias("n"), F.exists(F.col("body_sections"), lambda s: F.btrim(F.coalesce(s["text"], F.lit("")), F.lit(" \t\r\n")) != "").alias("b")
    )
    decoded = articles_of_records(raw).select(first_number("pmcid").alias("n"), (F.col("n_sections") > 0).alias("b"))
    there = nested.unionByName(decoded).where("n is not null").groupBy("n").agg(F.max(F.coalesce("b", F.lit(False))).alias("actual"))
    a = acquired.select("record_id", F.coalesce(first_number("pmcid_xml"), first_number("pmcid_requested")).alias("n"), claimed.alias("claimed"))
    j = a.join(there, "n", "left")
    verdict = (
        F.when(F.col("actual").isNull(), "unknown").when(F.col("claimed").isNull(), "unclaimed").when(F.col("claimed") == F.col("actual"), "agrees").otherwise("contradicts")
    )
    return j.select("record_id", "claimed", "actual", verdict.alias("verdict"))
