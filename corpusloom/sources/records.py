"""Bibliographic XML records (articles and books) and passage files of a second full-text format.

Where a field stands is a table of paths, one per sort of record; the parser only reads them off, and dates and years
are put together by column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from .xml_text import NONE, Document, distinct, parse

_S = T.StringType()
RECORD_COLUMNS = (
    "pmid", "pmcid", "doi", "title", "abstract", "journal", "publication_date", "publication_year", "publication_types", "language", "authors", "mesh_terms",
    "book_title", "publisher", "record_type", "has_pmc",
)
RECORD_TYPE = T.StructType([*[T.StructField(c, _S) for c in RECORD_COLUMNS], T.StructField("source_file", _S), T.StructField("error", _S)])

# Where the fields of each sort of record stand; of several paths the first with a text counts.
DATE_PARTS = ("year", "month", "day", "season", "medlinedate")
PATHS = {
    "pubmedarticle": {
        "record_type": "pubmed_article", "needs": "medlinecitation/article", "pmid": ["medlinecitation/pmid"], "title": ["medlinecitation/article/articletitle"],
        "journal": ["medlinecitation/article/journal/title"], "book_title": [], "publisher": [], "abstract": "medlinecitation/article/abstract/abstracttext",
        "publication_types": ["medlinecitation/article/publicationtypelist/publicationtype", "medlinecitation/article/publicationtype"],
        "language": ["medlinecitation/article/language"], "authors": "medlinecitation/article/authorlist/author", "mesh_terms": "medlinecitation/meshheadinglist/meshheading/descriptorname",
        "ids": ["pubmeddata/articleidlist/articleid", "medlinecitation/article/elocationid"], "dates": ["medlinecitation/article/journal/journalissue/pubdate", "medlinecitation/article/articledate"],
    },
    "pubmedbookarticle": {
        "record_type": "pubmed_book_article", "needs": "bookdocument", "pmid": ["bookdocument/pmid"], "title": ["bookdocument/articletitle", "bookdocument/book/booktitle"],
        "journal": [], "book_title": ["bookdocument/book/booktitle"], "publisher": ["bookdocument/book/publisher/publishername"], "abstract": "bookdocument/abstract/abstracttext",
        "publication_types": ["bookdocument/publicationtypelist/publicationtype", "bookdocument/publicationtype"],
        "language": ["bookdocument/language"], "authors": "bookdocument/authorlist/author", "mesh_terms": "bookdocument/meshheadinglist/meshheading/descriptorname",
        "ids": ["bookdocument/articleidlist/articleid", "bookdocument/elocationid", "bookdocument/book/elocationid"], "dates": ["bookdocument/book/pubdate", "bookdocument/articledate"],
    },
}
NAME_PATHS = (("forename", "initials"), ("lastname",), ("suffix",))
_RAW = T.StructType([*[T.StructField(c, _S) for c in RECORD_COLUMNS if not c.startswith("publication_d") and c not in ("publication_year", "has_pmc")], *[T.StructField(p, _S) for p in DATE_PARTS], T.StructField("source_file", _S), T.StructField("error", _S)])


def _first(doc: Document, i: int, paths: list[str] | tuple[str, ...]) -> str:
    return next((t for p in paths if (t := doc.plain(doc.at(i, p)))), "")


def _all(doc: Document, i: int, paths: list[str]) -> list[str]:
    return [t for p in paths for e in doc.along(i, p) if (t := doc.plain(e))]


def _labelled(doc: Document, e: int) -> str:
    text, label = doc.plain(e), doc.attr(e, "label")
    return f"{label}: {text}" if label and text else text


def _name(doc: Document, e: int) -> str:
    return _first(doc, e, ["collectivename"]) or " ".join(filter(None, (_first(doc, e, p) for p in NAME_PATHS)))


def _heading(doc: Document, e: int) -> str:
    text = doc.plain(e)
    return text + " [major]" if text and doc.attr(e, "majortopicyn") == "Y" else text


def raw_record(doc: Document, i: int) -> dict[str, str]:
    """The fields of the record element i with the parts of its date; ValueError without the part it needs or an id."""
    where = PATHS[doc.name[i]]
    if doc.at(i, where["needs"]) == NONE:
        raise ValueError(f"{where['record_type']} without {where['needs']}")
    row = {c: _first(doc, i, where[c]) for c in ("pmid", "title", "journal", "book_title", "publisher")}
    if not row["pmid"]:
        raise ValueError(f"{where['record_type']} without an id")
    row |= {c: "|".join(_all(doc, i, where[c])) for c in ("publication_types", "language")}
    for column, glue, read in (("abstract", "\n", _labelled), ("authors", "|", _name), ("mesh_terms", "|", _heading)):
        row[column] = glue.join(filter(None, (read(doc, e) for e in doc.along(i, where[column]))))
    ids: dict[str, str] = {}
    for e in (e for p in where["ids"] for e in doc.along(i, p)):
        sort = (doc.attr(e, "idtype") or doc.attr(e, "eidtype")).casefold()
        if text := doc.plain(e):
            ids.setdefault(sort, text)
    number = ids.get("pmc", "")
    row |= {"pmcid": number if not number or number.upper().startswith("PMC") else f"PMC{number}", "doi": ids.get("doi", ""), "record_type": where["record_type"]}
    parts = [{p: _first(doc, e, [p]) for p in DATE_PARTS} for d in where["dates"] for e in doc.along(i, d)[:1]]
    return row | next((d for sure in ("year", "medlinedate") for d in parts if d[sure]), dict.fromkeys(DATE_PARTS, ""))


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names, dtype=object)


def parse_records(files: DataFrame) -> DataFrame:
    """Rows of RECORD_TYPE from (source_file, content): one per record, or one with the error of a file or record."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[dict] = []
            for name, content in zip(pdf["source_file"], pdf["content"]):
                try:
                    doc = parse(content)
                except ValueError as e:
                    rows.append({"source_file": name, "error": str(e)})
                    continue
                for i in (i for i, n in enumerate(doc.name) if n in PATHS):
                    try:
                        rows.append(raw_record(doc, i) | {"source_file": name})
                    except ValueError as e:
                        rows.append({"source_file": name, "error": str(e)})
            yield _frame(rows, _RAW.names)

    raw = files.select("source_file", "content").mapInPandas(run, _RAW)
    good = F.col("error").isNull()
    date = F.when(good, dates.partial_date(*[F.col(p) for p in DATE_PARTS]))
    out = raw.withColumn("publication_date", date).withColumn("publication_year", F.regexp_extract("publication_date", r"\b(\d{4})\b", 1))
    out = out.withColumn("has_pmc", F.when(good, F.when(F.col("pmcid") != "", "true").otherwise("false")))
    return out.select(*RECORD_TYPE.names)


def record_kind(doc: Document, pmid: str) -> str:
    """article, book, other or not_found: what a response holds for an id."""
    with_id = [i for i, n in enumerate(doc.name) if n == "pmid" and doc.plain(i) == pmid]
    for name, kind in (("pubmedarticle", "article"), ("pubmedbookarticle", "book")):
        if any(i < k <= doc.last[i] for i, n in enumerate(doc.name) if n == name for k in with_id):
            return kind
    return "other" if with_id else "not_found"


def classify_responses(files: DataFrame) -> DataFrame:
    """(source_file, pmid, kind) of (source_file, pmid, content): what each response holds for the id asked for; invalid if it can't be read."""
    out = "source_file string, pmid string, kind string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, pmid, content in zip(pdf["source_file"], pdf["pmid"], pdf["content"]):
                try:
                    rows.append((name, pmid, record_kind(parse(content), pmid)))
                except ValueError:
                    rows.append((name, pmid, "invalid"))
            yield pd.DataFrame(rows, columns=["source_file", "pmid", "kind"])

    return files.select("source_file", "pmid", "content").mapInPandas(run, out)


PASSAGE_TYPE = T.StructType(
    [T.StructField(c, _S) for c in ("source_file", "pmcid", "pmid", "title")] + [T.StructField(c, T.BooleanType()) for c in ("has_abstract", "has_body")] + [T.StructField("license", _S), T.StructField("error", _S)]
)
# Section kinds of passages, and the keys of identifiers.
TITLES, BODIES = {"title", "article_title"}, {"body", "results", "introduction", "discussion", "methods"}
PMC_KEYS, PMID_KEYS = ("pmcid", "article_id_pmc", "article_id_pmcid"), ("pmid", "article_id_pmid")


def passage_document(content: bytes | str) -> dict:
    """Ids, title, licence and which parts a passage file has; ValueError without a document."""
    doc = parse(content)
    tops = [i for i, n in enumerate(doc.name) if n == "document"]
    if not tops:
        raise ValueError("no document")
    inside = sorted({j for t in tops for j in doc.below(t)})
    notes = [(doc.attr(i, "key").casefold().replace("-", "_"), doc.plain(i)) for i in inside if doc.name[i] == "infon"]
    number = next((v for k, v in notes if k in PMC_KEYS and v), "")
    passages: list[tuple[str, str]] = []
    for p in (i for i in inside if doc.name[i] == "passage"):
        kinds = [doc.plain(c).casefold() for c in doc.children(p) if doc.name[c] == "infon" and doc.attr(c, "key").casefold() in ("section_type", "type")]
        texts = [t for c in doc.children(p) if doc.name[c] == "text" and (t := doc.plain(c))]
        if texts:
            passages.append((kinds[-1] if kinds else "", texts[-1]))
    return {
        "pmcid": f"PMC{number}" if number.isdigit() else number, "pmid": next((v for k, v in notes if k in PMID_KEYS and v), ""),
        "title": " ".join(t for k, t in passages if k in TITLES), "has_abstract": any(k == "abstract" for k, _ in passages), "has_body": any(k in BODIES for k, _ in passages),
        "license": " | ".join(distinct(v for k, v in notes if "license" in k)),
    }


def parse_passages(files: DataFrame) -> DataFrame:
    """Rows of PASSAGE_TYPE from (source_file, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["source_file"], pdf["content"]):
                try:
                    rows.append(passage_document(content) | {"source_file": name, "error": None})
                except ValueError as e:
                    rows.append({"source_file": name, "error": str(e)})
            yield _frame(rows, PASSAGE_TYPE.names)

    return files.select("source_file", "content").mapInPandas(run, PASSAGE_TYPE)
