"""Queries of the XML sources: tables are written as documents, read back by the parsers, and compared with the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SECTION_CATEGORIES
from ..sources import jats, records
from .registry import Tables, query

# White space as the parsers collapse it; in Java's and in RE2's notation.
_JAVA_WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
_SQL_WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_NO_XML = r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]"


def escaped(c: Column) -> Column:
    """Text as XML content; characters that XML doesn't know become blanks."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), _NO_XML, " ")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def element(name: str, content: Column, attrs: str = "") -> Column:
    return F.concat(F.lit(f"<{name}{' ' + attrs if attrs else ''}>"), content, F.lit(f"</{name}>"))


def _each(c: Column, make) -> Column:
    return F.array_join(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: make(escaped(x))), "")


def article_files(t: Tables) -> DataFrame:
    """(source_file, content): literature_article as JATS documents; every body section holds the next one."""
    kind = t.literature_article.schema["body_sections"].dataType
    own = lambda s: F.concat(element("title", escaped(s["title"])), element("p", escaped(s["text"])))
    list_ = lambda c: F.coalesce(F.col(c), F.array().cast(kind))
    text = lambda c: escaped(F.col(c).cast("string"))
    flat = F.array_join(F.transform(list_("abstract_sections"), lambda s: element("sec", own(s))), "")
    nested = F.concat(F.array_join(F.transform(list_("body_sections"), lambda s: F.concat(F.lit("<sec>"), own(s))), ""), F.repeat(F.lit("</sec>"), F.size(list_("body_sections"))))
    meta = [
        element("article-id", text("pmid"), 'pub-id-type="pmid"'), element("article-id", text("pmcid"), 'pub-id-type="pmc"'), element("article-id", text("doi"), 'pub-id-type="doi"'),
        element("article-categories", element("subj-group", _each(F.col("publication_types"), lambda x: element("subject", x)), 'subj-group-type="article-type"')),
        element("title-group", element("article-title", text("title"))),
        element("contrib-group", _each(F.col("authors"), lambda x: element("contrib", element("name", element("surname", x)), 'contrib-type="author"'))),
        element("pub-date", element("year", text("publication_year"))), element("permissions", element("license", element("license-p", text("license")))),
        element("kwd-group", _each(F.col("mesh_terms"), lambda x: element("kwd", x)), 'kwd-group-type="MeSH"'), element("abstract", F.concat(F.lit("<title>Abstract</title>"), flat)),
    ]
    front = element("front", F.concat(element("journal-meta", element("journal-title-group", element("journal-title", text("journal")))), element("article-meta", F.concat(*meta))))
    whole = F.concat(F.lit('<article article-type="'), text("article_type"), F.lit('" xml:lang="'), text("language"), F.lit('">'), front, element("body", nested), F.lit("</article>"))
    return t.literature_article.select("source_file", F.encode(whole, "UTF-8").alias("content"))


def _sql(c: str) -> str:
    return f"trim(regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), '{_SQL_WS}', ' ', 'g'))"


def _sql_list(c: str) -> str:
    l = f"list_filter(list_transform(coalesce({c}, []), lambda x: {_sql('x')}), lambda x: x <> '')"
    return f"array_to_string(list_filter({l}, lambda x, i: list_position({l}, x) = i), '|')"


_PMC = f"CASE WHEN lower({_sql('pmcid')}) LIKE 'pmc%' THEN {_sql('pmcid')} WHEN {_sql('pmcid')} <> '' THEN 'PMC' || {_sql('pmcid')} END"
_FIELDS = ("title", "journal", "article_type", "language", "license")


@query(
    f"""SELECT source_file, {_sql("pmid")} AS pmid, {_PMC} AS pmcid, nullif({_sql("doi")}, '') AS doi, {", ".join(f"{_sql(c)} AS {c}" for c in _FIELDS)}, publication_year, {_sql("publication_year")} AS publication_date,
    {", ".join(f"{_sql_list(c)} AS {c}" for c in ("publication_types", "authors", "mesh_terms"))} FROM literature_article"""
)
def jats_articles(t: Tables) -> DataFrame:
    """Identifiers, titles, dates, people, types, terms, language and license of article files."""
    a = jats.parsed(jats.parse_files(article_files(t)))
    lists = [F.array_join(c, "|").alias(c) for c in ("publication_types", "authors", "mesh_terms")]
    return a.select("source_file", "pmid", "pmcid", "doi", *_FIELDS, "publication_year", "publication_date", *lists)


_CATEGORIES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in SECTION_CATEGORIES.items()) + "}"


def _sections_sql(side: str, path: str, level: str) -> str:
    titles = f"list_transform({side}_sections, lambda s: CASE WHEN {_sql('s.title')} = '' THEN 'Untitled section' ELSE {_sql('s.title')} END)"
    return f"""SELECT source_file, '{side}' AS source, i AS place, titles[i] AS title, array_to_string({path}, ' > ') AS path, CAST({level} AS INTEGER) AS level, text FROM
    (SELECT source_file, titles, i, {_sql("s[i].text")} AS text FROM (SELECT source_file, {side}_sections AS s, {titles} AS titles, unnest(generate_series(1, len({side}_sections))) AS i FROM literature_article WHERE {side}_sections IS NOT NULL))"""


@query(
    f"""SELECT source_file, source, CAST(row_number() OVER (PARTITION BY source_file, source ORDER BY place) AS INTEGER) AS place, title, path, level, normal AS normalized_title, coalesce({_CATEGORIES}[normal], 'other') AS category, md5(text) AS digest
    FROM (SELECT *, lower(trim(rtrim(regexp_replace(title, '^[0-9]+(\\.[0-9]+)*[.)]?\\s+', ''), ':'))) AS normal FROM ({_sections_sql("abstract", "[titles[i]]", "1")} UNION ALL {_sections_sql("body", "titles[1:i]", "i")}) WHERE text <> '')"""
)
def jats_sections(t: Tables) -> DataFrame:
    """Sections of article files in document order with their paths, levels and categories."""
    a = jats.parsed(jats.parse_files(article_files(t)))
    sides = [a.select("source_file", F.posexplode(f"{s}_sections").alias("place", "s")) for s in ("abstract", "body")]
    s = sides[0].unionByName(sides[1])
    return s.select(
        "source_file", "s.source", (F.col("place") + 1).alias("place"), "s.title", F.array_join("s.section_path", " > ").alias("path"), "s.level", "s.normalized_title", "s.category",
        F.md5(F.encode("s.text", "UTF-8")).alias("digest"),
    )


_N = {s: f"len(coalesce({s}_sections, []))" for s in ("abstract", "body")}
_PROFILE = [("part", "'body'", "1"), ("part", "'abstract'", "1"), ("part", "'section'", f"{_N['abstract']} + {_N['body']}"), ("root", "'article'", "1"), ("tag", "'title'", f"1 + {_N['abstract']} + {_N['body']}"), ("article_type", f"coalesce(nullif({_sql('article_type')}, ''), '(none)')", "1")]


@query(
    "SELECT kind, key, CAST(sum(n) AS BIGINT) AS n, count(*) AS files FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, {key} AS key, {n} AS n FROM literature_article" for k, key, n in _PROFILE) + ") WHERE n > 0 GROUP BY ALL"
)
def xml_profile(t: Tables) -> DataFrame:
    """How often roots, parts, article types and titles occur in article files."""
    total = jats.profile_totals(jats.profile_files(article_files(t)))
    return total.where("kind in ('part', 'root', 'article_type') or (kind = 'tag' and key = 'title')")


_MONTHS = ("Jan", "february", "Mar", "APR", "May", "06", "Jul", "Aug", "Sept", "Oct", "11", "Dec")


def record_files(t: Tables) -> DataFrame:
    """(source_file, pmid, content): pubmed_complete_metadata as bibliographic records, books by their record_type."""
    x = lambda c: escaped(F.col(c))
    month = F.element_at(F.array(*[F.lit(m) for m in _MONTHS]), (F.col("record_id") % 12 + 1).cast("int"))
    day = (F.col("record_id") % 28 + 1).cast("string")
    date = F.when(F.trim(F.coalesce("publication_year", F.lit(""))) != "", F.concat(element("Year", x("publication_year")), element("Month", month), element("Day", day))).otherwise(element("MedlineDate", x("publication_date")))
    ids = lambda: element("ArticleIdList", F.concat(element("ArticleId", x("pmcid"), 'IdType="pmc"'), element("ArticleId", x("doi"), 'IdType="doi"')))
    common = F.concat(
        element("ArticleTitle", x("title")), element("Abstract", element("AbstractText", x("abstract"), 'Label="ALL"')), element("AuthorList", element("Author", element("CollectiveName", x("authors")))),
        element("Language", x("language")), element("PublicationTypeList", element("PublicationType", x("publication_types"))),
    )
    mesh = element("MeshHeadingList", element("MeshHeading", element("DescriptorName", x("mesh_terms"), 'MajorTopicYN="Y"')))
    journal = element("Journal", F.concat(element("Title", x("journal")), element("JournalIssue", element("PubDate", date))))
    article = element("PubmedArticle", F.concat(element("MedlineCitation", F.concat(element("PMID", x("pmid")), element("Article", F.concat(journal, common)), mesh)), element("PubmedData", ids())))
    book = element("Book", F.concat(element("BookTitle", x("book_title")), element("Publisher", element("PublisherName", x("publisher"))), element("PubDate", date)))
    book_article = element("PubmedBookArticle", element("BookDocument", F.concat(element("PMID", x("pmid")), ids(), book, common, mesh)))
    one = F.when(F.contains(F.coalesce("record_type", F.lit("")), F.lit("book")), book_article).otherwise(article)
    content = element("PubmedArticleSet", one)
    return t.pubmed_complete_metadata.select(F.col("record_id").cast("string").alias("source_file"), F.col("pmid"), F.encode(content, "UTF-8").alias("content"))


_BOOK = "contains(coalesce(record_type, ''), 'book')"
_MONTH_SQL = "[" + ", ".join(f"'{i:02d}'" for i in range(1, 13)) + "][record_id % 12 + 1]"
_YEARLESS = f"{_sql('publication_year')} = ''"
_DATE_SQL = f"CASE WHEN {_YEARLESS} THEN {_sql('publication_date')} ELSE {_sql('publication_year')} || '-' || {_MONTH_SQL} || '-' || lpad(CAST(record_id % 28 + 1 AS VARCHAR), 2, '0') END"
_PMC_UPPER = f"CASE WHEN {_sql('pmcid')} = '' OR upper({_sql('pmcid')}) LIKE 'PMC%' THEN {_sql('pmcid')} ELSE 'PMC' || {_sql('pmcid')} END"


def _labelled(c: str, before: str, behind: str) -> str:
    return f"CASE WHEN {_sql(c)} = '' THEN '' ELSE '{before}' || {_sql(c)} || '{behind}' END"


@query(
    f"""SELECT CAST(record_id AS VARCHAR) AS source_file, {_sql("pmid")} AS pmid, {_PMC_UPPER} AS pmcid, {_sql("doi")} AS doi, CASE WHEN {_BOOK} AND {_sql("title")} = '' THEN {_sql("book_title")} ELSE {_sql("title")} END AS title,
    {_labelled("abstract", "ALL: ", "")} AS abstract, CASE WHEN {_BOOK} THEN '' ELSE {_sql("journal")} END AS journal, {_DATE_SQL} AS publication_date, coalesce(regexp_extract({_DATE_SQL}, '\\b([0-9]{{4}})\\b', 1), '') AS publication_year,
    {_sql("publication_types")} AS publication_types, {_sql("language")} AS language, {_sql("authors")} AS authors, {_labelled("mesh_terms", "", " [major]")} AS mesh_terms, CASE WHEN {_BOOK} THEN {_sql("book_title")} ELSE '' END AS book_title,
    CASE WHEN {_BOOK} THEN {_sql("publisher")} ELSE '' END AS publisher, CASE WHEN {_BOOK} THEN 'pubmed_book_article' ELSE 'pubmed_article' END AS record_type, CASE WHEN {_sql("pmcid")} <> '' THEN 'true' ELSE 'false' END AS has_pmc
    FROM pubmed_complete_metadata WHERE {_sql("pmid")} <> ''"""
)
def bibliographic_records(t: Tables) -> DataFrame:
    """Article and book records of response files with their dates, years and flags."""
    return records.parse_records(record_files(t)).where("error is null").drop("error")


@query(f"SELECT kind, count(*) AS n FROM (SELECT CASE WHEN {_sql('pmid')} = '' THEN 'not_found' WHEN {_BOOK} THEN 'book' ELSE 'article' END AS kind FROM pubmed_complete_metadata) GROUP BY 1")
def response_kinds(t: Tables) -> DataFrame:
    """What the response files hold for the ids asked for; a blank id is asked for as "0"."""
    collapsed = F.trim(F.regexp_replace(F.coalesce("pmid", F.lit("")), _JAVA_WS, " "))
    asked = record_files(t).withColumn("pmid", F.when(collapsed != "", collapsed).otherwise("0"))
    return records.classify_responses(asked).groupBy("kind").agg(F.count("*").alias("n"))


@query(
    f"""SELECT CAST(record_id AS VARCHAR) AS source_file, CASE WHEN regexp_matches({_sql("pmcid")}, '^[0-9]+$') THEN 'PMC' || {_sql("pmcid")} ELSE {_sql("pmcid")} END AS pmcid, {_sql("pmid")} AS pmid, {_sql("title")} AS title,
    {_sql("abstract")} <> '' AS has_abstract, {_sql("journal")} <> '' AS has_body, {_sql("language")} AS license FROM pubmed_complete_metadata"""
)
def passage_files(t: Tables) -> DataFrame:
    """Passage files: title, abstract, a text of methods, and ids and license as notes."""
    x = lambda c: escaped(F.col(c))
    note = lambda key, c: element("infon", c, f'key="{key}"')
    passage = lambda kind, c: element("passage", F.concat(note("section_type", F.lit(kind)), element("text", c)))
    doc = F.concat(
        note("article-id_pmc", x("pmcid")), note("article-id_pmid", x("pmid")), note("license", x("language")), passage("TITLE", x("title")), passage("ABSTRACT", x("abstract")), passage("METHODS", x("journal"))
    )
    files = t.pubmed_complete_metadata.select(F.col("record_id").cast("string").alias("source_file"), F.encode(element("collection", element("document", doc)), "UTF-8").alias("content"))
    return records.parse_passages(files).drop("error")
