"""The queries of problems 1 to 3; every callable takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested, orphans, packed

PACKED_FIELDS = ["disease_ids", "publication_types", "query_categories", "mesh_terms"]
EXTRA_SEPARATORS = {"query_categories": "+"}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return packed.split_packed(_table(spark, folder, "pubmed_complete_metadata"), "record_id", PACKED_FIELDS, EXTRA_SEPARATORS)


def p1_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(field, value, n_records, n_values): how often each value occurs."""
    v = p1_found(spark, folder)
    per_record = v.groupBy("field", "value", "record_id").agg(F.count("*").alias("n"))
    return per_record.groupBy("field", "value").agg(F.count("*").alias("n_records"), F.sum("n").alias("n_values"))


def _articles(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "literature_article")


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "literature_raw")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return nested.sections_by_path(_articles(spark, folder)).unionByName(nested.sections_of_records(_raw(spark, folder)))


def p2_parts(spark: SparkSession, folder: str) -> DataFrame:
    return nested.parts_by_path(_articles(spark, folder)).unionByName(nested.parts_of_records(_raw(spark, folder)))


def p2_articles(spark: SparkSession, folder: str) -> DataFrame:
    a = _articles(spark, folder).select(
        "source_file", "pmid", "pmcid", "doi", "title", F.col("publication_year").cast("string").alias("year"), F.array_join("authors", "; ").alias("authors"), "license", F.lit(None).cast("int").alias("n_refs")
    )
    return a.unionByName(nested.articles_of_records(_raw(spark, folder)).drop("n_sections"))


def p2_failed(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, reason): records that yield nothing."""
    return nested.failed_records(_raw(spark, folder))


def p2_body_claims(spark: SparkSession, folder: str) -> DataFrame:
    return nested.body_claims(_table(spark, folder, "acquire_pmc_fulltext"), _articles(spark, folder), _raw(spark, folder))


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    manifest, audit = _table(spark, folder, "pubmed_fulltext_manifest"), _table(spark, folder, "pubmed_selection_audit")
    metadata, diseases = _table(spark, folder, "pubmed_complete_metadata"), _table(spark, folder, "disease_manifest")
    meta = {"target": metadata, "target_name": "pubmed_complete_metadata", "begin": "ingested_at", "end": "withdrawn_at"}
    return orphans.find_orphans(
        [
            orphans.Reference("pubmed_fulltext_manifest", manifest, "pmcid", "created_at", target_field="pmcid", **meta),
            orphans.Reference("pubmed_selection_audit", audit, "pmid", "selected_at", target_field="pmid", **meta),
            orphans.Reference("pubmed_selection_audit", audit, "disease_id", "selected_at", diseases, "disease_manifest", "disease_id", "added_at", "retired_at"),
        ]
    )


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _orphans(spark, folder).select("ref_table", "ref_field", "record_id", "reason")


def p3_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return orphans.orphans_by_month(_orphans(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_value_counts, p2_found, p2_parts, p2_articles, p2_failed, p2_body_claims, p3_found, p3_by_month)}


_HARD = r"|;｜；\t\n\r"


def _split_sql(field: str) -> str:
    hard = _HARD + ("+" if field == "query_categories" else "")
    body = f"CASE WHEN regexp_matches(t, '^\\[(\"[^\"]*\"|[^\"\\[\\]]|\\[[^\\[\\]]*\\])*\\]$') THEN substr(t, 2, length(t) - 2) ELSE t END"
    # pieces are runs of quoted text and of characters that don't separate
    return f"""SELECT record_id, '{field}' AS field, b, CASE WHEN regexp_matches(regexp_replace(b, '"[^"]*"', 'Q', 'g'), '[{hard}]')
    THEN regexp_extract_all(b, '(?:"[^"]*"|[^"{hard}])+') ELSE regexp_extract_all(b, '(?:"[^"]*"|[^",])+') END AS pieces
    FROM (SELECT record_id, {body} AS b FROM (SELECT record_id, trim({field}, E' \\t\\n\\r') AS t FROM pubmed_complete_metadata WHERE {field} IS NOT NULL))"""


def _p1_sql() -> str:
    every = " UNION ALL ".join(_split_sql(f) for f in PACKED_FIELDS)
    strip = r"trim(x, E' \t\n\r')"
    clean = f"""CASE WHEN length({strip}) >= 2 AND {strip}[1] = '"' AND {strip}[-1] = '"' THEN trim(replace(substr({strip}, 2, length({strip}) - 2), '""', '"'), E' \\t\\n\\r') ELSE {strip} END"""
    vals = f"list_filter(list_transform(pieces, lambda x: {clean}), lambda v: v <> '')"
    return f"""WITH v AS (SELECT record_id, field, {vals} AS v FROM ({every}))
    SELECT record_id, field, CAST(i AS INTEGER) AS pos, v[i] AS value FROM (SELECT record_id, field, v, unnest(generate_series(1, len(v))) AS i FROM v)"""


_SECS = """CASE json_type({s}) WHEN 'ARRAY' THEN json_extract({s}, '$[*]') WHEN 'OBJECT' THEN [{s}] WHEN 'VARCHAR' THEN
    CASE WHEN NOT json_valid({s} ->> '$') THEN [] WHEN json_type(({s} ->> '$')::JSON) = 'ARRAY' THEN json_extract(({s} ->> '$')::JSON, '$[*]')
    WHEN json_type(({s} ->> '$')::JSON) = 'OBJECT' THEN [({s} ->> '$')::JSON] ELSE [] END ELSE [] END"""

_P2_SQL = f"""WITH RECURSIVE top AS (SELECT source_file, json_extract(record::JSON, '$.article.body.secs') AS secs FROM literature_raw WHERE json_valid(record)),
kids AS (SELECT source_file, CAST([] AS INTEGER[]) AS steps, {_SECS.format(s="secs")} AS list FROM top),
tree AS (
  SELECT source_file, list_append(steps, i::INTEGER) AS steps, list[i] AS node FROM (SELECT source_file, steps, list, unnest(generate_series(1, len(list))) AS i FROM kids)
  UNION ALL
  SELECT source_file, list_append(steps, i::INTEGER), list[i] FROM (SELECT source_file, steps, list, unnest(generate_series(1, len(list))) AS i FROM
    (SELECT source_file, steps, {_SECS.format(s="json_extract(node, '$.secs')")} AS list FROM tree WHERE json_type(node) = 'OBJECT'))),
numbered AS (SELECT source_file, steps, row_number() OVER (PARTITION BY source_file ORDER BY steps) AS no FROM tree WHERE json_type(node) = 'OBJECT'),
flat AS (SELECT source_file, i AS no, list_transform(coalesce(s[i].section_path, []), lambda e: lower(trim(regexp_replace(coalesce(e, ''), '\\s+', ' ', 'g')))) AS p
  FROM (SELECT source_file, body_sections AS s, unnest(generate_series(1, len(body_sections))) AS i FROM literature_article WHERE body_sections IS NOT NULL))
SELECT n.source_file, CAST(n.no AS INTEGER) AS section_no, CAST(coalesce(u.no, 0) AS INTEGER) AS parent_no FROM numbered n LEFT JOIN numbered u ON u.source_file = n.source_file AND u.steps = n.steps[1:len(n.steps) - 1]
UNION ALL
SELECT c.source_file, CAST(c.no AS INTEGER), CAST(coalesce(max_by(e.no, (len(e.p), e.no)), 0) AS INTEGER) FROM flat c LEFT JOIN flat e
ON e.source_file = c.source_file AND e.no < c.no AND len(e.p) > 0 AND len(e.p) < len(c.p) AND c.p[1:len(e.p)] = e.p GROUP BY c.source_file, c.no"""


_TREE = _P2_SQL[: _P2_SQL.index("flat AS (")].rstrip(", \n").replace("SELECT source_file, steps, row_number()", "SELECT source_file, steps, node, row_number()")


def _scalar_text(x: str) -> str:
    return f"CASE WHEN json_type({x}) IN ('VARCHAR', 'BIGINT', 'UBIGINT', 'DOUBLE') THEN {x} ->> '$' END"


def _any_text(x: str) -> str:
    inner = ", ".join(_scalar_text(f"json_extract({x}, '$.{k}')") for k in ("text", "value", "p", "title", "caption", "caption.text"))
    return f"CASE WHEN json_type({x}) = 'OBJECT' THEN coalesce({inner}) ELSE {_scalar_text(x)} END"


def _entries(x: str) -> str:
    return f"CASE WHEN json_type({x}) = 'ARRAY' THEN json_extract({x}, '$[*]') WHEN coalesce(json_type({x}), 'NULL') <> 'NULL' THEN [{x}] ELSE [] END"


_KINDS_SQL = " UNION ALL ".join(f"SELECT source_file, no, {k} AS k, '{name}' AS kind, {_entries(f"json_extract(node, '$.{name}')")} AS l FROM numbered" for k, name in enumerate(nested.PART_KINDS))
_BLANKS = r"E' \t\r\n'"
_P2_PARTS_SQL = f"""{_TREE},
parts AS (SELECT source_file, no, k, i, kind, {_any_text("l[i]")} AS text FROM (SELECT *, unnest(generate_series(1, len(l))) AS i FROM ({_KINDS_SQL}))),
nested AS (SELECT source_file, i AS no, s[i].title AS title, s[i].text AS text FROM (SELECT source_file, body_sections AS s, unnest(generate_series(1, len(body_sections))) AS i FROM literature_article WHERE body_sections IS NOT NULL)),
pieces AS (SELECT source_file, no, 0 AS i, 'title' AS kind, title AS text FROM nested WHERE trim(coalesce(title, '')) <> ''
  UNION ALL SELECT source_file, no, i, 'p', trim(l[i], {_BLANKS}) FROM (SELECT source_file, no, l, unnest(generate_series(1, len(l))) AS i FROM (SELECT source_file, no, regexp_split_to_array(coalesce(text, ''), '\\r?\\n\\s*\\r?\\n') AS l FROM nested)) WHERE trim(l[i], {_BLANKS}) <> '')
SELECT source_file, CAST(no AS INTEGER) AS section_no, CAST(row_number() OVER (PARTITION BY source_file, no ORDER BY k, i) AS INTEGER) AS part_no, kind, text FROM parts WHERE text IS NOT NULL
UNION ALL SELECT source_file, CAST(no AS INTEGER), CAST(row_number() OVER (PARTITION BY source_file, no ORDER BY i) AS INTEGER), kind, text FROM pieces"""

_FRONT = "SELECT source_file, record::JSON AS r, json_extract(record::JSON, '$.article.front') AS f FROM literature_raw WHERE json_valid(record) AND json_type(record::JSON) = 'OBJECT'"


def _id_sql(kind: str) -> str:
    return f"list_filter(list_transform({_entries("json_extract(f, '$.ids')")}, lambda x: CASE WHEN x ->> '$.type' = '{kind}' THEN x ->> '$.value' END), lambda x: x IS NOT NULL)[-1]"


_WHO = "coalesce(nullif(concat_ws(' ', x ->> '$.name.surname', x ->> '$.name.given'), ''), x ->> '$.collab')"
_P2_ARTICLES_SQL = f"""SELECT source_file, pmid, pmcid, doi, title, CAST(publication_year AS VARCHAR) AS year, array_to_string(authors, '; ') AS authors, license, CAST(NULL AS INTEGER) AS n_refs FROM literature_article
UNION ALL SELECT source_file, {_id_sql("pmid")}, coalesce(nullif({_id_sql("pmc")}, ''), {_id_sql("pmcid")}), {_id_sql("doi")}, f ->> '$.title',
  nullif(list_filter(list_transform({_entries("json_extract(f, '$.dates')")}, lambda x: x ->> '$.year'), lambda x: x <> '')[1], ''),
  nullif(array_to_string(list_filter(list_transform({_entries("json_extract(f, '$.contribs')")}, lambda x: {_WHO}), lambda x: x <> ''), '; '), ''),
  CASE WHEN json_type(f, '$.license') = 'OBJECT' THEN f ->> '$.license.type' ELSE f ->> '$.license' END,
  CAST(len({_entries("json_extract(r, '$.article.back.refs')")}) AS INTEGER) FROM ({_FRONT})"""

_P2_FAILED_SQL = """SELECT source_file, CASE WHEN trim(coalesce(record, '')) = '' THEN 'missing' WHEN NOT json_valid(record) THEN 'invalid' ELSE 'no object' END AS reason FROM literature_raw
WHERE trim(coalesce(record, '')) = '' OR NOT json_valid(record) OR json_type(CASE WHEN json_valid(record) THEN record ELSE '0' END::JSON) <> 'OBJECT'"""


def _first_number(c: str) -> str:
    return f"ltrim(nullif(regexp_extract({c}, '[0-9]+'), ''), '0')"


_P2_CLAIMS_SQL = f"""{_TREE},
there AS (SELECT n, bool_or(b) AS actual FROM (
  SELECT {_first_number("pmcid")} AS n, len(list_filter(coalesce(body_sections, []), lambda s: trim(coalesce(s.text, ''), {_BLANKS}) <> '')) > 0 AS b FROM literature_article
  UNION ALL SELECT {_first_number("pmcid")}, source_file IN (SELECT source_file FROM numbered) FROM (SELECT source_file, coalesce(nullif({_id_sql("pmc")}, ''), {_id_sql("pmcid")}) AS pmcid FROM ({_FRONT}))) WHERE n IS NOT NULL GROUP BY 1),
a AS (SELECT record_id, coalesce({_first_number("pmcid_xml")}, {_first_number("pmcid_requested")}) AS n,
  CASE WHEN lower(trim(has_body, {_BLANKS})) IN ('true', 't', 'yes', 'y', '1') THEN true WHEN lower(trim(has_body, {_BLANKS})) IN ('false', 'f', 'no', 'n', '0') THEN false END AS claimed FROM acquire_pmc_fulltext)
SELECT record_id, claimed, actual, CASE WHEN actual IS NULL THEN 'unknown' WHEN claimed IS NULL THEN 'unclaimed' WHEN claimed = actual THEN 'agrees' ELSE 'contradicts' END AS verdict FROM a LEFT JOIN there USING (n)"""


def _number(c: str) -> str:
    return f"ltrim(nullif(regexp_extract({c}, '[0-9]+'), ''), '0')"


def _reference_sql(table: str, field: str, at: str, target: str, target_field: str, begin: str, end: str) -> str:
    return f"""SELECT '{table}' AS ref_table, '{field}' AS ref_field, r.record_id, any_value(r.happened) AS happened, CASE WHEN count(t.n) = 0 THEN 'missing' WHEN min(t.b) > any_value(r.happened) THEN 'late' ELSE 'deleted' END AS reason
    FROM (SELECT record_id, {at} AS happened, {_number(field)} AS n FROM {table}) r LEFT JOIN (SELECT {_number(target_field)} AS n, {begin} AS b, {end} AS e FROM {target}) t ON t.n = r.n
    WHERE r.n IS NOT NULL AND r.happened IS NOT NULL GROUP BY r.record_id HAVING count(CASE WHEN t.b <= r.happened AND (t.e IS NULL OR t.e > r.happened) THEN 1 END) = 0"""


_P3_SQL = " UNION ALL ".join(
    [
        _reference_sql("pubmed_fulltext_manifest", "pmcid", "created_at", "pubmed_complete_metadata", "pmcid", "ingested_at", "withdrawn_at"),
        _reference_sql("pubmed_selection_audit", "pmid", "selected_at", "pubmed_complete_metadata", "pmid", "ingested_at", "withdrawn_at"),
        _reference_sql("pubmed_selection_audit", "disease_id", "selected_at", "disease_manifest", "disease_id", "added_at", "retired_at"),
    ]
)


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _p1_sql(),
        "p1_value_counts": f"SELECT field, value, count(DISTINCT record_id) AS n_records, count(*) AS n_values FROM ({_p1_sql()}) GROUP BY 1, 2",
        "p2_found": _P2_SQL,
        "p2_parts": _P2_PARTS_SQL,
        "p2_articles": _P2_ARTICLES_SQL,
        "p2_failed": _P2_FAILED_SQL,
        "p2_body_claims": _P2_CLAIMS_SQL,
        "p3_found": f"SELECT ref_table, ref_field, record_id, reason FROM ({_P3_SQL})",
        "p3_by_month": f"SELECT ref_table, ref_field, strftime(happened AT TIME ZONE 'UTC', '%Y-%m') AS month, reason, count(*) AS n FROM ({_P3_SQL}) GROUP BY ALL",
    }
