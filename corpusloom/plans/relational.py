"""Queries of the relational operators over the curation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.text import first_bigint, has_value, split_set, text_or_empty
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import ranking as R
from ..sources import connectors
from .registry import Tables, query, s_list, s_number, s_set, s_text, s_year

FIELDS = ["pmid", "pmcid", "doi", "title", "abstract", "journal", "publication_year", "mesh_terms", "authors"]
CATEGORIES = ["diagnosis", "symptoms", "clinical_presentation"]

# --- joins ------------------------------------------------------------------------------------------------------------


def _names(t: Tables) -> DataFrame:
    return t.disease_manifest.select(first_bigint("disease_id").alias("id"), "disease_name")


_NAMES = f"(SELECT {s_number('disease_id')} AS id, disease_name FROM disease_manifest)"
_LINK = f"(SELECT record_id, {s_number('x')} AS disease FROM (SELECT record_id, unnest({s_set('disease_ids')}) AS x FROM pubmed_complete_metadata)) "


@query(
    f"""SELECT a.record_id, coalesce(d.disease_name, 'UNKNOWN_DISEASE_' || a.id) AS disease
    FROM (SELECT record_id, {s_number("disease_id")} AS id FROM pubmed_selection_audit) a LEFT JOIN {_NAMES} d ON a.id = d.id WHERE a.id IS NOT NULL"""
)
def lookup_join_default(t: Tables) -> DataFrame:
    a = t.pubmed_selection_audit.select("record_id", first_bigint("disease_id").alias("id")).where("id is not null")
    j = J.lookup(a, _names(t), "id", "id", "disease_name", "disease", F.concat(F.lit("UNKNOWN_DISEASE_"), F.col("id").cast("string")))
    return j.select("record_id", "disease")


@query(f"SELECT l.record_id, l.disease, d.disease_name FROM {_LINK} l JOIN {_NAMES} d ON l.disease = d.id GROUP BY ALL")
def bridge_explode_join(t: Tables) -> DataFrame:
    b = J.bridge(t.pubmed_complete_metadata, ["record_id"], "disease_ids", "x").select("record_id", first_bigint("x").alias("disease")).distinct()
    return b.join(_names(t), b.disease == F.col("id")).select("record_id", "disease", "disease_name")


@query(
    f"""SELECT d.id, count(l.record_id) AS n_records, count(CASE WHEN {s_text("m.abstract")} <> '' THEN 1 END) AS with_abstract
    FROM {_NAMES} d LEFT JOIN (SELECT DISTINCT * FROM {_LINK}) l ON l.disease = d.id LEFT JOIN pubmed_complete_metadata m ON m.record_id = l.record_id GROUP BY d.id"""
)
def zero_filled_groups(t: Tables) -> DataFrame:
    m = t.pubmed_complete_metadata.select("record_id", "disease_ids", has_value("abstract").alias("a"))
    b = J.bridge(m, ["record_id", "a"], "disease_ids", "x").select("record_id", "a", first_bigint("x").alias("id")).distinct()
    counts = b.groupBy("id").agg(F.count("*").alias("n_records"), F.count(F.when(F.col("a"), 1)).alias("with_abstract"))
    return J.zero_filled(_names(t).select("id"), "id", counts, ["n_records", "with_abstract"])


@query(f"SELECT d.id FROM {_NAMES} d WHERE d.id NOT IN (SELECT {s_number('disease_id')} FROM pubmed_selection_audit WHERE {s_number('disease_id')} IS NOT NULL)")
def anti_join_gaps(t: Tables) -> DataFrame:
    used = t.pubmed_selection_audit.select(first_bigint("disease_id").alias("id"))
    return J.gaps(_names(t).select("id"), "id", used)


@query(
    f"""SELECT DISTINCT {s_number("pmid")} AS id FROM pubmed_selection_audit WHERE {s_number("pmid")} IS NOT NULL
    AND {s_number("pmid")} NOT IN (SELECT {s_number("pmid")} FROM pubmed_complete_metadata WHERE {s_number("pmid")} IS NOT NULL)"""
)
def outstanding_ids(t: Tables) -> DataFrame:
    wanted = t.pubmed_selection_audit.select(first_bigint("pmid").alias("id"))
    return connectors.outstanding(wanted, t.pubmed_complete_metadata.select(first_bigint("pmid").alias("id")))


@query(
    f"""SELECT record_id FROM pubmed_complete_metadata WHERE {s_number("pmid")} IN (SELECT {s_number("pmid")} FROM pubmed_selection_audit)"""
)
def semi_join_targets(t: Tables) -> DataFrame:
    m = t.pubmed_complete_metadata.select("record_id", first_bigint("pmid").alias("id"))
    return m.join(t.pubmed_selection_audit.select(first_bigint("pmid").alias("id")), "id", "left_semi").select("record_id")


_FIRST = f"(SELECT {s_number('pmid')} AS id, min_by(journal, record_id) AS journal, min_by(language, record_id) AS language FROM pubmed_complete_metadata WHERE {s_number('pmid')} IS NOT NULL GROUP BY 1)"


@query(f"SELECT f.record_id, m.journal, m.language FROM pubmed_fulltext_manifest f JOIN {_FIRST} m ON m.id = {s_number('f.pmid')}")
def attach_facts(t: Tables) -> DataFrame:
    m = A.keep_first(t.pubmed_complete_metadata.select(first_bigint("pmid").alias("id"), "journal", "language", "record_id").where("id is not null"), ["id"], "record_id")
    f = t.pubmed_fulltext_manifest.select("record_id", first_bigint("pmid").alias("id"))
    return J.attach_all(f.join(m, "id", "left_semi"), m, "id", ["journal", "language"]).select("record_id", "journal", "language")


@query(
    """SELECT record_id, CASE WHEN record_id % 7 = 0 THEN 'changed' ELSE title END AS title, CASE WHEN record_id % 7 = 0 THEN NULL ELSE journal END AS journal FROM pubmed_complete_metadata"""
)
def replace_by_key(t: Tables) -> DataFrame:
    base = t.pubmed_complete_metadata.select("record_id", "title", "journal")
    patch = base.where("record_id % 7 = 0").select("record_id", F.lit("changed").alias("title"), F.lit(None).cast("string").alias("journal"))
    return J.replace_by_key(base, patch, "record_id")


_PAIR = f"(SELECT {s_number('pmid')} AS id, min_by(struct_pack(title := {s_text('title')}, journal := {s_text('journal')}, language := {s_text('language')}), record_id) AS m FROM TABLE_NAME WHERE {s_number('pmid')} IS NOT NULL GROUP BY 1)"


@query(
    f"""WITH f AS {_PAIR.replace("TABLE_NAME", "pubmed_fulltext_manifest")}, m AS {_PAIR.replace("TABLE_NAME", "pubmed_complete_metadata")},
    j AS (SELECT f.m AS a, m.m AS b, m.id IS NOT NULL AS hit FROM f LEFT JOIN m ON f.id = m.id)
    SELECT 'title' AS field, count(CASE WHEN hit AND a.title <> b.title THEN 1 END) AS n FROM j UNION ALL SELECT 'journal', count(CASE WHEN hit AND a.journal <> b.journal THEN 1 END) FROM j
    UNION ALL SELECT 'language', count(CASE WHEN hit AND a.language <> b.language THEN 1 END) FROM j UNION ALL SELECT 'missing', count(CASE WHEN NOT hit THEN 1 END) FROM j"""
)
def cell_mismatches(t: Tables) -> DataFrame:
    cols = ["title", "journal", "language"]
    sides = [A.keep_first(d.select(first_bigint("pmid").alias("id"), *cols, "record_id").where("id is not null"), ["id"], "record_id") for d in (t.pubmed_fulltext_manifest, t.pubmed_complete_metadata)]
    return J.mismatches(*sides, "id", cols)


@query(
    f"""SELECT (rk - 1) * 3 + p AS query_id, disease_id, category FROM
    (SELECT disease_id, row_number() OVER (ORDER BY {s_number("disease_id")}) AS rk FROM disease_manifest),
    (VALUES (1, 'diagnosis'), (2, 'symptoms'), (3, 'clinical_presentation')) c(p, category)"""
)
def cross_categories(t: Tables) -> DataFrame:
    d = t.disease_manifest.select("disease_id", first_bigint("disease_id").alias("o"))
    return J.cross_categories(d, CATEGORIES, "o").select(F.col("query_id").cast("bigint").alias("query_id"), "disease_id", "category")


@query(
    f"""SELECT a.record_id, d.disease_id AS by_name FROM pubmed_selection_audit a LEFT JOIN (SELECT lower({s_text("disease_name")}) AS n, min(disease_id) AS disease_id FROM disease_manifest GROUP BY 1) d
    ON lower(regexp_replace({s_text("a.disease_name")}, '\\s+', ' ', 'g')) = d.n"""
)
def normal_name_join(t: Tables) -> DataFrame:
    j = J.by_normal_name(t.pubmed_selection_audit.select("record_id", "disease_name"), "disease_name", t.disease_manifest.select(F.col("disease_name").alias("n"), F.col("disease_id").alias("by_name")), "n", "by_name")
    return j.select("record_id", "by_name")


@query(
    f"""SELECT {s_text("pmcid")} AS pmcid, array_to_string(coalesce(list_sort(list_distinct(list({s_text("pmid")}) FILTER (WHERE {s_text("pmid")} <> ''))), []), ' ') AS pmids
    FROM pubmed_fulltext_manifest WHERE {s_text("pmcid")} <> '' GROUP BY 1"""
)
def multimap_ids(t: Tables) -> DataFrame:
    return J.multimap(t.pubmed_fulltext_manifest, "pmcid", "pmid").select("pmcid", F.array_join("values", " ").alias("pmids"))


# --- aggregates -------------------------------------------------------------------------------------------------------


@query(f"SELECT CASE WHEN {s_text('language')} = '' THEN '(empty)' ELSE {s_text('language')} END AS language, count(*) AS n FROM pubmed_complete_metadata GROUP BY 1")
def count_by_key(t: Tables) -> DataFrame:
    return A.count_by(t.pubmed_complete_metadata, "language")


@query(f"SELECT v AS value, count(*) AS n FROM (SELECT record_id, unnest({s_set('publication_types')}) AS v FROM pubmed_complete_metadata) GROUP BY 1")
def count_packed_sets(t: Tables) -> DataFrame:
    return A.count_packed(t.pubmed_complete_metadata, "publication_types")


@query(f"SELECT v AS value, count(*) AS n FROM (SELECT record_id, unnest({s_list('mesh_terms')}) AS v FROM pubmed_complete_metadata) GROUP BY 1")
def count_packed_lists(t: Tables) -> DataFrame:
    return A.count_packed(t.pubmed_complete_metadata, "mesh_terms", distinct=False)


_FILLED = " UNION ALL ".join(f"SELECT '{f}' AS field, count(CASE WHEN {s_text(f)} <> '' THEN 1 END) AS filled, count(*) AS total FROM pubmed_complete_metadata" for f in FIELDS)


@query(
    f"""WITH e AS ({_FILLED}) SELECT field, filled, total, CASE WHEN total > 0 THEN round(filled / total, 6) ELSE 0.0 END AS share FROM
    (SELECT * FROM e UNION ALL SELECT '(all)', CAST(sum(filled) AS BIGINT), CAST(sum(total) AS BIGINT) FROM e)"""
)
def completeness(t: Tables) -> DataFrame:
    return A.completeness(t.pubmed_complete_metadata, FIELDS)


@query(
    f"""SELECT count(CASE WHEN p AND NOT d THEN 1 END) AS only_a, count(CASE WHEN d AND NOT p THEN 1 END) AS only_b, count(CASE WHEN p AND d THEN 1 END) AS both, count(CASE WHEN NOT p AND NOT d THEN 1 END) AS neither
    FROM (SELECT {s_text("pmcid")} <> '' AS p, {s_text("doi")} <> '' AS d FROM pubmed_complete_metadata)"""
)
def access_quadrants(t: Tables) -> DataFrame:
    return A.quadrants(t.pubmed_complete_metadata, "pmcid", "doi")


@query(
    f"""SELECT CASE WHEN c = '' THEN '(none)' ELSE c END AS combo, count(*) AS n FROM (SELECT array_to_string(list_sort({s_set("publication_types")}), ' + ') AS c FROM pubmed_complete_metadata) GROUP BY 1"""
)
def type_combinations(t: Tables) -> DataFrame:
    return A.combinations(t.pubmed_complete_metadata, "publication_types")


@query(
    f"""SELECT CASE WHEN c = '' THEN '(none)' ELSE c END AS combo, count(*) AS n FROM (SELECT array_to_string(list_filter(['diagnosis', 'symptoms', 'clinical_presentation'],
    lambda c: list_contains({s_list("lower(query_categories)")}, c)), ' + ') AS c FROM pubmed_complete_metadata) GROUP BY 1"""
)
def category_combinations(t: Tables) -> DataFrame:
    return A.combinations(t.pubmed_complete_metadata, "query_categories", CATEGORIES)


@query(
    f"""WITH p AS (SELECT pmid, count(*) AS n FROM pubmed_complete_metadata WHERE {s_text("pmid")} <> '' GROUP BY 1)
    SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total, count(*) AS distinct_values, count(CASE WHEN n > 1 THEN 1 END) AS repeated_values, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows,
    (SELECT count(*) FROM pubmed_complete_metadata WHERE {s_text("pmid")} = '') AS blank FROM p"""
)
def duplicate_counts(t: Tables) -> DataFrame:
    return A.duplicates(t.pubmed_complete_metadata, "pmid")


@query(
    f"""SELECT language, array_to_string(list_sort(list(DISTINCT v)), '|') AS "values" FROM (SELECT language, unnest({s_set("query_categories")}) AS v FROM pubmed_complete_metadata) GROUP BY 1"""
)
def set_union(t: Tables) -> DataFrame:
    return A.union_of_sets(t.pubmed_complete_metadata, "language", "query_categories")


@query(
    f"""SELECT {s_number("pmid")} AS id, array_to_string(list_sort(list_distinct(list(disease_id) FILTER (disease_id IS NOT NULL))), '|') AS disease_id,
    array_to_string(list_sort(list_distinct(list(selection_run) FILTER (selection_run IS NOT NULL))), '|') AS selection_run, min({s_number("selection_rank")}) AS rank,
    array_to_string(list_transform(list_sort(list(struct_pack(s := record_id, v := record_id::VARCHAR))), lambda x: x.v), '|') AS records FROM pubmed_selection_audit GROUP BY 1"""
)
def provenance_aggregate(t: Tables) -> DataFrame:
    a = t.pubmed_selection_audit.select(first_bigint("pmid").alias("id"), "disease_id", "selection_run", first_bigint("selection_rank").alias("rank"), "record_id")
    return A.provenance(a, "id", ["disease_id", "selection_run"], "rank", {"record_id": "records"}, "record_id")


_MERGED = "array_to_string(list_filter(l_{c}, lambda x, i: list_position(l_{c}, x) = i), '{s}') AS {c}"


@query(
    f"""WITH m AS (SELECT {s_number("pmid")} AS id, flatten(list({s_list("disease_ids")} ORDER BY record_id)) AS l_disease_ids, flatten(list({s_list("queries", "||")} ORDER BY record_id)) AS l_queries,
    min(CASE WHEN regexp_full_match(trim(best_rank), '[0-9]+') THEN TRY_CAST(trim(best_rank) AS BIGINT) END) AS best_rank FROM pubmed_complete_metadata GROUP BY 1)
    SELECT id, {_MERGED.format(c="disease_ids", s="|")}, {_MERGED.format(c="queries", s="||")}, best_rank FROM m"""
)
def provenance_merge(t: Tables) -> DataFrame:
    m = t.pubmed_complete_metadata.select(first_bigint("pmid").alias("id"), "disease_ids", "queries", "best_rank", "record_id")
    return A.merge_packed(m, "id", {"disease_ids": "|", "queries": "||"}, "record_id", "best_rank")


@query("SELECT count(*) AS n_rows, min(record_id) AS least, CAST(sum(record_id) AS BIGINT) AS check_sum FROM (SELECT min(record_id) AS record_id FROM pubmed_selection_audit GROUP BY disease_id, pmid, selection_run)")
def keep_first_dedupe(t: Tables) -> DataFrame:
    k = A.keep_first(t.pubmed_selection_audit.select("disease_id", "pmid", "selection_run", "record_id", "selection_rank"), ["disease_id", "pmid", "selection_run"], "record_id")
    return k.agg(F.count("*").alias("n_rows"), F.min("record_id").alias("least"), F.sum("record_id").alias("check_sum"))


@query(f"SELECT source, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_pairs FROM (SELECT source, text, count(*) AS n FROM documents WHERE {s_text('text')} <> '' GROUP BY 1, 2) GROUP BY 1")
def exact_dup_counts(t: Tables) -> DataFrame:
    return A.distinct_pairs_per_label(t.documents, "text", "source")


_PCT = ", ".join(f"round(quantile_cont(n_chars, {p}), 6) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75, 0.9))


@query(f"SELECT count(n_chars) AS n, min(n_chars) AS least, max(n_chars) AS greatest, round(avg(n_chars), 6) AS mean, round(median(n_chars), 6) AS median, {_PCT} FROM documents")
def describe_lengths(t: Tables) -> DataFrame:
    return A.describe(t.documents, "n_chars")


@query("SELECT round(median(k), 6) AS median FROM (SELECT CAST(n_chars // 100 AS BIGINT) AS k FROM documents)")
def histogram_median(t: Tables) -> DataFrame:
    freq = t.documents.groupBy(F.floor(F.col("n_chars") / 100).alias("k")).agg(F.count("*").alias("n"))
    return A.histogram_median(freq, "k", "n")


@query(
    f"""WITH c AS (SELECT {s_number("disease_id")} AS id, count(*) AS n FROM pubmed_selection_audit WHERE {s_number("disease_id")} IS NOT NULL GROUP BY 1),
    r AS (SELECT n, row_number() OVER (ORDER BY n DESC, id) AS r, count(*) OVER () AS t FROM c),
    x AS (SELECT sum(CASE WHEN r <= ceil(t * 0.1) THEN n ELSE 0 END) / sum(n) AS share, max(n) / median(n) AS ratio FROM r)
    SELECT round(share, 6) AS top_decile_share, round(ratio, 6) AS max_to_median, (share > 0.25 OR ratio > 3) AS heavy FROM x"""
)
def skew_metric(t: Tables) -> DataFrame:
    c = t.pubmed_selection_audit.select(first_bigint("disease_id").alias("id")).where("id is not null").groupBy("id").agg(F.count("*").alias("n"))
    return A.skew(c, "n", "id")


@query(
    f"""SELECT CASE WHEN k >= 3 THEN '3+' ELSE k::VARCHAR END AS n_diseases, count(*) AS n FROM (SELECT len({s_set("disease_ids")}) AS k FROM pubmed_complete_metadata) GROUP BY 1"""
)
def association_counts(t: Tables) -> DataFrame:
    k = F.size(split_set("disease_ids"))
    return t.pubmed_complete_metadata.groupBy(F.when(k >= 3, "3+").otherwise(k.cast("string")).alias("n_diseases")).agg(F.count("*").alias("n"))


CAPS = [3, 5, 8, 10]


@query(
    f"""SELECT c.cap, count(*) AS assignments, count(DISTINCT a.pmid) AS articles, count(DISTINCT a.disease) AS diseases FROM
    (SELECT {s_number("pmid")} AS pmid, {s_number("disease_id")} AS disease, {s_number("selection_rank")} AS rank FROM pubmed_selection_audit) a, (VALUES (3), (5), (8), (10)) c(cap)
    WHERE a.rank <= c.cap GROUP BY 1"""
)
def cap_summary(t: Tables) -> DataFrame:
    a = t.pubmed_selection_audit.select(first_bigint("pmid").alias("pmid"), first_bigint("disease_id").alias("disease"), first_bigint("selection_rank").alias("rank")).where(F.col("rank") <= max(CAPS))
    caps = F.explode(F.filter(F.array(*[F.lit(c) for c in CAPS]), lambda c: c >= F.col("rank"))).alias("cap")
    return a.select("*", caps).groupBy("cap").agg(F.count("*").alias("assignments"), F.count_distinct("pmid").alias("articles"), F.count_distinct("disease").alias("diseases"))


@query(
    """SELECT source_file, CAST(sum(n - 1) AS BIGINT) AS extra FROM (SELECT source_file, s.section_path AS p, count(*) AS n FROM (SELECT source_file, unnest(body_sections) AS s FROM literature_article) GROUP BY 1, 2) GROUP BY 1"""
)
def duplicate_section_paths(t: Tables) -> DataFrame:
    s = t.literature_article.select("source_file", F.explode("body_sections.section_path").alias("p"))
    return A.duplicate_paths(s, "source_file", "p")


LENGTHS = [("<=200", None, 200), ("201-500", 201, 500), ("501-999", 501, 999), ("=1000", 1000, 1000), (">1000", 1001, None)]


@query(
    """WITH b AS (SELECT CASE WHEN length(text) <= 200 THEN '<=200' WHEN length(text) <= 500 THEN '201-500' WHEN length(text) <= 999 THEN '501-999' WHEN length(text) = 1000 THEN '=1000' ELSE '>1000' END AS bucket FROM literature_chunk),
    k AS (VALUES ('<=200'), ('201-500'), ('501-999'), ('=1000'), ('>1000')) SELECT k.col0 AS bucket, count(b.bucket) AS n, round(count(b.bucket) / (SELECT count(*) FROM b), 6) AS share FROM k LEFT JOIN b ON b.bucket = k.col0 GROUP BY 1"""
)
def length_buckets(t: Tables) -> DataFrame:
    return A.count_buckets(t.literature_chunk, F.length("text"), LENGTHS)


@query("SELECT count(*) AS n, count(*) * 768 * 4 AS bytes, round(count(*) * 768 * 4 / 1048576, 6) AS mib FROM literature_embedding_window")
def storage_estimate(t: Tables) -> DataFrame:
    return A.storage(t.literature_embedding_window)


@query(
    f"""SELECT CASE WHEN c <= 1 THEN 'low' WHEN c <= 10 THEN 'moderate' ELSE 'high' END AS coverage, count(*) AS n FROM (SELECT {s_number("unique_symptom_count")} AS c FROM disease_manifest) WHERE c IS NOT NULL GROUP BY 1"""
)
def coverage_groups(t: Tables) -> DataFrame:
    c = t.disease_manifest.select(first_bigint("unique_symptom_count").alias("c")).where("c is not null")
    return c.groupBy(A.bucket(F.col("c"), [("low", None, 1), ("moderate", 2, 10), ("high", 11, None)]).alias("coverage")).agg(F.count("*").alias("n"))


@query(
    f"""SELECT CASE WHEN y IS NULL THEN 'missing' WHEN y < 2000 THEN 'before 2000' WHEN y < 2010 THEN '2000-2009' WHEN y < 2015 THEN '2010-2014' WHEN y < 2020 THEN '2015-2019' WHEN y < 2025 THEN '2020-2024'
    WHEN y = 2025 THEN '2025' WHEN y = 2026 THEN '2026' ELSE '2027+' END AS bucket, count(*) AS n FROM (SELECT coalesce({s_year("publication_year")}, {s_year("publication_date")}) AS y FROM pubmed_complete_metadata) GROUP BY 1"""
)
def year_buckets(t: Tables) -> DataFrame:
    y = dates.publication_year("publication_year", "publication_date")
    return t.pubmed_complete_metadata.groupBy(dates.year_bucket(y).alias("bucket")).agg(F.count("*").alias("n"))


@query(
    f"""WITH m AS (SELECT list_contains({s_list("lower(language)")}, 'eng') AS a, {s_text("abstract")} <> '' AS b, len(list_filter({s_set("publication_types")}, lambda x: lower(x) IN ('news', 'comment'))) = 0 AS c FROM pubmed_complete_metadata)
    SELECT 0 AS stage, 'all' AS name, count(*) AS n FROM m UNION ALL SELECT 1, 'language', count(*) FROM m WHERE a UNION ALL SELECT 2, 'abstract', count(*) FROM m WHERE a AND b UNION ALL SELECT 3, 'type', count(*) FROM m WHERE a AND b AND c"""
)
def filter_funnel(t: Tables) -> DataFrame:
    stages = [
        ("language", text.contains_ci(split_set("language"), "eng")), ("abstract", has_value("abstract")), ("type", ~text.overlaps_ci(split_set("publication_types"), ["news", "comment"])),
    ]
    return A.funnel(t.pubmed_complete_metadata, stages)


@query(
    f"""SELECT record_id, CASE WHEN {s_text("pmcid")} <> '' THEN 'pmcid' WHEN {s_text("doi")} <> '' THEN 'doi' ELSE 'none' END AS best_id FROM pubmed_complete_metadata"""
)
def first_match_case(t: Tables) -> DataFrame:
    return t.pubmed_complete_metadata.select("record_id", text.first_match([("pmcid", has_value("pmcid")), ("doi", has_value("doi"))], "none").alias("best_id"))


@query(
    """SELECT disease_id, CASE WHEN disease_id = '17' THEN 'seventeen' ELSE regexp_replace(trim(disease_name), '\\s+', ' ', 'g') END AS term, '"' || CASE WHEN disease_id = '17' THEN 'seventeen' ELSE regexp_replace(trim(disease_name), '\\s+', ' ', 'g') END || '"[Title] AND (diagnosis[Title] OR symptoms[Title])' AS query
    FROM disease_manifest"""
)
def search_terms(t: Tables) -> DataFrame:
    name = F.when(F.col("disease_id") == "17", "17").otherwise(F.col("disease_name"))
    d = t.disease_manifest.select("disease_id", text.override(name, {"17": "seventeen"}).alias("term"))
    return d.select("disease_id", "term", text.search_query("term", "Title", ["diagnosis", "symptoms"]).alias("query"))


# --- ranks, sorts, samples --------------------------------------------------------------------------------------------


@query(
    f"""SELECT pmid, n FROM (SELECT pmid, count(*) AS n FROM pubmed_selection_audit GROUP BY 1) ORDER BY CASE WHEN regexp_full_match(pmid, '\\s*[0-9]+\\s*') THEN TRY_CAST(pmid AS BIGINT) END ASC NULLS LAST, pmid LIMIT 50"""
)
def numeric_then_text_sort(t: Tables) -> DataFrame:
    c = t.pubmed_selection_audit.groupBy("pmid").agg(F.count("*").alias("n"))
    return R.top(c, R.numeric_then_text("pmid"), 50)


@query("SELECT journal, count(*) AS n FROM pubmed_complete_metadata WHERE journal IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def top_by_count(t: Tables) -> DataFrame:
    c = t.pubmed_complete_metadata.where("journal is not null").groupBy("journal").agg(F.count("*").alias("n"))
    return R.top(c, [F.col("n").desc(), F.col("journal")], 20)


@query("SELECT journal, count(*) AS n FROM pubmed_complete_metadata WHERE journal IS NOT NULL GROUP BY 1 ORDER BY 2, 1 LIMIT 20")
def bottom_by_count(t: Tables) -> DataFrame:
    c = t.pubmed_complete_metadata.where("journal is not null").groupBy("journal").agg(F.count("*").alias("n"))
    return R.top(c, [F.col("n"), F.col("journal")], 20)


@query("SELECT section_title, n FROM (SELECT section_title, count(*) AS n, min(chunk_id) AS f FROM literature_chunk GROUP BY 1) ORDER BY n DESC, f LIMIT 15")
def most_common_titles(t: Tables) -> DataFrame:
    return R.most_common(t.literature_chunk, "section_title", "chunk_id", 15)


@query("SELECT chunk_id, category FROM literature_chunk ORDER BY md5('7:' || chunk_id), chunk_id LIMIT 500")
def hash_sample(t: Tables) -> DataFrame:
    return R.hash_sample(t.literature_chunk.select("chunk_id", "category"), "chunk_id", 500, 7)


@query(
    """WITH o AS (SELECT chunk_id, row_number() OVER (ORDER BY length(text), chunk_id) - 1 AS i, count(*) OVER () AS n FROM literature_chunk)
    SELECT chunk_id FROM o WHERE i IN (SELECT round_even(k * (n - 1) / 4, 0) FROM (VALUES (0), (1), (2), (3), (4)) v(k))"""
)
def evenly_spaced_examples(t: Tables) -> DataFrame:
    d = t.literature_chunk.select("chunk_id", F.length("text").alias("n"))
    return R.evenly_spaced(d, [F.col("n"), F.col("chunk_id")], 5).select("chunk_id")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def extremes_by_size(t: Tables) -> DataFrame:
    return R.top(t.documents.select("doc_id", "n_chars"), [F.col("n_chars").desc(), F.col("doc_id")], 20)


@query("SELECT chunk_id FROM literature_chunk ORDER BY pmcid NULLS FIRST, chunk_id LIMIT 50")
def first_in_scan_order(t: Tables) -> DataFrame:
    return R.first_of(t.literature_chunk.select("pmcid", "chunk_id"), [F.col("pmcid"), F.col("chunk_id")], 50).select("chunk_id")


@query(f"SELECT disease_id, CAST((row_number() OVER (ORDER BY {s_number('disease_id')}) - 1) // 200 AS BIGINT) AS batch FROM disease_manifest")
def fixed_batches(t: Tables) -> DataFrame:
    d = t.disease_manifest.select("disease_id", first_bigint("disease_id").alias("o"))
    return R.batch_number(d, [F.col("o")], 200).select("disease_id", "batch")


@query(
    """SELECT chunk_id, coalesce(ends_with(lag(text) OVER (PARTITION BY pmid, section_title ORDER BY chunk_id), text), false) AS redundant FROM literature_chunk"""
)
def redundant_tail(t: Tables) -> DataFrame:
    return R.redundant_tail(t.literature_chunk.select("pmid", "section_title", "chunk_id", "text"), ["pmid", "section_title"], "chunk_id", "text").select("chunk_id", "redundant")


@query(
    f"""SELECT disease, pmid FROM (SELECT disease, pmid, row_number() OVER (PARTITION BY disease ORDER BY pm DESC, y DESC NULLS LAST, pmid) AS r FROM (SELECT l.disease, {s_number("m.pmid")} AS pmid,
    {s_text("m.pmcid")} <> '' AS pm, coalesce({s_year("m.publication_year")}, {s_year("m.publication_date")}) AS y FROM (SELECT DISTINCT * FROM {_LINK}) l JOIN pubmed_complete_metadata m USING (record_id)) WHERE disease IS NOT NULL AND pmid IS NOT NULL) WHERE r = 1"""
)
def preference_winner(t: Tables) -> DataFrame:
    m = t.pubmed_complete_metadata.select(
        "disease_ids", first_bigint("pmid").alias("pmid"), has_value("pmcid").alias("pm"), dates.publication_year("publication_year", "publication_date").alias("y")
    )
    b = J.bridge(m, ["pmid", "pm", "y"], "disease_ids", "x").select(first_bigint("x").alias("disease"), "pmid", "pm", "y").where("disease is not null and pmid is not null")
    return R.winner(b, "disease", [F.col("pm").desc(), F.col("y").desc_nulls_last(), F.col("pmid")]).select("disease", "pmid")


_GREEDY = f"""m AS (SELECT {s_number("pmid")} AS pmid, {s_set("query_categories")} AS cats, coalesce({s_year("publication_year")}, {s_year("publication_date")}) AS y, array_to_string(list_sort({s_set("publication_types")}), '|') AS f, unnest({s_set("disease_ids")}) AS x FROM pubmed_complete_metadata),
    b AS (SELECT {s_number("x")} AS disease, pmid, list_distinct(flatten(list(cats))) AS cats, max(y) AS y, min(f) AS f FROM m WHERE {s_number("x")} IS NOT NULL AND pmid IS NOT NULL GROUP BY 1, 2)"""


def _greedy_candidates(t: Tables) -> DataFrame:
    m = t.pubmed_complete_metadata.select(
        "disease_ids", first_bigint("pmid").alias("pmid"), split_set("query_categories").alias("cats"), dates.publication_year("publication_year", "publication_date").alias("y"),
        F.array_join(F.array_sort(split_set("publication_types")), "|").alias("f"),
    )
    b = J.bridge(m, ["pmid", "cats", "y", "f"], "disease_ids", "x").select(first_bigint("x").alias("disease"), "pmid", "cats", "y", "f").where("disease is not null and pmid is not null")
    return b.groupBy("disease", "pmid").agg(F.array_distinct(F.flatten(F.collect_set("cats"))).alias("cats"), F.max("y").alias("y"), F.min("f").alias("f"))


@query(
    f"""WITH RECURSIVE {_GREEDY}, r AS (SELECT DISTINCT disease AS g, CAST([] AS VARCHAR[]) AS covered, CAST([] AS BIGINT[]) AS picked, 0 AS place, CAST(NULL AS BIGINT) AS item, CAST(0 AS BIGINT) AS new FROM b UNION ALL
    SELECT g, list_concat(covered, cats), list_append(picked, pmid), place + 1, pmid, new FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY new DESC, y DESC NULLS LAST, pmid) AS k FROM
    (SELECT g, covered, picked, place, b.pmid, b.cats, b.y, len(list_filter(b.cats, lambda c: NOT list_contains(covered, c))) AS new FROM r JOIN b ON b.disease = r.g WHERE place < 5 AND NOT list_contains(picked, b.pmid))) WHERE k = 1)
    SELECT g AS disease, item AS pmid, CAST(place AS INTEGER) AS place, CAST(new AS INTEGER) AS new_labels FROM r WHERE place > 0"""
)
def greedy_diverse_select(t: Tables) -> DataFrame:
    return R.greedy_diverse(_greedy_candidates(t), "disease", "pmid", "cats", [("y", True)], 5)


@query(
    f"""WITH RECURSIVE {_GREEDY}, e AS (SELECT disease, pmid, cats, y, f, unnest(cats) AS c FROM b),
    r AS (SELECT DISTINCT disease AS g, CAST([] AS VARCHAR[]) AS held, CAST([] AS BIGINT[]) AS picked, CAST([] AS VARCHAR[]) AS seen, 0 AS place, CAST(NULL AS BIGINT) AS item, CAST(NULL AS VARCHAR) AS label FROM e UNION ALL
    SELECT g, list_concat(held, cats), list_append(picked, pmid), list_append(seen, f), place + 1, pmid, c FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n, c, old, y DESC NULLS LAST, pmid) AS k FROM
    (SELECT g, held, picked, seen, place, e.pmid, e.cats, e.y, e.f, e.c, len(list_filter(held, lambda x: x = e.c)) AS n, list_contains(seen, e.f) AS old FROM r JOIN e ON e.disease = r.g WHERE place < 20 AND NOT list_contains(picked, e.pmid))) WHERE k = 1)
    SELECT cap, count(*) AS n, count(DISTINCT g) AS diseases, CAST(sum(item * place) AS BIGINT) AS check_sum FROM r, (SELECT unnest([5, 10, 15, 20]) AS cap) WHERE place > 0 AND place <= cap GROUP BY cap"""
)
def greedy_caps_simulation(t: Tables) -> DataFrame:
    """Items picked per cap; the picks of a cap are the first of those of the largest."""
    picked = R.greedy_balanced(_greedy_candidates(t), "disease", "pmid", "cats", "f", [("y", True)], 20)
    caps = picked.select("*", F.explode(F.array(*[F.lit(c) for c in (5, 10, 15, 20)])).alias("cap")).where("place <= cap")
    return caps.groupBy("cap").agg(F.count("*").alias("n"), F.count_distinct("disease").alias("diseases"), F.sum(F.col("pmid") * F.col("place")).alias("check_sum"))


# --- sets -------------------------------------------------------------------------------------------------------------

_IDS = "(SELECT DISTINCT {n} AS id FROM {t} WHERE {n} IS NOT NULL)"
_A, _M = (_IDS.format(n=s_number("pmid"), t=x) for x in ("pubmed_selection_audit", "pubmed_complete_metadata"))


@query(f"SELECT 'only_selected' AS side, count(*) AS n FROM (FROM {_A} EXCEPT FROM {_M}) UNION ALL SELECT 'only_metadata', count(*) FROM (FROM {_M} EXCEPT FROM {_A}) UNION ALL SELECT 'both', count(*) FROM (FROM {_A} INTERSECT FROM {_M})")
def set_operations(t: Tables) -> DataFrame:
    side = lambda d, n: d.select(first_bigint("pmid").alias("id")).where("id is not null").distinct().withColumn(n, F.lit(True))
    j = side(t.pubmed_selection_audit, "a").join(side(t.pubmed_complete_metadata, "m"), "id", "full")
    s = F.when(F.col("m").isNull(), "only_selected").when(F.col("a").isNull(), "only_metadata").otherwise("both")
    got = j.groupBy(s.alias("side")).agg(F.count("*").alias("n"))
    every = t.spark.createDataFrame([("only_selected",), ("only_metadata",), ("both",)], "side string")
    return every.join(got, "side", "left").na.fill(0, ["n"])


@query(
    "SELECT 'chunk' AS kind, category, count(*) AS n FROM literature_chunk GROUP BY ALL UNION ALL SELECT 'window', category, count(*) FROM literature_embedding_window GROUP BY ALL"
)
def union_all_with_origin(t: Tables) -> DataFrame:
    a, b = t.literature_chunk.select(F.lit("chunk").alias("kind"), "category"), t.literature_embedding_window.select(F.lit("window").alias("kind"), "category")
    return a.unionByName(b).groupBy("kind", "category").agg(F.count("*").alias("n"))


@query(f"SELECT record_id, array_to_string({s_set('mesh_terms')}, '|') AS terms FROM pubmed_complete_metadata")
def ordered_distinct(t: Tables) -> DataFrame:
    return t.pubmed_complete_metadata.select("record_id", text.pack(split_set("mesh_terms")).alias("terms"))


# --- integrity --------------------------------------------------------------------------------------------------------


@query(
    f"""SELECT 'rows' AS check_name, count(*) AS n FROM pubmed_selection_audit UNION ALL SELECT 'repeated ids', count(*) FROM (SELECT record_id FROM pubmed_selection_audit GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'repeated pairs', count(*) FROM (SELECT selection_run, {s_number("disease_id")} AS d, {s_number("pmid")} AS p FROM pubmed_selection_audit
    WHERE {s_number("disease_id")} IS NOT NULL AND {s_number("pmid")} IS NOT NULL GROUP BY ALL HAVING count(*) > 1) UNION ALL SELECT 'without rank', count(*) FROM pubmed_selection_audit WHERE {s_number("selection_rank")} IS NULL"""
)
def integrity_report(t: Tables) -> DataFrame:
    a = t.pubmed_selection_audit.select("selection_run", first_bigint("disease_id").alias("d"), first_bigint("pmid").alias("p"), first_bigint("selection_rank").alias("r"), "record_id")
    repeated = lambda d, *k: d.groupBy(*k).agg(F.count("*").alias("k")).where("k > 1")
    checks = {
        "rows": a, "repeated ids": repeated(a, "record_id"), "repeated pairs": repeated(a.where("d is not null and p is not null"), "selection_run", "d", "p"), "without rank": a.where("r is null"),
    }
    out = None
    for name, rows in checks.items():
        one = rows.agg(F.lit(name).alias("check_name"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    """SELECT pmid, section_title, count(*) AS n, min(chunk_index) AS first_index, max(chunk_index) + 1 = count(DISTINCT chunk_index) AND min(chunk_index) = 0 AS contiguous, bool_or(length(trim(coalesce(text, ''), E' \\t\\n\\r')) = 0) AS has_blank,
    max(length(text)) <= 1000 AS within_limit FROM literature_chunk GROUP BY ALL"""
)
def chunk_integrity(t: Tables) -> DataFrame:
    c = t.literature_chunk
    return c.groupBy("pmid", "section_title").agg(
        F.count("*").alias("n"), F.min("chunk_index").alias("first_index"), ((F.max("chunk_index") + 1 == F.count_distinct("chunk_index")) & (F.min("chunk_index") == 0)).alias("contiguous"),
        F.bool_or(text_or_empty("text") == "").alias("has_blank"), (F.max(F.length("text")) <= 1000).alias("within_limit"),
    )


@query(
    """SELECT count(*) AS n, count(CASE WHEN embedding_window_index < 0 OR embedding_window_index >= embedding_window_count THEN 1 END) AS bad_index,
    count(CASE WHEN length(trim(coalesce(text, ''), E' \\t\\n\\r')) = 0 THEN 1 END) AS blank FROM literature_embedding_window"""
)
def window_integrity(t: Tables) -> DataFrame:
    i, n = F.col("embedding_window_index"), F.col("embedding_window_count")
    return t.literature_embedding_window.agg(F.count("*").alias("n"), F.count(F.when((i < 0) | (i >= n), 1)).alias("bad_index"), F.count(F.when(text_or_empty("text") == "", 1)).alias("blank"))


@query(f"SELECT {s_number('disease_id')} AS id, count(*) AS n FROM disease_manifest GROUP BY 1 HAVING count(*) > 1 OR {s_number('disease_id')} IS NULL")
def manifest_uniqueness(t: Tables) -> DataFrame:
    return t.disease_manifest.groupBy(first_bigint("disease_id").alias("id")).agg(F.count("*").alias("n")).where("n > 1 or id is null")


