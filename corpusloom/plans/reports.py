"""Composite reports as rows (part, key, value); every part is one aggregate, rendered as text by the report sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import first_bigint, has_value, split_set, text_or_empty
from ..operators import aggregates as A
from ..operators import chunking as C
from .relational import FIELDS, LENGTHS
from . import documents  # noqa: F401 - its SQL is part of the reports
from .registry import SQL, Tables, query, s_number, s_set, s_text


def part(name: str, df: DataFrame, key: Column | str, value: Column | str) -> DataFrame:
    k, v = (F.col(x) if isinstance(x, str) else x for x in (key, value))
    return df.select(F.lit(name).alias("part"), k.cast("string").alias("key"), F.round(v.cast("double"), 6).alias("value"))


def wide(name: str, row: DataFrame) -> DataFrame:
    """A one-row aggregate as rows."""
    e = F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in row.columns])).alias("e")
    return part(name, row.select(e), "e.k", "e.v")


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _sql(*parts: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS part, CAST({k} AS VARCHAR) AS key, round(CAST({v} AS DOUBLE), 6) AS value FROM ({q})" for n, k, v, q in parts)


def _wide_sql(name: str, columns: list[str], q: str) -> str:
    return _sql(*[(name, f"'{c}'", f'"{c}"', q) for c in columns])


@query(
    _sql(
        ("completeness", "field", "share", SQL["completeness"]), ("years", "bucket", "n", SQL["year_buckets"]), ("languages", "language", "n", SQL["count_by_key"]),
        ("types", "value", "n", SQL["count_packed_sets"]), ("diseases per record", "n_diseases", "n", SQL["association_counts"]),
    )
    + " UNION ALL " + _wide_sql("access", ["only_a", "only_b", "both", "neither"], SQL["access_quadrants"])
)
def report_metadata_quality(t: Tables) -> DataFrame:
    m = t.pubmed_complete_metadata
    y = dates.year_bucket(dates.publication_year("publication_year", "publication_date"))
    k = F.size(split_set("disease_ids"))
    return union(
        [
            part("completeness", A.completeness(m, FIELDS), "field", "share"),
            part("years", m.groupBy(y.alias("k")).count(), "k", "count"),
            part("languages", A.count_by(m, "language"), "language", "n"),
            part("types", A.count_packed(m, "publication_types"), "value", "n"),
            part("diseases per record", m.groupBy(F.when(k >= 3, "3+").otherwise(k.cast("string")).alias("k")).count(), "k", "count"),
            wide("access", A.quadrants(m, "pmcid", "doi")),
        ]
    )


_TOP = "SELECT disease_name, n FROM (SELECT disease_name, count(*) AS n FROM pubmed_selection_audit WHERE {t} <> '' GROUP BY 1) ORDER BY n DESC, disease_name LIMIT 20".format(t=s_text("disease_name"))
_PER = f"SELECT count(*) AS n_chars FROM pubmed_selection_audit WHERE {s_number('disease_id')} IS NOT NULL GROUP BY {s_number('disease_id')}"
_STATS = "SELECT count(n_chars) AS n, min(n_chars) AS least, max(n_chars) AS greatest, avg(n_chars) AS mean, median(n_chars) AS median, quantile_cont(n_chars, 0.9) AS p90 FROM ({q})"


@query(
    _wide_sql("candidates per disease", ["n", "least", "greatest", "mean", "median", "p90"], _STATS.format(q=_PER))
    + " UNION ALL " + _sql(("most selected", "disease_name", "n", _TOP), ("without selection", "'n'", "n", f"SELECT count(*) AS n FROM ({SQL['anti_join_gaps']})"))
    + " UNION ALL " + _wide_sql("skew", ["top_decile_share", "max_to_median"], SQL["skew_metric"])
)
def report_candidates(t: Tables) -> DataFrame:
    a = t.pubmed_selection_audit
    per = a.select(first_bigint("disease_id").alias("id")).where("id is not null").groupBy("id").agg(F.count("*").alias("n_chars"))
    named = a.where(has_value("disease_name")).groupBy("disease_name").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "disease_name").limit(20)
    gaps = t.disease_manifest.select(first_bigint("disease_id").alias("id")).join(per, "id", "left_anti").agg(F.count("*").alias("n"))
    return union(
        [
            wide("candidates per disease", A.describe(per, "n_chars", (0.9,))),
            part("most selected", named, "disease_name", "n"),
            part("without selection", gaps, F.lit("n"), "n"),
            wide("skew", A.skew(per, "n_chars", "id").drop("heavy")),
        ]
    )


_LEN = "SELECT length(text) AS n_chars FROM literature_chunk WHERE text IS NOT NULL"


@query(
    _wide_sql("length", ["n", "least", "greatest", "mean", "median", "p90"], _STATS.format(q=_LEN))
    + " UNION ALL " + _sql(("buckets", "bucket", "n", SQL["length_buckets"]), ("categories", "category", "n", "SELECT category, count(*) AS n FROM literature_chunk GROUP BY 1"))
    + " UNION ALL " + _wide_sql("articles", ["n"], f"SELECT count(DISTINCT {s_number('pmid')}) AS n FROM literature_chunk")
)
def report_chunk_corpus(t: Tables) -> DataFrame:
    c = t.literature_chunk
    return union(
        [
            wide("length", A.describe(c.select(F.length("text").alias("n_chars")), "n_chars", (0.9,))),
            part("buckets", A.count_buckets(c, F.length("text"), LENGTHS), "bucket", "n"),
            part("categories", c.groupBy("category").count(), "category", "count"),
            wide("articles", c.agg(F.count_distinct(first_bigint("pmid")).alias("n"))),
        ]
    )


_TOKENS = "len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f\\v]+'))"


@query(
    _sql(
        ("windows per chunk", "embedding_window_count", "n", "SELECT embedding_window_count, count(*) AS n FROM literature_embedding_window GROUP BY 1"),
        ("tokens", "b", "n", f"SELECT CASE WHEN k <= 50 THEN '<=50' WHEN k <= 98 THEN '51-98' ELSE '>98' END AS b, count(*) AS n FROM (SELECT {_TOKENS} AS k FROM literature_embedding_window) GROUP BY 1"),
    )
    + " UNION ALL " + _wide_sql("storage", ["n", "bytes", "mib"], SQL["storage_estimate"])
)
def report_window_corpus(t: Tables) -> DataFrame:
    w = t.literature_embedding_window
    k = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+"))
    bucket = F.when(k <= 50, "<=50").when(k <= 98, "51-98").otherwise(">98")
    return union(
        [
            part("windows per chunk", w.groupBy("embedding_window_count").count(), "embedding_window_count", "count"),
            part("tokens", w.groupBy(bucket.alias("b")).count(), "b", "count"),
            wide("storage", A.storage(w)),
        ]
    )


@query(
    _sql(
        ("sections", "category", "n", "SELECT category, CAST(sum(n) AS BIGINT) AS n FROM (" + SQL["section_metrics"] + ") GROUP BY 1"),
        ("repeated paths", "'n'", "n", f"SELECT CAST(coalesce(sum(extra), 0) AS BIGINT) AS n FROM ({SQL['duplicate_section_paths']})"),
    )
)
def report_articles(t: Tables) -> DataFrame:
    from .documents import section_metrics
    from .relational import duplicate_section_paths

    per = section_metrics(t).groupBy("category").agg(F.sum("n").alias("n"))
    return union([part("sections", per, "category", "n"), part("repeated paths", duplicate_section_paths(t).agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n")), F.lit("n"), "n")])


@query(
    f"""SELECT source_file, CAST(sum(greatest(1, 1 + CAST(ceil((length(s.text) - 1000) / 850.0) AS BIGINT))) AS BIGINT) AS expected, count(*) AS sections FROM (SELECT source_file, unnest(list_concat(coalesce(abstract_sections, []), coalesce(body_sections, []))) AS s
    FROM literature_article) WHERE {s_text("s.text")} <> '' AND NOT contains(s.text, chr(10)) AND length(trim(s.text, E' \\t\\n\\r')) = length(s.text) GROUP BY 1"""
)
def chunk_count_check(t: Tables) -> DataFrame:
    """Chunks of the one-paragraph sections of each article, counted from the chunks themselves."""
    kind = t.literature_article.schema["body_sections"].dataType
    a = t.literature_article.select("source_file", *[F.filter(F.coalesce(F.col(c), F.array().cast(kind)), lambda s: ~F.contains(s["text"], F.lit("\n")) & (F.btrim(s["text"], F.lit(" \t\n\r")) == s["text"])).alias(c) for c in ("abstract_sections", "body_sections")])
    c = C.section_chunks(a, ["source_file"], 1000, 150)
    return c.groupBy("source_file").agg(F.count("*").alias("expected"), F.count_distinct("section_no").alias("sections"))


_SET = s_set("mesh_terms")


@query(f"SELECT len({_SET}) AS n_terms, count(*) AS n, count(CASE WHEN {s_text('abstract')} <> '' THEN 1 END) AS with_abstract FROM pubmed_complete_metadata GROUP BY 1")
def terms_per_record(t: Tables) -> DataFrame:
    k = F.size(split_set("mesh_terms")).cast("bigint")
    return t.pubmed_complete_metadata.groupBy(k.alias("n_terms")).agg(F.count("*").alias("n"), F.count(F.when(text_or_empty("abstract") != "", 1)).alias("with_abstract"))
