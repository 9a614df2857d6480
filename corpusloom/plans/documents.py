"""Queries of the text, chunk, window, vector and evidence operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, ids, text
from ..functions.text import first_bigint, has_value
from ..operators import aggregates as A
from ..operators import chunking as C
from ..operators import vector as V
from . import evidence
from .registry import Tables, query, s_number, s_text, s_year

# --- scalar functions -------------------------------------------------------------------------------------------------


@query(
    f"""SELECT record_id, regexp_replace({s_text("title")}, '\\s+', ' ', 'g') AS title, lower({s_text("language")}) AS language, trim(regexp_replace(lower(coalesce(record_type, '')), '[^a-z0-9]+', '_', 'g'), '_') AS token,
    CASE WHEN {s_text("pmcid")} = '' THEN '' WHEN lower({s_text("pmcid")}) LIKE 'pmc%' THEN {s_text("pmcid")} ELSE 'PMC' || {s_text("pmcid")} END AS pmcid,
    regexp_replace(lower({s_text("doi")}), '^(https?://doi[.]org/|https?://dx[.]doi[.]org/|doi:)', '') AS doi, {s_number("best_rank")} AS rank FROM pubmed_complete_metadata"""
)
def text_normalise(t: Tables) -> DataFrame:
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    return t.pubmed_complete_metadata.select(
        "record_id", text.collapse_ws(e("title")).alias("title"), F.lower(text.strip(e("language"))).alias("language"), text.type_token(e("record_type")).alias("token"),
        text.pmcid_form("pmcid").alias("pmcid"), text.doi_form(e("doi")).alias("doi"), first_bigint("best_rank").alias("rank"),
    )


@query(f"SELECT record_id, coalesce({s_year('publication_year')}, {s_year('publication_date')}) AS year, CASE WHEN {s_text('publication_year')} <> '' THEN {s_year('publication_year')} ELSE {s_year('publication_date')} END AS strict_year FROM pubmed_complete_metadata")
def year_extract(t: Tables) -> DataFrame:
    return t.pubmed_complete_metadata.select(
        "record_id", dates.publication_year("publication_year", "publication_date").alias("year"), dates.publication_year_blank_only("publication_year", "publication_date").alias("strict_year")
    )


_TITLES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in text.SECTION_CATEGORIES.items()) + "}"
_TITLE = f"lower(trim(regexp_replace(regexp_replace(regexp_replace({s_text('section_title')}, '\\s+', ' ', 'g'), '^[0-9]+(\\.[0-9]+)*[.)]?\\s+', ''), ':+$', '')))"


@query(f"SELECT title, coalesce({_TITLES}[title], 'other') AS category, count(*) AS n FROM (SELECT {_TITLE} AS title FROM literature_chunk) GROUP BY ALL")
def title_category(t: Tables) -> DataFrame:
    c = F.coalesce("section_title", F.lit(""))
    return t.literature_chunk.groupBy(text.section_title(c).alias("title"), text.section_category(c).alias("category")).agg(F.count("*").alias("n"))


@query(
    f"""SELECT disease_id, 'Diseases: ' || coalesce(disease_name, '') || E'\\nSymptoms: ' AS query, '"' || regexp_replace({s_text("disease_name")}, '\\s+', ' ', 'g') || '"' AS phrase FROM disease_manifest"""
)
def query_text(t: Tables) -> DataFrame:
    name = F.array_compact(F.array("disease_name"))
    return t.disease_manifest.select("disease_id", evidence.query_text(name, F.array().cast("array<string>")).alias("query"), text.quote_term(F.coalesce("disease_name", F.lit(""))).alias("phrase"))


@query(
    r"""SELECT disease_id, array_to_string(list_filter([CASE WHEN regexp_matches(disease_name, '[()]') THEN 'parentheses' END, CASE WHEN regexp_matches(disease_name, '\s{2,}') THEN 'double_space' END,
    CASE WHEN regexp_matches(disease_name, '[''‘’ʼ`]') THEN 'apostrophe' END, CASE WHEN regexp_matches(disease_name, '\b[A-Z]{2,}\b') THEN 'abbreviation' END, CASE WHEN length(trim(disease_name)) <= 4 THEN 'very_short' END],
    lambda x: x IS NOT NULL), ' ') AS flags FROM disease_manifest WHERE disease_name IS NOT NULL"""
)
def name_flags(t: Tables) -> DataFrame:
    return t.disease_manifest.where("disease_name is not null").select("disease_id", F.array_join(text.name_flags("disease_name"), " ").alias("flags"))


_WHITE = "trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
_VARIANTS = ", ".join(
    f"{{'kind': '{k}', 'term': {_WHITE.format(x=x)}}}"
    for k, x in (
        ("original", "n"),
        ("no_apostrophe", "regexp_replace(n, '[''‘’ʼ`]', '', 'g')"),
        ("possessive", r"regexp_replace(n, '\b([a-z]{4,}?)s?\s+(disease|syndrome|foot)\b', '\1''s \2', 'gi')"),
        ("no_punctuation", r"regexp_replace(n, '[^\p{L}\p{N}\s]+', ' ', 'g')"),
        ("no_parentheses", r"regexp_replace(n, '\([^()]*\)', ' ', 'g')"),
    )
)


@query(
    f"""WITH v AS (SELECT disease_id, [{_VARIANTS}] AS l FROM (SELECT disease_id, coalesce(disease_name, '') AS n FROM disease_manifest)),
    k AS (SELECT disease_id, list_filter(l, lambda x, i: x.term <> '' AND list_position(list_transform(l, lambda y: lower(y.term)), lower(x.term)) = i) AS l FROM v)
    SELECT disease_id, e.kind AS kind, e.term AS term FROM (SELECT disease_id, unnest(l) AS e FROM k)"""
)
def name_variants(t: Tables) -> DataFrame:
    return t.disease_manifest.select("disease_id", F.explode(text.name_variants(F.coalesce("disease_name", F.lit("")))).alias("v")).select("disease_id", "v.kind", "v.term")


@query(
    """SELECT chunk_id, CASE WHEN length(c) > 80 THEN substr(c, 1, 80) || '...' ELSE c END AS excerpt FROM (SELECT chunk_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS c FROM literature_chunk)"""
)
def excerpts(t: Tables) -> DataFrame:
    return t.literature_chunk.select("chunk_id", text.excerpt("text", 80).alias("excerpt"))


@query("SELECT chunk_id, '{\"category\":' || coalesce('\"' || category || '\"', 'null') || ',\"chunk_id\":' || chunk_id || ',\"level\":' || coalesce(level::VARCHAR, 'null') || '}' AS json, sha256('chunk-' || chunk_id) AS digest FROM literature_chunk")
def canonical_json(t: Tables) -> DataFrame:
    j = ids.canonical_json({"level": F.col("level"), "chunk_id": F.col("chunk_id"), "category": F.col("category")})
    return t.literature_chunk.select("chunk_id", j.alias("json"), ids.sha256(F.concat(F.lit("chunk-"), F.col("chunk_id").cast("string"))).alias("digest"))


_H = "sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('chunk-' || chunk_id))"


@query(
    f"""SELECT chunk_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || (['8', '9', 'a', 'b'])[('0x' || substr(h, 17, 1))::INTEGER % 4 + 1] || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id
    FROM (SELECT chunk_id, {_H} AS h FROM literature_chunk)"""
)
def uuid5_ids(t: Tables) -> DataFrame:
    return t.literature_chunk.select("chunk_id", ids.uuid5(F.concat(F.lit("chunk-"), F.col("chunk_id").cast("string"))).alias("id"))


# --- sections, chunks, windows ----------------------------------------------------------------------------------------


@query(
    f"""SELECT source_file, len(list_filter(coalesce(abstract_sections, []), lambda s: {s_text("s.text")} <> '')) > 0 AS has_abstract, len(list_filter(coalesce(body_sections, []), lambda s: {s_text("s.text")} <> '')) > 0 AS has_body,
    len(coalesce(abstract_sections, [])) + len(coalesce(body_sections, [])) AS n_sections FROM literature_article"""
)
def article_flags(t: Tables) -> DataFrame:
    some = lambda c: F.coalesce(F.exists(F.col(c), lambda s: has_value(s["text"])), F.lit(False))
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return t.literature_article.select(
        "source_file", some("abstract_sections").alias("has_abstract"), some("body_sections").alias("has_body"),
        (F.greatest(size("abstract_sections"), F.lit(0)) + F.greatest(size("body_sections"), F.lit(0))).cast("bigint").alias("n_sections"),
    )


@query(
    """SELECT s.category AS category, s.level AS level, count(*) AS n, CAST(sum(length(s.text)) AS BIGINT) AS chars FROM
    (SELECT unnest(list_concat(coalesce(abstract_sections, []), coalesce(body_sections, []))) AS s FROM literature_article) GROUP BY ALL"""
)
def section_metrics(t: Tables) -> DataFrame:
    kind = t.literature_article.schema["body_sections"].dataType
    both = F.concat(*[F.coalesce(F.col(c), F.array().cast(kind)) for c in ("abstract_sections", "body_sections")])
    s = t.literature_article.select(F.explode(both).alias("s"))
    return s.groupBy(F.col("s.category").alias("category"), F.col("s.level").alias("level")).agg(F.count("*").alias("n"), F.sum(F.length("s.text")).alias("chars"))


_CHUNKS = f"""(SELECT doc_id, CAST(s // 900 AS INTEGER) AS chunk_index, substr(text, CAST(s + 1 AS BIGINT), 1000) AS chunk_text FROM
    (SELECT doc_id, text, unnest(generate_series(0, greatest(0, CAST(ceil((length(text) - 1000) / 900.0) AS BIGINT)) * 900, 900)) AS s FROM documents WHERE {s_text("text")} <> ''))"""


@query(f"SELECT doc_id, chunk_index, md5(chunk_text) AS digest, length(chunk_text) AS n FROM {_CHUNKS}")
def chunk_fixed_overlap(t: Tables) -> DataFrame:
    c = C.fixed_chunks(t.documents, ["doc_id"], "text", 1000, 100)
    return c.select("doc_id", "chunk_index", F.md5(F.col("chunk_text").cast("binary")).alias("digest"), F.length("chunk_text").cast("bigint").alias("n"))


@query(
    f"""SELECT count(*) AS n, min(length(chunk_text)) AS least, max(length(chunk_text)) AS greatest, round(avg(length(chunk_text)), 6) AS mean, round(median(length(chunk_text)), 6) AS median,
    {", ".join(f"round(quantile_cont(length(chunk_text), {p}), 6) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75, 0.9))} FROM {_CHUNKS}"""
)
def chunk_length_stats(t: Tables) -> DataFrame:
    c = C.fixed_chunks(t.documents, ["doc_id"], "text", 1000, 100)
    return A.describe(c.select(F.length("chunk_text").cast("bigint").alias("n_chars")), "n_chars")


def _packed_sql(c: str) -> str:
    """Paragraphs of a text packed up to 1,000 characters as a list: a fold over (done, cur)."""
    cuts = "list_transform(generate_series(0, greatest(0, CAST(ceil((length(y.cur) - 1000) / 850.0) AS BIGINT)) * 850, 850), lambda s: substr(y.cur, CAST(s + 1 AS BIGINT), 1000))"
    flush = "CASE WHEN x.cur = '' THEN x.done ELSE list_concat(x.done, [x.cur]) END"
    fold = f"""lambda x, y: CASE WHEN length(y.cur) > 1000 THEN {{'done': list_concat({flush}, {cuts}), 'cur': ''}} WHEN x.cur = '' THEN {{'done': x.done, 'cur': y.cur}}
        WHEN length(x.cur) + 2 + length(y.cur) <= 1000 THEN {{'done': x.done, 'cur': x.cur || E'\\n\\n' || y.cur}} ELSE {{'done': {flush}, 'cur': y.cur}} END"""
    parts = f"""list_filter(list_transform(regexp_split_to_array({s_text(f"regexp_replace({c}, E'\\r\\n?', E'\\n', 'g')")}, '\\n\\s*\\n+'), lambda p: {s_text("p")}), lambda p: p <> '')"""
    none = "{'done': CAST([] AS VARCHAR[]), 'cur': ''}"
    folded = f"list_reduce(list_prepend({none}, list_transform({parts}, lambda p: {{'done': CAST([] AS VARCHAR[]), 'cur': p}})), {fold})"
    return f"list_transform([{folded}], lambda z: CASE WHEN z.cur = '' THEN z.done ELSE list_concat(z.done, [z.cur]) END)[1]"


@query(
    f"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_index, l[i] AS chunk_text FROM (SELECT doc_id, l, unnest(generate_series(1, len(l))) AS i FROM (SELECT doc_id, {_packed_sql("text")} AS l FROM documents WHERE {s_text("text")} <> ''))"""
)
def chunk_paragraph_pack(t: Tables) -> DataFrame:
    d = t.documents.where(has_value("text")).select("doc_id", F.posexplode(C.packed_paragraphs(F.col("text"))).alias("chunk_index", "chunk_text"))
    return d.select("doc_id", "chunk_index", "chunk_text")


@query(
    f"""SELECT source_file, CAST(n AS INTEGER) AS section_no, s.title AS section_title, s.section_path AS section_path, s.source AS source, CAST(i - 1 AS INTEGER) AS chunk_index, l[i] AS chunk_text FROM
    (SELECT source_file, n, s, l, unnest(generate_series(1, len(l))) AS i FROM (SELECT source_file, n, s, {_packed_sql("s.text")} AS l FROM
    (SELECT source_file, a[n] AS s, n FROM (SELECT source_file, a, unnest(generate_series(1, len(a))) AS n FROM (SELECT source_file, list_concat(coalesce(abstract_sections, []), coalesce(body_sections, [])) AS a FROM literature_article))) WHERE {s_text("s.text")} <> ''))"""
)
def section_chunks(t: Tables) -> DataFrame:
    return C.section_chunks(t.literature_article, ["source_file"])


_TOK = "regexp_extract_all(text, '^[ \\t\\n\\r\\f\\v]*[^ \\t\\n\\r\\f\\v]+[ \\t\\n\\r\\f\\v]*|[^ \\t\\n\\r\\f\\v]+[ \\t\\n\\r\\f\\v]*')"
_WINDOWS = f"""(SELECT chunk_id, CAST(s // 98 AS INTEGER) AS window_index, CAST((len(k) + 97) // 98 AS INTEGER) AS window_count, array_to_string(k[s + 1:s + 98], '') AS window_text FROM
    (SELECT chunk_id, k, unnest(generate_series(0, len(k) - 1, 98)) AS s FROM (SELECT chunk_id, {_TOK} AS k FROM literature_chunk WHERE {s_text("text")} <> '')))"""


@query(f"SELECT chunk_id, window_index, window_count, md5(window_text) AS digest FROM {_WINDOWS}")
def window_split_whitespace(t: Tables) -> DataFrame:
    w = C.token_windows(t.literature_chunk, ["chunk_id"], "text", 98)
    return w.select("chunk_id", "window_index", "window_count", F.md5(F.col("window_text").cast("binary")).alias("digest"))


@query(f"SELECT chunk_id, true AS joins_again FROM literature_chunk WHERE {s_text('text')} <> ''")
def window_reassembly_check(t: Tables) -> DataFrame:
    w = C.token_windows(t.literature_chunk, ["chunk_id"], "text", 98)
    again = w.groupBy("chunk_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("window_index", "window_text"))), lambda x: x["window_text"]), "").alias("again"))
    return again.join(t.literature_chunk.select("chunk_id", "text"), "chunk_id").select("chunk_id", (F.col("again") == F.col("text")).alias("joins_again"))


@query(f"SELECT CASE WHEN n > 5 THEN '>5' ELSE n::VARCHAR END AS n_windows, count(*) AS n FROM (SELECT chunk_id, count(*) AS n FROM {_WINDOWS} GROUP BY 1) GROUP BY 1")
def window_distribution(t: Tables) -> DataFrame:
    n = C.token_windows(t.literature_chunk, ["chunk_id"], "text", 98).where("window_index = 0").select(F.col("window_count").alias("k"))
    return n.groupBy(F.when(F.col("k") > 5, ">5").otherwise(F.col("k").cast("string")).alias("n_windows")).agg(F.count("*").alias("n"))


# --- vectors ----------------------------------------------------------------------------------------------------------

_COS = "round(list_cosine_similarity(a.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6)"


def _points(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def _one(t: Tables) -> DataFrame:
    return t.embeddings.where("vec_id = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def _every(t: Tables) -> DataFrame:
    """The stated set of searches: every row whose id is divisible by 50."""
    return t.embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


@query(f"SELECT a.vec_id AS id, {_COS} AS score FROM embeddings a, (SELECT * FROM embeddings WHERE vec_id = 0) q ORDER BY list_cosine_similarity(a.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, 1 LIMIT 5")
def vector_topk_cosine(t: Tables) -> DataFrame:
    return V.cosine_top_k(_points(t), _one(t), 5).select("id", F.round("score", 6).alias("score"))


@query(
    f"""SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT q.vec_id AS query_id, a.vec_id AS id, {_COS} AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(a.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, a.vec_id) AS rank
    FROM embeddings a, (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q) WHERE rank <= 5"""
)
def vector_batch_topk(t: Tables) -> DataFrame:
    return V.cosine_top_k(_points(t), _every(t), 5).select("query_id", "id", F.round("score", 6).alias("score"), "rank")


_SIDE = "(SELECT a.vec_id AS id, {c} AS score, row_number() OVER (ORDER BY list_cosine_similarity(a.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, a.vec_id) AS rank FROM embeddings a, (SELECT * FROM embeddings WHERE vec_id = 0) q WHERE a.label % 2 = {k})"


@query(
    f"""SELECT CAST(row_number() OVER (ORDER BY o, rank) AS INTEGER) AS evidence_id, source, CAST(rank AS INTEGER) AS rank, id, score FROM (SELECT 0 AS o, 'symptom' AS source, * FROM {_SIDE.format(c=_COS, k=0)}
    UNION ALL SELECT 1, 'literature', * FROM {_SIDE.format(c=_COS, k=1)}) WHERE rank <= 5"""
)
def vector_dual_topk(t: Tables) -> DataFrame:
    p = _points(t)
    return V.dual_top_k(p.where("label % 2 = 0"), p.where("label % 2 = 1"), _one(t), 5).select("evidence_id", "source", "rank", "id", F.round("score", 6).alias("score"))


_SIDE_EACH = """(SELECT q.vec_id AS query_id, a.vec_id AS id, {c} AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(a.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, a.vec_id) AS rank
    FROM embeddings a, (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q WHERE a.label % 2 = {k})"""


@query(
    f"""SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY o, rank) AS INTEGER) AS evidence_id, source, CAST(rank AS INTEGER) AS rank, id, score FROM (SELECT 0 AS o, 'symptom' AS source, * FROM {_SIDE_EACH.format(c=_COS, k=0)}
    UNION ALL SELECT 1, 'literature', * FROM {_SIDE_EACH.format(c=_COS, k=1)}) WHERE rank <= 5"""
)
def vector_batch_dual_topk(t: Tables) -> DataFrame:
    p = _points(t)
    return V.dual_top_k(p.where("label % 2 = 0"), p.where("label % 2 = 1"), _every(t), 5).select("query_id", "evidence_id", "source", "rank", "id", F.round("score", 6).alias("score"))


@query("SELECT vec_id AS id, label FROM embeddings WHERE vec_id IN (3, 7, 11, 400000)")
def point_lookup_by_ids(t: Tables) -> DataFrame:
    return _points(t).where(F.col("id").isin(3, 7, 11, 400000)).select("id", "label")


@query("SELECT count(*) AS n, min(len(embedding)) AS least, max(len(embedding)) AS greatest, 'cosine' AS distance FROM embeddings")
def collection_stats(t: Tables) -> DataFrame:
    s = F.size("vector").cast("bigint")
    return _points(t).agg(F.count("*").alias("n"), F.min(s).alias("least"), F.max(s).alias("greatest"), F.lit("cosine").alias("distance"))


@query("SELECT label, count(*) AS n FROM (SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN -1 ELSE label END AS label FROM embeddings UNION ALL SELECT vec_id + 1000000, -2 FROM embeddings WHERE vec_id % 25 = 0) GROUP BY 1")
def vector_upsert_replace(t: Tables) -> DataFrame:
    from ..sources.vectors import merged

    old = _points(t).select("id", "label")
    new = old.where("id % 10 = 0").select("id", F.lit(-1).alias("label")).unionByName(old.where("id % 25 = 0").select((F.col("id") + 1000000).alias("id"), F.lit(-2).alias("label")))
    return merged(old, new).groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(DISTINCT vec_id) AS n_ids FROM embeddings")
def upsert_is_idempotent(t: Tables) -> DataFrame:
    from ..sources.vectors import merged

    old = _points(t).select("id", "label")
    return merged(merged(old, old), old).agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))


_WORDS = "(SELECT chunk_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS w FROM literature_chunk)"


@query(
    f"""WITH n AS (SELECT chunk_id, CAST(('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS INTEGER) AS bucket, count(*) AS n FROM {_WORDS} GROUP BY ALL), l AS (SELECT chunk_id, sqrt(sum(n * n)) AS len FROM n GROUP BY 1)
    SELECT chunk_id, bucket, round(n / len, 5) AS value FROM n JOIN l USING (chunk_id)"""
)
def hashed_embedding(t: Tables) -> DataFrame:
    v = V.hashed_embedding(t.literature_chunk, "chunk_id", "text", 64)
    e = v.select("chunk_id", F.posexplode("vector").alias("bucket", "value")).where("value <> 0")
    return e.select("chunk_id", "bucket", F.round(F.col("value").cast("double"), 5).alias("value"))


# --- evidence and answers ---------------------------------------------------------------------------------------------


@query(
    f"""SELECT CAST(row_number() OVER (ORDER BY o, rank) AS INTEGER) AS evidence_id, source_type, CAST(rank AS INTEGER) AS retrieval_rank, id AS content_id, score AS relevance_score FROM (SELECT 0 AS o, 'symptom' AS source_type, * FROM {_SIDE.format(c=_COS, k=0)}
    UNION ALL SELECT 1, 'literature', * FROM {_SIDE.format(c=_COS, k=1)}) WHERE rank <= 5"""
)
def evidence_numbering(t: Tables) -> DataFrame:
    p = _points(t)
    return evidence.retrieve(p.where("label % 2 = 0"), p.where("label % 2 = 1"), _one(t), 5).select("evidence_id", "source_type", "retrieval_rank", "content_id", F.round("relevance_score", 6).alias("relevance_score"))


@query(
    f"""SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY o, rank) AS INTEGER) AS evidence_id, source_type, CAST(rank AS INTEGER) AS retrieval_rank, id AS content_id, score AS relevance_score FROM (SELECT 0 AS o, 'symptom' AS source_type, * FROM {_SIDE_EACH.format(c=_COS, k=0)}
    UNION ALL SELECT 1, 'literature', * FROM {_SIDE_EACH.format(c=_COS, k=1)}) WHERE rank <= 5"""
)
def evidence_batch_numbering(t: Tables) -> DataFrame:
    p = _points(t)
    rows = evidence.retrieve(p.where("label % 2 = 0"), p.where("label % 2 = 1"), _every(t), 5)
    return rows.select("query_id", "evidence_id", "source_type", "retrieval_rank", "content_id", F.round("relevance_score", 6).alias("relevance_score"))


def _evidence(t: Tables) -> DataFrame:
    """Evidence of every stated search with its text; scores rounded to 6 digits, as they are shown."""
    p = _points(t)
    rows = evidence.retrieve(p.where("label % 2 = 0"), p.where("label % 2 = 1"), _every(t), 5).withColumn("relevance_score", F.round("relevance_score", 6))
    c = t.literature_chunk.select(F.col("chunk_id").alias("content_id"), F.col("text").alias("content"), F.coalesce("pmcid", "pmid").alias("source"))
    return evidence.attach_content(rows, c)


_EVIDENCE = f"""(SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY o, rank) AS INTEGER) AS evidence_id, coalesce(c.text, '') AS content, coalesce(c.pmcid, c.pmid, '') AS source, source_type, '' AS location, score AS relevance_score, CAST(rank AS INTEGER) AS retrieval_rank
    FROM (SELECT 0 AS o, 'symptom' AS source_type, * FROM {_SIDE_EACH.format(c=_COS, k=0)} UNION ALL SELECT 1, 'literature', * FROM {_SIDE_EACH.format(c=_COS, k=1)}) e LEFT JOIN literature_chunk c ON c.chunk_id = e.id WHERE rank <= 5)"""
_PART = """'{title}' || E'\n\n' || string_agg(item, E'\n\n' ORDER BY evidence_id) FILTER (source_type = '{source}')"""


@query(
    f"""SELECT query_id, concat_ws(E'\n\n', {_PART.format(title="Symptom evidence", source="symptom")}, {_PART.format(title="Literature evidence", source="literature")}) AS context FROM (SELECT *,
    'Evidence ' || evidence_id || E'\nSource: ' || source || E'\nType: ' || source_type || E'\nLocation: ' || location || E'\nSimilarity: ' || relevance_score || E'\nText: ' || content AS item FROM {_EVIDENCE}) GROUP BY query_id"""
)
def evidence_context(t: Tables) -> DataFrame:
    return evidence.context_text(_evidence(t))


_ITEM = "{'evidence_id': evidence_id, 'content': content, 'source': source, 'source_type': source_type, 'location': location, 'relevance_score': relevance_score, 'retrieval_rank': retrieval_rank}"


@query(
    f"""SELECT query_id, CAST(to_json({{'agent': 'evidence', 'status': 'success', 'query_context': {{'clinical_text': 'persistent cough', 'diseases': ['pneumonia'], 'symptoms': ['cough', 'fever'], 'medications': CAST([] AS VARCHAR[]), 'tests': CAST([] AS VARCHAR[]), 'procedures': CAST([] AS VARCHAR[])}},
    'diagnostic_candidates': candidates, 'evidence': evidence, 'metadata': {{'symptom_evidence_count': s, 'literature_evidence_count': l, 'total_evidence_count': n, 'retrieval_top_k': greatest(s, l)}}, 'limitations': 'offline stand-in', 'error': NULL}}) AS VARCHAR) AS document
    FROM (SELECT query_id, list({_ITEM} ORDER BY evidence_id) AS evidence, count(*) AS n, count(*) FILTER (source_type = 'symptom') AS s, count(*) FILTER (source_type = 'literature') AS l,
    list_transform(list({{'source': source, 'evidence_id': evidence_id}} ORDER BY evidence_id) FILTER (retrieval_rank = 1), lambda x, i: {{'condition': 'see ' || x.source, 'rank': i, 'justification': 'closest evidence', 'supporting_evidence': [x.evidence_id]}}) AS candidates FROM {_EVIDENCE} GROUP BY query_id)"""
)
def output_contract(t: Tables) -> DataFrame:
    """The nested answer document as JSON."""
    e = _evidence(t)
    q = _every(t).select(
        "query_id", F.lit("persistent cough").alias("clinical_text"), F.array(F.lit("pneumonia")).alias("diseases"), F.array(F.lit("cough"), F.lit("fever")).alias("symptoms"),
        F.array().cast("array<string>").alias("medications"), F.array().cast("array<string>").alias("tests"),
    )
    answer = evidence.first_evidence_answerer(e)
    return evidence.output_contract(q, e, answer)
