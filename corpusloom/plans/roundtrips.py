"""Queries of sources, sinks, connectors, collections and checks: what was written is read back and compared with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import first_bigint, first_number, has_value, text_or_empty
from ..operators import aggregates as A
from ..operators import chunking as C
from ..operators import joins as J
from ..operators import ranking as R
from ..operators import vector as V
from ..sources import connectors, jats, services, sinks, tables
from ..sources.vectors import Collection, check_target, payload
from ..streaming import ingest as S
from . import evidence
from .documents import _CHUNKS, _WINDOWS  # noqa: F401 - SQL of chunks and windows
from .registry import Tables, query, s_list, s_number, s_text
from .xml import _sql as s_collapsed
from .xml import article_files

_DIGITS = "ltrim(nullif(regexp_extract({c}, '[0-9]+'), ''), '0')"

# --- files ------------------------------------------------------------------------------------------------------------

_CSV = ("record_id", "pmid", "pmcid", "title", "abstract", "journal", "authors", "acquisition_route", "error_message", "retrieved_at")


def _csv_text(c: str) -> str:
    return f"replace(replace(coalesce(CAST({c} AS VARCHAR), ''), E'\\r\\n', E'\\n'), E'\\r', E'\\n')"


@query(f"SELECT {', '.join(f'{_csv_text(c)} AS {c}' for c in _CSV)} FROM pubmed_fulltext_manifest")
def csv_strict_round_trip(t: Tables) -> DataFrame:
    """A CSV table written once in manifest order (route, latest year, id) and read strictly; missing cells are ""."""
    folder = S.work_folder(t.spark, "csv")
    m = t.pubmed_fulltext_manifest
    order = [F.col("acquisition_route").asc_nulls_first(), first_bigint("publication_year").desc_nulls_last(), *R.numeric_then_text("pmid")]
    lines = m.select(*[F.regexp_replace(F.col(c).cast("string"), "\r\n?", "\n").alias(c) for c in (*_CSV, "publication_year")])
    sinks.write_csv(lines, f"{folder}/manifest", order)
    return tables.read_csv(t.spark, f"{folder}/manifest", _CSV, strict=True).select(*_CSV)


@query(
    f"""SELECT 'row' AS kind, disease_id AS key, coalesce({s_text("literature_status")}, '') AS value, CAST(1 AS BIGINT) AS n FROM disease_manifest
    UNION ALL SELECT 'warning', 'rows with a wrong number of cells', '', count(*) FROM disease_manifest WHERE {s_text("literature_status")} = '' OR retired_at IS NOT NULL HAVING count(*) > 0"""
)
def csv_lenient_warnings(t: Tables) -> DataFrame:
    """Rows without a status are short, rows of retired diseases long; both are mended and counted."""
    folder = S.work_folder(t.spark, "lenient")
    status = text_or_empty("literature_status")
    cells = F.concat_ws(",", F.col("disease_id"), F.when((status != "") | F.col("retired_at").isNotNull(), status), F.when(F.col("retired_at").isNotNull(), F.lit("retired")))
    t.disease_manifest.select(cells.alias("value")).unionByName(t.spark.createDataFrame([("disease_id,status",)], "value string")).coalesce(1).sortWithinPartitions(~F.startswith("value", F.lit("disease_id"))).write.text(f"{folder}/in")
    rows, warnings = tables.read_csv_lenient(t.spark, f"{folder}/in")
    return rows.select(F.lit("row").alias("kind"), F.col("disease_id").alias("key"), F.col("status").alias("value"), F.lit(1).cast("bigint").alias("n")).unionByName(
        warnings.select(F.lit("warning").alias("kind"), F.col("issue").alias("key"), F.lit("").alias("value"), "n")
    )


@query(
    """SELECT 'first' AS part, count(*) AS n, CAST(sum(chunk_id) AS BIGINT) AS check_sum FROM literature_chunk WHERE category <> 'other' UNION ALL SELECT 'second', count(*), CAST(sum(chunk_id) AS BIGINT) FROM literature_chunk WHERE category = 'other' OR category IS NULL
    UNION ALL SELECT 'replaced', count(*), CAST(sum(chunk_id) AS BIGINT) FROM literature_chunk"""
)
def table_append_and_replace(t: Tables) -> DataFrame:
    """Two batches appended, one of them twice; a table replaced after a check, and a failing check that leaves it as it was."""
    folder = S.work_folder(t.spark, "append")
    c = t.literature_chunk.select("chunk_id", "category")
    known = F.coalesce(F.col("category") != "other", F.lit(False))
    for batch, rows in (("first", c.where(known)), ("second", c.where(~known)), ("second", c.where(~known))):
        sinks.append_batch(rows, f"{folder}/batches", batch)

    def full(written: DataFrame) -> None:
        if written.isEmpty() and not c.isEmpty():
            raise ValueError("nothing was written")

    sinks.replace_table(c.limit(1), f"{folder}/table")
    sinks.replace_table(c, f"{folder}/table", full)
    try:
        sinks.replace_table(c.limit(0), f"{folder}/table", full)
    except ValueError:
        pass
    both = t.spark.read.parquet(f"{folder}/batches").select(F.col("batch").alias("part"), "chunk_id")
    both = both.unionByName(sinks.current_table(t.spark, f"{folder}/table").select(F.lit("replaced").alias("part"), "chunk_id"))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.sum("chunk_id").alias("check_sum"))


_LINE = "to_json(struct_pack(embedding_window_index := embedding_window_index, section_path := section_path, source := source, \"text\" := \"text\", window_id := window_id))"


@query(
    f"""SELECT CAST(shard AS INTEGER) AS shard, 'windows-' || lpad(CAST(shard AS VARCHAR), 5, '0') || '.jsonl' AS file, count(*) AS n_rows, sha256(string_agg(line || chr(10), '' ORDER BY window_id)) AS sha256
    FROM (SELECT (row_number() OVER (ORDER BY window_id) - 1) // 300 AS shard, window_id, {_LINE} AS line FROM literature_embedding_window) GROUP BY shard"""
)
def jsonl_shards(t: Tables) -> DataFrame:
    """Canonical JSON lines in shards of 300 windows, with the digest of each shard's bytes."""
    w = t.literature_embedding_window.select("window_id", "text", "section_path", "source", "embedding_window_index")
    return sinks.export_shards(w, ["window_id"], S.work_folder(t.spark, "shards"), 300)


_NAMED = f"(SELECT {s_number('disease_id')} AS id, max_by(disease_name, disease_name) AS name FROM disease_manifest WHERE {s_text('disease_name')} <> '' GROUP BY 1)"


@query(
    f"""SELECT DISTINCT 'Disease: ' || name || E'\\nSymptoms: ' || t AS text, n.id AS disease_id FROM (SELECT {s_text("title")} AS t, {s_number("disease_id")} AS id FROM pubmed_selection_audit) r JOIN {_NAMED} n ON n.id = r.id WHERE t <> ''"""
)
def labelled_texts(t: Tables) -> DataFrame:
    """A JSON mapping of names to ids, turned around, gives the labels of a table of texts; equal pairs count once."""
    folder = S.work_folder(t.spark, "mapping")
    names = t.disease_manifest.where(has_value("disease_name")).groupBy(first_bigint("disease_id").alias("id")).agg(F.max("disease_name").alias("name"))
    whole = names.groupBy("name").agg(F.max("id").alias("id")).groupBy().agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "id"))))).alias("value"))
    whole.coalesce(1).write.text(f"{folder}/names")  # one entry per disease of a manifest
    mapping = tables.invert_mapping(tables.read_mapping(t.spark, f"{folder}/names"))
    rows = t.pubmed_selection_audit.select(F.col("title").alias("text"), first_number("disease_id").alias("label"))
    rows = rows.join(mapping.select(F.col("id").cast("string").alias("label")), "label", "left_semi")
    return tables.labelled_documents(rows, mapping).select("text", "metadata.disease_id")


@query(f"SELECT id, count(*) AS n FROM (SELECT unnest({s_list('x', ',')}) AS id FROM (SELECT concat_ws(' , ', pmid, pmcid, '') AS x FROM pubmed_complete_metadata)) GROUP BY 1")
def failure_log_ids(t: Tables) -> DataFrame:
    """Ids of a failure log that packs them with commas and stray blanks."""
    log = t.pubmed_complete_metadata.select(F.concat_ws(" , ", "pmid", "pmcid", F.lit("")).alias("pmids"))
    return tables.ids_of_log(log)


def _form_feed_pages(content: bytes) -> list[str]:
    return content.decode().split("\f")


@query(
    """SELECT 'c' || name || '.pdf' AS filename, CAST(p AS INTEGER) AS page_number, l[p] AS text FROM (SELECT name, l, unnest(generate_series(1, len(l))) AS p FROM
    (SELECT chunk_id // 100 AS name, list(CAST(chunk_id AS VARCHAR) ORDER BY chunk_id) AS l FROM literature_chunk GROUP BY 1))"""
)
def paged_files(t: Tables) -> DataFrame:
    """One file per hundred chunk ids with a page for each, written as files and read page by page with a given extractor."""
    folder = S.work_folder(t.spark, "pages")
    name = F.floor(F.col("chunk_id") / 100).cast("string")
    pages = t.literature_chunk.groupBy(name.alias("c")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("chunk_id")), lambda x: x.cast("string")), "\f").alias("x"))
    sinks.write_payloads(pages.select(F.concat(F.lit("c"), "c", F.lit(".pdf")).alias("source_file"), F.encode("x", "UTF-8").alias("content")), folder).count()
    return tables.read_pages(t.spark, folder, _form_feed_pages).select("filename", "page_number", "text")


@query(
    f"""SELECT source_file, {s_collapsed("title")} AS title, len(list_filter(coalesce(body_sections, []), lambda s: {s_collapsed("s.text")} <> '')) AS n_sections FROM literature_article
    WHERE source_file IN (SELECT {s_text("pmcid")} || '.xml' FROM pubmed_fulltext_manifest WHERE lower({s_text("acquisition_route")}) = 'pmc' AND {s_text("pmcid")} <> '')"""
)
def manifest_article_files(t: Tables) -> DataFrame:
    """Article files written under their names; those of the manifest's route are found, read and parsed."""
    folder = S.work_folder(t.spark, "articles")
    written = sinks.write_payloads(article_files(t), folder, valid=lambda data: data.startswith(b"<article"))
    listing = written.where("written").select(F.concat(F.lit(f"{folder}/"), "name").alias("path"))
    wanted = tables.manifest_files(t.pubmed_fulltext_manifest, _kept(listing))
    got = jats.parsed(jats.read_articles(t.spark, folder, only=wanted))
    return got.select("source_file", "title", F.size("body_sections").cast("bigint").alias("n_sections"))


def _kept(df: DataFrame) -> DataFrame:
    from ..session import cut_lineage

    return cut_lineage(df)


# --- services ---------------------------------------------------------------------------------------------------------


def _recorded_service(ids: list[str], tries: dict = {}) -> dict[str, str]:  # noqa: B006 - remembers what it was asked, as a service's load does
    """Answers of a service that is busy at the first request for a batch and lacks ids that end in 7."""
    key = ids[0]
    tries[key] = tries.get(key, 0) + 1
    if tries[key] % 2 == 1:
        raise connectors.ServiceError("busy", 503)
    return {i: f"record {i}" for i in ids if not i.endswith("7")}


@query(
    f"""SELECT id, CASE WHEN NOT ends_with(id, '7') THEN 'record ' || id END AS content, CASE WHEN ends_with(id, '7') THEN 'not in the answer' END AS error, CAST(2 AS INTEGER) AS attempts
    FROM (SELECT DISTINCT {_DIGITS.format(c="pmid")} AS id FROM pubmed_fulltext_manifest) WHERE id IS NOT NULL"""
)
def service_batches(t: Tables) -> DataFrame:
    """Ids fetched in batches of 200 from a service that has to be asked twice; ids it lacks are errors of their own."""
    ids = t.pubmed_fulltext_manifest.select(first_number("pmid").alias("id"))
    return connectors.fetch(connectors.batches(ids, 200), _recorded_service, attempts=3, base=0.0)


def _recorded_answers(url: str, timeout: float) -> bytes:
    """Recorded answers: a search finds as many articles as its term has letters; records and files repeat their ids; the
    last digit 3 is not there, and every file whose id ends in 9 is answered by an error."""
    import json
    from urllib.parse import parse_qs, urlsplit

    asked = {k: v[0] for k, v in parse_qs(urlsplit(url).query).items()}
    if "term" in asked:
        n = len(asked["term"])
        return json.dumps({"esearchresult": {"count": str(n), "idlist": [str(n * 100 + i) for i in range(min(n, int(asked["retmax"])))]}}).encode()
    if asked["db"] == "pmc":
        if asked["id"].endswith("9"):
            raise connectors.ServiceError("gone", 404)
        return f"<article>{asked['id']}</article>".encode()
    one = "<PubmedArticle><MedlineCitation><PMID>{0}</PMID><Article><ArticleTitle>About {0}</ArticleTitle></Article></MedlineCitation></PubmedArticle>"
    return ("<PubmedArticleSet>" + "".join(one.format(i) for i in asked["id"].split(",") if not i.endswith("3")) + "</PubmedArticleSet>").encode()


_RECORDED = services.Client("http://recorded", pause=0.0, opener=_recorded_answers)


@query(
    f"""SELECT CAST(id AS BIGINT) AS query_id, i AS rank, CAST(length(term) * 100 + i - 1 AS VARCHAR) AS id, CAST(length(term) AS BIGINT) AS n_hits FROM (SELECT id, term, CAST(unnest(generate_series(1, least(length(term), 5))) AS INTEGER) AS i FROM
    (SELECT {s_number("disease_id")} AS id, {s_text("disease_name")} AS term FROM disease_manifest) WHERE id IS NOT NULL AND term <> '')"""
)
def service_searches(t: Tables) -> DataFrame:
    """A search per disease: its first five hits with their place and the number of all."""
    terms = t.disease_manifest.select(first_bigint("disease_id").alias("query_id"), text_or_empty("disease_name").alias("term")).where("query_id is not null and term <> ''")
    found = services.search_entities(terms, _RECORDED, 5, base=0.0)
    hits = connectors.search_hits(found).join(found.select("query_id", "n_hits"), "query_id")
    return hits.select("query_id", "rank", "id", "n_hits")


@query(
    f"""SELECT id, CASE WHEN ends_with(id, '3') THEN NULL ELSE 'About ' || id END AS title, CASE WHEN ends_with(id, '3') THEN 'not in the answer' END AS error FROM (SELECT DISTINCT {_DIGITS.format(c="pmid")} AS id FROM pubmed_complete_metadata) WHERE id IS NOT NULL"""
)
def service_records(t: Tables) -> DataFrame:
    """Records fetched in batches of 200, cut out of their answers, and parsed."""
    from ..sources import records

    got = services.fetch_records(t.pubmed_complete_metadata.select(first_number("pmid").alias("id")), _RECORDED, base=0.0)
    got = _kept(got)
    parsed = records.parse_records(got.where("content is not null").select(F.col("id").alias("source_file"), F.encode("content", "UTF-8").alias("content")))
    return got.select("id", "error").join(parsed.select(F.col("source_file").alias("id"), "title"), "id", "left").select("id", "title", "error")


_WANTED = f"SELECT DISTINCT upper({s_text('pmcid')}) AS id FROM pubmed_fulltext_manifest WHERE {s_text('pmcid')} <> ''"


@query(
    f"""SELECT id, CASE WHEN good AND NOT ends_with(id, '9') THEN '<article>' || id || '</article>' END AS content, CASE WHEN NOT good THEN 'no PMC id' WHEN ends_with(id, '9') THEN 'status 404: ServiceError: gone' END AS error, CAST(CASE WHEN good THEN 1 ELSE 0 END AS INTEGER) AS attempts
    FROM (SELECT id, regexp_full_match(id, 'PMC[0-9]+') AS good FROM ({_WANTED}) WHERE NOT (regexp_full_match(id, 'PMC[0-9]+') AND id IN (SELECT upper({s_text("pmcid")}) FROM literature_article)))"""
)
def service_full_texts(t: Tables) -> DataFrame:
    """Full texts of a manifest that are not there yet; ids of another form and failing requests are rows with their error."""
    wanted = t.pubmed_fulltext_manifest.where(has_value("pmcid")).select(F.col("pmcid").alias("id"))
    there = t.literature_article.where(has_value("pmcid")).select(F.col("pmcid").alias("id"))
    return services.fetch_full_texts(wanted, there, _RECORDED, base=0.0)


@query(f"SELECT record_id AS query_id, l[i] AS id, CAST(i AS INTEGER) AS rank FROM (SELECT record_id, l, unnest(generate_series(1, len(l))) AS i FROM (SELECT record_id, {s_list('mesh_terms')} AS l FROM pubmed_complete_metadata))")
def search_hit_ranks(t: Tables) -> DataFrame:
    """Answers of a search as hits with their place."""
    return connectors.search_hits(t.pubmed_complete_metadata.select(F.col("record_id").alias("query_id"), text.split_list("mesh_terms").alias("ids")))


@query(
    """WITH t AS (SELECT lower(trim(normalized_section_title)) AS label, min(category) AS heading FROM literature_chunk WHERE normalized_section_title IS NOT NULL AND category IS NOT NULL GROUP BY 1)
    SELECT w.window_id, t.heading FROM literature_embedding_window w LEFT JOIN t ON lower(trim(w.section_title)) = t.label"""
)
def terminology_lookup(t: Tables) -> DataFrame:
    """Section titles looked up in a terminology by label, case ignored."""
    terms = t.literature_chunk.where("normalized_section_title is not null and category is not null").select(F.col("normalized_section_title").alias("label"), F.col("category").alias("heading"))
    return connectors.lookup_terms(t.literature_embedding_window.select("window_id", "section_title"), terms, "section_title").select("window_id", "heading")


_TRUE = f"lower({s_text('has_body')}) IN ('true', 't', 'yes', 'y', '1')"


@query(
    f"""WITH a AS (SELECT {_DIGITS.format(c="pmcid_requested")} AS g, record_id, {_TRUE} AS ok FROM acquire_pmc_fulltext), f AS (SELECT g, min(CASE WHEN ok THEN record_id END) AS first FROM a GROUP BY 1)
    SELECT CASE WHEN f.first IS NULL THEN 'unresolved' ELSE 'recovered' END AS outcome, count(*) AS attempts, count(DISTINCT a.g) AS articles FROM a JOIN f ON a.g IS NOT DISTINCT FROM f.g WHERE f.first IS NULL OR record_id <= f.first GROUP BY 1"""
)
def recovery_summary(t: Tables) -> DataFrame:
    """Attempts per article up to the first with a body: how many articles were recovered, and after how many attempts."""
    ok = F.lower(text_or_empty("has_body")).isin("true", "t", "yes", "y", "1").cast("int")
    a = t.acquire_pmc_fulltext.select(first_number("pmcid_requested").alias("g"), "record_id", ok.alias("n_results"))
    kept = connectors.first_success(a, "g", "record_id")
    solved = kept.groupBy("g").agg(F.max("n_results").alias("ok"), F.count("*").alias("n"))
    return solved.groupBy(F.when(F.col("ok") > 0, "recovered").otherwise("unresolved").alias("outcome")).agg(F.sum("n").alias("attempts"), F.count("g").alias("articles"))


# --- presentation -----------------------------------------------------------------------------------------------------


@query(
    f"""SELECT record_id, regexp_replace(coalesce(source_url, '') || '?email=me@example.org&x=1&api_key=' || record_id || '#top', '([?&](?:email|api_key)=)[^&#]*', '\\1REDACTED', 'g') AS url,
    coalesce('Page ' || {s_number("attempts")}, '') AS location, printf('%.1f', 100.0 * coalesce({s_number("attempts")}, 0) / 7) || '%' AS share, regexp_replace(coalesce(error_message, '') || E'\\r\\nnext', '[\\r\\n]+', ' ', 'g') AS message,
    CASE WHEN license IS NULL THEN source ELSE license END AS license FROM acquire_pmc_fulltext"""
)
def presentation_texts(t: Tables) -> DataFrame:
    """Redacted addresses, locations, percentages, one-line messages, and merged metadata where the last value counts."""
    a = t.acquire_pmc_fulltext
    url = F.concat(F.coalesce("source_url", F.lit("")), F.lit("?email=me@example.org&x=1&api_key="), F.col("record_id").cast("string"), F.lit("#top"))
    of = lambda c: F.when(F.col(c).isNotNull(), F.create_map(F.lit("license"), F.col(c)))
    merged = text.merge_maps(of("source"), of("license"))
    return a.select(
        "record_id", text.redact_url(url).alias("url"), text.location_text(first_bigint("attempts")).alias("location"), text.percent_text(F.coalesce(first_bigint("attempts"), F.lit(0)), F.lit(7)).alias("share"),
        text.one_line(F.concat(F.coalesce("error_message", F.lit("")), F.lit("\r\nnext"))).alias("message"), F.try_element_at(merged, F.lit("license")).alias("license"),
    )


# --- collections ------------------------------------------------------------------------------------------------------


def _uuid_sql(name: str) -> str:
    h = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name}))"
    return f"(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || (['8', '9', 'a', 'b'])[('0x' || substr(h, 17, 1))::INTEGER % 4 + 1] || substr(h, 18, 3) || '-' || substr(h, 21, 12) FROM (SELECT {h} AS h))"


_ID_JSON = "to_json(struct_pack(filename := filename, page_number := page_number, source_type := source_type, vec_id := vec_id))"
_POINT = "(SELECT vec_id, label, embedding, 'vectors.bin' AS filename, CAST(vec_id % 3 AS INTEGER) AS page_number, 'dataset' AS source_type FROM embeddings)"


def _points_of(t: Tables, label) -> DataFrame:
    """(id, vector, payload) of the embeddings; ids are digests of what identifies a point."""
    e = t.embeddings.select("vec_id", label.alias("label"), "embedding", F.lit("vectors.bin").alias("filename"), (F.col("vec_id") % 3).cast("int").alias("page_number"), F.lit("dataset").alias("source_type"))
    key = {c: F.col(c) for c in ("filename", "page_number", "source_type", "vec_id")}
    more = {"metadata": {"label": F.col("label"), "page": F.col("page_number")}}
    return e.select(V.point_id(key).alias("id"), F.col("embedding").alias("vector"), payload({"filename": F.col("filename"), "vec_id": F.col("vec_id")}, more).alias("payload"))


def _filled(t: Tables, folder: str) -> tuple[Collection, Collection]:
    """Two collections: all points, those of odd labels replaced by a second upsert and again by a third; and an untouched one."""
    size = len(t.embeddings.select("embedding").first()[0]) if not t.embeddings.isEmpty() else 1
    first, other = Collection(t.spark, folder, "first", size, buckets=8), Collection(t.spark, folder, "other", size, buckets=8)
    check_target(first, "first", size, forbidden=("other",))
    other.upsert(_points_of(t, F.col("label")))
    first.upsert(_points_of(t, F.col("label")))
    odd = F.col("label") % 2 == 1
    again = _points_of(t, F.when(odd, -F.col("label")).otherwise(F.lit(0))).join(_points_of(t, F.when(odd, F.lit(1))).where("get_json_object(payload, '$.metadata.label') = 1").select("id"), "id", "left_semi")
    for _ in range(2):
        first.upsert(again)
    return Collection(t.spark, folder, "first", size, buckets=8), other


@query(
    f"""SELECT {_uuid_sql(_ID_JSON)} AS id, '{{"filename":"vectors.bin","metadata":{{"label":' || CASE WHEN label % 2 = 1 THEN -label ELSE label END || ',"page":' || page_number || '}},"vec_id":' || vec_id || '}}' AS payload,
    round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 5) AS norm, len(embedding) AS dimension FROM {_POINT}"""
)
def collection_after_upserts(t: Tables) -> DataFrame:
    """Points of a collection after three upserts, the last two of the same points: ids, payloads, norms."""
    first, _ = _filled(t, S.work_folder(t.spark, "vectors"))
    return first.read().select("id", "payload", F.round("norm", 5).alias("norm"), F.size("vector").cast("bigint").alias("dimension"))


@query(
    """SELECT name, count(*) AS n, min(len(embedding)) AS least, max(len(embedding)) AS greatest, 'cosine' AS distance, CAST(sum(CASE WHEN name = 'first' AND label % 2 = 1 THEN -label ELSE label END) AS BIGINT) AS check_sum
    FROM embeddings, (SELECT unnest(['first', 'other']) AS name) GROUP BY name"""
)
def collection_isolation(t: Tables) -> DataFrame:
    """Size, dimensions and contents of two collections after upserts into one of them: the other is as it was."""
    out = None
    for c in _filled(t, S.work_folder(t.spark, "vectors")):
        label = F.get_json_object("payload", "$.metadata.label").cast("bigint")
        one = c.inspect().join(c.read().agg(F.lit(c.name).alias("name"), F.sum(label).alias("check_sum")), "name")
        out = one if out is None else out.unionByName(one)
    return out.select("name", "n", F.col("least").cast("bigint").alias("least"), F.col("greatest").cast("bigint").alias("greatest"), "distance", "check_sum")


@query("SELECT vec_id, CASE WHEN label % 2 = 1 THEN -label ELSE label END AS label FROM embeddings WHERE vec_id IN (3, 7, 11)")
def collection_lookup(t: Tables) -> DataFrame:
    """Points of a list of ids, one of them unknown; the same ids as a table give the same points."""
    first, _ = _filled(t, S.work_folder(t.spark, "vectors"))
    key = {"filename": F.lit("vectors.bin"), "page_number": (F.col("vec_id") % 3).cast("int"), "source_type": F.lit("dataset"), "vec_id": F.col("vec_id")}
    ids = t.embeddings.where("vec_id in (3, 7, 11)").select(V.point_id(key).alias("id"))
    listed = first.lookup([*[r["id"] for r in ids.collect()], "nowhere"])
    both = listed.intersect(first.lookup_all(ids))
    of = lambda path: F.get_json_object("payload", path).cast("bigint")
    return both.select(of("$.vec_id").alias("vec_id"), of("$.metadata.label").alias("label"))


@query("SELECT 'missing' AS field, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'dimension', 0 UNION ALL SELECT 'payload', count(CASE WHEN label % 2 = 1 THEN 1 END) FROM embeddings")
def read_back_mismatches(t: Tables) -> DataFrame:
    """What was first written against what a collection holds now: cells that differ."""
    first, _ = _filled(t, S.work_folder(t.spark, "vectors"))
    size = lambda d: d.select("id", F.size("vector").alias("dimension"), "payload")
    return J.mismatches(size(_points_of(t, F.col("label"))), size(first.read()), "id", ["dimension", "payload"])


_WINDOW_KEY = ("category", "embedding_window_index", "literature_chunk_index", "pmcid", "pmid", "section_path", "source", "text")


@query(f"SELECT window_id, {_uuid_sql('to_json(struct_pack(' + ', '.join(f'"{c}" := "{c}"' for c in _WINDOW_KEY) + '))')} AS id FROM literature_embedding_window")
def window_point_ids(t: Tables) -> DataFrame:
    """Point ids of windows from their place and text."""
    return t.literature_embedding_window.select("window_id", V.point_id({c: F.col(c) for c in _WINDOW_KEY}).alias("id"))


# --- windows and chunks -----------------------------------------------------------------------------------------------


@query(f"SELECT chunk_id, window_index, window_count, md5(window_text) AS digest, len(regexp_extract_all(window_text, '[^ \\t\\n\\r\\f\\v]+')) AS n_tokens FROM {_WINDOWS}")
def tokenizer_windows(t: Tables) -> DataFrame:
    """Windows by a pluggable tokenizer; the one given here has the words between blanks as tokens."""
    w = C.tokenizer_windows(t.literature_chunk, ["chunk_id"], "text", C.blank_tokens, 98)
    return w.select("chunk_id", "window_index", "window_count", F.md5(F.encode("window_text", "UTF-8")).alias("digest"), F.col("n_tokens").cast("bigint").alias("n_tokens"))


_BLANK = r"trim(coalesce(text, ''), E' \t\n\r') = ''"


@query(
    f"""WITH c AS (SELECT *, array_to_string(section_path, chr(31)) AS p, {s_number("pmid")} AS a FROM literature_chunk), g AS (SELECT pmid, p, max(chunk_index) + 1 = count(DISTINCT chunk_index) AND min(chunk_index) = 0 AS whole, count(*) - count(DISTINCT chunk_index) AS twice FROM c GROUP BY ALL)
    SELECT 'not empty' AS check_name, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS n FROM c UNION ALL SELECT 'article known', count(*) FROM c WHERE a IS NULL UNION ALL SELECT 'section kept', count(*) FROM c WHERE len(coalesce(section_path, [])) = 0
    UNION ALL SELECT 'title ends path', count(*) FROM c WHERE section_path[-1] IS DISTINCT FROM section_title UNION ALL SELECT 'index contiguous', count(*) FROM g WHERE NOT whole UNION ALL SELECT 'index once', CAST(coalesce(sum(twice), 0) AS BIGINT) FROM g
    UNION ALL SELECT 'abstract first', count(*) FROM (SELECT pmid FROM c WHERE pmid IS NOT NULL GROUP BY pmid HAVING max(CASE WHEN source = 'abstract' THEN chunk_id END) > min(CASE WHEN source = 'body' THEN chunk_id END))
    UNION ALL SELECT 'within limit', count(*) FROM c WHERE length(text) > 1000 UNION ALL SELECT 'text there', count(*) FROM c WHERE {_BLANK}"""
)
def chunk_checks(t: Tables) -> DataFrame:
    """Nine checks of a chunk table with the number of chunks, or groups of chunks, that fail each."""
    c = t.literature_chunk.withColumn("p", F.array_join("section_path", "\x1f"))
    bad = {
        "article known": first_number("pmid").isNull(), "section kept": F.coalesce(F.size("section_path"), F.lit(0)) <= 0, "title ends path": ~F.try_element_at("section_path", F.lit(-1)).eqNullSafe(F.col("section_title")),
        "within limit": F.length("text") > 1000, "text there": text_or_empty("text") == "",
    }
    rows = c.agg(F.when(F.count("*") > 0, 0).otherwise(1).cast("bigint").alias("not empty"), *[F.count(F.when(F.coalesce(b, F.lit(False)), 1)).alias(k) for k, b in bad.items()])
    g = c.groupBy("pmid", "p").agg(((F.max("chunk_index") + 1 == F.count_distinct("chunk_index")) & (F.min("chunk_index") == 0)).alias("whole"), (F.count("*") - F.count_distinct("chunk_index")).alias("twice"))
    groups = g.agg(F.count(F.when(~F.col("whole"), 1)).alias("index contiguous"), F.coalesce(F.sum("twice"), F.lit(0)).alias("index once"))
    side = lambda s, f: f(F.when(F.col("source") == s, F.col("chunk_id")))
    order = c.where("pmid is not null").groupBy("pmid").agg(side("abstract", F.max).alias("a"), side("body", F.min).alias("b")).agg(F.count(F.when(F.col("a") > F.col("b"), 1)).alias("abstract first"))
    out = None
    for one in (rows, groups, order):
        e = F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), F.col(k).alias("n")) for k in one.columns])).alias("e")
        part = one.select(e).select("e.*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    f"""WITH w AS (SELECT *, array_to_string(section_path, chr(31)) AS p, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f\\v]+')) AS k FROM literature_embedding_window),
    g AS (SELECT pmid, p, literature_chunk_index, max(embedding_window_index) + 1 = count(DISTINCT embedding_window_index) AND min(embedding_window_index) = 0 AS whole, count(DISTINCT embedding_window_count) > 1 AS torn, max(embedding_window_count) <> count(DISTINCT embedding_window_index) AS short FROM w GROUP BY ALL)
    SELECT 'index in range' AS check_name, count(*) AS n FROM w WHERE embedding_window_index < 0 OR embedding_window_index >= embedding_window_count UNION ALL SELECT 'within limit', count(*) FROM w WHERE k > 98 UNION ALL SELECT 'text there', count(*) FROM w WHERE {_BLANK}
    UNION ALL SELECT 'metadata readable', count(*) FROM w WHERE NOT coalesce(json_valid(metadata), false) UNION ALL SELECT 'index contiguous', count(*) FROM g WHERE NOT whole UNION ALL SELECT 'one count', count(*) FROM g WHERE torn UNION ALL SELECT 'count kept', count(*) FROM g WHERE short"""
)
def window_checks(t: Tables) -> DataFrame:
    """Seven checks of a window table with the number of windows, or groups of windows, that fail each."""
    w = t.literature_embedding_window.withColumn("p", F.array_join("section_path", "\x1f"))
    i, n = F.col("embedding_window_index"), F.col("embedding_window_count")
    bad = {"index in range": (i < 0) | (i >= n), "within limit": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+")) > 98, "text there": text_or_empty("text") == "", "metadata readable": F.try_parse_json("metadata").isNull()}
    rows = w.agg(*[F.count(F.when(F.coalesce(b, F.lit(False)), 1)).alias(k) for k, b in bad.items()])
    g = w.groupBy("pmid", "p", "literature_chunk_index").agg(
        ((F.max(i) + 1 == F.count_distinct(i)) & (F.min(i) == 0)).alias("whole"), (F.count_distinct(n) > 1).alias("torn"), (F.max(n) != F.count_distinct(i)).alias("short")
    )
    groups = g.agg(F.count(F.when(~F.col("whole"), 1)).alias("index contiguous"), F.count(F.when(F.col("torn"), 1)).alias("one count"), F.count(F.when(F.col("short"), 1)).alias("count kept"))
    parts = [one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), F.col(k).alias("n")) for k in one.columns])).alias("e")).select("e.*") for one in (rows, groups)]
    return parts[0].unionByName(parts[1])


# --- streams ----------------------------------------------------------------------------------------------------------


@query(
    """SELECT 'first' AS run, count(*) AS seen, count(CASE WHEN value IS NOT NULL AND value < 100 THEN 1 END) AS stored, count(CASE WHEN value IS NULL OR value >= 100 THEN 1 END) AS failed, CAST(0 AS BIGINT) AS skipped FROM events WHERE event_type <> 'click'
    UNION ALL SELECT 'second', count(CASE WHEN event_type = 'click' THEN 1 END) + count(*), count(CASE WHEN event_type = 'click' AND value IS NOT NULL AND value < 100 THEN 1 END), count(CASE WHEN value IS NULL OR value >= 100 THEN 1 END) + count(CASE WHEN event_type = 'click' AND (value IS NULL OR value >= 100) THEN 1 END),
    count(CASE WHEN value IS NOT NULL AND value < 100 THEN 1 END) FROM events UNION ALL SELECT 'third', 0, 0, 0, 0"""
)
def stream_resume_counters(t: Tables) -> DataFrame:
    """Three runs over one checkpoint: a first drop of files; a second drop, which also repeats all rows; nothing new.

    Rows without a value, or with one of 100 and more, fail and are kept apart; rows stored before are skipped.
    """
    folder = S.work_folder(t.spark, "resume")
    drop, out, state = f"{folder}/in", f"{folder}/out", f"{folder}/state"
    e = t.events.select(F.col("event_id").alias("id"), "event_type", "value")
    bad = F.when(F.col("value").isNull() | (F.col("value") >= 100), F.lit("value out of range"))
    stored = [0]

    def sink(rows: DataFrame, number: int) -> None:
        sinks.append_batch(rows, out, str(number))
        stored[0] += 1

    def run(name: str) -> tuple:
        stream = t.spark.readStream.schema(e.schema).parquet(drop)
        p = S.ingest(stream, lambda b: b.withColumn("error", bad), sink, state, stored=lambda: t.spark.read.parquet(out) if stored[0] else None)
        return (name, p.seen, p.stored, p.failed, p.skipped)

    click = F.coalesce(F.col("event_type") == "click", F.lit(False))
    e.where(~click).write.mode("append").parquet(drop)
    counts = [run("first")]
    e.where(click).write.mode("append").parquet(drop)
    counts.append(run("second half"))
    e.write.mode("append").parquet(drop)
    again = run("repeated")
    second = ("second", *[a + b for a, b in zip(counts[1][1:], again[1:])])
    return t.spark.createDataFrame([counts[0], second, run("third")], "run string, seen long, stored long, failed long, skipped long")


# --- questions and answers --------------------------------------------------------------------------------------------


@query(
    f"""SELECT record_id, CASE WHEN {s_text("abstract")} = '' THEN 'no text' WHEN mesh_terms IS NULL AND doi IS NULL THEN 'no list of symptoms, medications' WHEN mesh_terms IS NULL THEN 'no list of symptoms' WHEN doi IS NULL THEN 'no list of medications' END AS problem FROM pubmed_complete_metadata"""
)
def question_problems(t: Tables) -> DataFrame:
    """What is wrong with questions made of records: a blank text, or lists that are not there."""
    as_list = lambda c, n: F.when(F.col(c).isNotNull(), text.split_list(c)).alias(n)
    q = t.pubmed_complete_metadata.select("record_id", F.col("abstract").alias("clinical_text"), F.array(F.lit("x")).alias("diseases"), as_list("mesh_terms", "symptoms"), as_list("doi", "medications"), F.array(F.lit("y")).alias("tests"))
    return q.select("record_id", evidence.question_problem().alias("problem"))


_ANSWER_CASES = ("{\"condition\":\"c\",\"rank\":%s,\"justification\":\"j\",\"supporting_evidence\":%s}",)
_SHAPES = (("1", "[1,2]", None), ("true", "[1]", "a candidate is malformed"), ("1.0", "[1]", "a candidate is malformed"), ("2", "[\"1\"]", "a candidate is malformed"), ("3", "[]", None), ("\"1\"", "[1]", "a candidate is malformed"))


@query(
    "SELECT chunk_id, problem IS NULL AS ok, problem FROM (SELECT chunk_id, CASE WHEN coalesce(level, 0) % 2 = 1 AND chunk_id % 7 = 6 THEN 'no limitations' ELSE (["
    + ", ".join(f"'{p}'" if p else "NULL" for _, _, p in _SHAPES)
    + f"])[chunk_id % {len(_SHAPES)} + 1] END AS problem FROM literature_chunk)"
)
def answer_validation(t: Tables) -> DataFrame:
    """Answers whose JSON values have right and wrong types: true, 1.0 and "1" are no ranks, "1" is no evidence number."""
    candidate = F.element_at(F.array(*[F.lit(_ANSWER_CASES[0] % (r, s)) for r, s, _ in _SHAPES]), (F.col("chunk_id") % len(_SHAPES) + 1).cast("int"))
    silent = (F.coalesce("level", F.lit(0)) % 2 == 1) & (F.col("chunk_id") % 7 == 6)
    answer = F.concat(F.lit('{"candidates":['), candidate, F.lit('],"limitations":'), F.when(silent, F.lit('" "}')).otherwise(F.lit('"few"}')))
    p = t.literature_chunk.select("chunk_id", evidence.parse_answer(answer).alias("p"))
    return p.select("chunk_id", "p.ok", "p.problem")


# --- sets, samples, reports -------------------------------------------------------------------------------------------

_KEYS = {"audit": "pubmed_selection_audit", "manifest": "pubmed_fulltext_manifest", "metadata": "pubmed_complete_metadata"}
_PAIRS = (("audit", "metadata"), ("manifest", "metadata"), ("metadata", "metadata"))


def _relation_sql(a: str, b: str) -> str:
    per = lambda x, n: f"(SELECT {s_number('pmid')} AS k, count(*) AS {n} FROM {_KEYS[x]} WHERE {s_number('pmid')} IS NOT NULL GROUP BY 1)"
    return f"""SELECT '{a} and {b}' AS pair, count(CASE WHEN a IS NULL OR b IS NULL THEN 1 END) = 0 AS equal, count(CASE WHEN b IS NULL THEN 1 END) = 0 AS subset, count(CASE WHEN a IS NULL THEN 1 END) = 0 AS superset,
    count(CASE WHEN a IS DISTINCT FROM b THEN 1 END) = 0 AS same_counts FROM {per(a, "a")} FULL JOIN {per(b, "b")} USING (k)"""


@query(" UNION ALL ".join(_relation_sql(*p) for p in _PAIRS))
def set_relations(t: Tables) -> DataFrame:
    """Whether the ids of two tables are equal, one within the other, or equal with their counts."""
    ids = {k: getattr(t, n).select(first_bigint("pmid").alias("pmid")) for k, n in _KEYS.items()}
    out = None
    for a, b in _PAIRS:
        one = J.set_relation(ids[a], ids[b], "pmid").select(F.lit(f"{a} and {b}").alias("pair"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    f"""SELECT 'row' AS kind, record_id AS key, CAST(p AS BIGINT) AS n FROM (SELECT record_id, row_number() OVER (ORDER BY {s_number("disease_id")} NULLS LAST, {s_number("selection_rank")} NULLS LAST, record_id) AS p FROM pubmed_selection_audit) WHERE p <= 50
    UNION ALL SELECT 'total', NULL, count(*) FROM pubmed_selection_audit"""
)
def limited_export(t: Tables) -> DataFrame:
    """The first 50 rows in audit order (disease, rank, record), and the count of all."""
    a = t.pubmed_selection_audit.select("record_id", first_bigint("disease_id").alias("d"), first_bigint("selection_rank").alias("r"))
    order = [F.col("d").asc_nulls_last(), F.col("r").asc_nulls_last(), F.col("record_id").asc()]
    rows, total = A.limited_with_total(a, order, 50)
    placed = R.rank_within(rows.withColumn("g", F.lit("all")), "g", order, "p").select(F.lit("row").alias("kind"), F.col("record_id").alias("key"), F.col("p").cast("bigint").alias("n"))
    return placed.unionByName(total.select(F.lit("total").alias("kind"), F.lit(None).cast("bigint").alias("key"), "n"))



@query(
    f"""WITH r AS (SELECT {s_text("title")} AS t, {s_number("disease_id")} AS id FROM pubmed_selection_audit), d AS (SELECT DISTINCT t, id FROM r WHERE t <> '' AND id IS NOT NULL), g AS (SELECT id, count(*) AS n FROM d GROUP BY 1), m AS (SELECT DISTINCT {s_number("disease_id")} AS id FROM disease_manifest)
    SELECT 'rows' AS part, '' AS key, count(*) AS n FROM r UNION ALL SELECT 'blank', '', count(*) FROM r WHERE t = '' UNION ALL SELECT 'pairs', '', count(*) FROM d UNION ALL SELECT 'repeated', '', (SELECT count(*) FROM r WHERE t <> '' AND id IS NOT NULL) - (SELECT count(*) FROM d)
    UNION ALL SELECT 'frequency', CASE WHEN n <= 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 20 THEN '6-20' ELSE '21+' END, count(*) FROM g GROUP BY 2 UNION ALL SELECT 'labels used', '', count(*) FROM g UNION ALL SELECT 'labels unknown', '', count(*) FROM g ANTI JOIN m USING (id)
    UNION ALL SELECT 'labels unused', '', count(*) FROM m ANTI JOIN g USING (id) WHERE m.id IS NOT NULL UNION ALL (SELECT 'top', CAST(id AS VARCHAR), n FROM g ORDER BY n DESC, id LIMIT 20) UNION ALL (SELECT 'bottom', CAST(id AS VARCHAR), n FROM g ORDER BY n, id LIMIT 20)"""
)
def report_dataset(t: Tables) -> DataFrame:
    """Distribution of a labelled dataset: rows, blanks, distinct pairs, frequencies of labels, coverage of the manifest."""
    r = t.pubmed_selection_audit.select(text_or_empty("title").alias("t"), first_bigint("disease_id").alias("id"))
    d = r.where("t <> '' and id is not null").groupBy("t", "id").agg(F.count("*").alias("k"))
    g = _kept(d.groupBy("id").agg(F.count("*").alias("n"), F.sum("k").alias("k")))  # one row per label
    m = t.disease_manifest.select(first_bigint("disease_id").alias("id")).where("id is not null").distinct()
    part = lambda name, df, key=F.lit(""), n=F.col("n"): df.select(F.lit(name).alias("part"), key.cast("string").alias("key"), n.cast("bigint").alias("n"))
    count = lambda df: df.agg(F.count("*").alias("n"))
    size = F.when(F.col("n") <= 1, "1").when(F.col("n") <= 5, "2-5").when(F.col("n") <= 20, "6-20").otherwise("21+")
    parts = [
        part("rows", count(r)), part("blank", count(r.where("t = ''"))), part("pairs", g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))), part("repeated", g.agg(F.coalesce(F.sum(F.col("k") - F.col("n")), F.lit(0)).alias("n"))),
        part("frequency", g.groupBy(size.alias("s")).agg(F.count("*").alias("n")), F.col("s")), part("labels used", count(g)), part("labels unknown", count(g.join(m, "id", "left_anti"))), part("labels unused", count(m.join(g, "id", "left_anti"))),
        part("top", R.top(g, [F.col("n").desc(), F.col("id").asc()], 20), F.col("id")), part("bottom", R.top(g, [F.col("n").asc(), F.col("id").asc()], 20), F.col("id")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- numbers, pluggable parts, more reports ---------------------------------------------------------------------------

_SCALES = ("1e-9", "1e-7", "1e-5", "0.0001", "0.001", "1.0", "1000.0", "1e7", "1e12", "1e15", "1e18")


@query(f"SELECT event_id, CAST(value * ([{', '.join(f'CAST({x} AS DOUBLE)' for x in _SCALES)}])[event_id % {len(_SCALES)} + 1] AS VARCHAR) AS text FROM events WHERE value IS NOT NULL")
def float_texts(t: Tables) -> DataFrame:
    """Doubles of all sizes in their shortest form."""
    scale = F.element_at(F.array(*[F.lit(float(x)) for x in _SCALES]), (F.col("event_id") % len(_SCALES) + 1).cast("int"))
    return t.events.where("value is not null").select("event_id", text.float_text(F.col("value") * scale).alias("text"))


def _load_counter():
    """Stand-in for a model: characters, words between blanks, and a constant."""
    return lambda texts: [[len(x), len(x.split(" ")), 1.0] for x in texts]


@query(f"SELECT chunk_id, CAST(length(text) AS DOUBLE) AS chars, CAST(len(string_split(text, ' ')) AS DOUBLE) AS words FROM literature_chunk WHERE {s_text('text')} <> ''")
def pluggable_embedding(t: Tables) -> DataFrame:
    """A model of the caller's, loaded once per worker, over all chunks with text."""
    v = V.embed(t.literature_chunk.where(has_value("text")), "chunk_id", "text", _load_counter, 3)
    return v.select("chunk_id", F.col("vector")[0].cast("double").alias("chars"), F.col("vector")[1].cast("double").alias("words"))


_ANSWER = '{"candidates":[{"condition":"%d items","rank":1,"justification":"as given","supporting_evidence":[1]}],"limitations":"none"}'


def _counting_model(prompt: str) -> str:
    return _ANSWER % prompt.count("Evidence ")


def _one_hot_sql(n: str) -> str:
    return f"list_transform(generate_series(1, len(a.embedding)), lambda i: CASE WHEN i = CAST({n} AS BIGINT) % len(a.embedding) + 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


def _hits_sql(side: int) -> str:
    score = f"round(list_cosine_similarity(a.embedding::DOUBLE[], {_one_hot_sql('q.vec_id // 50')}), 12)"
    return f"SELECT q.vec_id AS query_id, a.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY {score} DESC, a.vec_id) AS rank FROM embeddings a, (SELECT vec_id FROM embeddings WHERE vec_id % 50 = 0) q WHERE a.label % 2 = {side}"


@query(
    f"""SELECT query_id, 'success' AS status, count(*) || ' items' AS condition, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY o, rank) AS ids FROM (SELECT 0 AS o, * FROM ({_hits_sql(0)}) UNION ALL SELECT 1, * FROM ({_hits_sql(1)})) WHERE rank <= 3 GROUP BY query_id"""
)
def engine_documents(t: Tables) -> DataFrame:
    """Questions through the whole engine with an embedder and a model of the caller's; the model counts the evidence in its prompt."""
    import json

    size = len(t.embeddings.select("embedding").first()[0]) if not t.embeddings.isEmpty() else 1

    def embed(texts: list[str]) -> list[list[float]]:
        return [[1.0 if i == int(x.split("\n")[0].removeprefix("Diseases: ")) % size else 0.0 for i in range(size)] for x in texts]

    p = t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    contents = t.embeddings.select(F.col("vec_id").alias("content_id"), F.lit("text").alias("content"), F.col("vec_id").cast("string").alias("source"))
    none = F.array().cast("array<string>")
    q = t.embeddings.where("vec_id % 50 = 0").select(
        F.col("vec_id").alias("query_id"), F.lit("cough").alias("clinical_text"), F.array(F.floor(F.col("vec_id") / 50).cast("string")).alias("diseases"), none.alias("symptoms"), none.alias("medications"), none.alias("tests")
    )
    engine = evidence.Engine(p.where("label % 2 = 0"), p.where("label % 2 = 1"), contents, embed, _counting_model, top_k=3)
    document = F.from_json("document", "status string, diagnostic_candidates array<struct<condition string>>, evidence array<struct<source string>>")
    d = engine.analyze(q).select("query_id", document.alias("d"))
    return d.select("query_id", "d.status", F.col("d.diagnostic_candidates")[0]["condition"].alias("condition"), F.array_join(F.transform("d.evidence", lambda e: e["source"]), " ").alias("ids"))


@query(
    f"""SELECT m.id, m.name, CAST(coalesce(p.n, 0) AS BIGINT) AS pairs, CASE WHEN coalesce(p.n, 0) = 0 THEN 'none' WHEN p.n <= 5 THEN 'low' WHEN p.n <= 20 THEN 'moderate' ELSE 'high' END AS coverage
    FROM (SELECT {s_number("disease_id")} AS id, max(disease_name) AS name FROM disease_manifest GROUP BY 1) m LEFT JOIN (SELECT id, count(*) AS n FROM (SELECT DISTINCT {s_number("disease_id")} AS id, {s_text("title")} AS t FROM pubmed_selection_audit WHERE {s_text("title")} <> '') GROUP BY 1) p USING (id) WHERE m.id IS NOT NULL"""
)
def report_manifest(t: Tables) -> DataFrame:
    """Every disease of the manifest with its distinct texts and coverage group."""
    m = t.disease_manifest.groupBy(first_bigint("disease_id").alias("id")).agg(F.max("disease_name").alias("name")).where("id is not null")
    texts = t.pubmed_selection_audit.select(first_bigint("disease_id").alias("id"), text_or_empty("title").alias("t")).where("t <> ''").distinct()
    p = m.join(texts.groupBy("id").agg(F.count("*").alias("pairs")), "id", "left").na.fill(0, ["pairs"])
    return p.select("id", "name", "pairs", A.bucket(F.col("pairs"), [("none", 0, 0), ("low", 1, 5), ("moderate", 6, 20), ("high", 21, None)]).alias("coverage"))


@query(
    f"""SELECT source_file, count(*) AS n_sections, max(length(x)) AS longest, min(length(x)) AS shortest, CAST(sum(1 + greatest(0, CAST(ceil((length(x) - 1000) / 850.0) AS BIGINT))) AS BIGINT) AS n_chunks FROM
    (SELECT source_file, {s_collapsed("s.text")} AS x FROM (SELECT source_file, unnest(list_concat(coalesce(abstract_sections, []), coalesce(body_sections, []))) AS s FROM literature_article)) WHERE x <> '' GROUP BY 1"""
)
def report_xml_sections(t: Tables) -> DataFrame:
    """Sections of article files against their chunks, to find files whose sections or chunks look wrong."""
    a = jats.parsed(jats.parse_files(article_files(t)))
    s = a.select("source_file", F.explode(F.concat("abstract_sections", "body_sections")).alias("s")).groupBy("source_file").agg(F.count("*").alias("n_sections"), F.max(F.length("s.text")).cast("bigint").alias("longest"), F.min(F.length("s.text")).cast("bigint").alias("shortest"))
    return s.join(C.section_chunks(a, ["source_file"]).groupBy("source_file").agg(F.count("*").alias("n_chunks")), "source_file")


_BY_NAME = f"(SELECT lower(x) AS k, pmid FROM (SELECT {s_number('pmid')} AS pmid, unnest({s_list('disease_names')}) AS x FROM pubmed_complete_metadata))"
_BY_ID = f"(SELECT {s_number('x')} AS k, pmid FROM (SELECT {s_number('pmid')} AS pmid, unnest({s_list('disease_ids')}) AS x FROM pubmed_complete_metadata))"


@query(
    f"""WITH m AS (SELECT {s_number("disease_id")} AS id, lower({s_text("disease_name")}) AS name FROM disease_manifest WHERE {s_text("disease_name")} <> ''),
    a AS (SELECT DISTINCT m.id, pmid FROM m JOIN {_BY_NAME} x ON x.k = m.name WHERE pmid IS NOT NULL), b AS (SELECT DISTINCT m.id, pmid FROM m JOIN {_BY_ID} x ON x.k = m.id WHERE pmid IS NOT NULL)
    SELECT id, count(*) FILTER (s = 'name') AS by_name, count(*) FILTER (s = 'id') AS by_id, count(*) FILTER (s = 'both') AS by_both FROM (SELECT id, 'name' AS s FROM a UNION ALL SELECT id, 'id' FROM b UNION ALL SELECT id, 'both' FROM a JOIN b USING (id, pmid)) GROUP BY id"""
)
def report_search_strategies(t: Tables) -> DataFrame:
    """How many articles of each disease three searches find: by name, by id, and by both."""
    m = t.disease_manifest.where(has_value("disease_name")).select(first_bigint("disease_id").alias("id"), F.lower(text_or_empty("disease_name")).alias("name"))
    d = t.pubmed_complete_metadata
    names = J.bridge(d.select(first_bigint("pmid").alias("pmid"), "disease_names"), ["pmid"], "disease_names", "x").select(F.lower("x").alias("name"), "pmid")
    numbers = J.bridge(d.select(first_bigint("pmid").alias("pmid"), "disease_ids"), ["pmid"], "disease_ids", "x").select(first_bigint("x").alias("id"), "pmid")
    found = m.join(names, "name").select("id", "pmid", F.lit(True).alias("n"), F.lit(False).alias("i")).unionByName(m.select("id").join(numbers, "id").select("id", "pmid", F.lit(False).alias("n"), F.lit(True).alias("i")))
    per = found.where("pmid is not null").groupBy("id", "pmid").agg(F.max("n").alias("n"), F.max("i").alias("i"))
    return per.groupBy("id").agg(F.count(F.when(F.col("n"), 1)).alias("by_name"), F.count(F.when(F.col("i"), 1)).alias("by_id"), F.count(F.when(F.col("n") & F.col("i"), 1)).alias("by_both"))


# --- ingestion and choices --------------------------------------------------------------------------------------------


@query(
    f"""SELECT source, count(*) AS n FROM (SELECT source, unnest(list_transform(generate_series(0, greatest(0, CAST(ceil((length(x) - 1000) / 850.0) AS BIGINT)) * 850, 850), lambda i: substr(x, CAST(i + 1 AS BIGINT), 1000))) AS chunk FROM
    (SELECT source, {s_collapsed("s.text")} AS x FROM (SELECT 'abstract' AS source, unnest(abstract_sections) AS s FROM literature_article UNION ALL SELECT 'body', unnest(body_sections) FROM literature_article)) WHERE x <> '') WHERE regexp_matches(lower(chunk), '[a-z0-9]') GROUP BY 1"""
)
def article_ingestion(t: Tables) -> DataFrame:
    """Article files as a stream: parsed, cut into chunks, embedded, and upserted into a collection; a second run adds nothing."""
    folder = S.work_folder(t.spark, "ingestion")
    sinks.write_payloads(article_files(t), f"{folder}/in").count()
    points = Collection(t.spark, folder, "chunks", 64, buckets=8)

    def sink(articles: DataFrame, number: int) -> None:
        c = C.section_chunks(articles, ["source_file"])
        key = {k: F.col(k) for k in ("source_file", "section_no", "chunk_index")}
        c = c.select(V.point_id(key).alias("id"), "chunk_text", payload({"source": F.col("source")} | key).alias("payload"))
        points.upsert(V.hashed_embedding(c, "id", "chunk_text", 64).join(c.select("id", "payload"), "id"))

    def run() -> S.Progress:
        return S.ingest(S.stream_files(t.spark, f"{folder}/in"), jats.parse_files, sink, f"{folder}/state", key="source_file")

    first, again = run(), run()
    if first.failed or again.seen:
        raise AssertionError("files failed, or were read twice")
    return points.read().groupBy(F.get_json_object("payload", "$.source").alias("source")).agg(F.count("*").alias("n"))


@query(f"SELECT {s_number('disease_id')} AS id, disease_name FROM disease_manifest WHERE {s_number('disease_id')} = (SELECT min({s_number('disease_id')}) FROM disease_manifest)")
def single_row_lookup(t: Tables) -> DataFrame:
    """The one row of the least disease id; none or several would be an error."""
    m = t.disease_manifest.select(first_bigint("disease_id").alias("id"), "disease_name")
    least = m.agg(F.min("id")).first()[0]
    return J.exactly_one(m, F.col("id") == least, "disease") if least is not None else m.limit(0)


_CASES = (("with doi", f"{s_text('doi')} <> ''"), ("many sections", "len(coalesce(body_sections, [])) > 5"), ("no pmcid", f"{s_text('pmcid')} = ''"), ("any", "true"))


def _examples_sql() -> str:
    picked, parts = "", []
    for i, (label, condition) in enumerate(_CASES):
        parts.append(f"e{i} AS (SELECT '{label}' AS label, source_file FROM literature_article WHERE {condition}{picked} ORDER BY source_file LIMIT 1)")
        picked += f" AND source_file NOT IN (SELECT source_file FROM e{i})"
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(f"FROM e{i}" for i in range(len(_CASES)))


@query(_examples_sql())
def example_choice(t: Tables) -> DataFrame:
    """For each condition in turn the first article that fulfils it and was not taken before."""
    conditions = [has_value("doi"), F.size(F.coalesce("body_sections", F.array().cast(t.literature_article.schema["body_sections"].dataType))) > 5, ~has_value("pmcid"), F.lit(True)]
    return R.examples(t.literature_article, "source_file", [F.col("source_file")], [(label, c) for (label, _), c in zip(_CASES, conditions)])
