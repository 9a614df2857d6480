"""From a structured question to numbered evidence, a context text, and a validated answer document.

Two collections are searched independently and never ranked against each other; the first one's hits come ahead.
The answering model is a pluggable function; the default one cites the best evidence of each source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import float_text, has_value, location_text
from ..operators import vector as V

SOURCES = ("symptom", "literature")
ANSWER = T.StructType(
    [
        T.StructField(
            "candidates",
            T.ArrayType(
                T.StructType(
                    [T.StructField("condition", T.StringType()), T.StructField("rank", T.IntegerType()), T.StructField("justification", T.StringType()), T.StructField("supporting_evidence", T.ArrayType(T.IntegerType()))]
                )
            ),
        ),
        T.StructField("limitations", T.StringType()),
    ]
)


def query_text(diseases: Column, symptoms: Column) -> Column:
    """Both lines are always there, even if a list is empty."""
    return F.concat(F.lit("Diseases: "), F.array_join(diseases, ", "), F.lit("\nSymptoms: "), F.array_join(symptoms, ", "))


def question_problem() -> Column:
    """What is wrong with a question (clinical_text, diseases, symptoms, medications, tests); null if nothing is."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("diseases", "symptoms", "medications", "tests")]))
    return F.when(~has_value("clinical_text"), "no text").when(F.size(missing) > 0, F.concat(F.lit("no list of "), F.array_join(missing, ", ")))


def check_question(df: DataFrame) -> DataFrame:
    """Rows (clinical_text, diseases, symptoms, medications, tests); a blank text or a missing list is an error when used."""
    p = question_problem()
    return df.withColumn("clinical_text", F.when(p.isNotNull(), F.raise_error(F.concat(F.lit("a question needs a text and four lists: "), p)).cast("string")).otherwise(F.col("clinical_text")))


def retrieve(symptom: DataFrame, literature: DataFrame, query: DataFrame, top_k: int = 5) -> DataFrame:
    """(query_id, evidence_id, source_type, retrieval_rank, content_id, relevance_score)."""
    d = V.dual_top_k(symptom, literature, query, top_k, SOURCES)
    return d.select("query_id", "evidence_id", F.col("source").alias("source_type"), F.col("rank").alias("retrieval_rank"), F.col("id").alias("content_id"), F.col("score").alias("relevance_score"))


def attach_content(rows: DataFrame, contents: DataFrame) -> DataFrame:
    """Adds content, source and location; evidence whose content is gone keeps its number with an empty text."""
    j = rows.join(contents, "content_id", "left")
    page = F.col("page_number") if "page_number" in contents.columns else F.lit(None).cast("int")
    return j.select(
        "query_id", "evidence_id", F.coalesce("content", F.lit("")).alias("content"), F.coalesce("source", F.lit("")).alias("source"), "source_type", location_text(page).alias("location"), "relevance_score", "retrieval_rank"
    )


def evidence_counts(evidence: DataFrame) -> DataFrame:
    """Per query: counts of each source, the total, and the larger of the two counts."""
    s, li = (F.count(F.when(F.col("source_type") == x, 1)) for x in SOURCES)
    return evidence.groupBy("query_id").agg(s.alias("symptom_evidence_count"), li.alias("literature_evidence_count"), F.count("*").alias("total_evidence_count"), F.greatest(s, li).alias("retrieval_top_k"))


def context_text(evidence: DataFrame) -> DataFrame:
    """(query_id, context): two titled parts, six lines per item; other sources are left out; "" if there is nothing.

    A query has at most 2 * top_k rows, so they are gathered whole.
    """
    e = evidence.where(F.col("source_type").isin(*SOURCES))
    item = F.concat(
        F.lit("Evidence "), F.col("evidence_id").cast("string"), F.lit("\nSource: "), F.col("source"), F.lit("\nType: "), F.col("source_type"), F.lit("\nLocation: "), F.col("location"),
        F.lit("\nSimilarity: "), float_text("relevance_score"), F.lit("\nText: "), F.col("content"),
    )
    per = e.select("query_id", F.struct("evidence_id", "source_type", item.alias("item")).alias("x")).groupBy("query_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))

    def part(title: str, source: str) -> Column:
        own = F.transform(F.filter("xs", lambda x: x["source_type"] == source), lambda x: x["item"])
        return F.when(F.size(own) > 0, F.concat(F.lit(f"{title}\n\n"), F.array_join(own, "\n\n")))

    both = F.array_compact(F.array(part("Symptom evidence", SOURCES[0]), part("Literature evidence", SOURCES[1])))
    return per.select("query_id", F.array_join(both, "\n\n").alias("context"))


def prompt(clinical_text: Column, context: Column, system: str = "Answer only from the evidence given and cite it by number.") -> Column:
    return F.concat(F.lit(system + "\n\nQuestion:\n"), clinical_text, F.lit("\n\nEvidence:\n"), context)


def first_evidence_answerer(evidence: DataFrame) -> DataFrame:
    """(query_id, answer): offline stand-in for a model; names the best evidence of each source as JSON."""
    best = evidence.where("retrieval_rank = 1").select("query_id", "evidence_id", "source")
    c = F.struct(F.concat(F.lit("see "), F.col("source")).alias("condition"), F.lit("closest evidence").alias("justification"), F.array("evidence_id").alias("supporting_evidence"))
    per = best.withColumn("c", c).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("evidence_id", "c"))).alias("cs"))
    cand = F.transform("cs", lambda x, i: F.struct(x["c"]["condition"].alias("condition"), (i + 1).alias("rank"), x["c"]["justification"].alias("justification"), x["c"]["supporting_evidence"].alias("supporting_evidence")))
    return per.select("query_id", F.to_json(F.struct(cand.alias("candidates"), F.lit("offline stand-in").alias("limitations"))).alias("answer"))


def answer_with(prompts: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """(query_id, answer, error) of (query_id, prompt) by any function of a text; a failure is a row."""
    import pandas as pd

    def run(frames):
        for pdf in frames:
            rows = []
            for q, p in zip(pdf["query_id"], pdf["prompt"]):
                try:
                    rows.append((q, model(p), None))
                except Exception as e:  # noqa: BLE001 - a failing service is a result
                    rows.append((q, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["query_id", "answer", "error"])

    return prompts.select("query_id", "prompt").mapInPandas(run, "query_id long, answer string, error string")


def parse_answer(answer: Column) -> Column:
    """struct<ok, value, problem>: an object with candidates (texts not blank, whole-number ranks, a list of whole numbers) and limitations.

    Types are those of the JSON values themselves, read as variants: true is no rank, and neither is 1.0 or "1".
    """
    v = F.try_parse_json(answer)
    raw = F.from_json(answer, "candidates array<struct<condition variant, rank variant, justification variant, supporting_evidence variant>>, limitations variant")
    kind = lambda x: F.coalesce(F.schema_of_variant(x), F.lit("VOID"))
    whole_kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("VOID"))
    said = lambda x: (kind(x) == "STRING") & has_value(F.try_variant_get(x, "$", "string"))

    def sound(c: Column) -> Column:
        return said(c["condition"]) & said(c["justification"]) & (kind(c["rank"]) == "BIGINT") & kind(c["supporting_evidence"]).isin("ARRAY<BIGINT>", "ARRAY<VOID>")

    problem = (
        F.when(v.isNull() | ~whole_kind("$").startswith("OBJECT"), "no JSON object")
        .when(~whole_kind("$.candidates").startswith("ARRAY") | raw["candidates"].isNull(), "no candidates")
        .when(~said(raw["limitations"]), "no limitations")
        .when(~F.forall(raw["candidates"], lambda c: F.coalesce(sound(c), F.lit(False))), "a candidate is malformed")
    )
    return F.struct(problem.isNull().alias("ok"), F.from_json(answer, ANSWER).alias("value"), problem.alias("problem"))


def output_contract(questions: DataFrame, evidence: DataFrame, answers: DataFrame, agent: str = "evidence") -> DataFrame:
    """(query_id, document): one JSON document per question; nulls are written, evidence in order of its number."""
    parsed = answers.select("query_id", parse_answer(F.col("answer")).alias("a"))
    e = F.struct("evidence_id", "content", "source", "source_type", "location", "relevance_score", "retrieval_rank")
    known = evidence.withColumn("retrieval_rank", F.when(F.col("source_type").isin(*SOURCES), F.col("retrieval_rank")))
    listed = known.groupBy("query_id").agg(F.array_sort(F.collect_list(e)).alias("evidence"))
    counts = evidence_counts(evidence)
    q = check_question(questions).join(listed, "query_id", "left").join(counts, "query_id", "left").join(parsed, "query_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
    doc = F.struct(
        F.lit(agent).alias("agent"),
        F.when(F.col("a.ok"), "success").otherwise("error").alias("status"),
        F.struct("clinical_text", "diseases", "symptoms", "medications", "tests", F.array().cast("array<string>").alias("procedures")).alias("query_context"),
        F.coalesce(F.col("a.value.candidates"), F.array().cast(ANSWER["candidates"].dataType)).alias("diagnostic_candidates"),
        F.coalesce("evidence", F.array().cast(listed.schema["evidence"].dataType)).alias("evidence"),
        F.struct(*[zero(c) for c in ("symptom_evidence_count", "literature_evidence_count", "total_evidence_count", "retrieval_top_k")]).alias("metadata"),
        F.col("a.value.limitations").alias("limitations"),
        F.when(~F.coalesce(F.col("a.ok"), F.lit(False)), F.coalesce("a.problem", F.lit("no answer"))).alias("error"),
    )
    return q.select("query_id", F.to_json(doc, {"ignoreNullFields": "false"}).alias("document"))


def renumber(rows: DataFrame) -> DataFrame:
    """Evidence numbers from 1 per query by (source, rank)."""
    o = F.when(F.col("source_type") == SOURCES[0], 0).otherwise(1)
    return rows.withColumn("evidence_id", F.row_number().over(Window.partitionBy("query_id").orderBy(o, "retrieval_rank")))


class Engine:
    """Question in, answer document out, from injected parts.

    embed(texts) -> vectors; collections are (id, vector) with contents (content_id, content, source); model is a
    function of a prompt.
    """

    def __init__(self, symptom: DataFrame, literature: DataFrame, contents: DataFrame, embed: Callable[[list[str]], list[list[float]]], model: Callable[[str], str] | None = None, top_k: int = 5):
        V.check_top_k(top_k)
        self.symptom, self.literature, self.contents, self.embed, self.model, self.top_k = symptom, literature, contents, embed, model, top_k

    def analyze(self, questions: DataFrame) -> DataFrame:
        """(query_id, document) of (query_id, clinical_text, diseases, symptoms, medications, tests); questions are few and asked together."""
        asked = check_question(questions).select("query_id", query_text(F.col("diseases"), F.col("symptoms")).alias("t")).collect()
        vectors = self.embed([r["t"] for r in asked]) if asked else []
        q = questions.sparkSession.createDataFrame([(r["query_id"], [float(x) for x in v]) for r, v in zip(asked, vectors)], "query_id long, vector array<float>")
        evidence = attach_content(retrieve(self.symptom, self.literature, q, self.top_k), self.contents)
        if self.model is None:
            answers = first_evidence_answerer(evidence)
        else:
            p = questions.join(context_text(evidence), "query_id", "left").select("query_id", prompt(F.col("clinical_text"), F.coalesce("context", F.lit(""))).alias("prompt"))
            answers = answer_with(p, self.model).select("query_id", "answer")
        return output_contract(questions, evidence, answers)
