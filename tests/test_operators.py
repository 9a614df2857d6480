import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry

from corpusloom.operators import aggregates as A
from corpusloom.operators import chunking as C
from corpusloom.operators import joins as J
from corpusloom.operators import ranking as R
from corpusloom.operators import vector as V
from corpusloom.plans import evidence


def fixed(t, size, overlap):
    out, s = [], 0
    while True:
        out.append(t[s : s + size])
        if s + size >= len(t):
            return out
        s += size - overlap


def packed(t, size, overlap):
    import re

    ps = [p.strip() for p in re.split(r"\n\s*\n+", t.replace("\r\n", "\n").replace("\r", "\n").strip())]
    out, cur = [], ""
    for p in filter(None, ps):
        if len(p) > size:
            out += [cur] * bool(cur) + fixed(p, size, overlap)
            cur = ""
        elif cur and len(cur) + 2 + len(p) <= size:
            cur += "\n\n" + p
        else:
            out += [cur] * bool(cur)
            cur = p
    return out + [cur] * bool(cur)


TEXTS = ["abcdefghij", "hello world", "", "  ", None, "a" * 2800, "x" * 1850, "p" * 400 + "\n\n" + "q" * 450 + "\n \n" + "r" * 300, "😀" * 1200, "a\r\n\r\nb\r\rc", " lead\n\n" + "y" * 1001]


@pytest.mark.parametrize(("size", "overlap"), [(4, 2), (5, 1), (1000, 150), (1000, 0)])
def test_chunks(spark, size, overlap):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = {}
    for r in C.fixed_chunks(df, ["i"], "t", size, overlap).orderBy("i", "chunk_index").collect():
        got.setdefault(r.i, []).append(r.chunk_text)
    assert got == {i: fixed(t, size, overlap) for i, t in enumerate(TEXTS) if t and t.strip()}
    got = {r.i: r.c for r in df.where("trim(t) <> ''").select("i", C.packed_paragraphs(F.col("t"), size, overlap).alias("c")).collect()}
    assert got == {i: packed(t, size, overlap) for i, t in enumerate(TEXTS) if t and t.strip()}


@pytest.mark.parametrize(("size", "overlap"), [(0, 0), (5, 5), (5, -1), (True, 0)])
def test_bad_sizes(size, overlap):
    with pytest.raises(ValueError):
        C.check_size(size, overlap)


def test_section_chunks(spark):
    sec = "struct<title:string,text:string,section_path:array<string>,source:string>"
    a = [("A", "x" * 1200, ["A"], "abstract"), ("blank", " ", ["b"], "abstract")]
    df = spark.createDataFrame([(1, a, [("B", "y" * 1200, ["B"], "body")]), (2, None, None), (3, None, [("C", "z", ["C"], "body")])], f"i int, abstract_sections array<{sec}>, body_sections array<{sec}>")
    got = [(r.i, r.section_title, r.chunk_index, len(r.chunk_text)) for r in C.section_chunks(df, ["i"], 500, 100).orderBy("i", "section_no", "chunk_index").collect()]
    assert got == [(1, "A", 0, 500), (1, "A", 1, 500), (1, "A", 2, 400), (1, "B", 0, 500), (1, "B", 1, 500), (1, "B", 2, 400), (3, "C", 0, 1)]


def two_piece(texts):
    """Words between blanks; "compound" has two tokens of one word."""
    out = []
    for t, toks in zip(texts, C.blank_tokens(texts)):
        row = []
        for b, e, w in toks:
            row += [(b, b + 4, w), (b + 4, e, w)] if t[b:e] == "compound" else [(b, e, w)]
        out.append(row)
    return out


def test_windows(spark):
    texts = [" ".join(["w"] * n) for n in (98, 99, 196, 197, 803)] + [" ".join(["w"] * 97 + ["compound", "tail"]), "  lead  and trail \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    want = [1, 2, 2, 3, 9, 2, 1]
    for w in (C.token_windows(df.where("i <> 5"), ["i"], "t", 98), C.tokenizer_windows(df, ["i"], "t", two_piece, 98)):
        got = {}
        for r in w.orderBy("i", "window_index").collect():
            got.setdefault(r.i, []).append(r)
        for i, rs in got.items():
            assert len(rs) == want[i] == rs[0].window_count and "".join(r.window_text for r in rs) == texts[i]
    assert got[5][0].window_text.split()[-1] == "w" and got[5][0].n_tokens == 97
    with pytest.raises(Exception, match="single word"):
        C.tokenizer_windows(spark.createDataFrame([(1, "compound")], "i int, t string"), ["i"], "t", two_piece, 1).collect()


def test_cosine_ties_zero_vectors_and_dimensions(spark):
    pts = [(5, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0]), (1, [-1.0, 0.0]), (2, None), (6, [1.0]), (7, [1.0, 1.0])]
    p = spark.createDataFrame(pts, "id long, vector array<float>").repartition(3)
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (None, [1.0, 1.0])], "query_id long, vector array<float>")
    for block in (2000, 1):
        got = {}
        for r in V.cosine_top_k(p, q, 3, block=block).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.id, round(r.score, 6)))
        assert got == {1: [(3, 1.0), (5, 1.0), (7, 0.707107)], 2: [(1, 0.0), (3, 0.0), (4, 0.0)]}
    assert V.cosine_top_k(p.limit(0), q, 3).count() == V.cosine_top_k(p, q.limit(0), 3).count() == 0
    for k in (0, True, 1.5):
        with pytest.raises(ValueError):
            V.cosine_top_k(p, q, k)


def test_cosine_against_numpy(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(400, 8)).astype(np.float32)
    p = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, vector array<float>").repartition(5)
    q = p.where("id % 50 = 0").select(F.col("id").alias("query_id"), "vector")
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    want = {(i, int(j)) for i in range(0, 400, 50) for j in np.argsort(-(u @ u[i]), kind="stable")[:7]}
    assert {(r.query_id, r.id) for r in V.cosine_top_k(p, q, 7).collect()} == want


def test_embedding(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "i long, t string")
    got = {r.i: r.vector for r in V.embed(df, "i", "t", lambda: lambda x: [[float(len(t)), 1.0] for t in x], 2, batch=1).collect()}
    assert got == {1: [3.0, 1.0], 2: [1.0, 1.0]}
    for bad, load in ((df.select("i", F.lit(" ").alias("t")), lambda: lambda x: [[1.0, 1.0]] * len(x)), (df, lambda: lambda x: [[1.0]] * len(x))):
        with pytest.raises(Exception, match="blank|model gave"):
            V.embed(bad, "i", "t", load, 2).collect()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.lists(st.sampled_from("abc"), max_size=3), st.integers(2000, 2004)), max_size=25))
def test_greedy_diverse_against_a_plain_loop(spark, data):
    data = list({(g, i): (g, i, sorted(set(c)), y) for g, i, c, y in data}.values())
    df = spark.createDataFrame(data, "g long, i long, c array<string>, y int")
    want = set()
    for g in {d[0] for d in data}:
        rest, covered = [d for d in data if d[0] == g], set()
        for place in range(1, 4):
            if rest:
                best = min(rest, key=lambda d: (-len(set(d[2]) - covered), -d[3], d[1]))
                want.add((g, best[1], place, len(set(best[2]) - covered)))
                covered |= set(best[2])
                rest.remove(best)
    assert {tuple(r) for r in R.greedy_diverse(df, "g", "i", "c", [("y", True)], 3).collect()} == want


def test_joins_that_must_not_lose_rows(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (None, "z")], "k int, v string")
    d = spark.createDataFrame([(1, "one"), (2, None)], "k int, name string")
    assert {(r.k, r.n) for r in J.lookup(a.where("k is not null"), d, "k", "k", "name", "n").collect()} == {(1, "one"), (2, None)}
    with pytest.raises(Exception, match="unknown k"):
        J.lookup(a, d, "k", "k", "name", "n").collect()
    with pytest.raises(Exception, match="no facts"):
        J.attach_all(a.where("k = 1").unionByName(a.selectExpr("9 as k", "v").limit(1)), d, "k", ["name"]).collect()
    with pytest.raises(ValueError, match="several"):
        J.exactly_one(a, F.lit(True), "row")
    assert J.exactly_one(a, F.col("k") == 1, "row").count() == 1


def test_aggregates_of_empty_tables(spark):
    e = spark.createDataFrame([], "k string, v string, n int")
    assert A.completeness(e, ["k"]).where("share > 0").count() == 0 and A.duplicates(e, "k").first().total == 0
    assert A.skew(e, "n", "k").first().top_decile_share == 0.0 and A.keep_first(e, ["k"], "n").count() == 0
    assert A.count_buckets(e, F.col("n"), [("a", 0, 5)]).first().n == 0 and R.evenly_spaced(e, [F.col("n")]).count() == 0
    with pytest.raises(ValueError):
        R.first_of(e, [F.col("n")], 1)


def test_merge_keeps_first_occurrence(spark):
    df = spark.createDataFrame([(1, 2, "b|a", "q2", "x"), (1, 1, "a | c", "q1 || q2", "7"), (2, 1, None, "", "3")], "k int, s int, d string, q string, r string")
    assert sorted(tuple(r) for r in A.merge_packed(df, "k", {"d": "|", "q": "||"}, "s", "r").collect()) == [(1, "a|c|b", "q1||q2", 7), (2, "", "", 3)]


def engine(spark, model=None):
    s = spark.createDataFrame([(i, [1.0, i / 10]) for i in range(8)], "id long, vector array<double>")
    li = spark.createDataFrame([(i, [i / 10, 1.0]) for i in range(100, 107)], "id long, vector array<double>")
    c = spark.createDataFrame([(i, f"text {i}", f"S{i}") for i in [*range(8), *range(100, 106)]], "content_id long, content string, source string")
    return evidence.Engine(s, li, c, lambda texts: [[1.0, 0.2] for _ in texts], model, 5)


QUESTION = "query_id long, clinical_text string, diseases array<string>, symptoms array<string>, medications array<string>, tests array<string>"


def ask(spark, e, text="cough"):
    return json.loads(e.analyze(spark.createDataFrame([(1, text, ["flu"], ["cough", "fever"], [], [])], QUESTION)).first().document)


def test_answer_document(spark):
    doc = ask(spark, engine(spark))
    assert doc["status"] == "success" and doc["error"] is None and doc["query_context"]["procedures"] == []
    assert [x["evidence_id"] for x in doc["evidence"]] == list(range(1, 11)) and [x["retrieval_rank"] for x in doc["evidence"]] == [1, 2, 3, 4, 5] * 2
    assert {x["source_type"] for x in doc["evidence"][:5]} == {"symptom"}
    assert doc["metadata"] == {"symptom_evidence_count": 5, "literature_evidence_count": 5, "total_evidence_count": 10, "retrieval_top_k": 5}
    cited = {i for c in doc["diagnostic_candidates"] for i in c["supporting_evidence"]}
    assert cited <= {x["evidence_id"] for x in doc["evidence"]}


@pytest.mark.parametrize(
    "answer",
    ["no json", "{}", '{"candidates": [], "limitations": " "}', '{"candidates": [{"condition": "x", "rank": true, "justification": "j", "supporting_evidence": [1]}], "limitations": "l"}',
     '{"candidates": [{"condition": " ", "rank": 1, "justification": "j", "supporting_evidence": [1]}], "limitations": "l"}', '{"candidates": [{"condition": "x", "rank": 1, "justification": "j", "supporting_evidence": ["1"]}], "limitations": "l"}'],
)
def test_malformed_answers_are_errors(spark, answer):
    doc = ask(spark, engine(spark, lambda p: answer))
    assert doc["status"] == "error" and doc["error"]


def test_model_sees_the_context(spark):
    good = '{"candidates": [{"condition": "flu", "rank": 1, "justification": "j", "supporting_evidence": [1, 6]}], "limitations": "few"}'
    doc = ask(spark, engine(spark, lambda p: good if "Question:\ncough" in p and "Evidence 10\n" in p and "Literature evidence" in p else "?"))
    assert doc["diagnostic_candidates"][0]["supporting_evidence"] == [1, 6] and doc["limitations"] == "few"

    def broken(p):
        raise OSError("down")

    assert ask(spark, engine(spark, broken))["status"] == "error"
    with pytest.raises(Exception, match="question needs"):
        ask(spark, engine(spark), " ")


def test_examples_take_each_row_once(spark):
    df = spark.createDataFrame([(i, i % 2, i % 3) for i in range(1, 10)], "k int, a int, b int")
    got = R.examples(df, "k", [F.col("k")], [("even", F.col("a") == 0), ("any", F.lit(True)), ("all", F.lit(True)), ("never", F.col("a") == 7)])
    assert {(r.label, r.k) for r in got.collect()} == {("even", 2), ("any", 1), ("all", 3)}


def test_merged_maps_and_funnel(spark):
    from corpusloom.functions import text

    df = spark.sql("select map('a', '1', 'b', '2') as x, map('b', '3') as y, cast(null as map<string,string>) as z")
    assert df.select(text.merge_maps(F.col("x"), F.col("y"), F.col("z")).alias("m")).first().m == {"a": "1", "b": "3"}
    f = A.funnel(spark.range(10), [("even", F.col("id") % 2 == 0), ("unknown", F.lit(None).cast("boolean")), ("rest", F.lit(True))])
    assert [(r.stage, r.n) for r in f.collect()] == [(0, 10), (1, 5), (2, 0), (3, 0)]
    rows, total = A.limited_with_total(spark.range(10), [F.col("id")], 3)
    assert rows.count() == 3 and total.first().n == 10


def test_evidence_is_there_for_every_search(spark, folder):
    every = entry.queries()
    ids = {r.vec_id for r in spark.read.parquet(f"{folder}/embeddings.parquet").where("vec_id % 50 = 0").select("vec_id").collect()}
    assert len(ids) > 1
    contexts = {r.query_id: r.context for r in every["evidence_context"](spark, folder).collect()}
    documents = {r.query_id: json.loads(r.document) for r in every["output_contract"](spark, folder).collect()}
    rows = [r.asDict() for r in every["evidence_batch_numbering"](spark, folder).collect()]
    assert set(contexts) == set(documents) == {r["query_id"] for r in rows} == ids
    for q in ids:
        own = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["evidence_id"])
        assert [r["evidence_id"] for r in own] == list(range(1, 11)) == [e["evidence_id"] for e in documents[q]["evidence"]]
        assert contexts[q].count("\nSimilarity: ") == 10 and documents[q]["status"] == "success"
    one = every["evidence_numbering"](spark, folder).collect()
    key = lambda r: r["evidence_id"]
    assert sorted((r.asDict() for r in one), key=key) == sorted(({k: v for k, v in r.items() if k != "query_id"} for r in rows if r["query_id"] == 0), key=key)
