import json

from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
import pyarrow as pa

from corpusloom.operators import nested
from corpusloom.plans import training
from tests import brute


def test_whole_tables(spark, folder, rows):
    got = sorted(tuple(r) for r in training.p2_found(spark, folder).collect())
    want = [(r["source_file"], a, b) for r in rows("literature_article", ["source_file", "body_sections"]) for a, b in brute.path_sections([s["section_path"] for s in r["body_sections"] or []])]
    want += [(r["source_file"], a, b) for r in rows("literature_raw") for a, b in brute.record_sections(r["record"])]
    assert got == sorted(want) and len(got) > 50


paths = st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["A", " a ", "B", "b  c", "B C", None, ""]), max_size=4)), max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(paths, max_size=4))
def test_path_parents_against_brute_force(articles):
    flat = [p for a in articles for p in a]
    owner = np.repeat(np.arange(len(articles)), [len(a) for a in articles])
    got = nested.path_parents(owner, nested._numbers(owner), pa.array(flat, pa.list_(pa.string())))
    want = [parent for a in articles for _, parent in brute.path_sections(a)]
    assert got.tolist() == want


def record(secs):
    return json.dumps({"article": {"front": {"title": "t", "ids": [{"type": "pmc", "value": "PMC7"}]}, "body": {"secs": secs}}})


def test_shapes_of_secs(spark):
    child = {"title": "c", "secs": None}
    data = [
        ("one", record({"title": "a", "secs": child})),
        ("array", record([{"secs": [child, "text", None, 5, child]}, {}])),
        ("encoded", record(json.dumps([{"secs": json.dumps(child)}]))),
        ("bad", record([{}])[:-3]),
        ("null", None),
        ("empty", ""),
        ("number", "12"),
        ("nan", '{"article": {"body": {"secs": [{"n": NaN}]}}}'),
        ("nobody", '{"article": {"front": {}}}'),
        ("decoy", record([{"note": {"secs": [child]}, "figs": [{"secs": child}]}])),
    ]
    df = spark.createDataFrame(data, "source_file string, record string")
    got = sorted(tuple(r) for r in nested.sections_of_records(df).collect())
    want = [("array", 1, 0), ("array", 2, 1), ("array", 3, 1), ("array", 4, 0), ("decoy", 1, 0), ("encoded", 1, 0), ("encoded", 2, 1), ("one", 1, 0), ("one", 2, 1)]
    assert got == want


def test_deep_records_need_no_recursion(spark):
    node = {"title": "leaf"}
    for _ in range(300):
        node = {"secs": node}
    df = spark.createDataFrame([("deep", record(node))], "source_file string, record string")
    assert nested.sections_of_records(df).selectExpr("max(section_no)", "max(parent_no)").first() == (301, 300)


def test_parts_and_articles(spark):
    df = spark.createDataFrame([("f", record([{"title": "T", "label": "1", "p": ["x", {"text": "y"}], "figs": [{"caption": {"text": "cap"}}], "note": {"type": "sec"}}]))], "source_file string, record string")
    assert [tuple(r)[1:] for r in nested.parts_of_records(df).collect()] == [(1, 1, "title", "T"), (1, 2, "label", "1"), (1, 3, "p", "x"), (1, 4, "p", "y"), (1, 5, "figs", "cap")]
    a = nested.articles_of_records(df).first()
    assert (a.pmcid, a.title, a.n_refs) == ("PMC7", "t", 0)


def test_empty_tables(spark):
    schema = "source_file string, body_sections array<struct<title:string,text:string,section_path:array<string>>>"
    assert nested.sections_by_path(spark.createDataFrame([], schema)).count() == 0
    some = spark.createDataFrame([("a", None), ("b", []), ("c", [None, ("t", None, ["X"]), ("t", "x\n\ny", ["x", "Y"])])], schema)
    assert sorted(tuple(r) for r in nested.sections_by_path(some).collect()) == [("c", 1, 0), ("c", 2, 0), ("c", 3, 2)]
    assert nested.parts_by_path(some).count() == 4
    assert nested.sections_of_records(spark.createDataFrame([], "source_file string, record string")).count() == 0


def test_body_claims(spark, folder):
    v = {r.verdict: r.n for r in training.p2_body_claims(spark, folder).groupBy("verdict").count().withColumnRenamed("count", "n").collect()}
    assert set(v) <= {"agrees", "contradicts", "unclaimed", "unknown"} and sum(v.values()) > 0
