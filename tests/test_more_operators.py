"""Collections in buckets, swaps, numbering, balanced selection, set relations, number texts and response kinds."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import aggregates as A
from corpusloom.operators import joins as J
from corpusloom.operators import ranking as R
from corpusloom.operators import vector as V
from corpusloom.plans import evidence
from corpusloom.sources import records, sinks
from corpusloom.sources.vectors import Collection, check_target, payload


def points(spark, ids, value=1.0):
    return spark.createDataFrame([(str(i), [value, float(i)], f"p{value}") for i in ids], "id string, vector array<float>, payload string")


def test_upserts_touch_only_their_buckets(spark, tmp_path):
    c = Collection(spark, str(tmp_path), "c", 2, buckets=4)
    assert c.upsert(points(spark, range(40))) == 40 and c.read().count() == 40
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("c/bucket=*/*.parquet")}
    assert c.upsert(points(spark, [7], 2.0)) == 1 and c.read().count() == 40
    after = {p: p.stat().st_mtime_ns for p in tmp_path.glob("c/bucket=*/*.parquet")}
    assert len(set(before.items()) & set(after.items())) == 3 and len(before) == len(after) == 4
    assert [r.payload for r in c.lookup(["7", "nowhere"]).collect()] == ["p2.0"] and c.lookup([]).count() == 0
    assert c.lookup_all(spark.createDataFrame([("7",), ("8",), ("7",), (None,)], "id string")).count() == 2
    again = Collection(spark, str(tmp_path), "c", 2, buckets=4)
    assert again.upsert(points(spark, [])) == 0 and again.inspect().first().n == 40
    with pytest.raises(ValueError, match="repeat"):
        c.upsert(points(spark, [1, 1]))
    with pytest.raises(ValueError, match="dimensions"):
        c.upsert(spark.createDataFrame([("1", [1.0], "")], "id string, vector array<float>, payload string"))
    for bad in (("d", 2, ()), ("c", 3, ()), ("c", 2, ("c",))):
        with pytest.raises(ValueError):
            check_target(c, *bad)


def test_payload_keeps_nulls_and_sorts_keys(spark):
    row = spark.range(1).select(payload({"b": F.lit(1), "a": F.lit(None).cast("string")}, {"m": {"z": F.lit(2), "y": F.lit("é")}}).alias("p")).first()
    assert row.p == '{"a":null,"b":1,"m":{"y":"é","z":2}}'


def test_a_swap_that_broke_off_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t._old")
    assert sinks.current_table(spark, path).count() == 3
    sinks.replace_table(spark.range(5), path)
    assert sinks.current_table(spark, path).count() == 5
    with pytest.raises(ValueError):
        sinks.replace_table(spark.range(1), path, lambda df: (_ for _ in ()).throw(ValueError("no")))
    assert sinks.current_table(spark, path).count() == 5


def test_places_in_an_order_over_partitions(spark):
    values = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(v, "x") for v in values], "v int, _i string").repartition(7).drop("_i")
    got = {r.v: r.n for r in R.numbered(df, [F.col("v").desc()], "n").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values, reverse=True))}
    assert R.numbered(df.limit(0), [F.col("v")], "n").count() == R.evenly_spaced(df.limit(0), [F.col("v")]).count() == 0


def balanced(items, n):
    left, held, seen, out = dict(items), {}, set(), []
    while len(out) < n:
        best = min(((held.get(x, 0), x, f in seen, -y, i) for i, (labels, f, y) in left.items() for x in labels), default=None)
        if best is None:
            return out
        labels, f, _ = left.pop(best[4])
        out.append((best[4], best[1]))
        seen.add(f)
        for x in labels:
            held[x] = held.get(x, 0) + 1
    return out


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.tuples(st.sets(st.sampled_from("abc"), max_size=3), st.sampled_from("fg"), st.integers(0, 3)), max_size=20))
def test_balanced_selection_against_a_plain_loop(spark, items):
    df = spark.createDataFrame([(1, i, sorted(ls), f, y) for i, (ls, f, y) in items.items()], "g int, i int, l array<string>, f string, y int")
    got = R.greedy_balanced(df, "g", "i", "l", "f", [("y", True)], 6).orderBy("place").collect()
    assert [(r.i, r.label) for r in got] == balanced(items, 6)


def test_set_relations(spark):
    of = lambda *v: spark.createDataFrame([(x,) for x in v], "k int")
    assert tuple(J.set_relation(of(1, 1, 2, None), of(2, 1), "k").first()) == (True, True, True, False)
    assert tuple(J.set_relation(of(1), of(1, 3), "k").first()) == (False, True, False, False)
    assert tuple(J.set_relation(of(), of(), "k").first()) == (True, True, True, True)


def test_float_text_is_the_shortest(spark):
    values = [0.0, -0.0, 1.0, 0.1, 1e-4, 9.999e-5, 1e-5, -2.5e-7, 123456789.0, 1e15, 1e16, 7.000000000000001e16, 1.5e300, 5e-324, 3.0000000000000004, float("inf"), float("-inf"), float("nan"), None]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(text.float_text("v").alias("t")).collect()
    assert [r.t for r in got] == [None if v is None else repr(v) for v in values]


def test_case_folding(spark):
    words = ["Straße", "STRASSE", "Σίσυφος", "ΣΊΣΥΦΟΣ", "ﬁne", "plain", "", None]
    got = [r.t for r in spark.createDataFrame([(w,) for w in words], "w string").select(text.casefold("w").alias("t")).collect()]
    assert got == [w.casefold() if w is not None else None for w in words]


def test_merged_cells_keep_the_first_place_of_each_value(spark):
    rows = [(1, 2, "b|a", "7"), (1, 1, "a|c|a", "x"), (None, 3, "z|y", None), (None, 4, "y|w", "5"), (2, 5, None, None)]
    df = spark.createDataFrame(rows, "k int, s int, d string, r string")
    assert {tuple(r) for r in A.merge_packed(df, "k", {"d": "|"}, "s", "r").collect()} == {(1, "a|c|b", 7), (None, "z|y|w", 5), (2, "", None)}


def test_near_ties_are_settled_by_id_in_any_partitioning(spark):
    data = [(i, [1.0, 1e-9 * (i % 3)]) for i in range(60)]
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, vector array<double>")
    for parts in (1, 7):
        df = spark.createDataFrame(data, "id int, vector array<double>").repartition(parts)
        assert [r.id for r in V.cosine_top_k(df, q, 5, tile=16).orderBy("rank").collect()] == [0, 1, 2, 3, 4]


def test_response_kinds(spark):
    article = b"<S><PubmedArticle><MedlineCitation><PMID>5</PMID></MedlineCitation></PubmedArticle><PubmedBookArticle><PMID>6</PMID></PubmedBookArticle><X><PMID>7</PMID></X></S>"
    df = spark.createDataFrame([("a", p, article) for p in ("5", "6", "7", "8")] + [("b", "5", b"<S>")], "source_file string, pmid string, content binary")
    assert [r.kind for r in records.classify_responses(df).orderBy("source_file", "pmid").collect()] == ["article", "book", "other", "not_found", "invalid"]


def test_question_problems(spark):
    df = spark.sql("select '' as clinical_text, array('a') as diseases, array('b') as symptoms, array('c') as medications, array('d') as tests union all select 'x', null, array('b'), null, array('d') union all select 'x', array(), array(), array(), array()")
    assert [r.p for r in df.select(evidence.question_problem().alias("p")).collect()] == ["no text", "no list of diseases, medications", None]
