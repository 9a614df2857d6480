import json

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.operators import json_arrays as J
from corpusloom.operators import nested

scalars = st.one_of(st.none(), st.booleans(), st.integers(-(10**6), 10**6), st.floats(allow_nan=False, allow_infinity=False), st.text(alphabet='ab"\\/{}[],:\n\té😀 ', max_size=6))
values = st.recursive(scalars, lambda v: st.one_of(st.lists(v, max_size=4), st.dictionaries(st.sampled_from(["secs", "text", "p", 'q"', "é"]), v, max_size=4)), max_leaves=20)


def is_json(b: bytes) -> bool:
    def reject(token):
        raise ValueError(token)

    try:
        json.loads(b.decode(), parse_constant=reject)
    except ValueError:
        return False
    return True


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(values, st.integers(0, 200), st.sampled_from(list('{}[]:,"\\ 1etn\n-.') + [""])), min_size=1, max_size=5), st.booleans())
def test_valid_is_what_the_grammar_says(docs, ascii_only):
    texts = []
    for v, at, put in docs:
        t = json.dumps(v, ensure_ascii=ascii_only)
        texts += [t.encode(), (t[: at % (len(t) + 1)] + put + t[at % (len(t) + 1) + 1 :]).encode()]
    assert J.Documents(texts).valid.tolist() == [is_json(t) for t in texts]


def test_cases_of_the_grammar():
    good = ['{"a":[1,2,{}]}', " [ ] ", '"x"', "-1.5e+3", "true", '{"a":1,"a":2}', '["\\u00e9\\\\"]', '"\\\\"']
    bad = ["", " ", "{", "[1,]", '{"a"}', '{"a":}', '{,}', "01", "1.", "nul", "NaN", '"a', '"\\x"', '"\\u12g4"', "[1 2]", '{"a":1 "b":2}', "[}", "{]", "1 2", "]", '"a\nb"', '{"a":1,}', "[,1]", "{1:2}", "\\", '[1]]', "﻿[]"]
    assert J.Documents([t.encode() for t in good + bad]).valid.tolist() == [True] * len(good) + [False] * len(bad)


def plain_text(x):
    if isinstance(x, (str, int, float)) and not isinstance(x, bool):
        return x if isinstance(x, str) else json.dumps(x)
    if isinstance(x, list):
        return "\n".join(t for t in map(plain_text, x) if t) or None
    if isinstance(x, dict):
        return next((t for k in ("text", "value", "p", "title", "caption") if (t := plain_text(x.get(k))) is not None), None)
    return None


@settings(max_examples=300, deadline=None)
@given(st.lists(values, min_size=1, max_size=5))
def test_members_entries_and_texts(docs):
    d = J.Documents([json.dumps(v).encode() for v in docs])
    assert d.texts(d.roots) == [plain_text(v) for v in docs]
    got = d.texts(d.get(d.roots, "p"))
    assert got == [plain_text(v.get("p")) if isinstance(v, dict) else None for v in docs]
    row, entry = d.items(d.roots)
    want = [(i, plain_text(x)) for i, v in enumerate(docs) for x in ([] if v is None else v if isinstance(v, list) else [v])]
    assert list(zip(row.tolist(), d.texts(entry))) == want


def test_a_hundred_thousand_levels(spark):
    n = 100_000
    deep = '{"article":{"body":{"secs":' + '{"p":"x","secs":[' * n + "]}" * n + "}}}"
    odd = deep.replace('"x"', '"' + "[" * 10 + '"', 1)
    df = spark.createDataFrame([("deep", deep), ("odd", odd), ("broken", deep[:-1])], "source_file string, record string")
    got = nested.sections_of_records(df).groupBy("source_file").agg(F.max("section_no"), F.max("parent_no")).collect()
    assert {tuple(r) for r in got} == {("deep", n, n - 1), ("odd", n, n - 1)}
    assert [tuple(r) for r in nested.failed_records(df).collect()] == [("broken", "invalid")]
    parts = np.array([r.section_no for r in nested.parts_of_records(df.limit(1)).collect()])
    assert len(parts) == n


def test_failures_have_their_reason(spark):
    df = spark.createDataFrame([("a", None), ("b", " "), ("c", "[1]"), ("d", "{x"), ("e", "{}")], "source_file string, record string")
    assert {tuple(r) for r in nested.failed_records(df).collect()} == {("a", "missing"), ("b", "missing"), ("c", "no object"), ("d", "invalid")}
    assert nested.articles_of_records(df).count() == 1
