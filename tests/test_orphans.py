import datetime as dt
import random
from collections import defaultdict

import pytest

from corpusloom.operators.orphans import Reference, find_orphans, orphans_by_month
from corpusloom.plans import training
from tests import brute


def targets(rows, field, begin, end):
    out = defaultdict(list)
    for r in rows:
        if (n := brute.number(r[field])) is not None:
            out[n].append((r[begin], r[end]))
    return out


def test_whole_tables(spark, folder, rows):
    m, d = rows("pubmed_complete_metadata"), rows("disease_manifest")
    by = {"pmid": targets(m, "pmid", "ingested_at", "withdrawn_at"), "pmcid": targets(m, "pmcid", "ingested_at", "withdrawn_at"), "disease_id": targets(d, "disease_id", "added_at", "retired_at")}
    want = set()
    for table, fields, at in (("pubmed_fulltext_manifest", ["pmcid"], "created_at"), ("pubmed_selection_audit", ["pmid", "disease_id"], "selected_at")):
        for r in rows(table):
            for f in fields:
                n = brute.number(r[f])
                if n is not None and (why := brute.orphan_reason(r[at], by[f].get(n))):
                    want.add((table, f, r["record_id"], why))
    got = [tuple(r) for r in training.p3_found(spark, folder).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


REFS, TARGETS = "record_id long, ref string, at timestamp, begin string, t long", "id string, begin timestamp, end timestamp, record_id long, at string"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def reference(spark, refs, tgts):
    r = spark.createDataFrame([(i, k, None if t is None else day(t), "x", 1) for i, (k, t) in enumerate(refs)], REFS)
    t = spark.createDataFrame([(k, None if b is None else day(b), None if e is None else day(e), 7, "y") for k, b, e in tgts], TARGETS)
    return Reference("refs", r, "ref", "at", t, "targets", "id", "begin", "end")


@pytest.mark.parametrize("partitions", [1, 7])
def test_a_hot_key_over_many_partitions(spark, partitions):
    rnd = random.Random(3)
    keys = ["hot"] * 6 + ["a1", "K0002", "b3.0", "4"]
    refs = [("9" if (k := rnd.choice(keys)) == "hot" else k, rnd.randrange(60)) for _ in range(900)]
    tgts = [("9", b := rnd.randrange(50), b + rnd.randrange(4)) for _ in range(60)] + [("1", 30, None), ("2", 5, 20), ("2", 40, None)]
    tgts += [("9", 55, None)]
    by = defaultdict(list)
    for k, b, e in tgts:
        by[brute.number(k)].append((b, e))
    want = {(i, why) for i, (k, t) in enumerate(refs) if (n := brute.number(k)) is not None and (why := brute.orphan_reason(t, by.get(n)))}
    got = {(r.record_id, r.reason) for r in find_orphans([reference(spark, refs, tgts)], partitions).collect()}
    assert got == want and {w for _, w in want} == {"missing", "late", "deleted"}


def test_edges(spark):
    refs = [(None, 1), ("", 1), ("none", 1), ("5", None), ("5", 3), ("5", 4), ("6", 3), ("7", 3), ("005.1", 4), ("123456789012345678901234567890", 1)]
    tgts = [("5", 0, 4), ("6", None, None), ("7", 2, 2), (None, 0, 1)]
    got = {r.record_id: r.reason for r in find_orphans([reference(spark, refs, tgts)], 3).collect()}
    assert got == {5: "deleted", 7: "deleted", 8: "deleted", 9: "missing"}


def test_empty_tables(spark):
    assert find_orphans([reference(spark, [], [("1", 0, None)])], 2).count() == 0
    found = find_orphans([reference(spark, [("1", 3), ("2", 40)], [])], 2)
    assert {r.reason for r in found.collect()} == {"missing"}
    assert [(r.month, r.n) for r in orphans_by_month(found).orderBy("month").collect()] == [("2024-01", 1), ("2024-02", 1)]
