import random

import numpy as np
import pytest

from corpusloom.llm import kernels as K
from corpusloom.llm import neardup, queries
from tests.llm import brute


def test_whole_tables(spark, folder, rows):
    want = {("abstract", *p) for p in brute.similar_pairs([(r["record_id"], r["abstract"]) for r in rows("pubmed_complete_metadata")])}
    want |= {("chunk", *p) for p in brute.similar_pairs([(r["chunk_id"], r["text"]) for r in rows("literature_chunk")])}
    got = [tuple(r) for r in queries.p4_found(spark, folder).collect()]
    assert set(got) == want and len(got) == len(set(got)) and want


@pytest.mark.parametrize("bag", [False, True])
def test_signatures_are_unbiased(bag):
    rng = np.random.default_rng(5)
    off = []
    for _ in range(40):
        base = rng.integers(0, 2**63, 300).astype(np.uint64)
        owner = np.r_[np.zeros(200, int), np.ones(200, int)]
        s = neardup.signatures(owner, np.r_[base[:200], base[100:]], 2, 128, bag)
        off.append((s[0] == s[1]).mean() - 100 / 300)
    assert abs(np.mean(off)) < 0.03


def test_weights_count_in_bags():
    rng = np.random.default_rng(6)
    off = []
    for _ in range(40):
        x = rng.integers(0, 2**63, 4).astype(np.uint64)
        a, b = np.repeat(x[:3], [3, 10, 1]), np.repeat(x[[0, 1, 3]], [6, 5, 2])
        s = neardup.signatures(np.r_[np.zeros(14, int), np.ones(13, int)], np.r_[a, b], 2, 512, True)
        off.append((s[0] == s[1]).mean() - 8 / 19)
    assert abs(np.mean(off)) < 0.02


def test_words_match_the_plain_pattern():
    texts = ["Straße_Ünï 12,3", "", "ÄB́c", "日本 x9", "Σίσυφος", "a" * 3_000, "\U0001f600z"]
    owner, h = K.words(texts)
    plain = [brute.ALNUM.findall(t.lower()) for t in texts]
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(w) for w in plain]
    flat = [w for ws in plain for w in ws]
    assert len(set(flat)) == len(set(h.tolist()))
    owner, h = K.words(["Éá\u200bB\xadc Ａ１ K", "eabc a1 k"], latin=True)
    assert h[owner == 0].tolist() == h[owner == 1].tolist()


def table(spark, data):
    return spark.createDataFrame(data, "src string, id long, text string, rep string, key long")


def test_edges_groups_and_copies(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(4000)]
    base = rnd.sample(words, 120)
    near = [*base[:60], "changed", *base[61:]]
    other = rnd.sample(words, 120)
    data = [("a", 1, " ".join(base)), ("a", 2, " ".join(near)), ("a", 3, " ".join(base)), ("a", 4, " ".join(base)), ("b", 5, " ".join(base)), ("a", 6, None), ("a", 7, ""), ("a", 8, "two words"), ("a", 9, "two words")]
    data += [("a", 10, " ".join(other)), ("a", 11, "x y z"), ("a", 12, "X, y... Z"), ("a", 1, " ".join(base)), ("a", None, "x y z"), ("b", 13, "wort " * 20_000)]
    df = table(spark, [(*d, "clash", 3) for d in data])
    members, links = neardup.near_duplicates(df, 0.6, 3)
    got = {tuple(r) for r in neardup.pairs_of_rows(members, links).collect()}
    assert got == {("a", x, y) for x, y in ((1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (11, 12))}
    groups = {(r.src, r.id): (r.group_id, r.links) for r in neardup.groups_of_rows(members, links).collect()}
    assert groups["a", 2] == (1, 3) and groups["a", 4] == (1, 3) and groups["a", 12] == (11, 1) and groups["b", 5] == (5, 0) and groups["a", 10] == (10, 0)
    assert ("a", 6) not in groups and ("a", 8) not in groups


@pytest.mark.parametrize("hot", [7, 40, 2000])
def test_copies_are_pairs_at_every_size(spark, hot):
    w = [f"w{i}" for i in range(60)]
    data = [("a", i, " ".join(w)) for i in range(10, 310)] + [("a", i, " ".join([*w[:30], "x", *w[31:]])) for i in (5, 500)]
    members, links = neardup.near_duplicates(table(spark, [(*d, "", 0) for d in data]), 0.6, 3)
    got = [(r.id_a, r.id_b) for r in neardup.pairs_of_rows(members, links, hot).collect()]
    ids = [5, *range(10, 310), 500]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]}
    groups = neardup.groups_of_rows(members, links).collect()
    assert {r.group_id for r in groups} == {5} and {r.links for r in groups} == {301}


def test_ten_thousand_copies_stay_one_row_each(spark):
    df = spark.range(10_000).selectExpr("'a' as src", "id", "repeat('one two three four five six ', 5) as text")
    members, links = neardup.near_duplicates(df, 0.6, 3)
    assert (members.count(), members.where("rep = 0").count(), links.count()) == (10_000, 10_000, 0)
    assert neardup.groups_of_rows(members, links).where("group_id = 0 and links = 9999").count() == 10_000


@pytest.mark.parametrize("hot", [25, 2000])
def test_a_hot_template_is_split_and_loses_nothing(spark, hot):
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    data = []
    for i in range(260):
        w = list(base)
        for at in rnd.sample(range(80), rnd.randrange(1, 7)):
            w[at] = f"x{rnd.randrange(10**6)}"
        data.append(("a", i, " ".join(w)))
    members, links = neardup.near_duplicates(table(spark, [(*d, "", 0) for d in data]), 0.6, 3, hot=hot, hot_sample=1)
    want = brute.similar_pairs([(i, t) for _, i, t in data])
    got = [(r.a, r.b) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.995 * len(want) > 10_000


def test_components_are_read_back_from_the_keys():
    rng = np.random.default_rng(3)
    sig = rng.random((2, 84))
    sig[1, :50] = sig[0, :50]
    keys = neardup.band_keys(sig, 28, 3)
    assert neardup.agreements(keys[:1], keys[1:]).tolist() == [50] and neardup.agreements(keys, keys).tolist() == [84, 84]
    assert 25 < neardup.least_agreement(0.6, 84) < 35 < neardup.least_agreement(0.8, 84) < 60


def test_chains_become_one_group(spark):
    members = spark.createDataFrame([("s", i, i) for i in range(1, 41)], "src string, id long, rep long")
    links = spark.createDataFrame([("s", i, i + 1, 0.9) for i in range(1, 30)] + [("s", 31, 40, 0.9)], "src string, a long, b long, similarity double")
    got = {r.id: r.group_id for r in neardup.groups_of_rows(members, links).collect()}
    assert all(got[i] == 1 for i in range(1, 31)) and got[40] == 31 and got[35] == 35


def test_empty_table(spark):
    members, links = neardup.near_duplicates(table(spark, []))
    assert members.count() == links.count() == neardup.pairs_of_rows(members, links).count() == neardup.groups_of_rows(members, links).count() == 0


def test_default_is_five_words_and_four_fifths(spark):
    w = [f"t{i}" for i in range(200)]
    data = [("a", 1, " ".join(w)), ("a", 2, " ".join([*w[:100], "x", *w[101:]])), ("a", 3, " ".join([*w[:30], *["y"] * 60, *w[90:]]))]
    members, links = neardup.near_duplicates(table(spark, [(*d, "", 0) for d in data]), bag=True)
    assert [(r.a, r.b) for r in links.collect()] == [(1, 2)] and members.count() == 3
