"""Splitting, top-n, packing, leakage and truncation."""

import collections
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import leakage, packing, queries, splitting, topn, truncation
from tests.llm import brute

# --- splitting --------------------------------------------------------------------------------------------------------


def test_oversized_items_of_whole_tables(spark, folder, rows):
    want = {("chunk", str(r["chunk_id"])) for r in rows("literature_chunk") if brute.oversized_chars(r["text"])}
    want |= {("window", str(r["window_id"])) for r in rows("literature_embedding_window") if brute.oversized_tokens(r["text"])}
    for r in rows("literature_article"):
        for side in ("abstract", "body"):
            want |= {("section", f"{r['source_file']}/{side}/{i}") for i, s in enumerate(r[f"{side}_sections"] or [], 1) if brute.oversized_chars(s["text"])}
    got = [tuple(r) for r in queries.p5_found(spark, folder).collect()]
    assert set(got) == want and len(got) == len(set(got)) and want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab. \n\tü!", max_size=300), st.integers(5, 60), st.integers(0, 4), st.sampled_from(["chars", "tokens"]))
def test_pieces_cover_the_text_within_the_limit(text, limit, overlap, unit):
    text = text.strip(splitting.BLANKS)
    pieces = splitting.cut(text, limit, overlap, unit)
    size = (lambda s: len(s)) if unit == "chars" else (lambda s: len(s.split()))
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (a, b, _), (c, d, _) in zip(pieces, pieces[1:]):
        assert d > b > a and size(text[c:b]) == overlap and c > a
    for a, b, kind in pieces:
        assert size(text[a:b]) <= limit
        if kind in ("word", "sentence", "paragraph") and b < len(text):
            assert text[b] in splitting.BLANKS and text[b - 1] not in splitting.BLANKS


def test_boundaries_in_order_of_preference():
    p = "x" * 60 + "\n\n" + "y" * 30 + ". " + "z" * 40
    assert splitting.cut(p, 100, 10)[0] == (0, 60, "paragraph")
    assert splitting.cut("x" * 60 + ". " + "y" * 30 + " " + "z" * 40, 100, 10)[0] == (0, 61, "sentence")
    assert splitting.cut("x" * 70 + " " + "y" * 70, 100, 10)[0] == (0, 70, "word")
    assert splitting.cut("字" * 80 + "。" + "字" * 80, 100, 10)[0] == (0, 81, "sentence")
    assert splitting.cut("x" * 250, 100, 10) == [(0, 100, "hard"), (90, 190, "hard"), (180, 250, "end")]


def test_split_edges(spark):
    data = [(1, None), (2, ""), (3, " " * 5000), (4, "x" * 1000), (5, " " + "x" * 1000 + "\n"), (6, "x" * 1001), (6, "x" * 1001), (7, "😀" * 1200), (8, "w " * 200_000)]
    df = spark.createDataFrame([(*d, 1, "c") for d in data], "id long, t string, piece_no int, piece string")
    got = collections.Counter(r.id for r in splitting.split_oversized(df, ["id"], "t", 1000, 150).where("piece_no = 1").collect())
    assert got == {6: 2, 7: 1, 8: 1}
    assert splitting.split_oversized(df.limit(0), ["id"], "t", 98, 0, "tokens").count() == 0
    with pytest.raises(ValueError):
        splitting.split_oversized(df, ["id"], "t", 0)


# --- top n ------------------------------------------------------------------------------------------------------------


def test_best_items_of_whole_tables(spark, folder, rows):
    audit = [(r["selection_run"], r["disease_id"], r["pmid"], r["selection_rank"]) for r in rows("pubmed_selection_audit")]
    want = brute.best_items(audit, [(r["pmid"], r["best_rank"]) for r in rows("pubmed_complete_metadata")])
    got = [tuple(r) for r in queries.p6_found(spark, folder).collect()]
    assert set(got) == want and len(got) == len(want) > 10


@pytest.mark.parametrize("buffer", [7, 200_000])
def test_top_n_with_ties_and_a_hot_group(spark, monkeypatch, buffer):
    monkeypatch.setattr(topn, "BUFFER", buffer)
    rnd = random.Random(4)
    data = [(rnd.choice(["r", None]), rnd.choice([1, 1, 1, 2, 3]), rnd.randrange(60), rnd.randrange(4)) for _ in range(800)] + [("r", 1, None, 1), ("r", 1, 5, None)]
    ties = {i: rnd.randrange(3) for i in range(40)}
    df = spark.createDataFrame([(*d, "x") for d in data], "run string, g long, item long, score long, tie string").repartition(5)
    t = spark.createDataFrame([*ties.items(), (1, None), (None, 2), *ties.items()], "item long, tie long")
    best = collections.defaultdict(dict)
    for run, g, i, s in data:
        if i is not None and s is not None:
            best[run, g][i] = min(best[run, g].get(i, s), s)
    want = {(run, g, i) for (run, g), m in best.items() for i in sorted(m, key=lambda i: (m[i], ties.get(i, 99), i))[:5]}
    for hot in (3, topn.HOT):
        got = topn.top_n(df, ["run", "g"], "item", "score", 5, t, hot)
        assert {(r.run, r.g, r.item) for r in got.collect()} == want
    plain = {(run, g, i) for (run, g), m in best.items() for i in sorted(m, key=lambda i: (m[i], i))[:5]}
    assert {(r.run, r.g, r.item) for r in topn.top_n(df, ["run", "g"], "item", "score", 5).collect()} == plain
    assert topn.top_n(df.limit(0), ["run", "g"], "item", "score", 5, t).count() == 0


# --- packing ----------------------------------------------------------------------------------------------------------


def test_all_documents_are_packed(spark, folder, rows):
    got = queries.p7_pack(spark, folder).collect()
    enc = packing._encoding(packing.default_tokenizer())
    size = {r["doc_id"]: len(enc.encode_ordinary(r["text"] or "")) for r in rows("documents", ["doc_id", "text"])}
    per_doc, per_box = collections.Counter(), collections.Counter()
    for r in got:
        per_doc[r.doc_id] += r.n_tokens
        per_box[r.container_id] += r.n_tokens
        assert r.n_parts == max(1, -(-size[r.doc_id] // packing.CAPACITY))
    assert per_doc == collections.Counter(size) and max(per_box.values()) <= packing.CAPACITY
    assert len(per_box) <= 1 + -(-sum(size.values()) // packing.CAPACITY) and len(got) == len({(r.doc_id, r.part_no) for r in got})


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=12))
def test_plan_uses_up_all_items_and_fits(counts):
    used = collections.Counter()
    for times, pattern in packing.plan_containers(dict(counts), 40):
        assert sum(k * c for k, c in pattern.items()) <= 40
        for k, c in pattern.items():
            used[k] += times * c
    assert used == collections.Counter(counts)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 60), st.dictionaries(st.integers(1, 20), st.integers(1, 4), max_size=6))
def test_closest_fill_is_the_best_there_is(room, left):
    sums = {0}
    for k, n in left.items():
        sums = {s + k * c for s in sums for c in range(n + 1) if s + k * c <= room}
    got = packing._closest_fill(room, dict(left))
    assert sum(k * c for k, c in got.items()) == max(sums) and all(c <= left[k] for k, c in got.items())


def test_packing_edges(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "a b c d e f g h", 3), (3, "a b c d e f g h", 3)], "doc_id long, text string, size int")
    got = [tuple(r) for r in packing.pack(df, capacity=3).orderBy("doc_id", "part_no").collect()]
    assert [g[:4] for g in got[:2]] == [(1, 1, 1, 0), (2, 1, 1, 0)] and collections.Counter(g[3] for g in got[2:]) == {3: 4, 2: 2}
    assert packing.pack(df.limit(0)).count() == 0 and packing.fill_report(packing.pack(df, capacity=3), 3).first().n_tokens == 16


# --- leakage ----------------------------------------------------------------------------------------------------------


def test_leaks_of_whole_tables(spark, folder, rows):
    want = brute.leaks([(r["doc_id"], r["text"]) for r in rows("documents")], [(r["item_id"], r["text"]) for r in rows("eval_item")])
    got = [tuple(r) for r in queries.p8_found(spark, folder).collect()]
    assert set(got) == want and len(got) == len(want) > 0


@pytest.mark.parametrize("bits", [1 << 18, 8])
def test_leak_edges(spark, bits):
    w = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(w[:20])), (2, "Only five words of it"), (3, None), (4, "..."), (5, " ".join(w[:20])), (6, "one")]
    docs = [(1, None), (2, ""), (3, "x " + " ".join(w[5:17])), (4, " ".join(w[5:16])), (5, "ONLY, <b>five</b> wórds o\u200bf i\xadt"), (6, " ".join(w[:6] + ["z"] + w[6:20])), (7, "y " * 60_000 + " ".join(w[:12])), (3, " ".join(w[:12]))]
    d = spark.createDataFrame([(*x, 9) for x in docs], "doc_id long, text string, item_id long")
    i = spark.createDataFrame([(*x, 9) for x in items], "item_id long, text string, doc_id long")
    got = {tuple(r) for r in leakage.find_leaks(d, i, sieve_bits=bits).select("doc_id", "item_id").collect()}
    want = brute.leaks(docs, items)
    assert got == want and (5, 6) not in got
    assert {(3, 1), (3, 5), (6, 1), (7, 1)} <= got
    assert leakage.find_leaks(d.limit(0), i).count() == leakage.find_leaks(d, i.limit(0)).count() == 0


# --- truncation -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "how"),
    [
        ("It ends here.", "sentence"), ("It ends here", "word"), ("It en", "word"), ("It ends here. […]", "mark"), ("It ends he… ", "mark"), ("It goes on [read more]", "mark"), ("half a char \ufffd", "mark"),
        ("<p>Yes.</p>", "sentence"), ("<p>Yes, <b", "markup"), ("<p>Fine</p>", "tag word"), ("See <a href=\"x\"", "markup"), ("Fish &am", "markup"), ("Seen before. [12, 40]", "sentence"), ("Seen (p = 0.", "open number"), ("Seen (see approx.", "short"),
        ("Given e.g.", "short"), ("and I am 34.", "sentence"), ("Yes.\n- item one", "bullet"), ("Yes.\nTable 1\nx\t12", "row"), ("Yes. Keywords: a; b", "key"), ("Yes. Registration no. TR-12345", "code"), ("See. https://x.example/y", "address"), ("", "sentence"), ("  ", "sentence"),
        ('He said "yes."', "sentence"), ("ends with a comma,", "word"), ("Who?", "sentence"), ("Yes.\n- item " + "word " * 500, "bullet"), ("in 12", "number"), ("any ideas 🙂", "symbol"),
        ("Seen in one guideline (71.2%)", "bracket word"), ("Yes. Any joint (n = 258) [3]", "bracket word"), ('They call it "alpha"', "bracket word"), ("Seen vs. (n = 3)", "short bracket"), ("Seen before. (alpha, beta)", "sentence"),
        ("Seen before. [3] (alpha [4])", "sentence"), ("<p>Yes.</p> [3]", "sentence"), ("Higher at 37. [3, 55]", "sentence"), ("(alpha)", "sentence"), ("Seen. (" + "long " * 200 + "note)", "sentence"), ("Yes.\n- item (fig. 2)", "bracket bullet"), ("Not bad =)", "unopened"),
    ],
)
def test_endings(text, how):
    assert truncation.ending(text) == how


def test_closing_words_are_those_after_the_last_sentence_end():
    same = [("Bad pain. Hope this helps", "Other. hope this helps"), ("Weh. Mit freundlichen Grüßen", "<p>Lang.</p> mit freundlichen grüßen "), ("<p>a.</p> xx", "No? xx")]
    assert all(truncation.closing(a) == truncation.closing(b) is not None for a, b in same)
    assert truncation.closing("a b c d e f g h") == truncation.closing("z g h") and truncation.closing(" ") is None


CLOSINGS = {"en": ["Hope this helps", "thanks in advance", "The end", "Regards, Tom", "cheers"], "de": ["Mit freundlichen Grüßen", "Vielen Dank im Voraus"], "es": ["Saludos", "Gracias"], "fr": ["Bien cordialement", "Merci d'avance"]}


def test_closings_of_any_language_are_learned_and_single_breaks_are_not(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    docs, closed, broken = [], set(), set()
    for i in range(4000):
        t = " ".join(" ".join(rnd.choice(words) for _ in range(rnd.randrange(4, 12))).capitalize() + rnd.choice(".?!") for _ in range(rnd.randrange(2, 12)))
        if i % 10 == 0:
            t += " " + rnd.choice(CLOSINGS[rnd.choice("en de es fr".split())])
            closed.add(i)
        elif i % 100 == 1:
            t = t[: rnd.randrange(len(t) // 2, len(t) - 2)]
            if t.rstrip()[-1] not in ".?!":
                broken.add(i)
        docs.append((i, "posts", t))
    found, _, _ = truncation.find_truncated(spark.createDataFrame(docs, "doc_id long, source string, text string"))
    got = {r.doc_id: r.reason for r in found.collect()}
    assert set(got) == broken and set(got.values()) == {"broken"}


def test_a_habit_of_the_source_is_no_accident_and_limits_decide(spark):
    rnd = random.Random(5)
    docs = []
    for i in range(3000):
        t = " ".join(f"w{rnd.randrange(900)}" for _ in range(rnd.randrange(30, 200)))
        docs.append((i, "titles", t))  # never a full stop: complete as they are
        t = ". ".join(" ".join(f"w{rnd.randrange(900)}" for _ in range(9)) for _ in range(rnd.randrange(3, 20))) + "."
        docs.append((10_000 + i, "field", t[:400]))
    found, _, hazards = truncation.find_truncated(spark.createDataFrame(docs, "doc_id long, source string, text string"))
    got = {(r.source, r.reason, r.doc_id) for r in found.collect()}
    want = {d for d, s, t in docs if s == "field" and len(t) == 400 and t.rstrip()[-1] != "."}
    assert {d for _, _, d in got} == want and {r for _, r, _ in got} == {"limit"} and len(want) > 300


def test_cuts_right_after_a_bracket(spark):
    docs = corpus()
    at_limit = "Long. " + "alpha " * 46 + "beta (n = 12) and so on."
    at_limit = at_limit[: at_limit.index(")") + 1].rjust(300, "x")
    extra = [(9001, "limited", at_limit, None), (9002, "limited", "Alpha was seen (p = 0.5)", None), (9003, "limited", "Alpha was seen. (beta, gamma)", None), (9004, None, 'Alpha is "beta"', None)]
    df = spark.createDataFrame([d[:3] for d in docs + extra], "doc_id long, source string, text string")
    assert len(at_limit) == 300
    found, _, hazards = truncation.find_truncated(df)
    got = {r.doc_id for r in found.collect()}
    assert {9001, 9002, 9004} <= got and 9003 not in got
    assert ("limited", "chars", 300) in {(r.source, r.measure, r.n) for r in hazards.where("significant").collect()}


def corpus(n=3000):
    rnd = random.Random(8)
    out = []
    for i in range(n):
        words = [rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rnd.randrange(10, 120))]
        t = " ".join(words).capitalize() + rnd.choice([".", ".", ".", "?\n- alpha", ".\nTable\nbeta\t12"])
        cut = i % 2 == 0 and len(t) > 300
        out.append((i, "limited" if i % 2 == 0 else "free", t[:300] if cut else t, cut and t[299] not in ".?"))
    return out


def test_limits_are_found_and_unusual_endings_judged_by_them(spark):
    docs = corpus()
    free = [len(t) for _, s, t, _ in docs if s == "free"]
    assert max(collections.Counter(free).values()) < 20
    extra = [(9001, "limited", "x" * 290 + ".\n- alph"[:10].ljust(10, "a"), None), (9002, "free", "Complete.\n- alpha", None), (9003, None, "cut he", None), (9004, "free", None, None)]
    df = spark.createDataFrame([d[:3] + (1,) for d in docs + extra], "doc_id long, source string, text string, words int")
    found, seen, hazards = truncation.find_truncated(df)
    got = {r.doc_id for r in found.collect()}
    want = {d[0] for d in docs if d[3]}
    assert want <= got and 9003 in got and 9002 not in got and 9004 not in got
    assert ("limited", "chars", 300) in {(r.source, r.measure, r.n) for r in hazards.where("significant").collect()}
    assert not hazards.where("significant and source = 'free' and measure = 'chars'").count()
    by = {r.source: r for r in truncation.truncation_by_source(found, seen, hazards).collect()}
    assert by["free"].n_cut == 0 and by[None].n_cut == 1 and "chars:300" in by["limited"].limits


def test_truncation_of_whole_tables(spark, folder):
    assert queries.p9_found(spark, folder).count() > 0


def test_truncation_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    found, seen, hazards = truncation.find_truncated(df)
    assert found.count() == truncation.truncation_by_source(found, seen, hazards).count() == 0
