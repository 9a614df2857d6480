import pytest

from corpusloom.operators import packed
from corpusloom.plans import training
from tests import brute

FIELDS = training.PACKED_FIELDS


def test_whole_table(spark, folder, rows):
    got = sorted(tuple(r) for r in training.p1_found(spark, folder).collect())
    want = sorted((r["record_id"], f, i, v) for r in rows("pubmed_complete_metadata", ["record_id", *FIELDS]) for f in FIELDS for i, v in enumerate(brute.packed_values(r[f], f), 1))
    assert got == want and len(got) > 100


@pytest.mark.parametrize(
    ("cell", "values"),
    [
        ("a|b;c\td\ne\r\nf｜g；h", list("abcdefgh")),
        ('"x|y"|"say ""hi"""', ["x|y", 'say "hi"']),
        ("a, b", ["a", "b"]),
        ("a, b|c", ["a, b", "c"]),
        ('["a", "b [major]"]', ["a", "b [major]"]),
        ("a [major] | b [major]", ["a [major]", "b [major]"]),
        (" || ; ", []),
        ('""|a', ["a"]),
        ("a|a", ["a", "a"]),
        ('open "quote|rest', ['open "quote|rest']),
        ("[a] | [b]", ["[a]", "[b]"]),
        ("x" * 100_000 + "|y", ["x" * 100_000, "y"]),
    ],
)
def test_cells(cell, values):
    assert packed.segment_cell(cell) == values


def test_extra_separator_only_for_its_field():
    assert packed.segment_cell("a+b", "+") == ["a", "b"] and packed.segment_cell("a+b") == ["a+b"]


def test_known_values_protect_separators_and_the_best_cover_wins():
    a = packed._automaton({"Trial, Phase II": 1, "Phase II, Review": 1, "Letter, Open, Long": 2, "Protocol; Amended": 1, "A|B|C": 1, "B|C": 1})
    assert packed.segment_cell("Trial, Phase II, Review", automaton=a) == ["Trial, Phase II", "Review"]
    assert packed.segment_cell("News, Letter, Open, Long", automaton=a) == ["News", "Letter, Open, Long"]
    assert packed.segment_cell("XTrial, Phase II", automaton=a) == ["XTrial", "Phase II"]
    assert packed.segment_cell("x|Protocol; Amended;y", automaton=a) == ["x", "Protocol; Amended", "y"]
    assert packed.segment_cell("A|B|C", automaton=a) == ["A|B|C"] and packed.segment_cell('A|"B"|C', automaton=a) == ["A", "B", "C"]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, types string, value string, pos int")


def test_dictionary_is_mined_and_the_join_agrees_with_the_automaton(spark):
    df = frame(
        spark,
        [
            (1, '"Trial, Phase II"|Review', "clash", 9), (2, "Trial, Phase II, Review", None, None), (3, None, None, None), (4, "  ", None, None), (2, "Trial, Phase II, Review", None, None),
            (5, "Pain, Chronic | Cough", None, None), (6, "Cough, Pain, Chronic", None, None), (7, '"Study; Amended"', None, None), (8, "Cough|Study; Amended", None, None),
            (9, '"Cough, Fever"|Fever', None, None), (10, "Cough, Fever", None, None), (11, "Unknown, Thing", None, None),
        ],
    )
    want = {
        1: ["Trial, Phase II", "Review"], 2: ["Trial, Phase II", "Review"] * 2, 5: ["Pain, Chronic", "Cough"], 6: ["Cough", "Pain, Chronic"], 7: ["Study; Amended"], 8: ["Cough", "Study; Amended"],
        9: ["Cough, Fever", "Fever"], 10: ["Cough", "Fever"], 11: ["Unknown", "Thing"],
    }
    for most in (packed.MAX_DICTIONARY_BYTES, 0):
        got = packed.split_packed(df, "id", ["types"], max_dictionary_bytes=most).collect()
        assert sorted((r.id, r.value) for r in got) == sorted((i, v) for i, vs in want.items() for v in vs)
        assert all(r.pos == want[r.id].index(r.value) + 1 for r in got)


def test_a_given_dictionary_counts_too(spark):
    df = frame(spark, [(1, "Alpha, Beta, Gamma", None, None)])
    given = spark.createDataFrame([("types", "Beta, Gamma"), ("other", "Alpha, Beta"), ("types", None)], "field string, value string")
    assert [r.value for r in packed.split_packed(df, "id", ["types"], dictionary=given).orderBy("pos").collect()] == ["Alpha", "Beta, Gamma"]


def test_empty_table(spark):
    assert packed.split_packed(frame(spark, []), "id", ["types", "value"]).count() == 0
