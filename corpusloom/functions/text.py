"""String primitives with Python-like semantics (strip, whitespace, multi-value cells, titles, identifiers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that a Unicode-aware strip removes: Unicode white space plus the four information separators.
_WS = r"[\s\x1c-\x1f]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove all Unicode white space at both ends; null stays null."""
    return F.regexp_replace(_c(c), rf"(?U)^{_WS}+|{_WS}+$", "")


def collapse_ws(c: Column | str) -> Column:
    """Every run of white space becomes one blank; both ends are stripped."""
    return strip(F.regexp_replace(_c(c), rf"(?U){_WS}+", " "))


# Characters whose case-folded form is not their lower-case form, by rule; about 100, most of them fold to several.
_FOLDED = {c: c.casefold() for c in map(chr, range(0x80, 0x1F000)) if c.lower() != c.casefold() and not 0x13A0 <= ord(c) <= 0x13FF and not 0xAB70 <= ord(c) <= 0xABBF}
_FOLDED["\u03a3"] = "\u03c3"  # capital sigma, which lower case makes final or not by its place


def casefold(c: Column | str) -> Column:
    """Lower case for comparisons: also "\u00df" and "ss", final and other sigma, ligatures and their letters are the same."""
    x = _c(c)
    table = F.create_map(*[F.lit(v) for kv in _FOLDED.items() for v in kv])
    folded = F.array_join(F.transform(F.split(x, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), F.lower(ch))), "")
    odd = "[" + "".join(f"\\x{{{ord(k):x}}}" for k in _FOLDED) + "]"
    return F.when(x.rlike(odd), folded).otherwise(F.lower(x))


def float_text(c: Column | str) -> Column:
    """Shortest text of a double: plain between 1e-4 and 1e16, else with an exponent of at least two digits (1e-05).

    The fewest digits that give the same number again; a plain cast sometimes has one too many.
    """
    x = _c(c).cast("double")
    texts = [F.format_string(f"%.{p}e", x) for p in (0, 14, 15, 16)]
    same = [t.try_cast("double") == x for t in texts]
    s = F.when(same[0], texts[0]).when(same[1], texts[1]).when(same[2], texts[2]).otherwise(texts[3])
    part = lambda i: F.regexp_extract(s, r"^(-?)([0-9])(?:\.([0-9]+))?e([+-])([0-9]+)$", i)
    frac = F.rtrim(F.translate(part(3), "0", " "))
    frac = F.substring(part(3), F.lit(1), F.length(frac))
    digits, e = F.concat(part(2), frac), F.concat(part(4), part(5)).try_cast("int")
    n = F.length(digits)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    whole = F.concat(digits, F.repeat(F.lit("0"), e + 1 - n), F.lit(".0"))
    large = F.when(n <= e + 1, whole).otherwise(F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, n)))
    power = F.concat(part(2), F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(""), F.lit("e"), part(4), F.when(F.length(part(5)) < 2, F.concat(F.lit("0"), part(5))).otherwise(part(5)))
    number = F.concat(part(1), F.when((e < 0) & (e >= -4), small).when((e >= 0) & (e < 16), large).otherwise(power))
    return F.when(x.isNull(), None).when(F.isnan(x), "nan").when(F.abs(x) == float("inf"), F.when(x > 0, "inf").otherwise("-inf")).otherwise(number)


def text_or_empty(c: Column | str) -> Column:
    """Null, empty and blank all mean "no value"; this maps them to the empty string."""
    return strip(F.coalesce(_c(c), F.lit("")))


def has_value(c: Column | str) -> Column:
    return text_or_empty(c) != ""


def null_if_blank(c: Column | str) -> Column:
    s = strip(_c(c))
    return F.when(s != "", s)


def split_list(c: Column | str, sep: str = "|") -> Column:
    """Values of a packed cell in order, stripped, blanks dropped, repeats kept; a null cell gives an empty array."""
    pattern = "[" + sep + "]" if len(sep) == 1 and sep not in "^]\\" else sep.replace("|", "[|]")
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), pattern), strip)
    return F.filter(parts, lambda x: x != "")


def split_set(c: Column | str, sep: str = "|") -> Column:
    """As split_list with repeats removed; the first occurrence keeps its place."""
    return F.array_distinct(split_list(c, sep))


def pack(c: Column | str, sep: str = "|") -> Column:
    return F.array_join(_c(c), sep)


def contains_ci(values: Column, wanted: str) -> Column:
    return F.exists(values, lambda x: F.lower(x) == wanted.lower())


def overlaps_ci(values: Column, wanted: list[str]) -> Column:
    """Whether any value equals one of the wanted ones, case ignored."""
    return F.arrays_overlap(F.transform(values, F.lower), F.array(*[F.lit(w.lower()) for w in wanted]))


def first_match(cases: list[tuple[str, Column]], default: str) -> Column:
    """Label of the first condition that holds; unknown counts as false."""
    out = None
    for label, condition in cases:
        c = F.coalesce(condition, F.lit(False))
        out = F.when(c, label) if out is None else out.when(c, label)
    return F.lit(default) if out is None else out.otherwise(default)


def override(c: Column | str, table: dict[str, str]) -> Column:
    """The table's entry for a name with blanks collapsed, else the name itself."""
    name = collapse_ws(c)
    if not table:
        return name
    lookup = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, name), name)


def search_query(term: Column | str, field: str, qualifiers: list[str] | None = None) -> Column:
    """A quoted term in a field, with alternative qualifiers: "term"[Field] AND (a[Field] OR b[Field])."""
    head = F.concat(quote_term(term), F.lit(f"[{field}]"))
    if not qualifiers:
        return head
    return F.concat(head, F.lit(" AND (" + " OR ".join(f"{q}[{field}]" for q in qualifiers) + ")"))


def percent_text(part: Column, whole: Column, digits: int = 1) -> Column:
    """For presentation only: "12.5%"."""
    return F.concat(F.format_number(percent(part, whole), digits), F.lit("%"))


def merge_maps(*maps: Column) -> Column:
    """Union of maps; of equal keys the last map's value counts; null maps are empty."""

    def over(a: Column, b: Column) -> Column:
        return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)

    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    out = none
    for m in maps:
        out = over(out, F.coalesce(m, none))
    return out


def type_token(c: Column | str) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 becomes "_", outer "_" removed."""
    return F.btrim(F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def first_number(c: Column | str) -> Column:
    """The first run of ASCII digits of a cell as a string without leading zeros; null if there is none.

    A string keeps ids of any length exact; cast it where a number is wanted.
    """
    digits = F.regexp_extract(_c(c), "([0-9]+)", 1)
    return F.when(digits != "", F.regexp_replace(digits, "^0+(?=[0-9])", ""))


def first_bigint(c: Column | str) -> Column:
    """first_number as bigint; null where it has none or does not fit."""
    return first_number(c).try_cast("bigint")


def section_title(c: Column | str) -> Column:
    """Collapsed title without leading numbering and trailing colons, case folded."""
    t = collapse_ws(c)
    t = F.regexp_replace(t, r"^[0-9]+(\.[0-9]+)*[.)]?\s+", "")
    return casefold(strip(F.regexp_replace(t, ":+$", "")))


# Section titles with a category of their own.
SECTION_CATEGORIES = {
    "introduction": "introduction",
    "background": "background",
    "methods": "methods",
    "materials and methods": "methods",
    "methodology": "methods",
    "results": "results",
    "discussion": "discussion",
    "conclusion": "conclusion",
    "conclusions": "conclusion",
    "diagnosis": "diagnosis",
    "treatment": "treatment",
    "management": "management",
    "prognosis": "prognosis",
    "clinical presentation": "clinical_presentation",
    "differential diagnosis": "differential_diagnosis",
    "pathophysiology": "pathophysiology",
}


def section_category(c: Column | str, categories: dict[str, str] | None = None) -> Column:
    table = categories or SECTION_CATEGORIES
    lookup = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, section_title(c)), F.lit("other"))


def pmcid_form(c: Column | str) -> Column:
    """"PMC" put in front unless it is there in any case; blank stays blank."""
    s = text_or_empty(c)
    return F.when(s == "", s).when(F.lower(s).startswith("pmc"), s).otherwise(F.concat(F.lit("PMC"), s))


def doi_form(c: Column | str) -> Column:
    """Stripped, lower case, one known resolver or scheme prefix dropped."""
    return F.regexp_replace(F.lower(strip(c)), "^(https?://doi[.]org/|https?://dx[.]doi[.]org/|doi:)", "")


def excerpt(c: Column | str, limit: int = 300) -> Column:
    s = collapse_ws(c)
    return F.when(F.length(s) > limit, F.concat(F.substring(s, 1, limit), F.lit("..."))).otherwise(s)


def redact_url(c: Column | str, names: tuple[str, ...] = ("email", "api_key")) -> Column:
    return F.regexp_replace(_c(c), "([?&](?:" + "|".join(names) + ")=)[^&#]*", "$1REDACTED")


def one_line(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), r"[\r\n]+", " ")


def location_text(page: Column | str) -> Column:
    return F.coalesce(F.concat(F.lit("Page "), _c(page).cast("string")), F.lit(""))


def quote_term(c: Column | str) -> Column:
    """A search phrase in double quotes, inner quotes escaped."""
    return F.concat(F.lit('"'), F.regexp_replace(collapse_ws(c), '"', r'\\"'), F.lit('"'))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where the whole is 0."""
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))


# --- search-name variants -------------------------------------------------------------------------------------------

APOSTROPHES = "['‘’ʼ`]"


def without_apostrophes(c: Column | str) -> Column:
    return collapse_ws(F.regexp_replace(_c(c), APOSTROPHES, ""))


def with_possessive(c: Column | str) -> Column:
    """'s put behind a stem of four or more letters in front of Disease, Syndrome or Foot."""
    return collapse_ws(F.regexp_replace(_c(c), r"(?i)\b([a-z]{4,}?)s?\s+(disease|syndrome|foot)\b", "$1's $2"))


def without_punctuation(c: Column | str) -> Column:
    return collapse_ws(F.regexp_replace(_c(c), r"[^\p{L}\p{N}\s]+", " "))


def without_parentheses(c: Column | str) -> Column:
    return collapse_ws(F.regexp_replace(_c(c), r"\([^()]*\)", " "))


def name_variants(c: Column | str) -> Column:
    """array<struct<kind, term>> of the search variants of a name: blanks and case-insensitive repeats dropped, first kept."""
    kinds = [
        ("original", collapse_ws(c)),
        ("no_apostrophe", without_apostrophes(c)),
        ("possessive", with_possessive(c)),
        ("no_punctuation", without_punctuation(c)),
        ("no_parentheses", without_parentheses(c)),
    ]
    every = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("term")) for k, v in kinds])
    seen = F.transform(every, lambda x: F.lower(x["term"]))
    return F.filter(every, lambda x, i: (x["term"] != "") & (F.array_position(seen, F.lower(x["term"])) == i + 1))


def name_flags(c: Column | str, known_typos: tuple[str, ...] = ()) -> Column:
    """Ordered list of oddities of a name that tend to spoil a literature search; typos are words the caller knows as wrong."""
    n = F.coalesce(_c(c), F.lit(""))
    checks = [
        ("parentheses", n.rlike(r"[()]")),
        ("double_space", n.rlike(r"\s{2,}")),
        ("apostrophe", n.rlike(APOSTROPHES)),
        ("abbreviation", n.rlike(r"\b[A-Z]{2,}\b")),
        ("very_short", F.length(strip(n)) <= 4),
        ("typo", F.arrays_overlap(F.split(F.lower(n), r"[^\p{L}\p{N}]+"), F.array(*[F.lit(w.lower()) for w in known_typos]) if known_typos else F.array().cast("array<string>"))),
    ]
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks]))
