"""Texts cut off by field limits or broken transfers.

Lengths.  For every source the discrete hazard of each length is the share of the texts of at least that length that
end exactly there, in characters, UTF-8 bytes and words.  Window functions over the counts give the texts at risk and
the hazard of the neighbouring lengths; a length whose deaths are too many for its neighbours gets a small Poisson
tail bound, and a Benjamini-Hochberg threshold over all sources and lengths picks the significant ones.  A second
round leaves the lengths found in the first out of the neighbours, so limits that lie close together don't hide each
other.

Endings.  Every ending has a class: `sentence` (a sentence end, also with brackets, quotes or tags behind it), `mark`
(a sign left by a cut), `markup` (an open tag or entity), or a shape that neither closes nor marks anything (a plain word, a bracket inside a sentence,
a bullet line, a table row, a key with its value, an address, a symbol, ...).  Which of the shapes are complete is
not listed but learned from the corpus.  Each text is also cut once at a place that depends on its hash; the classes
of these reference cuts show how a text ends that breaks off anywhere.  Of the texts that end at no significant
length, a source's share of a class is compared with what accidents would give, `accidents` times the share among the
reference cuts: a class that is more frequent is a habit of the source, any other a broken transfer.  Closing words
(the last two of a text) that recur at many lengths over the corpus are learned in the same way.

Decision.  At a significant length the excess deaths, spread over the classes as the reference cuts are, stand
against the expected deaths, spread as the source's other endings: a text is cut there if the first are more.  At any
other length it is cut if its class is no habit.  Marks and open markup are cuts unless their words are a learned
closing; a cut at the very end of a sentence leaves no trace and is no case.

Defined results: null texts are not reported; empty and blank texts are complete; a null source is a source of its
own; repeated rows are judged each for itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

OFFSET = 150
ACCIDENTS = 0.05  # share of the texts of a source that break off anywhere, at most
HABIT_P = 0.01
BROADCAST_ROWS = 200_000  # of some 60 bytes
CLOSING_LENGTHS = 5  # different lengths at which closing words must recur

# Marks that readers and feeds put behind a cut.
MARK = re.compile(r"(?:\[\s*(?:\.{3}|…)\s*\]|\(\s*(?:\.{3}|…)\s*\)|>>|»|\[(?:read more|more|continued|truncated|cut)\]|\((?:continued|more|truncated|cont\.?|cont'd)\)|\ufffd+)$", re.I)
ELLIPSIS = re.compile(r"(?:…|\.{3,})$")
# Abbreviations that are followed by more.
ABBREVIATION = re.compile(r"(?:^|[\s(\[])(?:e\.g|i\.e|approx|vs|fig|figs|no|nos|cf|ca|resp|et al|incl|viz|dr|mr|mrs|prof|st|p|pp|vol|ed|eds|z\.B|bzw|p\.ej)\.$", re.I)
NUMBER_OPEN = re.compile(r"(?:\([^()]*\b\d+\.|(?:=|<|>|\bat|\bCI|±|≤|≥)\s*\d+\.|\(\s*[A-Za-z]{1,2}\.)$")
OPEN_MARKUP = re.compile(r"(?:<[/!]?[A-Za-z][^<>\n]{0,200}|</?)$|&#?[A-Za-z0-9]{0,8}$")
SENTENCE_END = re.compile(r"[.!?。！？؟][\"'”’»)\]}*_]*$")
MARK_ENDS, SENTENCE_ENDS = frozenset("])>»\ufffd"), frozenset(".!?。！？؟\"'”’»)]}*_")
TAG = re.compile(r"<(?:/[A-Za-z][\w:-]*\s*|[A-Za-z][^<>]*/|br)>$", re.I)
IN_TAG = re.compile(r"<[^<>]*>")
OPENERS = {")": "(", "]": "[", "}": "{", '"': '"', "”": "“„”", "»": "«", "’": "‘"}
BULLET = re.compile(r"\s*(?:\W|\d{1,3}[.)])\s+\S[^.!?]*$")
ADDRESS = re.compile(r"(?:\w+://|www\.)\S")
CODE = re.compile(r"(?=\S*\d)(?=\S*[^\W\d])[\w/-]+")
KEY = re.compile(r"(?:^|[.!?>)\]]\s+)[^\W\d_][\w ]{1,30}:\s*\S[^.!?:]*$")
SPACES = 256  # characters before the end that hold the last two words of ordinary texts
SENTENCE, CUT_MARK, MARKUP, WORD = "sentence", "mark", "markup", "word"


def _opening(text: str) -> int:
    """Where the bracket or quote that ends the text was opened; -1: nowhere."""
    close, depth = text[-1], 1
    for i in range(len(text) - 2, -1, -1):
        if text[i] in OPENERS[close]:
            depth -= 1
            if not depth:
                return i
        elif text[i] == close:
            depth += 1
    return -1


def _shape(text: str) -> str:
    """Shape of a text that ends neither a sentence nor in a mark, bracket or tag."""
    line = text[text.rfind("\n") + 1 :]
    if "\t" in line:
        return "row"
    if BULLET.match(line):
        return "bullet"
    token = line.rsplit(None, 1)[-1]
    if ADDRESS.match(token):
        return "address"
    if CODE.fullmatch(token):
        return "code"
    if token[-1].isdecimal():
        return "number"
    if ":" in line and KEY.search(line):
        return "key"
    return WORD if text[-1].isalnum() or text[-1] in ",-" else "symbol"


def ending(text: str) -> str:
    """The class of a text's ending.

    Every pattern ends at the end of the text, so its last character tells which of them can match.
    """
    text = text.rstrip()
    behind = ""
    while True:
        if not text:
            return SENTENCE
        near, last = text[-SPACES:], text[-1]
        dots = last in ".…" and ELLIPSIS.search(near) is not None
        if not behind and (dots or (last in MARK_ENDS and MARK.search(near))):
            return CUT_MARK
        if last == ".":
            if ABBREVIATION.search(near, max(0, len(near) - 12)):
                return f"short {behind}".strip()
            if not behind and NUMBER_OPEN.search(near):
                return "open number"
        if dots or (last in SENTENCE_ENDS and SENTENCE_END.search(near)):
            return SENTENCE
        if last == ">" and (tag := TAG.search(near)):
            behind, text = "tag", text[: len(text) - len(near) + tag.start()].rstrip()
        elif ("<" in near or "&" in near) and OPEN_MARKUP.search(near):
            return MARKUP
        elif last in OPENERS:
            at = _opening(text)
            if at < 0:
                return "unopened"
            behind, text = behind or "bracket", text[:at].rstrip()
        else:
            return f"{behind} {_shape(text)}".strip()


def closing(text: str) -> int | None:
    """Hash of the words after the last sentence end if they are at most five, else of the last two; null without words.

    Tags count as blanks.
    """
    words = IN_TAG.sub(" ", text[-SPACES:].lower()).split()[-6:]
    last = next((i for i in range(len(words) - 2, -1, -1) if SENTENCE_END.search(words[i])), None)
    words = words[-2:] if last is None else words[last + 1 :]
    return zlib.crc32(" ".join(words).encode("utf-8", "surrogatepass")) if words else None


def _reference_cut(text: str) -> str:
    """The text up to a place that depends on its hash; every second one goes on to the end of the word."""
    seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    at = 1 + (seed >> 1) % len(text)
    return _to_word_end(text, at) if seed & 1 else text[:at]


def _to_word_end(text: str, at: int) -> str:
    end = at
    while end < len(text) and not text[end].isspace():
        end += 1
    return text[:end]


_MEASURES = ("chars", "bytes", "words")
_SEEN = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), *[T.StructField(m, T.IntegerType()) for m in _MEASURES]]
    + [T.StructField("ending", T.StringType()), T.StructField("closing", T.LongType()), T.StructField("ref_ending", T.StringType()), T.StructField("ref_closing", T.LongType())]
)


def endings(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, source, chars, bytes, words, ending, closing, ref_ending, ref_closing) of every text that is not null.

    closing is null where the text ends a sentence; the ref_ columns are those of its reference cut.
    """
    slim = df.select(F.col(key).cast("bigint").alias("k"), F.col(source).cast("string").alias("s"), F.col(text).cast("string").alias("t")).where("t is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            n = b.num_rows
            chars = np.fromiter(map(len, texts), np.int32, n)
            octets = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int32, n)
            words = np.fromiter((len(t.split()) for t in texts), np.int32, n)
            end, close, ref_end, ref_close = [], [], [], []
            for t in texts:
                how = ending(t)
                end.append(how)
                close.append(None if how == SENTENCE else closing(t))
                cut = _reference_cut(t) if t else ""
                how = ending(cut)
                ref_end.append(how)
                ref_close.append(None if how == SENTENCE else closing(_to_word_end(t, len(cut))))
            columns = [pa.array(chars), pa.array(octets), pa.array(words), pa.array(end, pa.string()), pa.array(close, pa.int64()), pa.array(ref_end, pa.string()), pa.array(ref_close, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], names=_SEEN.names)

    return slim.mapInArrow(run, _SEEN)


def _small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Written out, and marked for broadcast if it has at most that many rows; sources with their lengths or classes are few."""
    out = cut_lineage(df)
    return F.broadcast(out) if out.count() <= most else out


def _bound(d: Column, e: Column) -> Column:
    """Log10 of the Chernoff bound of P(X >= d) for a Poisson mean e."""
    return F.when(d > e, (d - e + d * F.log(e / d)) / F.log(F.lit(10.0))).otherwise(F.lit(0.0))


def _lengths(seen: DataFrame) -> DataFrame:
    """One row per text and measure: all columns and (measure, n)."""
    e = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("n")) for m in _MEASURES]))
    return seen.select("*", e.alias("e")).select(*seen.columns, "e.measure", "e.n").where("n > 0")


def length_hazards(seen: DataFrame, q: float = 0.001, reach: float = 0.06, least: int = 3) -> DataFrame:
    """(source, measure, n, deaths, at_risk, expected, log_p, own, significant) of every length that occurs.

    `reach` is the width of the neighbourhood as a share of the length, to either side; `q` the false-discovery rate;
    a length with fewer than `least` deaths is not tested.  A limit in characters also piles up texts at some numbers
    of bytes and words; so each text counts for the most significant of its lengths only (`own`), and a length stays
    significant if its own deaths are too many too and most of them are cut.
    """
    counts = _lengths(seen).groupBy("source", "measure", "n").agg(F.count("*").alias("deaths"))
    by = Window.partitionBy("source", "measure")
    risk = F.sum("deaths").over(by.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0))
    # lengths on a scale of thousandths of their logarithm, for a frame in proportion to the length; the offset keeps
    # some ten neighbours to either side of the shortest
    table = counts.withColumn("at_risk", risk).withColumn("place", F.round(F.log((F.col("n") + OFFSET).cast("double")) * 1000).cast("bigint")).withColumn("significant", F.lit(False))
    step = round(reach * 1000)
    near = by.orderBy("place").rangeBetween(-step, step)
    half = F.lit(reach) * (F.col("n") + OFFSET)
    width = half + F.least(half, F.col("n") - 1.0)
    for _ in range(2):
        other = F.when(~F.col("significant"), F.col("deaths")).otherwise(0)
        around = F.sum(other).over(near) - other
        left_out = F.sum(F.col("significant").cast("int")).over(near)
        # neighbours that never occur have no deaths; half a death keeps the hazard of an empty neighbourhood above 0
        lengths = F.greatest(width - left_out, F.lit(1.0))
        table = table.withColumn("expected", (around + 0.5) / lengths).withColumn(
            "log_p", F.when(F.col("deaths") >= least, _bound(F.col("deaths").cast("double"), F.col("expected"))).otherwise(0.0)
        )
        table = _discoveries(cut_lineage(table.drop("limit")), q)
    best = _small(table.where("significant").select(F.col("source").alias("s"), F.col("measure").alias("m"), F.col("n").alias("at"), "log_p"))
    text = ["doc_id", "source", *_MEASURES, "ending"]
    hits = _lengths(seen).join(best, F.col("source").eqNullSafe(F.col("s")) & (F.col("measure") == F.col("m")) & (F.col("n") == F.col("at")))
    first = hits.groupBy(*text).agg(F.min_by(F.struct("measure", "n"), F.struct(F.col("log_p"), F.col("measure") == "words", F.col("measure") == "bytes")).alias("l"))
    cut = F.count(F.when(F.col("ending") != SENTENCE, 1))
    own = first.groupBy(F.col("source").alias("s"), F.col("l.measure").alias("m"), F.col("l.n").alias("at")).agg(F.count("*").alias("own"), cut.alias("own_cut"))
    j = table.join(own, F.col("source").eqNullSafe(F.col("s")) & (F.col("measure") == F.col("m")) & (F.col("n") == F.col("at")), "left")
    n = F.coalesce("own", F.lit(0))
    still = F.col("significant") & (n >= least) & (_cell(_bound(n.cast("double"), F.col("expected"))) <= F.col("limit")) & (F.coalesce("own_cut", F.lit(0)) * 2 > n)
    return j.select("source", "measure", "n", "deaths", "at_risk", "expected", "log_p", n.alias("own"), still.alias("significant"))


def _cell(log_p: Column) -> Column:
    return F.greatest(F.ceil(log_p * 20), F.lit(-6400)).cast("int")


def _discoveries(table: DataFrame, q: float) -> DataFrame:
    """Benjamini-Hochberg: the largest p with p <= q * rank / tests; adds its cell as `limit`.

    Ranks are read off counts on a grid of 0.05 in log p (at most 6,400 cells), so no sort over all tests is needed;
    rounding goes to the safe side.
    """
    grid = table.groupBy(_cell(F.col("log_p")).alias("cell")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    upto = F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    fits = F.col("cell") / 20.0 <= F.log10(F.lit(q) * F.col("upto") / F.col("total"))
    limit = grid.select("cell", upto.alias("upto"), total.alias("total")).where(fits).agg(F.coalesce(F.max("cell"), F.lit(-10_000)).alias("limit")).first()["limit"]
    return table.withColumn("limit", F.lit(limit)).withColumn("significant", _cell(F.col("log_p")) <= limit)


def with_limits(seen: DataFrame, hazards: DataFrame) -> DataFrame:
    """`seen` with the excess and the expected deaths of the sharpest significant length a text ends at, null elsewhere."""
    lim = cut_lineage(hazards.where("significant").select(F.col("source").alias("s"), F.col("measure").alias("m"), F.col("n").alias("at"), "deaths", "expected"))
    few = lim.count() <= BROADCAST_ROWS
    by = []
    for m in _MEASURES:
        one = lim.where(F.col("m") == m).select("s", "at", F.struct(F.greatest(F.col("deaths") - F.col("expected"), F.lit(0.0)).alias("excess"), "expected").alias(f"by_{m}"))
        by.append(f"by_{m}")
        one = F.broadcast(one) if few else one
        seen = seen.join(one, F.col("source").eqNullSafe(F.col("s")) & (F.col(m) == F.col("at")), "left").drop("s", "at")
    return seen.withColumn("limit", F.greatest(*by)).drop(*by)


def ending_habits(judged: DataFrame, closings: DataFrame, accidents: float = ACCIDENTS) -> DataFrame:
    """(s, c, own, ref, habit) per source and class: shares among its free endings and its reference cuts.

    A class is a habit if the free endings with it, learned closings left out, are too many for accidents.
    """
    ends = judged.where("limit is null").join(closings, "closing", "left_anti").select("source", F.col("ending").alias("c"), F.lit(1).alias("own"), F.lit(0).alias("ref"))
    refs = judged.select("source", F.col("ref_ending").alias("c"), F.lit(0).alias("own"), F.lit(1).alias("ref"))
    n = ends.unionByName(refs).groupBy("source", "c").agg(F.sum("own").alias("own"), F.sum("ref").alias("ref"))
    every = Window.partitionBy("source")  # one row per source and class
    n = n.withColumn("n_own", F.sum("own").over(every)).withColumn("n_ref", F.sum("ref").over(every))
    ref = (F.col("ref") + 0.5) / (F.col("n_ref") + 1.0)
    mean = F.lit(accidents) * ref * F.col("n_own")
    habit = (F.col("own") > 0) & (_bound(F.col("own").cast("double"), mean) <= F.log10(F.lit(HABIT_P)))
    return n.select(F.col("source").alias("s"), "c", ((F.col("own") + 0.5) / (F.col("n_own") + 1.0)).alias("own"), ref.alias("ref"), habit.alias("habit"))


def learned_closings(judged: DataFrame, accidents: float = ACCIDENTS, least: int = CLOSING_LENGTHS) -> DataFrame:
    """(closing): words that end texts at many lengths, and more often than accidents would."""
    free = judged.where("limit is null and closing is not null")
    ends = free.groupBy("closing", "chars").agg(F.count("*").alias("n")).groupBy("closing").agg(F.count("*").alias("lengths")).where(F.col("lengths") >= least)
    refs = judged.where("ref_closing is not null").groupBy(F.col("ref_closing").alias("closing")).agg(F.count("*").alias("refs"))
    j = ends.join(refs, "closing", "left")
    mean = F.lit(accidents) * (F.coalesce("refs", F.lit(0)) + 0.5)
    return j.where(_bound(F.col("lengths").cast("double"), mean) <= F.log10(F.lit(HABIT_P))).select("closing")


def find_truncated(
    df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", q: float = 0.001, accidents: float = ACCIDENTS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(found, seen, hazards): found has (doc_id, source, ending, reason) of the cut texts.

    reason: limit (at a significant length), mark, or broken (anywhere else).
    """
    seen = cut_lineage(endings(df, key, source, text))
    hazards = length_hazards(seen, q)
    judged = cut_lineage(with_limits(seen, hazards))
    closings = _small(learned_closings(judged, accidents))
    habits = _small(ending_habits(judged, closings, accidents))
    open_ = judged.where(F.col("ending") != SENTENCE).join(closings, "closing", "left_anti")
    j = open_.join(habits, F.col("source").eqNullSafe(F.col("s")) & (F.col("ending") == F.col("c")), "left")
    cut_here = F.col("limit.excess") * F.col("ref") > F.col("limit.expected") * F.col("own")
    always = F.col("ending").isin(CUT_MARK, MARKUP)
    reason = F.when(F.col("limit").isNotNull() & (always | cut_here), "limit").when(F.col("ending") == CUT_MARK, CUT_MARK)
    reason = reason.when(F.col("limit").isNull() & (always | ~F.coalesce("habit", F.lit(False))), "broken")
    found = j.select("doc_id", "source", "ending", reason.alias("reason")).where("reason is not null")
    return found, seen, hazards


def truncation_by_source(found: DataFrame, seen: DataFrame, hazards: DataFrame) -> DataFrame:
    """(source, n_texts, n_cut, share, limits): limits lists the significant lengths as "measure:length"."""
    total = seen.groupBy("source").agg(F.count("*").alias("n_texts"))
    cut = found.groupBy("source").agg(F.count("*").alias("n_cut"))
    lim = hazards.where("significant").groupBy("source").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "measure", "n"))), " ").alias("limits"))
    c, m = cut.select(F.col("source").alias("sc"), "n_cut"), lim.select(F.col("source").alias("sl"), "limits")
    j = total.join(c, F.col("source").eqNullSafe(F.col("sc")), "left").join(m, F.col("source").eqNullSafe(F.col("sl")), "left")
    n = F.coalesce("n_cut", F.lit(0))
    return j.select("source", "n_texts", n.alias("n_cut"), F.round(n / F.col("n_texts"), 6).alias("share"), F.coalesce("limits", F.lit("")).alias("limits"))
