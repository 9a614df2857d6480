"""The queries of problems 4 to 9; every callable takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_bigint
from . import leakage, neardup, packing, splitting, topn, truncation

SIMILARITY, SEQUENCE = 0.6, 3  # of near-duplicate records
WEIGHTED_SIMILARITY, WEIGHTED_SEQUENCE = 0.8, 5
CHUNK_CHARS, OVERLAP_CHARS, WINDOW_TOKENS = 1000, 150, 98
BEST = 5


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    a = _table(spark, folder, "pubmed_complete_metadata").select(F.lit("abstract").alias("src"), F.col("record_id").alias("id"), F.col("abstract").alias("text"))
    c = _table(spark, folder, "literature_chunk").select(F.lit("chunk").alias("src"), F.col("chunk_id").alias("id"), "text")
    return a.unionByName(c)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    members, links = neardup.near_duplicates(_records(spark, folder), SIMILARITY, SEQUENCE)
    return neardup.pairs_of_rows(members, links)


def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    members, links = neardup.near_duplicates(_records(spark, folder), SIMILARITY, SEQUENCE)
    return neardup.groups_of_rows(members, links)


def p4_members(spark: SparkSession, folder: str) -> DataFrame:
    """(src, id, rep): the class of equal word sequences of every text, by its least id."""
    return neardup.near_duplicates(_records(spark, folder), SIMILARITY, SEQUENCE)[0].distinct()


def p4_links(spark: SparkSession, folder: str) -> DataFrame:
    """(src, a, b): similar pairs of class representatives; with p4_members the compact form of p4_found."""
    return neardup.near_duplicates(_records(spark, folder), SIMILARITY, SEQUENCE)[1].select("src", "a", "b")


def p4_weighted_groups(spark: SparkSession, folder: str) -> DataFrame:
    """As p4_groups with every word sequence weighted by how often it occurs, at the default width and limit."""
    members, links = neardup.near_duplicates(_records(spark, folder), WEIGHTED_SIMILARITY, WEIGHTED_SEQUENCE, bag=True)
    return neardup.groups_of_rows(members, links)


def _sections(spark: SparkSession, folder: str, side: str) -> DataFrame:
    s = _table(spark, folder, "literature_article").select("source_file", F.posexplode(F.col(f"{side}_sections").getField("text")).alias("n", "text"))
    return s.select(F.concat_ws("/", "source_file", F.lit(side), (F.col("n") + 1).cast("string")).alias("item"), "text")


def _pieces(spark: SparkSession, folder: str, with_text: bool) -> DataFrame:
    chunks = _table(spark, folder, "literature_chunk").select(F.lit("chunk").alias("src"), F.col("chunk_id").cast("string").alias("item"), "text")
    sections = _sections(spark, folder, "abstract").unionByName(_sections(spark, folder, "body")).select(F.lit("section").alias("src"), "item", "text")
    windows = _table(spark, folder, "literature_embedding_window").select(F.lit("window").alias("src"), F.col("window_id").cast("string").alias("item"), "text")
    by_chars = splitting.split_oversized(chunks.unionByName(sections), ["src", "item"], "text", CHUNK_CHARS, OVERLAP_CHARS, splitting.CHARS, with_text)
    return by_chars.unionByName(splitting.split_oversized(windows, ["src", "item"], "text", WINDOW_TOKENS, 0, splitting.TOKENS, with_text))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder, with_text=False).where("piece_no = 1").select("src", "item")


def p5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder, with_text=True)


def p5_rejoined(spark: SparkSession, folder: str) -> DataFrame:
    """(src, item, digest, within): the texts that the pieces of each item make without their overlaps; whether all pieces keep the limit."""
    p = _pieces(spark, folder, with_text=True)
    size = F.when(F.col("src") == "window", F.regexp_count("piece", F.lit("[^ \\t\\r\\n]+")) <= WINDOW_TOKENS).otherwise(F.length("piece") <= CHUNK_CHARS)
    # the pieces of one text, which was one cell before
    one = p.groupBy("src", "item").agg(F.array_sort(F.collect_set(F.struct("piece_no", "begin", "end", "piece"))).alias("ps"), F.bool_and(size).alias("within"))
    fresh = F.transform("ps", lambda x, i: F.when(i == 0, x["piece"]).otherwise(F.substring(x["piece"], F.element_at("ps", i)["end"] - x["begin"] + 1, F.length(x["piece"]))))
    return one.select("src", "item", F.md5(F.encode(F.array_join(fresh, ""), "UTF-8")).alias("digest"), "within")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    audit = _table(spark, folder, "pubmed_selection_audit").select(
        "selection_run", first_bigint("disease_id").alias("disease_id"), first_bigint("pmid").alias("pmid"), first_bigint("selection_rank").alias("rank")
    )
    ties = _table(spark, folder, "pubmed_complete_metadata").select(first_bigint("pmid").alias("item"), first_bigint("best_rank").alias("tie"))
    best = topn.top_n(audit.where("disease_id is not null"), ["selection_run", "disease_id"], "pmid", "rank", BEST, ties)
    return best.select("selection_run", "disease_id", "pmid")


def p7_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill_report(p7_pack(spark, folder))


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "eval_item"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return _leaks(spark, folder).select("doc_id", "item_id")


def p8_items(spark: SparkSession, folder: str) -> DataFrame:
    found = _leaks(spark, folder)
    whole = F.sum(F.when(F.col("passages") == F.col("item_passages"), 1).otherwise(0))
    return found.groupBy("item_id").agg(F.count("*").alias("n_docs"), whole.alias("n_whole"), F.round(F.max(F.col("passages") / F.col("item_passages")), 6).alias("most"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    found, _, _ = truncation.find_truncated(_table(spark, folder, "documents"))
    return found.select("doc_id")


def p9_sources(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncation_by_source(*truncation.find_truncated(_table(spark, folder, "documents")))


def p9_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """(source, reason, n): cuts at a significant length, with a mark, or broken off anywhere."""
    found, _, _ = truncation.find_truncated(_table(spark, folder, "documents"))
    return found.groupBy("source", "reason").agg(F.count("*").alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p4_found, p4_members, p4_links, p4_groups, p4_weighted_groups, p5_found, p5_pieces, p5_rejoined, p6_found, p7_pack, p7_fill, p8_found, p8_items, p9_found, p9_sources, p9_reasons)}
