from pyspark.sql import functions as F

from corpusloom.sources import jats
from corpusloom.streaming import ingest as S

XML = "<article><front><article-meta><article-id pub-id-type='pmid'>{}</article-id></article-meta></front></article>"


def test_files_in_micro_batches_with_failures_and_resume(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i in range(5):
        (src / f"a{i}.xml").write_text(XML.format(i % 4))  # one id twice
    (src / "bad.xml").write_text("<article>")
    (src / "note.txt").write_text("x")
    seen = []

    def parse(files):
        return jats.parse_files(files).select(F.col("pmid").alias("id"), "source_file", "error")

    def stored():
        return spark.read.parquet(out) if seen else None

    def sink(rows, n):
        rows.write.parquet(f"{out}/batch={len(seen)}")
        seen.append(n)

    def run(state):
        return S.ingest(S.stream_files(spark, str(src), per_batch=2), parse, sink, str(tmp_path / state), stored=stored)

    first = run("s1")
    assert (first.batches, first.seen, first.failed, first.skipped, first.stored, first.successful) == (3, 6, 1, 1, 4, False) and len(first.problems) == 1
    (src / "new.xml").write_text(XML.format(77))
    second = run("s1")
    assert (second.seen, second.stored, second.successful) == (1, 1, True)
    third = run("s2")
    assert third.stored == 0 and third.skipped == 6 and spark.read.parquet(out).count() == 5
    assert second.row(spark).first().successful


def test_every_failed_row_is_kept(spark, tmp_path):
    src, stored = tmp_path / "in", []
    src.mkdir()
    for i in range(25):
        (src / f"bad{i}.xml").write_text("<article>")
    (src / "good.xml").write_text(XML.format(1))

    def parse(files):
        return jats.parse_files(files).select(F.col("pmid").alias("id"), "source_file", "error", F.lit(None).alias("nothing"))

    def run():
        return S.ingest(S.stream_files(spark, str(src)), parse, lambda rows, n: stored.append(rows.count()), str(tmp_path / "state"))

    p = run()
    assert (p.seen, p.failed, p.stored, len(p.problems)) == (26, 25, 1, 20) and stored == [1]
    (src / "late.xml").write_text("<article>")
    q = run()
    assert q.failed == 1 and q.failures == p.failures == str(tmp_path / "state-failures")
    rows = spark.read.parquet(p.failures).collect()
    assert sorted(r.source_file for r in rows) == sorted([*(f"bad{i}.xml" for i in range(25)), "late.xml"]) and all(r.error for r in rows)


def test_windows_and_watermark_dedupe(spark, tmp_path):
    rows = [(i % 6, f"2024-01-01 00:{m:02d}:00", "k") for i, m in enumerate(range(0, 60, 5))]
    d = str(tmp_path / "in")
    spark.createDataFrame(rows, "id int, t string, k string").select("id", F.to_timestamp("t").alias("t"), "k").coalesce(1).write.parquet(d)
    schema = "id int, t timestamp, k string"
    S.append_new(spark.readStream.schema(schema).parquet(d), str(tmp_path / "once"), str(tmp_path / "c1"), "id", "t", "2 hours")
    assert spark.read.parquet(str(tmp_path / "once")).count() == 6
    S.windowed_counts(spark.readStream.schema(schema).parquet(d), "t", "k", "20 minutes", str(tmp_path / "w"), str(tmp_path / "c2"), "0 minutes")
    assert {r.n for r in spark.read.parquet(str(tmp_path / "w")).collect()} == {4}
