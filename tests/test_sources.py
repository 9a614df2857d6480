import hashlib
import json

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import connectors, jats, records, sinks, tables
from corpusloom.sources.vectors import Collection
from corpusloom.sources.xml_text import parse, running_text

ARTICLE = """<article xmlns:xlink="http://www.w3.org/1999/xlink" article-type="research-article" xml:lang="en"><front>
<journal-meta><journal-title-group><journal-title>J  One</journal-title></journal-title-group></journal-meta>
<article-meta><article-id pub-id-type="pmid">11</article-id><article-id pub-id-type="pmc">22</article-id><article-id pub-id-type="pmcid">99</article-id>
<elocation-id eidtype="doi">10.1/a</elocation-id><title-group><article-title>On <italic>things</italic></article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Doe</surname><given-names>A B</given-names></name></contrib><contrib contrib-type="editor"><name><surname>No</surname></name></contrib>
<contrib><collab>The Group</collab></contrib></contrib-group>
<article-categories><subj-group subj-group-type="article_type"><subject>Review</subject><subject>Review</subject></subj-group></article-categories>
<pub-date><month>3</month><year>2020</year></pub-date><permissions><license xlink:href="http://l"><license-p>Open</license-p></license></permissions>
<kwd-group kwd-group-type="MeSH terms"><kwd>Cough</kwd></kwd-group>
<abstract><title>Abstract</title><sec><title>Aim</title><p>Why.</p></sec></abstract></article-meta></front>
<body><p>Loose.</p><sec><title>1. Methods:</title><p>We did<xref>1</xref>it.</p><table-wrap><p>no</p></table-wrap><sec><label>1.1</label><p>Deep</p></sec><sec><title>Empty</title><sec><title>Leaf</title><p>x</p></sec></sec></sec></body>
<back><ref-list><p>never</p></ref-list></back></article>"""


def files(spark, data):
    return spark.createDataFrame([(n, c.encode()) for n, c in data], "source_file string, content binary")


def test_article(spark):
    got = jats.parse_files(files(spark, [("a.xml", ARTICLE), ("b.xml", "<article><fr"), ("c.xml", "<book/>")]))
    r = jats.parsed(got).first()
    assert (r.pmid, r.pmcid, r.doi, r.title, r.journal, r.publication_date, r.publication_year, r.language, r.license) == ("11", "PMC22", "10.1/a", "On things", "J One", "2020 3", 2020, "en", "Open | http://l")
    assert (r.authors, r.publication_types, r.mesh_terms) == (["A B Doe", "The Group"], ["Review"], ["Cough"])
    assert [(s.title, s.text, s.section_path, s.level) for s in r.abstract_sections] == [("Aim", "Why.", ["Aim"], 1)]
    assert [(s.title, s.text, s.section_path, s.category, s.level) for s in r.body_sections] == [
        ("1. Methods:", "We did 1 it.", ["1. Methods:"], "methods", 1), ("1.1", "Deep", ["1. Methods:", "1.1"], "other", 2), ("Leaf", "x", ["1. Methods:", "Empty", "Leaf"], "other", 3),
    ]
    assert {x.source_file for x in jats.failed(got).collect()} == {"b.xml", "c.xml"}
    assert jats.parse_article(ARTICLE, "a", loose_paragraphs=True)["body_sections"][0]["text"] == "Loose."


@pytest.mark.parametrize(
    ("xml", "text"),
    [
        ("<p>a<i>b</i>c</p>", "a b c"), ("<p>H<sub>2</sub>O</p>", "H2O"), ("<p>seen<xref>[1]</xref>.</p>", "seen[1]."), ("<p>as<xref>12</xref>said</p>", "as 12 said"), ("<p>x<fig>no</fig>y</p>", "x y"),
        ("<p><p>one</p><p>two</p></p>", "one two"), ("<p>a<xref><sup>3</sup></xref>4</p>", "a 3 4"), ("<p>a<!-- c -->b</p>", "ab"),
    ],
)
def test_running_text(xml, text):
    assert running_text(parse(xml)) == text


def test_profile(spark):
    p = jats.profile_files(files(spark, [("a.xml", ARTICLE), ("b.xml", "<x")]))
    total = {(r.kind, r.key): r.n for r in jats.profile_totals(p).collect()}
    assert total["part", "section"] == 5 and total["root", "article"] == 1 and total["article_type", "research-article"] == 1 and any(k == "error" for k, _ in total)


RECORDS = """<Set><PubmedArticle><MedlineCitation><PMID>5</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><Year>2001</Year><Month>Feb</Month><Day>3</Day></PubDate></JournalIssue></Journal>
<ArticleTitle>T</ArticleTitle><Abstract><AbstractText Label="AIM">x</AbstractText><AbstractText>y</AbstractText></Abstract><AuthorList><Author><LastName>Li</LastName><Initials>Q</Initials></Author></AuthorList><Language>eng</Language>
<PublicationTypeList><PublicationType>Review</PublicationType></PublicationTypeList></Article><MeshHeadingList><MeshHeading><DescriptorName MajorTopicYN="Y">Cough</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pmc">7</ArticleId></ArticleIdList></PubmedData></PubmedArticle>
<PubmedBookArticle><BookDocument><PMID>6</PMID><Book><BookTitle>B</BookTitle><Publisher><PublisherName>P</PublisherName></Publisher><PubDate><Year>1999</Year></PubDate></Book></BookDocument></PubmedBookArticle>
<PubmedArticle><MedlineCitation/></PubmedArticle></Set>"""


def test_records(spark):
    got = {r.pmid: r for r in records.parse_records(files(spark, [("r.xml", RECORDS), ("x.xml", "<")])).collect()}
    a, b = got["5"], got["6"]
    assert (a.publication_date, a.abstract, a.authors, a.mesh_terms, a.pmcid, a.has_pmc) == ("2001-02-03", "AIM: x\ny", "Q Li", "Cough [major]", "PMC7", "true")
    assert (b.title, b.book_title, b.publisher, b.publication_year, b.record_type) == ("B", "B", "P", "1999", "pubmed_book_article") and got[None].error
    root = parse(RECORDS)
    assert [records.record_kind(root, i) for i in ("5", "6", "8")] == ["article", "book", "not_found"]


def test_passages(spark):
    xml = """<c><document><infon key="article-id_pmc">7</infon><passage><infon key="section_type">TITLE</infon><text>T</text></passage>
    <passage><infon key="section_type">METHODS</infon><text>m</text></passage><passage><infon key="license">CC</infon><infon key="type">abstract</infon><text/></passage></document></c>"""
    r = records.parse_passages(files(spark, [("p.xml", xml), ("q.xml", "<c/>")])).orderBy("source_file").collect()
    assert (r[0].pmcid, r[0].title, r[0].has_body, r[0].has_abstract, r[0].license) == ("PMC7", "T", True, False, "CC") and r[1].error


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv(spark, tmp_path):
    p = write(tmp_path / "a.csv", '\ufeffpmid,title\n1,"two\nlines, ""q"""\n2,\n')
    assert [tuple(r) for r in tables.read_csv(spark, p, ["pmid"]).collect()] == [("1", 'two\nlines, "q"'), ("2", "")]
    with pytest.raises(tables.MissingColumns, match="doi, year"):
        tables.read_csv(spark, p, ["year", "pmid", "doi"])
    bad = write(tmp_path / "b.csv", "a,b\n1,2\n3\n4,5,6\n")
    with pytest.raises(Exception, match="wrong number of cells"):
        tables.read_csv(spark, bad, strict=True).collect()
    rows, warnings = tables.read_csv_lenient(spark, bad)
    assert [tuple(r) for r in rows.collect()] == [("1", "2"), ("3", ""), ("4", "5")] and warnings.first().n == 2
    with pytest.raises(ValueError, match="duplicate"):
        tables.read_csv(spark, write(tmp_path / "c.csv", "a,a\n1,2\n"), strict=True)
    assert tables.read_csv(spark, write(tmp_path / "d.csv", "a,b\n")).count() == 0


def test_labelled_documents(spark, tmp_path):
    mapping = tables.read_mapping(spark, write(tmp_path / "m.json", '{"Flu": 1, "Cold": 2, "Influenza": 1}'))
    names = tables.invert_mapping(mapping)
    assert {r.id: r["name"] for r in names.collect()} == {1: "Influenza", 2: "Cold"}
    rows = spark.createDataFrame([("\tfever\t", " 1 "), ("fever", "1"), ("  ", "1"), ("°C & 'q'", "2")], "text string, label string")
    got = tables.labelled_documents(rows, names).collect()
    assert [r.text for r in got] == ["Disease: Influenza\nSymptoms: fever", "Disease: Cold\nSymptoms: °C & 'q'"] and got[0].metadata.disease_id == 1
    for bad in ("x", "9"):
        with pytest.raises(Exception, match="label"):
            tables.labelled_documents(spark.createDataFrame([("a", bad)], "text string, label string"), names).collect()
    for bad in ('{"a": "b"}', "{"):
        with pytest.raises(Exception):
            tables.read_mapping(spark, write(tmp_path / "bad.json", bad)).collect()
    assert tables.labelled_documents(rows.limit(0), names).count() == 0


def test_pages_and_manifest(spark, tmp_path):
    (tmp_path / "b.pdf").write_bytes(b"one|two")
    (tmp_path / "a.pdf").write_bytes(b"three")
    got = tables.read_pages(spark, str(tmp_path), lambda c: c.decode().split("|"))
    assert [(r.filename, r.page_number, r.text) for r in got.collect()] == [("a.pdf", 1, "three"), ("b.pdf", 1, "one"), ("b.pdf", 2, "two")]
    m = spark.createDataFrame([(" PMC ", "PMC2"), ("pmc", "PMC1"), ("pmc", "PMC1"), ("doi", "PMC3"), ("pmc", "  ")], "acquisition_route string, pmcid string")
    there = spark.createDataFrame([("/x/PMC1.xml",), ("/x/PMC2.xml",), ("/x/PMC3.xml",), ("/x/.xml",)], "path string")
    assert [r.pmcid for r in tables.manifest_files(m, there).collect()] == ["PMC1", "PMC2"]
    log = spark.createDataFrame([("1, 2,,3",), ("2",)], "pmids string")
    assert {r.id: r.n for r in tables.ids_of_log(log).collect()} == {"1": 1, "2": 2, "3": 1}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "ä")], "i int, s string")
    out = str(tmp_path / "csv")
    sinks.write_csv(df, out, ["i"], files=1)
    assert [tuple(r) for r in spark.read.option("header", "true").csv(out).collect()] == [("1", "ä"), ("2", "b")]
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_csv(df, out)
    t = str(tmp_path / "t")
    sinks.replace_table(df, t)
    sinks.replace_table(df.limit(1), t)
    assert spark.read.parquet(t).count() == 1

    def reject(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.replace_table(df, t, reject)
    assert spark.read.parquet(t).count() == 1
    a = str(tmp_path / "a")
    for _ in range(2):
        sinks.append_batch(df, a, "x")
    assert spark.read.parquet(a).count() == 2
    assert sinks.report_lines([("Title", df.orderBy("i"))]) == ["Title", "-----", "1 | ä", "2 | b", ""]
    got = sinks.write_payloads(spark.createDataFrame([("f1", b"ok"), ("f2", b"")], "source_file string, content binary"), str(tmp_path), valid=lambda c: len(c) > 0).collect()
    assert {r.name: r.written for r in got} == {"f1": True, "f2": False} and (tmp_path / "f1").read_bytes() == b"ok" and not (tmp_path / "f2").exists()


def test_report_has_every_row_of_a_section(spark):
    lines = sinks.report_lines([("Many", spark.range(1500).orderBy("id")), ("Few", spark.range(1))])
    assert lines == ["Many", "----", *map(str, range(1500)), "", "Few", "---", "0", ""]


def test_shards(spark, tmp_path):
    df = spark.range(25).select(F.col("id").alias("k"), F.concat(F.lit("ü"), F.col("id").cast("string")).alias("a")).repartition(7)
    m = sinks.export_shards(df, ["k"], str(tmp_path / "e"), 10)
    got = {r.shard: r for r in m.collect()}
    lines = [sinks.canonical_json({"k": i, "a": f"ü{i}"}) + "\n" for i in range(25)]
    for s in range(3):
        data = "".join(lines[10 * s : 10 * s + 10])
        assert got[s].n_rows == len(data.splitlines()) and got[s].sha256 == hashlib.sha256(data.encode()).hexdigest() and got[s].file == f"windows-0000{s}.jsonl"
        (part,) = (tmp_path / "e" / "lines" / f"shard={s}").glob("*.txt")
        assert part.read_text(encoding="utf-8") == data
    again = sinks.export_shards(df.repartition(3), ["k"], str(tmp_path / "never"), 10, dry_run=True)
    assert {r.sha256 for r in again.collect()} == {r.sha256 for r in got.values()} and not (tmp_path / "never").exists()


def test_collections(spark, tmp_path):
    a, b = (Collection(spark, str(tmp_path), n, 2) for n in ("one", "two"))
    pts = spark.createDataFrame([("x", [3.0, 4.0], "{}"), ("y", [0.0, 0.0], None)], "id string, vector array<double>, payload string")
    assert a.upsert(pts) == 2 and a.upsert(pts) == 2 and a.upsert(pts.limit(0)) == 0
    assert {r.id: r.norm for r in a.read().collect()} == {"x": 5.0, "y": 0.0} and b.read().count() == 0
    assert [r.id for r in a.lookup(["x", "zz"]).collect()] == ["x"] and a.lookup([]).count() == 0
    assert a.inspect().first()[1:4] == (2, 2, 2)
    with pytest.raises(ValueError, match="repeat"):
        a.upsert(pts.unionByName(pts))
    with pytest.raises(ValueError, match="dimensions"):
        a.upsert(pts.select("id", F.array(F.lit(1.0)).alias("vector"), "payload"))
    assert Collection(spark, str(tmp_path), "one", 2).read().count() == 2


def test_connectors(spark):
    waits, calls = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise connectors.ServiceError("busy", 503)
        return {i: f"<{i}>" for i in x if i != "3"}

    assert connectors.with_retry(flaky, ["1"], sleep=waits.append, base=2.0, least=3.0) == {"1": "<1>"} and waits == [3.0, 4.0]
    with pytest.raises(connectors.ServiceError):
        connectors.with_retry(lambda: (_ for _ in ()).throw(connectors.ServiceError("gone", 404)), sleep=waits.append)
    ids = spark.createDataFrame([("1",), ("2",), ("3",), ("2",), (None,)], "id string")
    assert sorted(len(r.ids) for r in connectors.batches(ids, 2).collect()) == [1, 2]

    def service(x):
        if "3" in x:
            raise connectors.ServiceError("bad\nrequest", 400)
        return {i: f"<{i}>" for i in x}

    got = {r.id: r for r in connectors.fetch(connectors.batches(ids, 2), service, base=0.0).collect()}
    assert got["1"].content == "<1>" and got["3"].error == "status 400: ServiceError: bad request" and got["3"].attempts == 1
    hits = connectors.search_hits(spark.createDataFrame([("q", ["b", "a"])], "query_id string, ids array<string>"))
    assert [(r.id, r["rank"]) for r in hits.collect()] == [("b", 1), ("a", 2)]
    tries = spark.createDataFrame([("d", 1, 0), ("d", 2, 4), ("d", 3, 9), ("e", 1, 0)], "g string, o int, n_results int")
    assert sorted((r.g, r.o) for r in connectors.first_success(tries, "g", "o").collect()) == [("d", 1), ("d", 2), ("e", 1)]
    terms = spark.createDataFrame([("Flu ", "Influenza, Human")], "label string, heading string")
    assert connectors.lookup_terms(spark.createDataFrame([("FLU",), ("x",)], "name string"), terms).orderBy("name").collect()[0].heading == "Influenza, Human"


def test_json_stays_canonical():
    assert json.loads(sinks.canonical_json({"b": 1, "a": None})) == {"a": None, "b": 1} and sinks.canonical_json({"b": "é", "a": [1]}) == '{"a":[1],"b":"é"}'
