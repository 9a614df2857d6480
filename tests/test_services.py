import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest

from corpusloom.sources import services
from corpusloom.sources.connectors import ServiceError

SET = "<PubmedArticleSet>{}</PubmedArticleSet>"
ONE = "<PubmedArticle><MedlineCitation><PMID Version='1'>{0}</PMID><Article/><Refs><Ref><PMID>99</PMID></Ref></Refs></MedlineCitation><!-- {1} --></PubmedArticle>"


class Handler(BaseHTTPRequestHandler):
    asked: list = []

    def do_GET(self):
        q = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
        self.asked.append((urlsplit(self.path).path, q))
        if q.get("term") == "busy" and len(self.asked) % 2:
            return self.send_error(503)
        if q.get("term") == "bad":
            body = b"no json"
        elif "term" in q:
            body = json.dumps({"esearchresult": {"count": "7", "idlist": ["3", "1"]}}).encode()
        elif "label" in q:
            body = json.dumps([{"label": q["label"].title()}] if q["label"] != "none" else []).encode()
        elif q["db"] == "pmc":
            body = b"<article/>"
        else:
            body = SET.format("".join(ONE.format(i, "é") for i in q["id"].split(",")) + ONE.format(q["id"].split(",")[0], "again") + ONE.format("77", "not asked")).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def client():
    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield services.Client(f"http://127.0.0.1:{server.server_port}", email="me@example.org", api_key="k", pause=0.0, timeout=5)
    server.shutdown()


def test_requests_and_answers(client):
    assert client.search("cough & fever", 2) == (7, ["3", "1"])
    assert Handler.asked[-1] == ("/esearch.fcgi", {"db": "pubmed", "retmode": "json", "sort": "relevance", "retmax": "2", "term": "cough & fever", "email": "me@example.org", "api_key": "k"})
    got = client.records(["5", "6"])
    assert list(got) == ["5", "6"] and got["5"] == ONE.format(5, "é") and Handler.asked[-1][1]["id"] == "5,6"
    assert client.full_text(["PMC1"]) == {"PMC1": "<article/>"} and client.heading("heart attack") == "Heart Attack" and client.heading("none") is None
    with pytest.raises(ValueError):
        client.full_text(["12"])
    with pytest.raises(ServiceError, match="unreadable"):
        client.search("bad")
    with pytest.raises(ServiceError):
        services.Client("http://127.0.0.1:9", pause=0.0, timeout=1).search("x")


def test_split_records():
    assert services.split_records(SET.format("").encode()) == {} and services.split_records(SET.format(ONE.format(" 4 ", "x")).encode()).keys() == {"4"}
    with pytest.raises(ServiceError, match="well-formed"):
        services.split_records(b"<a>")


def test_searches_as_a_table(spark, client):
    df = spark.createDataFrame([(1, "cough"), (2, "busy"), (3, "bad")], "query_id int, term string")
    got = {r.query_id: r for r in services.search_entities(df, client, base=0.0, attempts=3).collect()}
    assert (got[1].n_hits, got[1].ids, got[1].error) == (7, ["3", "1"], None) and got[2].n_hits == 7 and got[3].ids is None and "unreadable" in got[3].error
    assert services.search_entities(df.limit(0), client).count() == 0


def test_only_missing_files_are_fetched(spark, client):
    ids = spark.createDataFrame([("PMC1",), ("pmc2 ",), ("PMC2",), ("x",), (None,)], "id string")
    got = {r.id: (r.content, r.error) for r in services.fetch_full_texts(ids, spark.createDataFrame([("pmc1",)], "id string"), client, base=0.0).collect()}
    assert got == {"PMC2": ("<article/>", None), "X": (None, "no PMC id")}
