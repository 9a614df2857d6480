"""Clients of bibliographic web services: requests, answers, and DataFrame operators that ask them.

A client is a small object that goes to the workers; `open_url` does the request and can be replaced by recorded answers.
How often a service may be asked is set by `pause` and by the number of tasks of an operator.
"""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from .connectors import ServiceError, batches, fetch, outstanding, safe_message, with_retry

# Public addresses of the services and the names of their parameters.
UTILITIES = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils"
TERMS = "https://id.nlm.nih.gov/mesh"
RECORDS = ("PubmedArticle", "PubmedBookArticle")
PMCID = re.compile(r"PMC[0-9]+", re.I)


def open_url(url: str, timeout: float) -> bytes:
    """The body of an answer; ServiceError with its status, or without one if nothing answered."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:
            return r.read()
    except urllib.error.HTTPError as e:
        raise ServiceError(str(e.reason), e.code) from None
    except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
        raise ServiceError(str(getattr(e, "reason", e))) from None


@dataclass(frozen=True)
class Client:
    """Where a service is and how it is asked; email and key never appear in errors."""

    base: str = UTILITIES
    email: str = ""
    api_key: str = ""
    pause: float = 0.5
    timeout: float = 30.0
    opener: Callable[[str, float], bytes] = open_url

    def url(self, path: str, **parameters: str | int) -> str:
        known = {k: v for k, v in {**parameters, "email": self.email, "api_key": self.api_key}.items() if v != ""}
        return f"{self.base.rstrip('/')}/{path}?{urllib.parse.urlencode(known)}"

    def get(self, path: str, **parameters: str | int) -> bytes:
        if self.pause:
            time.sleep(self.pause)
        return self.opener(self.url(path, **parameters), self.timeout)

    def search(self, term: str, most: int = 20) -> tuple[int, list[str]]:
        """(hits in all, ids of the first `most` by relevance)."""
        answer = self.get("esearch.fcgi", db="pubmed", retmode="json", sort="relevance", retmax=most, term=term)
        try:
            found = json.loads(answer)["esearchresult"]
            return int(found["count"]), [str(i) for i in found["idlist"]]
        except (ValueError, KeyError, TypeError) as e:
            raise ServiceError(f"unreadable answer: {e}") from None

    def records(self, ids: list[str]) -> dict[str, str]:
        """The record of each id that the answer holds; of several the first; others than those asked for are left out."""
        found = split_records(self.get("efetch.fcgi", db="pubmed", retmode="xml", id=",".join(ids)))
        return {i: found[i] for i in ids if i in found}

    def full_text(self, ids: list[str]) -> dict[str, str]:
        """The article files of PMC ids, one request each; an id of another form is an error."""
        out = {}
        for i in ids:
            if not PMCID.fullmatch(i):
                raise ValueError(f"{i} is no PMC id")
            out[i] = self.get("efetch.fcgi", db="pmc", retmode="xml", id=i).decode()
        return out

    def heading(self, label: str) -> str | None:
        """The first heading of exactly that label; null if there is none or no readable answer."""
        try:
            hits = json.loads(self.get("lookup/descriptor", label=label, match="exact", limit=1))
            return hits[0]["label"] if hits else None
        except (ServiceError, ValueError, KeyError, TypeError, IndexError):
            return None


def split_records(content: bytes) -> dict[str, str]:
    """The records of an answer by their ids, cut out of its bytes; ServiceError if it is not well-formed."""
    found: dict[str, str] = {}
    at: list[str] = []
    begin, pmid = 0, ""

    def start(name: str, _: dict) -> None:
        nonlocal begin, pmid
        at.append(name)
        if name in RECORDS:
            begin, pmid = reader.CurrentByteIndex, ""

    def text(data: str) -> None:
        nonlocal pmid
        # the record's own id stands two levels below it; references have theirs deeper down
        if at[-1] == "PMID" and len(at) >= 3 and at[-3] in RECORDS:
            pmid += data

    def end(name: str) -> None:
        at.pop()
        if name in RECORDS and pmid.strip():
            stop = content.index(b">", reader.CurrentByteIndex) + 1
            found.setdefault(pmid.strip(), content[begin:stop].decode())

    reader = expat.ParserCreate()
    reader.StartElementHandler, reader.CharacterDataHandler, reader.EndElementHandler = start, text, end
    try:
        reader.Parse(content, True)
    except expat.ExpatError as e:
        raise ServiceError(f"not well-formed XML: {e}", 502) from None
    return found


def search_entities(terms: DataFrame, client: Client, most: int = 20, attempts: int = 4, base: float = 1.0, tasks: int = 1) -> DataFrame:
    """(query_id, n_hits, ids, error) of (query_id, term): a failing search is a row of its own."""
    out = "query_id long, n_hits long, ids array<string>, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for q, term in zip(pdf["query_id"], pdf["term"]):
                try:
                    n, ids = with_retry(client.search, term, most, attempts=attempts, base=base)
                    rows.append((q, n, ids, None))
                except Exception as e:  # noqa: BLE001 - any failure of a service is a row, not the end of the job
                    rows.append((q, None, None, safe_message(e)))
            yield pd.DataFrame(rows, columns=["query_id", "n_hits", "ids", "error"])

    return terms.select(F.col("query_id").cast("bigint").alias("query_id"), "term").coalesce(tasks).mapInPandas(run, out)


def fetch_records(ids: DataFrame, client: Client, size: int = 200, **how) -> DataFrame:
    """(id, content, error, attempts) of ids (id), asked for in batches."""
    return fetch(batches(ids, size), client.records, **how)


def fetch_full_texts(ids: DataFrame, there: DataFrame, client: Client, **how) -> DataFrame:
    """(id, content, error, attempts) of the PMC ids (id) whose file is not there (id) yet; ids of another form are errors."""
    wanted = ids.select(F.upper(strip("id")).alias("id"))
    good = F.col("id").rlike("^PMC[0-9]+$")
    bad = wanted.where(~good).distinct().select("id", F.lit(None).cast("string").alias("content"), F.lit("no PMC id").alias("error"), F.lit(0).alias("attempts"))
    left = outstanding(wanted.where(good), there.select(F.upper(strip("id")).alias("id")))
    return fetch(batches(left, 1), client.full_text, **how).unionByName(bad)
