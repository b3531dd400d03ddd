"""Paper sources: how answers of literature services become paper rows, and a Spark data source over stored or live answers.

Parsing is pure and needs no network. The data source asks a service with requests spaced by rate and repeated with growing pauses.
A search is a row of pages of PAGE papers, read as a batch or as a stream whose offset is the number of papers asked for so far.
A request that failed for good, or whose answer cannot be read, is a row with `error`, so no result is short without saying so."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from urllib.parse import quote, urlencode

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.pandas.types import to_arrow_schema

SCHEMA = "source string, external_id string, title string, abstract string, authors array<string>, journal string, year int, doi string, pmcid string, url string, fulltext_url string, pdf_url string, is_open_access boolean"
FIELDS = [x.split()[0] for x in SCHEMA.split(", ")]
#: What the data source gives: papers, and requests that failed (error; all else but the source null).
ASKED = f"{SCHEMA}, error string"


def paper(**known) -> tuple:
    return tuple(known.get(f) for f in FIELDS)


def number(text) -> int | None:
    try:
        return int(str(text)[:4])
    except (TypeError, ValueError):
        return None


def pubmed(xml: str) -> list[tuple]:
    """Articles of an efetch answer; a broken answer has none."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    said = lambda node, path: (x.text or "").strip() if node is not None and (x := node.find(path)) is not None else ""
    out = []
    for a in root.iter("PubmedArticle"):
        art = a.find("MedlineCitation/Article")
        if art is None:
            continue
        ids = {x.get("IdType"): x.text for x in reversed(list(a.iter("ArticleId")))}
        pmid, pmc = said(a, "MedlineCitation/PMID"), ids.get("pmc")
        people = [f"{said(p, 'LastName')}, {said(p, 'ForeName')}".strip(", ") for p in art.iter("Author") if said(p, "LastName")]
        out.append(paper(
            source="pubmed", external_id=pmid, title=said(art, "ArticleTitle"), abstract=" ".join(t.text for t in art.iter("AbstractText") if t.text), authors=people,
            journal=said(art, ".//Title") or said(art, ".//ISOAbbreviation"), year=number(said(art, ".//PubDate/Year")), doi=ids.get("doi"), pmcid=pmc, url=f"https://pubmed.ncbi.nlm.nih.gov/{pmid}/",
            fulltext_url=f"https://pmc.ncbi.nlm.nih.gov/articles/{pmc}/" if pmc else None, is_open_access=bool(pmc),
        ))
    return out


def pmc_pdf(xml: str) -> str | None:
    """The PDF link of an open-access record, by https."""
    try:
        links = [x.get("href", "") for x in ET.fromstring(xml).iter("link") if x.get("format") == "pdf"]
    except ET.ParseError:
        return None
    return links[0].replace("ftp://", "https://", 1) if links else None


def doaj(answer: str) -> list[tuple]:
    out = []
    for r in json.loads(answer).get("results", []):
        b = r.get("bibjson", {})
        doi = next((x.get("id") for x in b.get("identifier", []) if x.get("type") == "doi"), None)
        full = next((x.get("url") for x in reversed(b.get("link", [])) if x.get("type") in ("fulltext", "pdf")), None)
        out.append(paper(source="doaj", external_id=r.get("id", ""), title=b.get("title", ""), abstract=b.get("abstract", ""), authors=[x.get("name", "") for x in b.get("author", [])], journal=b.get("journal", {}).get("title", ""), year=number(b.get("year")), doi=doi, url=full or (f"https://doi.org/{doi}" if doi else ""), fulltext_url=full, is_open_access=True))
    return out


def plos(answer: str) -> list[tuple]:
    out = []
    for d in json.loads(answer).get("response", {}).get("docs", []):
        doi, text = d.get("doi", ""), d.get("abstract", [])
        page = "https://journals.plos.org/plosone/article"
        out.append(paper(source="plos", external_id=d.get("id", doi), title=d.get("title_display", ""), abstract=" ".join(text) if isinstance(text, list) else text, authors=d.get("author_display", []), journal=d.get("journal", "PLOS"), year=number(d.get("publication_date")), doi=doi, url=f"https://doi.org/{doi}" if doi else "", fulltext_url=f"{page}?id={doi}" if doi else "", pdf_url=f"{page}/file?id={doi}&type=printable" if doi else "", is_open_access=True))
    return out


def pmc(xml: str) -> list[tuple]:
    """Open-access records: one paper a record, with the link to its PDF."""
    try:
        records = list(ET.fromstring(xml).iter("record"))
    except ET.ParseError:
        return []
    return [paper(source="pmc", external_id=r.get("id", ""), pmcid=r.get("id"), pdf_url=pmc_pdf(ET.tostring(r, "unicode")), is_open_access=True) for r in records]


PARSERS: dict[str, Callable[[str], list[tuple]]] = {"pubmed": pubmed, "pmc": pmc, "doaj": doaj, "plos": plos}

# Addresses of the services, fields of a search, papers that one request takes.
PUBMED = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils"
PMC = "https://www.ncbi.nlm.nih.gov/pmc/utils/oa/oa.fcgi"
DOAJ = "https://doaj.org/api"
PLOS = "https://api.plos.org"
PLOS_FIELDS = "id,title_display,abstract,author_display,journal,publication_date,doi,article_type"
BASES = {"pubmed": PUBMED, "doaj": DOAJ, "plos": PLOS}
PAGE = 100


def search_url(service: str, query: str, start: int, count: int, base: str | None = None, **who: str) -> str:
    """The address of a search's papers from start (0 is the best) on; who: tool, email, api_key. For pubmed the answer has ids only."""
    base = base or BASES[service]
    if service == "pubmed":
        return f"{base}/esearch.fcgi?" + urlencode({**who, "db": "pubmed", "term": query, "retstart": start, "retmax": count, "retmode": "json", "sort": "relevance", "filter": "lang.english"})
    if service == "doaj":
        return f"{base}/search/articles/{quote(query, safe='')}?" + urlencode({**who, "pageSize": count, "page": start // count + 1})
    return f"{base}/search?" + urlencode({**who, "q": query, "fl": PLOS_FIELDS, "rows": count, "start": start, "wt": "json", "sort": "score desc"})


def found_ids(answer: str) -> list[str]:
    """Ids of a search's answer."""
    return [str(i) for i in json.loads(answer)["esearchresult"]["idlist"]]


def detail_urls(ids: list[str], base: str = PUBMED, size: int = PAGE, **who: str) -> list[str]:
    return [f"{base}/efetch.fcgi?" + urlencode({**who, "db": "pubmed", "id": ",".join(ids[k : k + size]), "retmode": "xml", "rettype": "abstract"}) for k in range(0, len(ids), size)]


def pmc_urls(pmcids: list[str], base: str = PMC) -> list[str]:
    return [f"{base}?" + urlencode({"id": i}) for i in pmcids]


def polite(fetch: Callable[[str], tuple[int, str]], per_second: float, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str | None]:
    """Wraps fetch (url -> status and text): requests are spaced, failures repeated with growing pauses, longer after a 429."""
    last = [0.0]

    def ask(url: str) -> str | None:
        for n in range(1, attempts + 1):
            wait = last[0] + 1 / per_second - time.monotonic()
            if wait > 0:
                sleep(wait)
            last[0] = time.monotonic()
            status, text = fetch(url)
            if status == 200:
                return text
            if n < attempts:
                sleep(5.0 * n if status == 429 else 2.0**n)
        return None

    return ask


def fetched(url: str) -> tuple[int, str]:
    """Status and text of an address; 0 where the service cannot be reached."""
    try:
        with urllib.request.urlopen(url, timeout=60) as r:
            return r.status, r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, ""
    except OSError:
        return 0, ""


class Service:
    """One service behind one clock: searches by page, and addresses; (papers, error) of each request."""

    def __init__(self, options: dict):
        self.kind, self.query = options["service"], options.get("query")
        if self.kind not in PARSERS or self.query and self.kind not in BASES:
            raise ValueError(f"no such search: {self.kind}")
        self.urls, self.most = json.loads(options.get("urls", "[]")), int(options.get("most", "50"))
        self.base, self.page = options.get("base") or BASES.get(self.kind), max(1, min(int(options.get("page", PAGE)), self.most))
        self.rate, self.attempts, self.pause = float(options.get("perSecond", "2")), int(options.get("attempts", "3")), float(options.get("pause", "1"))
        self.who = {k: options[k] for k in ("tool", "email", "api_key") if options.get(k)}
        self._ask = None

    def ask(self, url: str) -> str | None:
        if self._ask is None:
            self._ask = polite(fetched, self.rate, self.attempts, lambda seconds: time.sleep(seconds * self.pause))
        return self._ask(url)

    def parsed(self, url: str) -> tuple[list[tuple], str | None]:
        answer = self.ask(url)
        if answer is None:
            return [], f"no answer from {url}"
        try:
            if answer.lstrip()[:1] == "<":
                ET.fromstring(answer)  # the parsers take a broken answer as one without papers
            return PARSERS[self.kind](answer), None
        except (ValueError, KeyError, AttributeError, TypeError, ET.ParseError) as e:
            return [], f"cannot read the answer from {url}: {e}"

    def searched(self, start: int, count: int) -> tuple[list[tuple], int, str | None]:
        """Papers of a search from start on, how many the service had there, and an error."""
        url = search_url(self.kind, self.query, start, count, self.base, **self.who)
        if self.kind != "pubmed":
            papers, error = self.parsed(url)
            return papers, len(papers), error
        answer = self.ask(url)
        try:
            if answer is None:
                return [], 0, f"no answer from {url}"
            ids = found_ids(answer)
        except (ValueError, KeyError, TypeError) as e:
            return [], 0, f"cannot read the answer from {url}: {e!r}"
        out, errors = [], []
        for details in detail_urls(ids, self.base, **self.who):
            papers, error = self.parsed(details)
            out += papers
            errors += [error] if error else []
        return out, len(ids), "; ".join(errors) or None

    def rows(self, papers: list[tuple], error: str | None) -> Iterator[tuple]:
        yield from ((*p, None) for p in papers)
        if error:
            yield (*paper(source=self.kind), error)

    def pages(self, start: int, end: int) -> Iterator[tuple]:
        """Rows of a search's pages; a page that could not be had does not hide the next ones, an empty one is the last."""
        while start < end:
            papers, found, error = self.searched(start, self.page)
            yield from self.rows(papers[: end - start], error)
            if not found and not error:
                return
            start += self.page


class Requests(InputPartition):
    """All requests to one service: one partition, so that its one clock spaces them."""


class PaperReader(DataSourceReader):
    def __init__(self, options: dict):
        self.service = Service(options)

    def partitions(self):
        return [Requests(None)]

    def read(self, partition) -> Iterator[tuple]:
        service = self.service
        if service.query:
            yield from service.pages(0, service.most)
        for url in service.urls:
            yield from service.rows(*service.parsed(url))


class PaperStream(SimpleDataSourceStreamReader):
    """A search as a stream: its offset is the place of the next paper to ask for. A page that failed is asked for again in the next
    batch, `retries` times; then its row with `error` is given and the stream goes on. At `most`, or behind the last page, it rests."""

    def __init__(self, options: dict):
        self.service, self.retries = Service(options), int(options.get("retries", "3"))
        if not self.service.query:
            raise ValueError("a stream needs a query")

    def initialOffset(self) -> dict:
        return {"start": 0, "tries": 0, "done": False}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        at, service = start["start"], self.service
        if start["done"] or at >= service.most:
            return iter([]), start
        papers, found, error = service.searched(at, service.page)
        if error and not papers and start["tries"] < self.retries:
            return iter([]), {**start, "tries": start["tries"] + 1}
        end = {"start": at + service.page, "tries": 0, "done": not found and not error}
        return iter(list(service.rows(papers[: service.most - at], error))), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """A batch once more, after a failure: asked for again."""
        return self.service.pages(start["start"], min(end["start"], self.service.most))

    def commit(self, end: dict) -> None:
        """Nothing is kept for a batch."""


class PaperSource(DataSource):
    """format("papers"), as a batch or a stream: option service (pubmed, pmc, doaj, plos) with urls (a JSON list), or for pubmed, doaj
    and plos a query, of which the `most` best papers are read by pages. perSecond spaces requests, attempts repeats failed ones,
    pause stretches the time between; tool, email and api_key go with them."""

    @classmethod
    def name(cls) -> str:
        return "papers"

    def schema(self) -> str:
        return ASKED

    def reader(self, schema) -> DataSourceReader:
        return PaperReader(self.options)

    def simpleStreamReader(self, schema) -> PaperStream:
        return PaperStream(self.options)


def parse_answers(answers: DataFrame) -> DataFrame:
    """answers: service, answer (texts kept from services). One row per paper; unknown services and broken answers have none."""
    names, fields = [x.split()[0] for x in SCHEMA.split(", ")], T.StructType.fromDDL(SCHEMA)
    kinds = to_arrow_schema(fields)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for service, answer in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    found += PARSERS[service](answer)
                except (KeyError, ValueError, AttributeError, TypeError):
                    continue
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], names)

    return answers.select("service", "answer").mapInArrow(parse, fields)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PaperSource)
