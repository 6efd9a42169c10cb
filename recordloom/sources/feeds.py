"""Article feeds as a Spark data source: ``spark.read.format("article_feed")``.

A feed gives one row a record: source, published, position and the record as
the source wrote it, for the parsers of ``landed``. What can be asked at once
is a partition: a batch of ids for PubMed, a slice of the date window with its
own cursor for Crossref and Europe PMC, a landed file for ``landed``. Filters on
``published`` become the window that sources are asked for (or the folders that
are listed), and Spark checks them again on what comes back, since a source may
answer with more.

``max_records`` is dealt to the slices in order, by the number of records that
each declares before anything is fetched, so partitions needn't wait for each
other and together they give what one cursor over the whole window would.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, SimpleDataSourceStreamReader

from recordloom.plans.lineage import cut
from recordloom.sources import fetch

SCHEMA = "source string, published date, position long, record string"
ENDPOINTS = {
    "crossref": "https://api.crossref.org/works",
    "europe_pmc": "https://www.ebi.ac.uk/europepmc/webservices/rest/search",
    "pubmed": "https://eutils.ncbi.nlm.nih.gov/entrez/eutils",
}
#: Ids and records that one request asks for at the most.
IDS, ROWS, MOST_RECORDS, SLICES = 200, 1000, 500, 4
CROSSREF_FIELDS = "DOI,title,container-title,published-online,published-print,published,issued,ISSN,author,URL,type,resource"
_DAY = dt.timedelta(days=1)


@dataclass
class Window:
    """Whole days, both ends included; an end may be open."""

    start: dt.date | None = None
    end: dt.date | None = None

    def narrow(self, f: Filter) -> bool:
        """Takes in a filter on ``published``; says whether it could."""
        kinds = (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
        if not isinstance(f, kinds) or tuple(f.attribute) != ("published",) or not isinstance(f.value, dt.date):
            return False
        if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
            low = f.value + _DAY if isinstance(f, GreaterThan) else f.value
            self.start = low if self.start is None else max(low, self.start)
        if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
            high = f.value - _DAY if isinstance(f, LessThan) else f.value
            self.end = high if self.end is None else min(high, self.end)
        return True

    def holds(self, day: dt.date) -> bool:
        return (self.start is None or day >= self.start) and (self.end is None or day <= self.end)

    def slices(self, n: int) -> list[Window]:
        """Up to ``n`` windows of nearly equal length that follow one another."""
        if self.start is None or self.end is None:
            raise ValueError("a feed over HTTP needs a first and a last day: filter on published")
        days = (self.end - self.start).days + 1
        n = max(0, min(n, days))
        edges = [self.start + _DAY * (days * i // n) for i in range(n + 1)] if n else []
        return [Window(a, b - _DAY) for a, b in zip(edges, edges[1:], strict=False)]


@dataclass
class Part(InputPartition):
    """What one task asks for: ids, a window with a budget, or a landed file."""

    window: Window | None = None
    most: int = 0
    first: int = 0
    ids: tuple[str, ...] = ()
    path: str = ""
    day: dt.date | None = None


def _named(journal: str, issn: str, by_name: str, by_issn: str) -> str:
    name = by_name.format(journal.replace('"', r"\""))
    return f"({name} OR {by_issn.format(issn)})" if issn else name


def _dated(of: dict, parts: tuple[str, ...]) -> dt.date | None:
    for p in parts:
        said = ((of.get(p) or {}).get("date-parts") or [[]])[0]
        try:
            return dt.date(*[*map(int, said), 1, 1][:3])
        except (TypeError, ValueError):
            continue
    return None


def _loose(text: str | None) -> dt.date | None:
    said = (text or "").split("-")
    try:
        return dt.date(*[*map(int, said), 1, 1][:3])
    except ValueError:
        return None


class Crossref:
    """Cursor pages of a date window; the window is part of the request's filter."""

    dates = ("published-online", "published-print", "published", "issued")

    def __init__(self, journal: str, issn: str, endpoint: str, ask: Callable[[str, dict], bytes]) -> None:
        self.journal, self.issn, self.endpoint, self.ask = journal, issn, endpoint, ask

    def _page(self, w: Window, rows: int, cursor: str) -> dict:
        filters = [f"from-pub-date:{w.start}", f"until-pub-date:{w.end}", "type:journal-article", *([f"issn:{self.issn}"] if self.issn else [])]
        asked = {"filter": ",".join(filters), "query.container-title": self.journal, "select": CROSSREF_FIELDS, "rows": rows, "cursor": cursor}
        return json.loads(self.ask(self.endpoint, asked)).get("message") or {}

    def available(self, w: Window) -> int:
        return int(self._page(w, 0, "*").get("total-results") or 0)

    def page(self, w: Window, rows: int, cursor: str) -> tuple[list[tuple[dt.date | None, str]], str]:
        found = self._page(w, rows, cursor)
        return [(_dated(r, self.dates), json.dumps(r)) for r in found.get("items") or [] if isinstance(r, dict)], found.get("next-cursor") or ""


class EuropePmc(Crossref):
    """Cursor pages of a search; the window is part of its terms."""

    def _page(self, w: Window, rows: int, cursor: str) -> dict:
        term = f"{_named(self.journal, self.issn, 'JOURNAL:\"{}\"', 'ISSN:\"{}\"')} AND FIRST_PDATE:[{w.start} TO {w.end}]"
        return json.loads(self.ask(self.endpoint, {"query": term, "format": "json", "resultType": "lite", "pageSize": rows, "cursorMark": cursor}))

    def available(self, w: Window) -> int:
        return int(self._page(w, 1, "*").get("hitCount") or 0)

    def page(self, w: Window, rows: int, cursor: str) -> tuple[list[tuple[dt.date | None, str]], str]:
        found = self._page(w, rows, cursor)
        records = (found.get("resultList") or {}).get("result") or []
        return [(_loose(r.get("firstPublicationDate")), json.dumps(r)) for r in records if isinstance(r, dict)], found.get("nextCursorMark") or ""


class PubMed:
    """Ids of a search first, then their records in batches."""

    def __init__(self, journal: str, issn: str, endpoint: str, ask: Callable[[str, dict], bytes]) -> None:
        self.journal, self.issn, self.endpoint, self.ask = journal, issn, endpoint, ask

    def ids(self, w: Window, most: int) -> list[str]:
        term = f'{_named(self.journal, self.issn, "\"{}\"[Journal]", "\"{}\"[ISSN]")} AND ("{w.start:%Y/%m/%d}"[Date - Publication] : "{w.end:%Y/%m/%d}"[Date - Publication])'
        found = json.loads(self.ask(f"{self.endpoint}/esearch.fcgi", {"db": "pubmed", "term": term, "retmode": "json", "retmax": most, "sort": "pub date"}))
        return [str(i) for i in (found.get("esearchresult") or {}).get("idlist") or []]

    def records(self, ids: tuple[str, ...]) -> Iterator[tuple[dt.date | None, str]]:
        said = self.ask(f"{self.endpoint}/efetch.fcgi", {"db": "pubmed", "id": ",".join(ids), "retmode": "xml"})
        for one in ElementTree.fromstring(said).iter("PubmedArticle"):
            when = [one.find(f".//ArticleDate/{p}") for p in ("Year", "Month", "Day")]
            day = _loose("-".join(e.text or "" for e in when if e is not None)) if when[0] is not None else None
            yield day, ElementTree.tostring(one, encoding="unicode").strip()


def _retried(read: Callable[[], bytes], tries: int = fetch.RETRIES) -> bytes:
    for k in range(tries + 1):
        try:
            return read()
        except OSError:
            if k == tries:
                raise
            time.sleep(fetch.PAUSE * 2**k)
    raise AssertionError


class Landed:
    """Pages that were landed as lines of JSON, in folders ``published=DAY``; a file is a partition."""

    def __init__(self, path: str, most_bytes: int) -> None:
        u = urlsplit(path)
        if u.scheme not in ("", "file"):
            raise ValueError("landed pages are opened in place: the folder must be mounted on every executor")
        self.root, self.most_bytes = u.path, most_bytes

    def days(self) -> list[dt.date]:
        return sorted(dt.date.fromisoformat(n[10:]) for n in os.listdir(self.root) if n.startswith("published=") and n[10:11].isdigit())

    def files(self, days: list[dt.date]) -> list[Part]:
        folders = [(d, os.path.join(self.root, f"published={d}")) for d in days]
        return [Part(path=os.path.join(at, n), day=d) for d, at in folders for n in sorted(os.listdir(at)) if n[0] not in "._"]

    def rows(self, part: Part) -> Iterator[tuple]:
        if os.path.getsize(part.path) > self.most_bytes:
            raise fetch.TooLarge(f"{part.path} holds more than {self.most_bytes} bytes")

        def whole() -> bytes:
            with open(part.path, "rb") as f:
                return f.read()

        position = 0
        for line in _retried(whole).decode().split("\n"):
            for record in (json.loads(line).get("items") or []) if line else ():
                yield "landed", part.day, position, json.dumps(record)
                position += 1


class FeedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.o, self.window = options, Window()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802  (Spark's name)
        for f in filters:
            self.window.narrow(f)
            yield f  # Spark checks it again

    def _most_bytes(self) -> int:
        return int(self.o.get("max_bytes", fetch.MOST_BYTES))

    def _source(self):
        name = self.o.get("source", "landed")
        if name == "landed":
            return Landed(self.o["path"], self._most_bytes())
        check = str if self.o.get("private_hosts") == "true" else fetch.public_url
        ask = lambda url, params: fetch.get(url, params, most=self._most_bytes(), check=check, pause=float(self.o.get("pause", fetch.PAUSE)))
        return {"crossref": Crossref, "europe_pmc": EuropePmc, "pubmed": PubMed}[name](self.o.get("journal", ""), self.o.get("issn", ""), self.o.get("endpoint", ENDPOINTS[name]), ask)

    def partitions(self) -> list[InputPartition]:
        source, left, parts, first = self._source(), int(self.o.get("max_records", MOST_RECORDS)), [], 0
        if isinstance(source, Landed):
            return source.files([d for d in source.days() if self.window.holds(d)])
        slices = self.window.slices(1 if isinstance(source, PubMed) else int(self.o.get("slices", SLICES)))
        if isinstance(source, PubMed):
            ids = source.ids(slices[0], left) if slices else []
            return [Part(ids=tuple(ids[i:i + IDS]), first=i) for i in range(0, len(ids), IDS)]
        for w in slices:
            if n := min(left, source.available(w)):
                parts.append(Part(window=w, most=n, first=first))
                left, first = left - n, first + n
        return parts

    def read(self, part: Part | None) -> Iterator[tuple]:
        if part is None:  # Spark asks once even where there are no partitions
            return
        source, name = self._source(), self.o.get("source", "landed")
        if part.path:
            yield from source.rows(part)
        elif part.ids:
            for k, (day, record) in enumerate(source.records(part.ids)):
                yield name, day, part.first + k, record
        elif part.window:
            got, cursor = 0, "*"
            while got < part.most:
                records, after = source.page(part.window, min(part.most - got, ROWS), cursor)
                for day, record in records[:part.most - got]:
                    yield name, day, part.first + got, record
                    got += 1
                if not records or not after or after == cursor:
                    break
                cursor = after


class FeedStream(SimpleDataSourceStreamReader):
    """Landed days in order; an offset is the last day that has been read. A day's folder must be whole when it appears."""

    def __init__(self, options: dict) -> None:
        self.source, self.days_a_batch = Landed(options["path"], int(options.get("max_bytes", fetch.MOST_BYTES))), int(options.get("days_a_batch", 7))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"day": ""}

    def _rows(self, days: list[dt.date]) -> Iterator[tuple]:
        return iter([r for p in self.source.files(days) for r in self.source.rows(p)])

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        days = [d for d in self.source.days() if d.isoformat() > start["day"]][:self.days_a_batch]
        return self._rows(days), {"day": days[-1].isoformat()} if days else start

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return self._rows([d for d in self.source.days() if start["day"] < d.isoformat() <= end["day"]])


class ArticleFeed(DataSource):
    """Options: source (landed, crossref, europe_pmc, pubmed), path or endpoint, journal, issn, max_records, slices, max_bytes."""

    @classmethod
    def name(cls) -> str:
        return "article_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FeedReader(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return FeedStream(dict(self.options))


def feed(spark: SparkSession, start: dt.date | None = None, end: dt.date | None = None, **options: object) -> DataFrame:
    """Records of a feed within a window of days."""
    spark.dataSource.register(ArticleFeed)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("article_feed").options(**options).load()
    for day, op in ((start, ">="), (end, "<=")):
        rows = rows if day is None else rows.filter(f"published {op} date'{day}'")
    return rows


def fetched(spark: SparkSession, start: dt.date, end: dt.date, **options: object) -> tuple[DataFrame, DataFrame]:
    """(records, check): a feed fetched once, and one row that says how that went.

    The check has source, status, returned_count and detail. A feed that fails
    anywhere gives no records at all: status FAILED. One that gives as many as
    ``max_records`` may have more: PARTIAL.
    """
    source, most = str(options.get("source", "landed")), int(options.get("max_records", MOST_RECORDS))
    try:
        rows = cut(feed(spark, start, end, **options))
        n = rows.count()
        status, detail = ("NO_RESULTS", None) if not n else ("PARTIAL", f"capped at {n}") if source != "landed" and n >= most else ("SUCCESS", None)
    except Exception as e:  # whatever a source does wrong, it has failed
        rows, n, status, detail = spark.createDataFrame([], SCHEMA), 0, "FAILED", f"{type(e).__name__}: {str(e)[:500]}"
    check = spark.createDataFrame([(source, status, n, detail)], "source string, status string, returned_count long, detail string")
    return rows, check


def land(records: DataFrame, path: str, rows_a_page: int = 100) -> None:
    """Writes records (published, record) as pages of lines, in folders by day, as ``landed`` reads them.

    Pages are dealt by day and a hash of the record, so a day of any size is written by many tasks.
    """
    page = F.pmod(F.xxhash64("record"), F.greatest(F.lit(1), F.ceil(F.col("n") / rows_a_page)))
    sizes = records.groupBy("published").agg(F.count(F.lit(1)).alias("n"))
    pages = records.join(sizes, "published").withColumn("page", page).groupBy("published", "page").agg(F.array_sort(F.collect_list("record")).alias("items"))
    line = F.concat(F.lit('{"items":['), F.array_join("items", ","), F.lit("]}"))
    pages.select(line.alias("value"), "published").write.option("maxRecordsPerFile", 20).partitionBy("published").text(path)
