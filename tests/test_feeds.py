import datetime as dt
import http.server
import json
import threading
from collections import Counter
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from recordloom.sources import feeds, fetch, landed

START, END = dt.date(2026, 8, 1), dt.date(2026, 8, 19)
#: 700 records, 35 or so a day.
RECORDS = [(START + dt.timedelta(days=i % 20), i) for i in range(700)]
PUBLIC = lambda host, port: ["93.184.216.34"]


class Sources(http.server.BaseHTTPRequestHandler):
    """The three services over RECORDS, with a refusal now and then."""

    asked: Counter = Counter()

    def log_message(self, *_):
        pass

    def answer(self, body: bytes, code: int = 200, **headers: str) -> None:
        self.send_response(code)
        for k, v in {"Content-Length": str(len(body)), **headers}.items():
            self.send_header(k.replace("_", "-"), v)
        self.end_headers()
        self.wfile.write(body)

    def do_GET(self):  # noqa: N802
        u = urlsplit(self.path)
        q = {k: v[0] for k, v in parse_qs(u.query).items()}
        self.asked[u.path] += 1
        if self.asked[u.path] % 4 == 2:
            return self.answer(b"", 503, Retry_After="0")
        if u.path == "/moved":
            return self.answer(b"", 302, Location="/crossref?" + u.query)
        if u.path == "/loop":
            return self.answer(b"", 302, Location="/loop")
        if u.path == "/inside":
            return self.answer(b"", 302, Location="http://127.0.0.1:1/")
        if u.path == "/broken":
            return self.answer(b"[1,")
        if u.path == "/crossref":
            f = dict(x.split(":", 1) for x in q["filter"].split(","))
            found = [(d, i) for d, i in RECORDS if f["from-pub-date"] <= d.isoformat() <= f["until-pub-date"]]
            at, n = int(q["cursor"].strip("*") or 0), int(q["rows"])
            items = [{"DOI": f"10.1/{i}", "title": ["T"], "published": {"date-parts": [[d.year, d.month, d.day]]}} for d, i in found[at:at + n]]
            return self.answer(json.dumps({"message": {"total-results": len(found), "next-cursor": str(at + n), "items": items}}).encode())
        if u.path == "/epmc":
            a, b = q["query"].split("[")[1].rstrip("]").split(" TO ")
            found = [(d, i) for d, i in RECORDS if a <= d.isoformat() <= b]
            at, n = int(q["cursorMark"].strip("*") or 0), int(q["pageSize"])
            result = [{"id": str(i), "title": "T", "firstPublicationDate": d.isoformat()} for d, i in found[at:at + n]]
            return self.answer(json.dumps({"hitCount": len(found), "nextCursorMark": str(at + n), "resultList": {"result": result}}).encode())
        if u.path == "/pubmed/esearch.fcgi":
            a, b = (x.split('"')[0].replace("/", "-") for x in q["term"].split('("')[-1].replace(' : "', '|').replace('"[Date - Publication]', "").rstrip(")").split("|"))
            ids = [str(i) for d, i in RECORDS if a <= d.isoformat() <= b]
            return self.answer(json.dumps({"esearchresult": {"count": str(len(ids)), "idlist": ids[:int(q["retmax"])]}}).encode())
        if u.path == "/pubmed/efetch.fcgi":
            days = {str(i): d for d, i in RECORDS}
            one = "<PubmedArticle><MedlineCitation><PMID>{0}</PMID><Article><ArticleTitle>T</ArticleTitle><ArticleDate><Year>{1.year}</Year><Month>{1.month}</Month><Day>{1.day}</Day></ArticleDate></Article></MedlineCitation></PubmedArticle>"
            return self.answer(("<S>" + "".join(one.format(i, days[i]) for i in q["id"].split(",")) + "</S>").encode())
        return self.answer(b"", 404)


@pytest.fixture(scope="module")
def service():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Sources)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def options(service, source, **more):
    at = {"crossref": "/crossref", "europe_pmc": "/epmc", "pubmed": "/pubmed"}[source]
    return {"source": source, "endpoint": service + at, "journal": 'A "J"', "private_hosts": "true", "pause": "0.01", **more}


WANT = sorted(i for d, i in RECORDS if d <= END)


@pytest.mark.parametrize("source", ["crossref", "europe_pmc", "pubmed"])
def test_a_window_is_fetched_whole_in_partitions(spark, service, source):
    rows = feeds.feed(spark, START, END, **options(service, source, max_records=10_000))
    ids = {"crossref": F.regexp_extract("record", r"10\.1/(\d+)", 1), "europe_pmc": F.get_json_object("record", "$.id"), "pubmed": F.regexp_extract("record", r"<PMID>(\d+)", 1)}
    got = rows.select(ids[source].cast("int").alias("i"), "published", F.spark_partition_id().alias("p"), "position").collect()
    assert sorted(r["i"] for r in got) == WANT and all(START <= r["published"] <= END for r in got)
    assert len({r["p"] for r in got}) == 4 and sorted(r["position"] for r in got) == list(range(len(WANT)))


def test_the_window_reaches_the_source_and_is_checked_again(spark, service):
    reader = feeds.FeedReader({})
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThanOrEqual

    given = [GreaterThan(("published",), START), LessThanOrEqual(("published",), END), EqualTo(("record",), "x")]
    assert list(reader.pushFilters(given)) == given
    assert (reader.window.start, reader.window.end) == (START + dt.timedelta(days=1), END)
    day = feeds.feed(spark, START, START, **options(service, "crossref", max_records=10_000))
    assert day.count() == 35
    assert [r["n"] for r in day.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()] == [35]  # one slice of one day


def test_budgets_follow_the_declared_counts(spark, service):
    for most in (1, 100, 301):
        rows = feeds.feed(spark, START, END, **options(service, "crossref", max_records=most)).collect()
        first = [i for i in (r["record"] for r in sorted(rows, key=lambda r: r["position"]))]
        assert len(rows) == most and len(set(first)) == most
    rows, check = feeds.fetched(spark, START, END, **options(service, "europe_pmc", max_records=50))
    assert rows.count() == 50 and tuple(check.first()) == ("europe_pmc", "PARTIAL", 50, "capped at 50")
    rows, check = feeds.fetched(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 9), **options(service, "crossref"))
    assert rows.count() == 0 and check.first()["status"] == "NO_RESULTS"


def test_a_feed_that_fails_gives_nothing(spark, service):
    for more in ({"endpoint": service + "/broken"}, {"endpoint": service + "/nowhere"}, {"max_bytes": "2000"}, {"private_hosts": "false"}):
        rows, check = feeds.fetched(spark, START, END, **{**options(service, "crossref"), **more})
        assert rows.collect() == [] and check.first()["status"] == "FAILED" and check.first()["detail"]


def test_bounded_gets(service):
    ask = lambda path, **more: fetch.get(service + path, check=more.pop("check", str), pause=0.01, **more)
    q = "?filter=from-pub-date:2026-08-01,until-pub-date:2026-08-01&rows=3&cursor=*"
    assert len(fetch.get_json(service + "/moved" + q, check=str, pause=0.01)["message"]["items"]) == 3
    with pytest.raises(fetch.Unsafe, match="too many"):
        ask("/loop")
    with pytest.raises(fetch.TooLarge):
        ask("/crossref" + q, most=50)
    with pytest.raises(ValueError, match="JSON|Expecting"):
        fetch.get_json(service + "/broken", check=str, pause=0.01)

    def guarded(url):
        return url if url.startswith(service + "/inside") else fetch.public_url(url)

    with pytest.raises(fetch.Unsafe, match="not a public host"):
        ask("/inside", check=guarded)


def test_public_urls():
    assert fetch.public_url("HTTPS://EXAMPLE.org?a=1#b", PUBLIC) == "https://example.org/?a=1"
    assert fetch.public_url("http://[2606:2800:220:1:248:1893:25c8:1946]:8080/x", PUBLIC) == "http://[2606:2800:220:1:248:1893:25c8:1946]:8080/x"
    mixed = lambda h, p: ["93.184.216.34", "10.0.0.1"]
    for url, resolver in (("ftp://e.org/", PUBLIC), ("http://u:p@e.org/", PUBLIC), ("http:///x", PUBLIC), ("http://127.0.0.1/", PUBLIC), ("http://[::1]/", PUBLIC), ("http://e.org/", mixed), ("http://e.org/", lambda h, p: []), ("http://e.org:x/", PUBLIC), ("http://169.254.169.254/", PUBLIC)):
        with pytest.raises(fetch.Unsafe):
            fetch.public_url(url, resolver)


def test_landed_pages_prune_folders_and_stream(spark, tmp_path):
    records = spark.createDataFrame([(d, json.dumps({"DOI": f"10.1/{i}", "title": ["A \"b\""], "published": {"date-parts": [[2026, 8, d.day]]}})) for d, i in RECORDS], "published date, record string")
    feeds.land(records.repartition(3), path := f"file://{tmp_path}/pages", rows_a_page=7)
    rows = feeds.feed(spark, START, END, path=path)
    got = [r[0] for r in rows.select(F.get_json_object("record", "$.DOI")).collect()]
    assert sorted(got) == sorted(f"10.1/{i}" for i in WANT)
    articles = landed.crossref_articles(rows.select(F.concat(F.lit('{"message":{"items":['), "record", F.lit("]}}")).alias("payload")).transform(lambda df: landed.parsed(df, landed.CROSSREF)))
    assert articles.filter("title = 'A \"b\"'").count() == len(WANT)
    reader = feeds.FeedReader({"path": path})
    list(reader.pushFilters([feeds.EqualTo(("published",), START)]))
    assert {p.day for p in reader.partitions()} == {START}
    with pytest.raises(Exception, match="holds more than"):
        feeds.feed(spark, path=path, max_bytes=10).count()

    stream = spark.readStream.format("article_feed").options(path=path, days_a_batch=6).load()
    sizes = []
    query = stream.writeStream.foreachBatch(lambda df, n: sizes.append((df.count(), str(df.agg(F.max("published")).first()[0])))).option("checkpointLocation", str(tmp_path / "at")).trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    query.stop()
    assert sum(n for n, _ in sizes) == 700 and sizes[:4] == [(210, "2026-08-06"), (210, "2026-08-12"), (210, "2026-08-18"), (70, "2026-08-20")]
