import datetime as dt
import hashlib
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from recordloom.operators import hashtree
from recordloom.sources import landed, sinks
from recordloom.streaming.backfill import merge_stream


def test_crossref_pages(spark, tmp_path):
    items = [
        {"DOI": "10.1/A", "URL": "https://doi.org/10.1/A", "type": "journal-article", "title": ["A <i>b</i> &amp; c"], "container-title": ["J"], "ISSN": ["25743805"], "author": [{"given": "X", "family": "Y"}, {"name": "Group"}], "published-print": {"date-parts": [[2026, 8]]}, "issued": {"date-parts": [[2025]]}},
        {"DOI": "10.1/B", "title": ["No date"]},
    ]
    (tmp_path / "p.json").write_text(json.dumps({"message": {"items": items}}))
    (r,) = landed.crossref_pages(spark, str(tmp_path)).collect()
    assert (r["title"], r["publication_date"], r["publication_date_precision"], r["doi"], r["issns"], r["authors"]) == ("A b & c", dt.date(2026, 8, 1), "MONTH", "10.1/a", ["2574-3805"], ["X Y", "Group"])


def test_europe_pmc_pages(spark, tmp_path):
    row = {"id": "77", "pmcid": "pmc5", "title": "T.", "authorString": "A B, C D.", "firstPublicationDate": "2026-08-13", "journalInfo": {"journal": {"title": "J", "issn": "1234-567x"}}}
    (tmp_path / "p.json").write_text(json.dumps({"resultList": {"result": [row]}}))
    (r,) = landed.europe_pmc_pages(spark, str(tmp_path)).collect()
    assert (r["pmid"], r["pmcid"], r["authors"], r["issns"], r["publication_date"]) == ("77", "PMC5", ["A B", "C D"], ["1234-567X"], dt.date(2026, 8, 13))


def test_pubmed_xml(spark, tmp_path):
    (tmp_path / "p.xml").write_text("""<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>5</PMID><Article><Journal><ISSN>1234-5678</ISSN><JournalIssue><PubDate><Year>2026</Year><Month>Aug</Month></PubDate></JournalIssue><Title>J</Title></Journal>
    <ArticleTitle>Some <b>title</b></ArticleTitle><Abstract><AbstractText Label="METHODS">We did.</AbstractText><AbstractText>It worked.</AbstractText></Abstract><AuthorList><Author><LastName>Doe</LastName><ForeName>Jo A</ForeName><Initials>JA</Initials></Author><Author ValidYN="Y"><LastName>Roe</LastName><Initials>R</Initials></Author><Author><CollectiveName>The &amp; Group</CollectiveName></Author></AuthorList></Article></MedlineCitation>
    <PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/Z</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>""")
    (r,) = landed.pubmed_xml(spark, str(tmp_path)).collect()
    assert (r["pmid"], r["title"], r["doi"], r["publication_date"], r["publication_date_precision"]) == ("5", "Some title", "10.1/z", dt.date(2026, 8, 1), "MONTH")
    assert r["abstract"] == "METHODS: We did.\n\nIt worked." and r["authors"] == ["Jo A Doe", "R Roe", "The & Group"]


def test_surrogate_dates_close_on_doubt(spark):
    good = ("A title", "Chem J", "10.1039/X1", ["2041-6520"], "P", "10.1039", "journal-article", [2026, 8, 5])
    bad = [("Front Cover", *good[1:]), (good[0], "Other", *good[2:]), (*good[:2], "10.2/x", *good[3:]), (*good[:7], [2026, 8]), (*good[:3], ["1234-5678"], *good[4:])]
    df = spark.createDataFrame([good, *bad], "title string, journal string, doi string, issns array<string>, publisher string, prefix string, type string, created array<int>")
    rows, counts = landed.surrogate_dated(df, "Chem J", "2041-6520", "P", "10.1039", "surrogate")
    (r,) = rows.collect()
    assert (r["publication_date"], r["doi"], [x["source"] for x in r["source_records"]]) == (dt.date(2026, 8, 5), "10.1039/x1", ["crossref", "surrogate"])
    c = counts.first()
    assert (c["seen"], c["fails_furniture"], c["fails_created"]) == (6, 1, 1)


def test_journal_homes_and_months(spark):
    page = "<html><title>My Journal | Press</title><body>Open access ISSN: 1234-5678 (Print), 8765-432X (Online)</body></html>"
    df = spark.createDataFrame([("a", page), ("b", page.replace("Open access", "Contains open access"))], "slug string, html string")
    a, b = landed.journal_homes(df).orderBy("slug").collect()
    assert (a["name"], a["issn"], a["print_issn"], a["fully_open"], b["fully_open"]) == ("My Journal", "8765-432X", "1234-5678", True, False)
    rows = spark.createDataFrame([(i, "August 2026" if i < 5 else "July 2026") for i in range(8)], "id int, label string")
    kept, counts = landed.month_snapshot(rows, "label", 2026, 8, 3, [F.col("id")])
    assert [r["id"] for r in kept.collect()] == [0, 1, 2] and tuple(counts.first()) == (5, 3, True)


def test_catalogues(spark, tmp_path):
    for name, provider, journals, n in (("a", "One", [{"slug": "x", "name": "X", "sources": ["s"]}, {"slug": "x", "name": "", "provider": "two"}], 3), ("b", "one", [{"slug": "Bad_slug", "name": "Y", "sources": [""]}], 1)):
        (tmp_path / f"{name}.json").write_text(json.dumps({"provider": provider, "publisher": "P", "journals": journals, "journal_count": n}))
    journals, wrong = landed.provider_catalogs(spark, str(tmp_path))
    assert journals.count() == 3 and {r["publisher"] for r in journals.collect()} == {"P"}
    assert {r["check"] for r in wrong.collect()} == {"JOURNAL_COUNT", "PROVIDER_REPEATS", "SLUG", "NAME", "SOURCES", "OTHER_PROVIDER", "SLUG_REPEATS"}
    reg = spark.createDataFrame([("a", "J", "active", ["c"]), ("a", "", "odd", [""])], "slug string, journal string, status string, categories array<string>")
    assert sorted(r["check"] for r in landed.registry_violations(reg).collect()) == ["CATEGORIES", "NAME", "SLUG_REPEATS", "STATUS"]


def test_batch_requests(tmp_path):
    from recordloom.sources.requests import RequestError, batch_request

    good = {"request_id": "r-1", "acquisition_start": "2026-08-01", "acquisition_end": "2026-08-14", "revision": 2, "journals": ["a", "b-2"], "max_records_by_journal": {"a": 10}, "policy_override_journals": ["a"], "provider": " Prov "}
    at = tmp_path / "r.json"
    at.write_text(json.dumps(good))
    assert batch_request(at).provider == "prov" and batch_request(at).limits == {"a": 10}
    for change in ({"acquisition_end": "2026-09-01"}, {"journals": ["a", "a"]}, {"journals": []}, {"revision": 0}, {"max_records_by_journal": {"a": 5001}}, {"policy_override_journals": ["b-2"]}, {"allow_planned_journals": ["z"]}, {"request_id": "a b"}, {"acquisition_start": "x"}, {"max_records_by_journal": {"a": True}}):
        at.write_text(json.dumps(good | change))
        with pytest.raises(RequestError):
            batch_request(at)


def test_html_cards(spark):
    html = "<li class='card'><a href='/x'>One &amp; two</a><span>2026-08-13</span></li><li class='card'><a href='/y'>Three</a><span>2026-07-01</span></li>"
    df = spark.createDataFrame([("l", html)], "page string, html string")
    rows = landed.html_cards(df, "html", "(?s)<li class='card'>.*?</li>", {"title": "(?s)<a[^>]*>(.*?)</a>", "date": "<span>(.*?)</span>"}, ("page",))
    assert [r["title"] for r in landed.until_older(rows.withColumn("d", F.to_date("date")), "d", "2026-08-01").collect()] == ["One & two"]
    one, ok = landed.reconciled(rows, "title", 2)
    assert ok and one.count() == 2


def test_immutable_snapshots(spark, tmp_path):
    df = spark.range(5).select(F.col("id").cast("string").alias("k"))
    at = str(tmp_path / "s")
    assert sinks.write_immutable(df, at) == "WRITTEN"
    assert sinks.write_immutable(df.repartition(3), at) == "UNCHANGED"
    with pytest.raises(sinks.Conflict):
        sinks.write_immutable(df.limit(4), at)


def test_snapshots_are_proven_and_broken_ones_recovered(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.when(F.col("id") % 9 > 0, F.lit("x")).alias("w"))
    at = f"{tmp_path}/s"
    assert sinks.write_immutable(df, at, ("v",), ("k",)) == "WRITTEN" and sinks.write_immutable(df.repartition(5), at, ("v",), ("k",)) == "UNCHANGED"
    assert sinks.verify_snapshot(spark, at, ("k",)).collect() == []
    other = df.withColumn("w", F.when(F.col("k") == 77, "y").otherwise(F.col("w")))
    (leaf,) = hashtree.changed(df, other, ["k"]).collect()
    assert (leaf["k"], leaf["change"]) == (77, "CHANGED")
    with pytest.raises(sinks.Conflict, match=f"key ranges {leaf['prefix']}$"):
        sinks.write_immutable(other, at, ("v",), ("k",))
    # Equal sums aren't equal rows: two values that change places.
    swapped = df.withColumn("w", F.when(F.col("k") == 9, "x").when(F.col("k") == 10, None).otherwise(F.col("w")))
    assert {r["k"] for r in hashtree.changed(df, swapped, ["k"]).collect()} == {9, 10}
    shutil.rmtree(f"{at}/_tree")
    assert sinks.write_immutable(df, at, ("v",), ("k",)) == "RECOVERED" and sinks.write_immutable(df, at, ("v",), ("k",)) == "UNCHANGED"
    one = next(p for p in sorted((tmp_path / "s").rglob("*.parquet")) if "_tree" not in str(p))
    one.rename(one.with_name("part-renamed.parquet"))
    assert {r["check"] for r in sinks.verify_snapshot(spark, at, ("k",)).collect()} == {"FILE_MISSING", "FILE_ADDED"}
    one.with_name("part-renamed.parquet").unlink()
    spark.catalog.refreshByPath(at)
    assert {r["check"] for r in sinks.verify_snapshot(spark, at, ("k",)).collect()} == {"FILE_MISSING", "ROWS_DIFFER"}
    os.remove(f"{at}/_SUCCESS")
    assert sinks.write_immutable(df, at, ("v",), ("k",)) == "RECOVERED" and spark.read.parquet(at).count() == 500


def test_trees_of_repeats_nulls_and_nothing(spark):
    some = spark.createDataFrame([("a", 1), ("a", 1), (None, None)], "k string, v int")
    once = hashtree.tree(some, ["k"])
    assert hashtree.root(once) == hashtree.root(hashtree.tree(some.repartition(3), ["k"])) != hashtree.root(hashtree.tree(some.distinct(), ["k"]))
    assert once.filter("prefix = ''").first()["rows"] == 3
    none = some.limit(0)
    assert hashtree.root(hashtree.tree(none, ["k"])) == hashtree.root(hashtree.tree(none, ["v"]))
    assert {r["change"] for r in hashtree.changed(none, some, ["k"]).collect()} == {"ADDED"}


def test_a_vault_takes_only_what_is_new(spark, tmp_path):
    df = spark.createDataFrame([(bytearray(b"a"),), (bytearray(b"b"),), (bytearray(b"a"),), (None,)], "content binary")
    at = str(tmp_path / "v")
    assert {(r["bytes"], r["stored"]) for r in sinks.store_payloads(df, at).collect()} == {(1, True)}
    again = sinks.store_payloads(df.union(spark.createDataFrame([(bytearray(b"ccc"),)], "content binary")), at).collect()
    assert sorted((r["bytes"], r["stored"]) for r in again) == [(1, False), (1, False), (3, True)]
    assert spark.read.parquet(at).count() == 3
    (r,) = [r for r in again if r["stored"]]
    assert r["sha256"] == hashlib.sha256(b"ccc").hexdigest()


def test_vault(spark, tmp_path):
    digest = hashlib.sha256(b"abc").hexdigest()
    (tmp_path / f"{digest}.txt").write_bytes(b"abc")
    (r,) = landed.vault(spark, str(tmp_path)).collect()
    assert (r["sha256"], r["bytes"]) == (digest, 3)


def test_receipts_hide_payloads(spark):
    df = spark.range(1).select(F.struct(F.lit("x").alias("payload")).alias("receipt"))
    assert sinks.forbidden_fields(df.schema) == ["receipt.payload"]


def test_streamed_backfill(spark, tmp_path):
    base = spark.createDataFrame([("1", "a")], "id string, name string")
    schema = "idx int, id string, name string"
    spark.createDataFrame([(0, "1", "z"), (1, "2", "b")], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        q = merge_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), base, str(tmp_path / "out"), str(tmp_path / "cp"), "id", "idx")
        q.awaitTermination(60)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out" / "snapshot=000000")).select("id", "name").collect())) == [("1", "a"), ("2", "b")]


def test_pubmed_articles_are_parsed_once_and_dealt_over_all_cores(spark, monkeypatch):
    from recordloom.plans import record_queries

    def whole(journal="", title="<ArticleTitle>T</ArticleTitle>"):
        return f"<PubmedArticle><MedlineCitation><PMID>1</PMID><Article><Journal>{journal}</Journal>{title}</Article></MedlineCitation></PubmedArticle>"

    cases = [
        (whole(), "T", "", []), (whole("<Title>J</Title><ISSN>1234-5678</ISSN>"), "T", "J", ["1234-5678"]), (whole("<ISSN>1234-5678</ISSN><ISSN>bad</ISSN><ISSN>2234-567x</ISSN>"), "T", "", ["1234-5678", "2234-567X"]),
        (whole(title=""), "", "", []), (whole(title="<ArticleTitle>a <i>b</i></ArticleTitle><ArticleTitle>c</ArticleTitle>"), "a bc", "", []), (whole("<Title>x<![CDATA[ & y]]></Title>", "<ArticleTitle>a<![CDATA[b]]>c</ArticleTitle>"), "abc", "x & y", []),
    ]
    made = landed.pubmed_articles(spark.createDataFrame([(c[0],) for c in cases], "x string"))
    assert [(r["title"], r["journal"], r["issns"], r["pmid"], r["doi"]) for r in made.collect()] == [(*c[1:], "1", None) for c in cases]
    # Two of the paths stand in branches for rows of several titles or ISSNs alone.
    xpath, paths = F.xpath, []
    monkeypatch.setattr(F, "xpath", lambda x, p: paths.append(p) or xpath(x, p))
    rows = record_queries.pubmed_articles(lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet"))
    assert len(paths) <= 2 and "RepartitionByExpression" in rows._jdf.queryExecution().optimizedPlan().toString()
