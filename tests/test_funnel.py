import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from recordloom.__main__ import main
from recordloom.functions.text import bounded_int
from recordloom.operators.identity import journal_matches
from recordloom.plans import funnel
from recordloom.plans.policy import EvaluationPolicy, ReviewPolicy, ShortlistPolicy
from recordloom.sources import landed

ARTICLES = "journal_slug string, period_key string, revision int, canonical_id string, title_original string, doi string, pmid string, pmcid string, publication_date date, processing_mode string"
WORDS = [f"subject{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]


def articles(spark, journals=4, each=100):
    rows = [(f"j{j}", "2026-08", 1, f"doi:10.1/{j}-{i}", f"Randomized controlled trial of {WORDS[i]} {WORDS[-1 - i]} {WORDS[(7 * i) % 400]}", f"10.1/{j}-{i}", None, None, dt.date(2026, 8, 1 + i % 28), "FULL") for j in range(journals) for i in range(each)]
    return spark.createDataFrame(rows, ARTICLES)


def priors(spark, journals=4):
    return spark.createDataFrame([(f"j{j}", 20.0 * j, False) for j in range(journals)], "slug string, registry_category_percentile double, unknown_metric boolean")


def test_the_whole_funnel(spark):
    t = funnel.triage(articles(spark))
    assert {r["route"]: r["count"] for r in t.groupBy("route").count().collect()} == {"FETCH_CANDIDATE": 120, "RESERVE": 280}
    s = funnel.shortlist(t, priors(spark), ShortlistPolicy(target=30)).cache()
    chosen = s.filter("shortlist_route = 'FETCH_NOW'").collect()
    by = Counter(r["journal_slug"] for r in chosen)
    assert len(chosen) == 30 and max(by.values()) - min(by.values()) <= 1 and sorted(r["ordinal"] for r in chosen) == list(range(1, 31))
    assert all(r["reasons"] for r in s.filter("shortlist_route = 'HOLD_RESERVE'").collect())
    text = "Methods: n = 200 patients. Results: hazard ratio 0.8. " + "pad " * 80
    abstracts = s.filter("shortlist_route = 'FETCH_NOW' AND ordinal <= 20").select("record_key", F.lit(text).alias("abstract"))
    r = funnel.abstract_review(s, abstracts, priors(spark), ReviewPolicy(target=8)).cache()
    assert {x["fulltext_route"]: x["count"] for x in r.groupBy("fulltext_route").count().collect()} == {"FULLTEXT_NOW": 8, "FULLTEXT_RESERVE": 12, "NO_ABSTRACT": 10}
    texts = r.filter("fulltext_route = 'FULLTEXT_NOW' AND ordinal <= 6").select("record_key", F.lit("Randomized. Funding. 120 patients.").alias("text"), F.array(F.lit("METHODS_SECTION")).alias("flags"))
    e = funnel.evaluated_edition(r, texts, EvaluationPolicy(target=4)).collect()
    assert Counter(x["editorial_route"] for x in e) == {"FEATURED": 4, "EVIDENCE_RESERVE": 2, "LIMITED_REVIEW": 2}
    assert sorted(x["featured_ordinal"] for x in e if x["featured_ordinal"]) == [1, 2, 3, 4]
    s.unpersist()
    r.unpersist()


def test_command_line(spark, tmp_path):
    articles(spark, 2, 5).write.parquet(str(tmp_path / "a"))
    assert main(["triage", str(tmp_path / "a"), str(tmp_path / "t")]) == 0
    priors(spark, 2).write.parquet(str(tmp_path / "p"))
    assert main(["shortlist", str(tmp_path / "t"), str(tmp_path / "s"), "--priors", str(tmp_path / "p")]) == 0
    assert spark.read.parquet(str(tmp_path / "s")).filter("shortlist_route = 'FETCH_NOW'").count() == 10
    assert main(["backfill", str(tmp_path / "a"), str(tmp_path / "a"), str(tmp_path / "m")]) == 0
    assert spark.read.parquet(str(tmp_path / "m")).count() == 10


def test_journal_by_name_or_issn(spark):
    df = spark.createDataFrame([("  Some   Journal", []), ("Other", ["1234567x"]), ("Other", None)], "j string, issns array<string>")
    assert [r[0] for r in df.select(journal_matches(F.col("j"), F.col("issns"), "some journal", "1234-567X")).collect()] == [True, True, False]


def test_small_things(spark):
    assert [r[0] for r in spark.createDataFrame([("7",), ("70",), ("x",), (None,)], "v string").select(bounded_int(F.col("v"), 1, 10)).collect()] == [7, None, None, None]
    rows, check = landed.nothing(spark)
    assert rows.count() == 0 and check["status"] == "NOT_ATTEMPTED"


def test_titles_are_classified_once_and_over_all_cores(spark):
    from recordloom.operators import publish
    from recordloom.plans import table_queries

    for name in ("edition_artifacts", "title_paths", "triage_summary"):
        plan = table_queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" in plan and not [line for line in plan.splitlines() if "Filter" in line.split("(")[0] and "RLIKE" in line]
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 3, None), ("b", 1, "z")], "g string, at int, v string")
    made = publish.grouped_items(rows, ["g"], ["at"], ["v"], where=F.col("v").isin("x", "y"))
    assert [(r["g"], r["n"], [tuple(i) for i in r["items"]]) for r in made.collect()] == [("a", 2, [(1, "y"), (2, "x")])]
