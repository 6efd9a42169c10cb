import datetime as dt
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.functions import period, text


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v")).alias("x")).first()["x"]


def test_identifiers(spark):
    assert one(spark, " https://doi.org/10.5555/AbC.). ", text.normalize_doi) == "10.5555/abc"
    assert one(spark, "doi: 10.5555/x;", text.normalize_doi) == "10.5555/x"
    assert one(spark, "", text.normalize_doi) is None
    assert one(spark, "2574380x", text.normalize_issn) == "2574-380X"
    assert one(spark, "123", text.normalize_issn) is None


def test_names_keys_and_slugs(spark):
    assert one(spark, " Straße &amp;  Ｆoo ", text.normalize_name) == "strasse & foo"
    assert one(spark, "Naïve <i>Bayes</i>: 2", text.normalize_title_key) == "naivebayes2"
    assert one(spark, "Crème & Brûlée!", text.slugify) == "creme-brulee"
    assert one(spark, "!!", text.slugify) == "edition"
    assert one(spark, "a &lt; b &gt; c", text.clean_text) == "a c"
    assert one(spark, "漢", text.contains_cjk) is True and one(spark, "abc", text.contains_cjk) is False


def test_tokens(spark):
    tokens = one(spark, "The Naïve model of a Tokamak plasma model", text.title_tokens)
    assert tokens == ["nai", "model", "tokamak", "plasma", "model"]
    assert one(spark, ["b", "a", "b", "c", "d", "e"], lambda c: text.topic_signature(c), "array<string>") == "b|a|c|d"
    assert one(spark, [], lambda c: text.topic_signature(c), "array<string>") == "untitled"


def test_links(spark):
    assert one(spark, "HTTPS://Example.ORG:443?q=1#x", text.safe_url) == "https://example.org:443/?q=1"
    assert one(spark, "https://u:p@example.org/", text.safe_url) is None
    assert one(spark, "ftp://example.org/", text.safe_url) is None
    assert one(spark, "https://bücher.example/a", text.safe_url) == "https://xn--bcher-kva.example/a"
    assert one(spark, "https://api.creativecommons.org/x", text.open_licence_host) is True
    assert one(spark, "https://notcreativecommons.org/x", text.open_licence_host) is False


def test_loose_dates(spark):
    cases = {
        "2026-08-13T09:00": ("2026-08-13", "DAY"), "2026-02-30": None, "2026-08": ("2026-08-01", "MONTH"), "2026": ("2026-01-01", "YEAR"),
        "2026 Aug 9": ("2026-08-09", "DAY"), "2026 August": ("2026-08-01", "MONTH"), "Spring 2025": ("2025-01-01", "YEAR"), "issue of 2024 Dec special": ("2024-12-01", "MONTH"), "none": None, "": None,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, v string")
    got = {r["v"]: (str(r["d"]["date"]), r["d"]["precision"]) if r["d"] else None for r in df.select("v", text.parse_loose_date(F.col("v")).alias("d")).collect()}
    assert got == cases


def test_period_overlap_by_precision(spark):
    d = spark.createDataFrame([(dt.date(2026, 8, 1), "MONTH"), (dt.date(2026, 7, 1), "MONTH"), (dt.date(2026, 1, 1), "YEAR"), (dt.date(2026, 8, 13), "DAY")], "d date, p string")
    assert sorted(r["p"] for r in period.in_period(d, "d", "p", "2026-08-13", "2026-08-13").collect()) == ["DAY", "MONTH", "YEAR"]


def test_period_identity(spark):
    def key(a, b):
        r = spark.createDataFrame([(dt.date.fromisoformat(a), dt.date.fromisoformat(b))], "a date, b date").select(period.period_kind(F.col("a"), F.col("b")), period.period_key(F.col("a"), F.col("b"))).first()
        return tuple(r)

    assert key("2026-08-10", "2026-08-16") == ("week", "2026-W33")
    assert key("2026-08-01", "2026-08-31") == ("month", "2026-08")
    assert key("2026-08-13", "2026-08-13") == ("day", "2026-08-13")
    assert key("2026-08-10", "2026-08-17") == ("range", "2026-08-10_2026-08-17")
    r = spark.range(1).select(period.edition_identity(F.lit("j"), F.lit("2026-08"), F.lit(2)).alias("x")).first()
    assert r["x"] == "j__2026-08__r02"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=["Cs"], blacklist_characters="<>&\x00"), max_size=20), min_size=1, max_size=8))
def test_title_key_is_pythons(spark, titles):
    def wanted(t):
        s = "".join(c for c in unicodedata.normalize("NFKD", " ".join(t.split())).casefold() if not unicodedata.combining(c))
        return "".join(c for c in s if "a" <= c <= "z" or "0" <= c <= "9")

    got = [r["k"] for r in spark.createDataFrame(list(enumerate(titles)), "i int, t string").select("i", text.normalize_title_key(F.col("t")).alias("k")).orderBy("i").collect()]
    assert got == [wanted(t) for t in titles]
