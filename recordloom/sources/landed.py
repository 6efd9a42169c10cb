"""Scans of landed payloads: pages of JSON, XML records and HTML listings.

Fetching is a matter of what lands the files; these scans give rows of the
article schema from files that Spark can read, each with its own schema and
without inference. ``articles`` columns are those of ``ARTICLE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.text import blank_to_null, clean_text, date_from_parts, normalize_doi, normalize_issn, parse_loose_date, strip_tags, unescape_entities
from recordloom.operators import checks

SLUG = r"^[a-z0-9]([a-z0-9-]{0,78}[a-z0-9])?$"
S, A = T.StringType(), T.ArrayType(T.StringType())
ARTICLE = T.StructType([
    *(T.StructField(n, S) for n in ("canonical_id", "title", "journal")), T.StructField("publication_date", T.DateType()), T.StructField("publication_date_precision", S),
    *(T.StructField(n, S) for n in ("doi", "pmid", "pmcid")), T.StructField("issns", A), T.StructField("authors", A), T.StructField("article_type", S), T.StructField("urls", A),
    T.StructField("source_records", T.ArrayType(T.StructType([T.StructField(n, S) for n in ("source", "source_id", "url")]))),
])


def _record(source: str, ident: Column, url: Column) -> Column:
    return F.array(F.struct(F.lit(source).alias("source"), ident.alias("source_id"), url.alias("url")))


def _texts(c: Column) -> Column:
    return F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda v: blank_to_null(v).isNotNull())


_DATE_PARTS = "struct<`date-parts`: array<array<int>>>"
_WORK = (
    "DOI: string, URL: string, type: string, title: array<string>, `container-title`: array<string>, ISSN: array<string>, author: array<struct<given: string, family: string, name: string>>, "
    f"`published-online`: {_DATE_PARTS}, `published-print`: {_DATE_PARTS}, published: {_DATE_PARTS}, issued: {_DATE_PARTS}"
)
CROSSREF = f"message struct<items: array<struct<{_WORK}>>>"
_RESULT = "id: string, pmid: string, pmcid: string, doi: string, title: string, authorString: string, pubType: string, firstPublicationDate: string, journalInfo: struct<journal: struct<title: string, issn: string, essn: string>>, journalTitle: string"
EUROPE_PMC = f"resultList struct<result: array<struct<{_RESULT}>>>"


def parsed(payloads: DataFrame, schema: str, payload: str = "payload") -> DataFrame:
    """Pages that a table holds as JSON text, as their files would be read: for ``crossref_articles`` and ``europe_pmc_articles``."""
    return payloads.select(F.from_json(payload, schema).alias("__page")).select("__page.*")


def crossref_pages(spark: SparkSession, path: str) -> DataFrame:
    """Articles of landed work-list pages."""
    return crossref_articles(spark.read.schema(CROSSREF).json(path, multiLine=True))


def crossref_articles(pages: DataFrame) -> DataFrame:
    """Articles of pages of the ``CROSSREF`` schema. The date is the first of published-online, print, published and issued that is one."""
    w = pages.select(F.explode("message.items").alias("w")).select("w.*")

    def parts(name: str) -> Column:
        p = F.col(f"`{name}`")["date-parts"][0]
        return date_from_parts(F.try_element_at(p, F.lit(1)), F.try_element_at(p, F.lit(2)), F.try_element_at(p, F.lit(3)))

    when = F.coalesce(*(parts(n) for n in ("published-online", "published-print", "published", "issued")))
    return w.withColumn("__d", when).filter("__d is not null").select(
        clean_text(F.try_element_at("title", F.lit(1))).alias("title"), clean_text(F.try_element_at("container-title", F.lit(1))).alias("journal"),
        F.col("__d.date").alias("publication_date"), F.col("__d.precision").alias("publication_date_precision"), normalize_doi(F.col("DOI")).alias("doi"),
        F.array_compact(F.transform(F.coalesce("ISSN", F.array().cast("array<string>")), normalize_issn)).alias("issns"),
        _texts(F.transform("author", lambda a: F.coalesce(blank_to_null(F.trim(F.concat_ws(" ", a["given"], a["family"]))), a["name"]))).alias("authors"),
        F.col("type").alias("article_type"), _texts(F.array("URL")).alias("urls"), _record("crossref", F.col("DOI"), F.col("URL")).alias("source_records"),
    )


def europe_pmc_pages(spark: SparkSession, path: str) -> DataFrame:
    """Articles of landed search pages."""
    return europe_pmc_articles(spark.read.schema(EUROPE_PMC).json(path, multiLine=True))


def europe_pmc_articles(pages: DataFrame) -> DataFrame:
    """Articles of pages of the ``EUROPE_PMC`` schema; a record without a PMID takes its id for one."""
    r = pages.select(F.explode("resultList.result").alias("r")).select("r.*").withColumn("__d", parse_loose_date(F.col("firstPublicationDate"))).filter("__d is not null")
    link = F.concat(F.lit("https://europepmc.org/article/MED/"), F.coalesce("pmid", "id"))
    return r.select(
        clean_text(F.col("title")).alias("title"), clean_text(F.coalesce("journalInfo.journal.title", "journalTitle")).alias("journal"),
        F.col("__d.date").alias("publication_date"), F.col("__d.precision").alias("publication_date_precision"), normalize_doi(F.col("doi")).alias("doi"),
        F.coalesce(blank_to_null(F.col("pmid")), F.col("id")).alias("pmid"), F.upper("pmcid").alias("pmcid"),
        F.array_compact(F.array(normalize_issn(F.col("journalInfo.journal.issn")), normalize_issn(F.col("journalInfo.journal.essn")))).alias("issns"),
        _texts(F.transform(F.split(F.regexp_replace("authorString", r"\.$", ""), ",\\s*"), F.trim)).alias("authors"),
        F.col("pubType").alias("article_type"), F.array(link).alias("urls"), _record("europe_pmc", F.col("id"), link).alias("source_records"),
    )


def _tagged(c: Column, tag: str) -> Column:
    """The text of an element of a fragment, without tags; entities stay."""
    return strip_tags(F.regexp_extract(c, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1))


def pubmed_xml(spark: SparkSession, path: str) -> DataFrame:
    """Articles of landed PubMed XML, one element a row.

    Files are read in splits, each row up to the end of an element, so that none is held whole.
    """
    parts = spark.read.option("lineSep", "</PubmedArticle>").text(path)
    return pubmed_articles(parts.select(F.concat(F.regexp_extract("value", r"(?s)<PubmedArticle[ >].*$", 0), F.lit("</PubmedArticle>")).alias("x")))


#: Paths of an article's element of which the first value counts.
PUBMED_PATHS = (
    "//MedlineCitation/PMID/text()", "//JournalIssue/PubDate/Year/text()", "//JournalIssue/PubDate/Month/text()", "//JournalIssue/PubDate/Day/text()", "//JournalIssue/PubDate/MedlineDate/text()",
    "//ArticleDate/Year/text()", "//ArticleDate/Month/text()", "//ArticleDate/Day/text()", "//Journal/Title/text()", "//Journal/ISSN/text()",
    "//ArticleIdList/ArticleId[@IdType='doi']/text()", "//ArticleIdList/ArticleId[@IdType='pmc']/text()", "//PublicationTypeList/PublicationType/text()",
)
#: What no text of XML can hold, as a path's literal.
_BETWEEN = '"\x1f"'


def pubmed_articles(elements: DataFrame, xml: str = "x") -> DataFrame:
    """Articles of a column of PubmedArticle elements, with the abstract's labelled sections joined by blank lines; other rows go."""
    one = elements.select(F.col(xml).alias("x")).filter("x like '<PubmedArticle%'")
    # Each function of paths parses the text anew, so one evaluation gives all values, one after the other: of nodes a string takes the first. A text node is never empty.
    values = [*PUBMED_PATHS, "//Article/ArticleTitle", "count(//Journal/ISSN/text())", "count(//Article/ArticleTitle)"]
    one = one.select("x", F.split(F.xpath_string("x", F.lit(f"concat({f', {_BETWEEN}, '.join(values)})")), "\x1f").alias("__v"))
    value = lambda p: F.get("__v", F.lit(values.index(p)))
    at = lambda p: blank_to_null(value(p))
    many = lambda p: F.xpath("x", F.lit(p))
    n_issns, n_titles, title = (value(p) for p in ("count(//Journal/ISSN/text())", "count(//Article/ArticleTitle)", "//Article/ArticleTitle"))
    issns = F.when(n_issns.cast("double") > 1, many("//Journal/ISSN/text()")).otherwise(F.array_compact(F.array(at("//Journal/ISSN/text()"))))
    title = F.when(n_titles.cast("double") > 1, F.array_join(many("//Article/ArticleTitle//text()"), "")).otherwise(title)
    pmid, year = at("//MedlineCitation/PMID/text()"), at("//JournalIssue/PubDate/Year/text()")
    written = F.concat_ws(" ", year, at("//JournalIssue/PubDate/Month/text()"), at("//JournalIssue/PubDate/Day/text()"))
    day = date_from_parts(at("//ArticleDate/Year/text()").cast("int"), at("//ArticleDate/Month/text()").cast("int"), at("//ArticleDate/Day/text()").cast("int"))
    parsed = F.coalesce(day, parse_loose_date(F.coalesce(blank_to_null(written), at("//JournalIssue/PubDate/MedlineDate/text()"))))
    link = F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/"))
    sections = F.regexp_extract_all("x", F.lit(r"(?s)<AbstractText[^>]*>.*?</AbstractText>"), F.lit(0))

    people = F.transform(F.regexp_extract_all("x", F.lit(r"(?s)<Author[ >].*?</Author>"), F.lit(0)), lambda a: F.coalesce(
        blank_to_null(_tagged(a, "CollectiveName")), blank_to_null(F.trim(F.concat_ws(" ", F.coalesce(blank_to_null(_tagged(a, "ForeName")), _tagged(a, "Initials")), _tagged(a, "LastName")))),
    ))

    def section(s: Column) -> Column:
        label = F.regexp_extract(s, r'Label="([^"]*)"', 1)
        text = F.trim(F.regexp_replace(F.regexp_replace(s, "<[^>]+>", " "), r"\s+", " "))
        return F.when(label != "", F.concat(label, F.lit(": "), text)).otherwise(text)

    return one.withColumn("__d", parsed).select(
        clean_text(title).alias("title"), clean_text(at("//Journal/Title/text()")).alias("journal"),
        F.col("__d.date").alias("publication_date"), F.col("__d.precision").alias("publication_date_precision"),
        normalize_doi(at("//ArticleIdList/ArticleId[@IdType='doi']/text()")).alias("doi"), pmid.alias("pmid"), F.upper(at("//ArticleIdList/ArticleId[@IdType='pmc']/text()")).alias("pmcid"),
        F.array_compact(F.transform(issns, normalize_issn)).alias("issns"),
        # Entities are decoded once for all names: a function of Python can't stand in a lambda.
        F.filter(F.split(unescape_entities(F.array_join(F.array_compact(people), "\x1f")), "\x1f"), lambda v: v != "").alias("authors"), at("//PublicationTypeList/PublicationType/text()").alias("article_type"),
        F.array(link).alias("urls"), _record("pubmed", pmid, link).alias("source_records"),
        blank_to_null(F.array_join(F.transform(sections, section), "\n\n")).alias("abstract"),
    )


def html_cards(pages: DataFrame, html: str, card: str, fields: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a listing's cards: ``card`` matches one card, each of ``fields`` has a group for its value. Tags and spaces are cleaned."""
    rows = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(card), F.lit(0))).alias("position", "__card"))
    return rows.select(*keep, "position", *(blank_to_null(clean_text(F.regexp_extract("__card", p, 1))).alias(n) for n, p in fields.items()))


def until_older(rows: DataFrame, date: str, start: str) -> DataFrame:
    """Of a newest-first listing, what isn't older than the window's start: the reader's early stop as a filter."""
    return rows.filter(F.col(date) >= F.lit(start).cast("date"))


def reconciled(rows: DataFrame, key: str, declared: int) -> tuple[DataFrame, bool]:
    """Distinct rows, and whether they are as many as the listing declares."""
    one = rows.dropDuplicates([key])
    return one, one.count() == declared


def accepted(rows: DataFrame, conditions: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every condition, and how many fail each: sources that close on doubt."""
    ok = F.lit(True)
    for c in conditions.values():
        ok = ok & F.coalesce(c, F.lit(False))
    return rows.filter(ok), rows.agg(F.count(F.lit(1)).alias("seen"), *(F.count_if(~F.coalesce(c, F.lit(False))).alias(f"fails_{n}") for n, c in conditions.items()))


#: Titles of an issue's parts that aren't articles.
FURNITURE = ("front cover", "inside front cover", "back cover", "inside back cover", "contents list")


def surrogate_dated(works: DataFrame, journal: str, issn: str, publisher: str, prefix: str, source: str, furniture: tuple[str, ...] = FURNITURE) -> tuple[DataFrame, DataFrame]:
    """(articles, counts): works of one journal whose day of creation stands for that of publication, closing on doubt.

    ``works``: title, journal, doi, issns, publisher, prefix, type, created (an array of date parts). Only rows of the
    very journal, publisher and prefix with a whole day count; an issue's furniture is told apart. Articles name the
    surrogate as a source of its own.
    """
    low = F.lower(clean_text(F.col("title")))
    day = F.when(F.size("created") >= 3, date_from_parts(F.get("created", F.lit(0)), F.get("created", F.lit(1)), F.get("created", F.lit(2))))
    doi = normalize_doi(F.col("doi"))
    kept, counts = accepted(works, {
        "title": blank_to_null(low).isNotNull(), "journal": F.lower(clean_text(F.col("journal"))) == journal.casefold(), "furniture": ~low.isin(*furniture), "doi": doi.startswith(f"{prefix}/"),
        "issn": F.array_contains(F.transform("issns", normalize_issn), issn), "publisher": F.col("publisher") == publisher, "prefix": F.col("prefix") == prefix, "type": F.col("type") == "journal-article", "created": day["date"].isNotNull(),
    })
    dated = kept.withColumns({"publication_date": day["date"], "publication_date_precision": F.lit("DAY"), "doi": doi, "article_type": F.when(low.startswith("correction:"), "Correction").otherwise("Journal Article")})
    named = F.concat(_record("crossref", F.col("doi"), F.lit(None).cast("string")), _record(source, F.concat(F.col("doi"), F.lit("|crossref-created:"), F.date_format("publication_date", "yyyy-MM-dd")), F.lit(None).cast("string")))
    return dated.withColumn("source_records", named), counts


def journal_homes(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("slug",)) -> DataFrame:
    """What journals' home pages say: name, ISSNs and whether the journal is wholly open access, which must be said before the ISSNs and not as a part."""
    text = clean_text(F.col(html))
    before = F.lower(F.regexp_extract(text, r"(?s)^(.*?)ISSN:", 1))
    issn = lambda kind: normalize_issn(blank_to_null(F.regexp_extract(text, rf"(?i)([0-9]{{4}}-[0-9]{{3}}[0-9X])\s*\({kind}\)", 1)))
    any_issn = normalize_issn(blank_to_null(F.regexp_extract(text, r"ISSN:\s*([0-9]{4}-[0-9]{3}[0-9Xx])", 1)))
    name = clean_text(F.element_at(F.split(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\|"), 1))
    online, print_ = issn("online"), issn("print")
    return pages.select(
        *keep, blank_to_null(name).alias("name"), F.coalesce(online, print_, any_issn).alias("issn"), online.alias("online_issn"), print_.alias("print_issn"),
        (before.contains("open access") & ~before.contains("contains open access")).alias("fully_open"),
    )


def month_snapshot(rows: DataFrame, label: str, year: int, month: int, most: int, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(rows, counts) of a listing's month, which labels such as ``August 2026`` name: the first ``most``, and how many there were."""
    date = parse_loose_date(F.concat_ws(" ", F.regexp_extract(label, r"(\d{4})", 1), F.regexp_extract(label, r"([A-Za-z]+)", 1)))
    ours = rows.withColumn("publication_date", date["date"]).withColumn("publication_date_precision", date["precision"]).filter((F.year("publication_date") == year) & (F.month("publication_date") == month) & (F.col("publication_date_precision") == "MONTH"))
    counts = ours.agg(F.count(F.lit(1)).alias("available"), F.least(F.count(F.lit(1)), F.lit(most).cast("long")).alias("accepted"), (F.count(F.lit(1)) > most).alias("truncated"))
    return ours.orderBy(*order).limit(most), counts


def nothing(spark: SparkSession) -> tuple[DataFrame, dict]:
    """The source that is never asked: no rows and a NOT_ATTEMPTED check."""
    return spark.createDataFrame([], ARTICLE), {"source": "radar_rss", "status": "NOT_ATTEMPTED", "accepted": 0}


def editions(spark: SparkSession, root: str) -> DataFrame:
    """Stored editions with their path, where path and content name the same edition."""
    scope = "struct<journal: string, journal_slug: string, period_key: string, revision: int, start_date: string, end_date: string>"
    item = "struct<" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in ARTICLE.fields) + ">"
    read = spark.read.schema(f"scope {scope}, articles array<{item}>").option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "edition.json").json(root)
    told = read.withColumn("path", F.col("_metadata.file_path"))
    return told.filter(F.col("path").contains(F.concat(F.lit("/"), F.col("scope.journal_slug"), F.lit("/"))) & F.col("path").contains(F.format_string("/r%02d/", F.col("scope.revision"))))


def registry_violations(journals: DataFrame, statuses: tuple[str, ...] = ("active", "planned", "retired")) -> DataFrame:
    """Registry rows without a name, with an unsafe or repeated slug, an unknown status or empty categories."""
    filled_in = lambda c: ~F.exists(F.coalesce(c, F.array().cast("array<string>")), lambda v: F.coalesce(v == "", F.lit(True)))
    return checks.report([
        checks.violations(journals, F.col("slug"), {"NAME": blank_to_null(F.trim("journal")).isNotNull(), "SLUG": F.col("slug").rlike(SLUG), "STATUS": F.coalesce("status", F.lit("active")).isin(*statuses), "CATEGORIES": filled_in(F.col("categories"))}),
        checks.unique(journals, ["slug"], "SLUG_REPEATS"),
    ])


def provider_catalogs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(journals, violations) of catalogue files, one provider each: the journals with their file's provider and publisher,
    and what is wrong: an unsafe or repeated provider, slugs, names or sources, a journal of another provider, a wrong count."""
    item = "struct<slug: string, name: string, provider: string, publisher: string, sources: array<string>, categories: array<string>>"
    files = spark.read.schema(f"provider string, publisher string, scope string, journal_count long, journals array<{item}>").option("multiLine", True).json(path).withColumn("provider", F.lower(F.trim("provider")))
    j = files.select("provider", F.col("publisher").alias("__publisher"), F.explode("journals").alias("j"))
    journals = j.select("provider", F.coalesce(blank_to_null(F.trim("j.publisher")), "__publisher").alias("publisher"), F.trim("j.name").alias("name"), F.lower(F.trim("j.slug")).alias("slug"), F.transform(F.coalesce("j.sources", F.array().cast("array<string>")), F.trim).alias("sources"), "j.categories")
    given = j.select("provider", F.lower(F.trim("j.slug")).alias("slug"), F.lower(F.trim("j.provider")).alias("own"))
    wrong = checks.report([
        checks.violations(files, F.col("provider"), {"PROVIDER": F.col("provider").rlike(SLUG), "PUBLISHER": blank_to_null(F.col("publisher")).isNotNull(), "JOURNAL_COUNT": F.col("journal_count").isNull() | (F.col("journal_count") == F.size("journals"))}),
        checks.unique(files, ["provider"], "PROVIDER_REPEATS"),
        checks.violations(journals, F.col("slug"), {"SLUG": F.col("slug").rlike(SLUG), "NAME": blank_to_null(F.col("name")).isNotNull(), "SOURCES": ~F.exists("sources", lambda v: F.coalesce(v == "", F.lit(True)))}),
        checks.violations(given, F.col("slug"), {"OTHER_PROVIDER": F.coalesce(blank_to_null(F.col("own")), "provider") == F.col("provider")}),
        checks.unique(journals, ["provider", "slug"], "SLUG_REPEATS"),
    ])
    return journals, wrong


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Journals: slug, name, ISSNs, categories, status, publisher, enabled and processing mode."""
    return spark.read.schema("slug string, journal string, issns array<string>, categories array<string>, status string, publisher string, enabled boolean, processing_mode string").json(path, multiLine=True)


def registry_filter(journals: DataFrame, status: str | None = None, category: str | None = None, publisher: str | None = None, mode: str | None = None, enabled: bool | None = True) -> DataFrame:
    for c, ok in (
        (status, lambda: F.col("status") == status), (category, lambda: F.array_contains("categories", category)),
        (publisher, lambda: F.lower("publisher") == publisher.casefold()), (mode, lambda: F.col("processing_mode") == mode), (enabled, lambda: F.col("enabled") == enabled),
    ):
        if c is not None:
            journals = journals.filter(ok())
    return journals.orderBy("journal", "slug")


def vault(spark: SparkSession, root: str) -> DataFrame:
    """Payloads by the digest that names them: (sha256, content, bytes)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.regexp_extract("path", r"([0-9a-f]{64})(?:\.[A-Za-z0-9]+)?$", 1).alias("sha256"), "content", F.col("length").alias("bytes"))
