"""Aggregates and projections for publication: facets, indexes, filters and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import blank_to_null
from recordloom.operators.caps import top_per_group


def facets(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Sorted distinct values and their number, for each column."""
    made = [F.array_sort(F.collect_set(c)).alias(f"{c}_values") for c in columns] + [F.count_distinct(c).alias(f"n_{c}") for c in columns]
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), *made)


def counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n) of several columns in one pass."""
    stacked = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns))).alias("f"))
    return stacked.groupBy("f.facet", "f.value").agg(F.count(F.lit(1)).alias("n"))


def conditional_counts(df: DataFrame, group: list[str], column: str, values: tuple[str, ...]) -> DataFrame:
    """One row a group, a column for each value."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), *(F.count_if(F.col(column) == v).alias(v.lower()) for v in values))


def run_status(checks: DataFrame, group: list[str], status: str, articles: Column) -> DataFrame:
    """A run's status from its sources' ones and its article count."""
    s = F.col(status)
    failed = F.every(s == "FAILED")
    partial = F.some(s.isin("FAILED", "PARTIAL"))
    some = F.max(articles) > 0
    made = F.when(failed, "SOURCE_ACCESS_GAP").when(partial, "PARTIAL_SOURCE_COVERAGE").when(some, "COMPLETE").otherwise("NO_MATCHING_ARTICLES")
    return checks.groupBy(*group).agg(made.alias("run_status"))


def grouped_items(df: DataFrame, group: list[str], order: list[str], item: list[str], name: str = "items", where: Column | None = None) -> DataFrame:
    """One row a group with its items as a sorted array of structs.

    ``where``: only rows that meet it count. Of columns that cost much it costs
    less than a filter, which Spark takes below them and there makes them anew,
    once for each time that the condition names them.
    """
    kept = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    items = F.array_sort(F.collect_list(F.when(kept, F.struct(*dict.fromkeys([*order, *item])))))
    return df.groupBy(*group).agg(F.count_if(kept).alias("n"), items.alias(name)).filter("n > 0")


def filter_page(
    df: DataFrame, needle: str | None = None, over: list[str] | None = None, equal: dict | None = None, member: dict | None = None,
    present: list[str] | None = None, least: dict | None = None, order: list[Column] | None = None, offset: int = 0, limit: int = 50,
) -> DataFrame:
    """One page of what an interactive table would show."""
    if needle:
        df = df.filter(F.lower(F.concat_ws(" ", *(over or []))).contains(needle.lower()))
    for c, v in (equal or {}).items():
        df = df.filter(F.col(c) == v)
    for c, v in (member or {}).items():
        df = df.filter(F.array_contains(F.col(c), v))
    for c in present or []:
        df = df.filter(blank_to_null(F.col(c)).isNotNull())
    for c, v in (least or {}).items():
        df = df.filter(F.col(c) >= v)
    if order:
        df = df.orderBy(*order)
    return (df.offset(offset) if offset else df).limit(limit)


def link_list(primary: Column, others: Column) -> Column:
    """Links without empty ones or repeats, the primary first."""
    return F.filter(F.array_distinct(F.concat(F.array(primary), others)), lambda u: blank_to_null(u).isNotNull())


def source_order(pmcid: Column, pmid: Column, doi: Column, sources: dict[str, str]) -> Column:
    """Sources (name to the identifier it needs) that can be asked, in order."""
    has = {"pmcid": blank_to_null(pmcid).isNotNull(), "pmid": blank_to_null(pmid).isNotNull(), "doi": blank_to_null(doi).isNotNull()}
    return F.array_compact(F.array(*(F.when(has[k], F.lit(s)) for s, k in sources.items())))


def search_index(publications: DataFrame, articles: DataFrame, per_edition: int = 250) -> DataFrame:
    """Articles of the latest revisions, so many of each edition, with each edition's totals."""
    keys = ["journal_slug", "period_key", "revision"]
    newest = publications.groupBy(*keys[:2]).agg(F.max("revision").alias("revision"))
    rows = articles.join(newest, keys, "left_semi")
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    return top_per_group(rows, keys, [F.col("position")], per_edition, rank="__rn").drop("__rn").join(n, keys)


def catalog_counts(editions: DataFrame, journal: str = "journal", month: str = "month") -> DataFrame:
    """One row: journals, periods and revisions, the latest month and how many journals it has."""
    last = editions.agg(F.max(month).alias("latest_month"))
    c = editions.agg(F.count_distinct(journal).alias("journals"), F.count_distinct(journal, month).alias("periods"), F.count(F.lit(1)).alias("revisions"))
    newest = editions.join(F.broadcast(last), F.col(month) == F.col("latest_month")).groupBy("latest_month").agg(F.count_distinct(journal).alias("in_latest_month"))
    return c.crossJoin(F.broadcast(newest)).select("journals", "periods", "revisions", "latest_month", "in_latest_month")  # one row beside one row


def coverage(df: DataFrame, group: list[str], known: Column) -> DataFrame:
    """How many rows of each group have something, how many lack it, and the share that has it."""
    has = F.count_if(known)
    return df.groupBy(*group).agg(has.alias("known"), (F.count(F.lit(1)) - has).alias("unknown"), F.round(has / F.count(F.lit(1)), 6).alias("fraction"))


def provider_totals(providers: DataFrame, sums: list[str]) -> DataFrame:
    """One row: the number of providers and the totals of their counts."""
    return providers.agg(F.count(F.lit(1)).alias("providers"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums))


def default_role(roles: DataFrame, group: list[str], role: str = "curation_role", many: int = 200) -> DataFrame:
    """The role that a group's page opens with: primary where it has more than ``many`` rows and any primary one, else all."""
    n = roles.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(role) == "primary").alias("__p"))
    return n.select(*group, F.when((F.col("__n") > many) & (F.col("__p") > 0), "primary").otherwise("all").alias("default_role"))


def primary_category(categories: Column, order: list[str]) -> Column:
    ranked = F.array_intersect(F.array(*map(F.lit, order)), categories)
    return F.coalesce(F.try_element_at(ranked, F.lit(1)), F.try_element_at(categories, F.lit(1)), F.lit("uncategorized"))


def ledger(declared: DataFrame, observed: DataFrame, key: str, declared_n: str, observed_n: str) -> DataFrame:
    """Declared against observed counts, with rows that only one side has."""
    both = declared.select(key, declared_n).join(observed.select(key, observed_n), key, "full_outer")
    d, o = F.coalesce(declared_n, F.lit(0)), F.coalesce(observed_n, F.lit(0))
    return both.select(key, d.alias("declared"), o.alias("observed"), (d == o).alias("agrees"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
