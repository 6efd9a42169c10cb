"""Output orders, and numbering of all rows in an order without gathering them in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.plans.lineage import cut

#: Routes in the order in which they are shown.
TRIAGE_ROUTES = ("INTEGRITY_REVIEW", "FETCH_CANDIDATE", "RESERVE", "CATALOG_ONLY")
SHORTLIST_ROUTES = ("FETCH_NOW", "HOLD_RESERVE", "CATALOG_ONLY")
REVIEW_ROUTES = ("FULLTEXT_NOW", "FULLTEXT_RESERVE", "NO_ABSTRACT")
UNKNOWN, UNPLACED = 99, 999_999
#: Groups beyond so many rows are numbered by ranges, not by a window in one task.
LARGE_GROUP = 1_000_000


def place_of(route: Column, routes: tuple[str, ...]) -> Column:
    """A route's place among ``routes``; 99 for any other."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, routes)), route), F.lit(0)), F.lit(UNKNOWN + 1)) - 1


def _low(name: str) -> Column:
    return F.lower(F.coalesce(name, F.lit("")))


def triage_order() -> list[Column]:
    """Route, best score, journal, earliest date, title, id."""
    return [place_of(F.col("route"), TRIAGE_ROUTES), F.desc("score"), _low("journal"), F.col("publication_date"), _low("title_original"), F.col("canonical_id")]


def portfolio_order() -> list[Column]:
    """Route, best score, latest date, title, id, journal; the catalogue isn't part of the portfolio."""
    return [place_of(F.col("route"), TRIAGE_ROUTES[:3]), F.desc("score"), F.desc("publication_date"), _low("title_original"), F.col("canonical_id"), _low("journal")]


def hold_order() -> list[Column]:
    """Candidates first, then percentile, score, journal and title."""
    return [F.when(F.col("prefetch_route") == "FETCH_CANDIDATE", 0).otherwise(1), F.desc(F.coalesce("percentile", F.lit(50.0))), F.desc("prefetch_score"), _low("journal"), _low("title_original")]


def audit_order() -> list[Column]:
    """Within an edition: route, ordinal (none last), score, title, key."""
    ordinal = F.coalesce(F.nullif(F.col("selection_ordinal"), F.lit(0)), F.lit(UNPLACED))
    return [place_of(F.col("editorial_route"), SHORTLIST_ROUTES), ordinal, F.desc("prefetch_score"), _low("title_original"), F.col("record_key")]


def review_order() -> list[Column]:
    return [place_of(F.col("fulltext_route"), REVIEW_ROUTES), F.desc("fulltext_priority_score"), _low("journal")]


def publication_order() -> list[Column]:
    """Newest period first, then journal and revision, all descending."""
    return [F.desc("period_end"), F.lower("journal").desc(), F.desc("revision")]


def journal_order() -> list[Column]:
    """Journals by what is to be fetched, then by integrity notices, then by name."""
    return [F.desc("fetch_candidate"), F.desc("integrity_review"), _low("journal")]


def numbered(df: DataFrame, order: list[Column | str], name: str = "ordinal") -> DataFrame:
    """Every row with its place in ``order``, from 1.

    Rows are sorted by ranges; a row's place is the number of rows in the ranges
    before its own plus its place there. Only one count a range meets in one
    task. Order by something unique: ties are numbered in any order.
    """
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    joined = placed.withColumn("__part", part).join(F.broadcast(before), "__part")
    return joined.withColumn(name, F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).drop("__at", "__part", "__before")


def places(df: DataFrame, group: list[str], order: list[Column | str], name: str, most: int = LARGE_GROUP) -> DataFrame:
    """Every row with its place in its group, from 1; groups may be null.

    Groups are counted first. Those of up to ``most`` rows are numbered by a
    window; larger ones are numbered by sorted ranges, spread over tasks. There
    can be no more of those than rows / most, so their names are broadcast.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    large = cut(df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most))
    if not large.limit(1).count():
        return df.withColumn(name, rank)
    same = lambda c, i: F.col(c).eqNullSafe(F.col(f"__g{i}"))
    named = [F.col(c).alias(f"__g{i}") for i, c in enumerate(group)]
    keys, on = F.broadcast(large.select(*named)), reduce(Column.__and__, (same(c, i) for i, c in enumerate(group)))
    made = numbered(df.join(keys, on, "left_semi"), [*group, *order], "__ordinal")
    first = F.broadcast(cut(made.groupBy(*group).agg(F.min("__ordinal").alias("__first"))).select(*named, "__first"))
    spread = made.join(first, on).withColumn(name, (F.col("__ordinal") - F.col("__first") + 1).cast("int")).select(*df.columns, name)
    return df.join(keys, on, "left_anti").withColumn(name, rank).unionByName(spread)
