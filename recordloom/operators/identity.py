"""Identities of records, and their resolution across sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.period import interval
from recordloom.functions.text import blank_to_null, normalize_doi, normalize_name, normalize_title_key
from recordloom.operators.graph import connected_components
from recordloom.operators.joins import shuffled, small
from recordloom.plans.lineage import cut

#: The source whose ids are OpenReview's.
SNAPSHOT = "tmlr_official_snapshot"
PRECISIONS = {"YEAR": 1, "MONTH": 2, "DAY": 3}
#: Scalars that a survivor takes from the first member that has one.
FIRST_SCALARS = ("doi", "pmid", "pmcid", "article_type", "title_zh_tw", "summary_zh_tw", "translation_basis", "translation_source_url")


def canonical_id(candidates: dict[str, Column], fallback: Column) -> Column:
    """``name:value`` of the first candidate that isn't empty, else ``fingerprint:`` and ``fallback`` as it is."""
    tried = [F.when(blank_to_null(c).isNotNull(), F.concat(F.lit(f"{name}:"), c)) for name, c in candidates.items()]
    return F.coalesce(*tried, F.concat(F.lit("fingerprint:"), F.coalesce(fallback, F.lit(""))))


def article_id(ascii_only: bool = False) -> Column:
    """Of an article row: DOI, PMID, PMCID, the OpenReview id of a snapshot record, or title key and date.

    A PMID or PMCID counts if it isn't empty, and is trimmed then.
    """
    snapshot = F.filter(F.transform("source_records", lambda r: F.when(r["source"] == SNAPSHOT, F.trim(F.coalesce(r["source_id"], F.lit(""))))), lambda v: v.rlike("^[A-Za-z0-9_-]+$"))
    review = F.try_element_at(snapshot, F.lit(1))
    key = F.concat_ws("|", normalize_title_key(F.col("title"), ascii_only), F.date_format("publication_date", "yyyy-MM-dd"))
    given = lambda c, value: F.when(blank_to_null(F.col(c)).isNotNull(), F.concat(F.lit(f"{c}:"), value))
    return F.coalesce(
        F.concat(F.lit("doi:"), blank_to_null(normalize_doi(F.col("doi")))), given("pmid", F.trim("pmid")), given("pmcid", F.upper(F.trim("pmcid"))),
        F.concat(F.lit("openreview:"), review), F.concat(F.lit("fingerprint:"), key),
    )


def record_key(slug: Column, period: Column, revision: Column, canonical: Column) -> Column:
    """slug|period|revision|id, empty where a part is missing."""
    return F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in (slug, period, revision, canonical)))


def aliases() -> Column:
    """An article's aliases: title with journal and date, and whatever identifiers it has."""
    title = F.concat(F.lit("title:"), F.concat_ws("|", normalize_title_key(F.col("title")), normalize_name(F.col("journal")), F.date_format("publication_date", "yyyy-MM-dd")))
    named = [F.concat(F.lit(f"{k}:"), blank_to_null(c)) for k, c in (("doi", normalize_doi(F.col("doi"))), ("pmid", F.trim("pmid")), ("pmcid", F.upper(F.trim("pmcid"))))]
    return F.array_compact(F.array(title, *named))


#: An alias of more characters stands by its digest.
LONG_ALIAS = 80


def short_alias(alias: Column) -> Column:
    """``alias``, or its SHA-256 if it is long: what is shuffled and kept doesn't grow with a title that is a whole text."""
    return F.when(F.length(alias) > LONG_ALIAS, F.concat(F.lit("sha256:"), F.sha2(alias, 256))).otherwise(alias)


def components(records: DataFrame, record: str, alias: str) -> DataFrame:
    """(record, component): records that share aliases, directly or through others.

    ``alias`` is an array column. An alias links every record to the first that
    has it, so a common alias gives a star, not pairs. Aliases are made once and
    cut. Only explode_outer does that: for explode() Spark asks first, with all
    that makes them, which arrays are empty.
    """
    held = cut(records.select(F.col(record).alias("r"), F.explode_outer(alias).alias("alias")).filter("alias is not null").distinct())
    first = held.groupBy("alias").agg(F.min("r").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("alias", "first")
    edges = held.join(shuffled(first), "alias").filter("r <> first").select(F.col("r").alias("a"), F.col("first").alias("b"))
    linked = connected_components(edges)
    return records.select(F.col(record)).join(shuffled(linked.withColumnRenamed("node", record)), record, "left").withColumn("component", F.coalesce("component", record))


def _rank(precision: Column) -> Column:
    return F.when(F.upper(precision) == "DAY", 3).when(F.upper(precision) == "MONTH", 2).when(F.upper(precision) == "YEAR", 1).otherwise(0)


#: Members of a component whose places agree but for so many bits are compared together.
BLOCK_BITS = 16


def _settled_dates(dated: DataFrame, by: str) -> DataFrame:
    """(by, date, precision): what remains of a component's dates (by, at, date, precision), taken in the order of ``at``.

    At equal precision the earlier date stays; a finer one wins if both may mean
    one day; anything else changes nothing. So precision only rises, and while
    it stays the date is a running minimum. Each round finds, for every
    component, the first finer date that meets the minimum before it; there can
    be no more rounds than precisions. Minima run over blocks of places first
    and over the blocks after that, so no task holds a component.
    """
    rows = cut(dated.select(by, F.col("at").cast("long").alias("at"), "date", "precision", _rank(F.col("precision")).alias("rank")).withColumn("block", F.shiftright("at", BLOCK_BITS)))
    entry = F.struct("date", "precision", "rank", "at")
    now = cut(rows.groupBy(by).agg(F.min_by(entry, F.col("at")).alias("e")))
    done: list[DataFrame] = []
    while True:
        same = (F.col("rank") == F.col("e.rank")) & (F.col("at") > F.col("e.at"))
        known = rows.join(small(now), by)
        lows = known.filter(same & F.col("date").isNotNull()).groupBy(by, "block").agg(F.min(F.struct("date", "at", "precision")).alias("low"))
        before = Window.partitionBy(by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        # Blocks without a date of the component's precision have a row too, so that each knows what came before it.
        blocks = known.select(by, "block").distinct().join(shuffled(lows), [by, "block"], "left").withColumn("earlier", F.min("low.date").over(before)).select(by, "block", "earlier")
        within = Window.partitionBy(by, "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        running = known.join(shuffled(blocks), [by, "block"]).withColumn("least", F.least("e.date", "earlier", F.min(F.when(same, F.col("date"))).over(within)))
        (a, b), (c, d) = interval(F.col("least"), F.col("e.precision")), interval(F.col("date"), F.col("precision"))
        finer = (F.col("rank") > F.col("e.rank")) & (F.col("at") > F.col("e.at")) & F.col("e.date").isNotNull() & (a <= d) & (c <= b)
        risen = running.filter(finer).groupBy(by).agg(F.min_by(entry, F.col("at")).alias("e"))
        low = lows.groupBy(by).agg(F.min("low").alias("low"))
        went = cut(now.select(by, F.col("e").alias("was")).join(shuffled(risen), by, "left").join(shuffled(low), by, "left"))
        kept = F.coalesce(F.col("low.date") < F.col("was.date"), F.lit(False))
        done.append(went.filter("e is null").select(by, F.when(kept, F.col("low.date")).otherwise(F.col("was.date")).alias("date"), F.when(kept, F.col("low.precision")).otherwise(F.col("was.precision")).alias("precision")))
        now = went.filter("e is not null").select(by, "e")
        if not now.limit(1).count():
            return reduce(DataFrame.unionByName, done)


def _earliest_dates(dated: DataFrame, by: str) -> DataFrame:
    """The older rule: the earliest date, of equal ones the finest; a component whose first date is missing keeps none."""
    first = F.min_by(F.struct("date", "precision"), F.col("at")).alias("first")
    least = F.min(F.when(F.col("date").isNotNull(), F.struct("date", (-_rank(F.col("precision"))).alias("r"), "at", "precision"))).alias("least")
    made = dated.groupBy(by).agg(first, least)
    known = F.col("first.date").isNotNull()
    return made.select(by, F.when(known, F.col("least.date")).alias("date"), F.when(known, F.col("least.precision")).otherwise(F.col("first.precision")).alias("precision"))


DATE_RULES = {"finer": _settled_dates, "earliest": _earliest_dates}


def merge_survivors(members: DataFrame, by: str = "component", order: str = "idx", rule: str = "finer") -> DataFrame:
    """One row for each component: what folding its members in input order would leave.

    The first member is the target: its scalars stay if they aren't empty, the
    longest author list wins (the earlier of equals), sets of ISSNs and links
    are united and sorted, source records keep their first order, and dates
    follow ``rule``. Every part is a partial aggregate (the first value that
    isn't empty, the longest list, the first place of each record) or a running
    minimum, so no array holds a component's members. ``order`` is a whole
    number, different for each member.
    """
    rest = [c for c in members.columns if c not in (by, order)]
    dates, sets = ("publication_date", "publication_date_precision"), ("issns", "urls")
    at = F.col(order)
    first = {c: F.min_by(c, at) for c in rest if c not in (*dates, *sets, "authors", "source_records")}
    for c in FIRST_SCALARS:
        # A record that nothing is merged into stays as it is.
        first[c] = F.coalesce(F.min_by(blank_to_null(F.col(c)), F.when(blank_to_null(F.col(c)).isNotNull(), at)), F.when(F.count(F.lit(1)) == 1, F.min(c)))
    # Equal lists meet once in each task; what remains is no larger than the lists that differ.
    united = {c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce(c, F.array().cast("array<string>")))))) for c in sets}
    longest = F.min_by("authors", F.struct((-F.size(F.coalesce("authors", F.array().cast("array<string>")))).alias("n"), at.alias("at")))
    span = F.struct(F.col(dates[0]).alias("date"), F.col(dates[1]).alias("precision"))
    whole = members.groupBy(by).agg(
        F.count(F.lit(1)).cast("int").alias("members"), F.min(order).alias(order), longest.alias("authors"), *(c.alias(n) for n, c in (first | united).items()), F.min_by(span, at).alias("__first"),
        (F.min(span).eqNullSafe(F.max(span))).alias("__one"),
    )
    whole = cut(whole)
    dated = members.select(by, at.alias("at"), F.col(dates[0]).alias("date"), F.col(dates[1]).alias("precision")).join(shuffled(whole.filter("not __one").select(by)), by, "left_semi")
    settled = DATE_RULES[rule](dated, by).select(by, F.struct("date", "precision").alias("__settled"))
    each = members.select(by, at.alias("at"), F.posexplode("source_records").alias("pos", "record")).groupBy(by, "record").agg(F.min(F.struct("at", "pos")).alias("at"))
    records = each.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "record"))), lambda r: r["record"]).alias("source_records"))
    joined = whole.join(shuffled(settled), by, "left").join(shuffled(records), by, "left").withColumn("__date", F.coalesce("__settled", "__first"))
    none = F.array().cast(members.schema["source_records"].dataType)
    made = {dates[0]: F.col("__date.date"), dates[1]: F.col("__date.precision"), "source_records": F.coalesce("source_records", none)}
    return joined.select(by, "members", *(made.get(c, F.col(c)).alias(c) for c in members.columns if c != by))


def deduplicate(articles: DataFrame, order: str = "idx") -> DataFrame:
    """Articles resolved: one survivor a component, newest first (equal ones in input order)."""
    marked = articles.withColumn("__alias", aliases())
    parts = components(marked, order, "__alias")
    merged = merge_survivors(articles.join(shuffled(parts), order), "component", order)
    return merged.orderBy(F.desc("publication_date"), F.desc(normalize_name(F.col("title"))), order)


def counts_by_source(articles: DataFrame) -> DataFrame:
    """Distinct canonical ids of each source."""
    return articles.select("canonical_id", F.explode("source_records.source").alias("source")).groupBy("source").agg(F.countDistinct("canonical_id").alias("n"))


def journal_matches(name: Column, issns: Column, journal: str, issn: str | None) -> Column:
    """Whether a row's journal is the one asked for, by name or by ISSN."""
    from recordloom.functions.text import normalize_issn

    by_name = normalize_name(name) == normalize_name(F.lit(journal))
    if not issn:
        return by_name
    own = F.transform(issns, normalize_issn)
    return by_name | F.coalesce(F.array_contains(own, normalize_issn(F.lit(issn))), F.lit(False))


def same_record(found: dict[str, Column], wanted: dict[str, Column]) -> Column:
    """Whether a fetched text is the record asked for: its PMCID, PMID or DOI agrees, each where the record has one."""
    pairs = (
        (F.upper(F.trim(found["pmcid"])), F.upper(F.trim(wanted["pmcid"]))), (found["pmid"].cast("string"), wanted["pmid"].cast("string")),
        (normalize_doi(found["doi"]), normalize_doi(wanted["doi"])),
    )
    ok = F.lit(False)
    for a, b in pairs:
        ok = ok | F.coalesce(blank_to_null(b).isNotNull() & (a == b), F.lit(False))
    return ok
