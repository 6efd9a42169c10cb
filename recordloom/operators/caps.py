"""Caps by group: soft caps with a bypass, bounded projections, global targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.rules import weights
from recordloom.plans.policy import ProcessingPolicy, TriagePolicy


def top_per_group(df: DataFrame, group: list[str], order: list[Column], cap: int | Column, most: int | None = None, rank: str = "rank_in_group") -> DataFrame:
    """The first ``cap`` rows of each group.

    Where the cap differs by row, ``most`` (the largest) is a literal limit
    that Spark applies in each task before the shuffle.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(w))
    if isinstance(cap, Column) and most is not None:
        ranked = ranked.filter(F.col(rank) <= most)
    return ranked.filter(F.col(rank) <= cap)


def soft_cap(
    records: DataFrame, group: str, order: list[Column], cap: Column, key: list[str], most: int,
    score: str = "score", routed: str = "route", bypass: int = 92, candidate: str = "FETCH_CANDIDATE", demoted: str = "RESERVE",
) -> DataFrame:
    """Demotes candidates beyond their group's cap.

    Candidates of ``bypass`` or more always stay and use up the cap; the
    others stay while their rank fits what is left. Adds ``demoted``.

    ``key`` names a record and ``most`` is the largest cap. Only the first
    ``most`` regular candidates of a group leave their task to be ranked, and
    the exceptional ones are counted where they are, so a group of any size
    costs one short list; the records themselves are joined to the lists.
    """
    is_candidate = F.col(routed) == candidate
    regular = is_candidate & (F.col(score) < bypass)
    above = records.filter(is_candidate & (F.col(score) >= bypass)).groupBy(group).agg(F.count(F.lit(1)).alias("__above")).withColumnRenamed(group, "__g")
    first = top_per_group(records.filter(regular).withColumn("__cap", cap), [group], order, most, rank="__place")
    room = F.greatest(F.lit(0), F.col("__cap") - F.coalesce("__above", F.lit(0)))
    stay = first.join(above, F.col(group) == F.col("__g"), "left").filter(F.col("__place") <= room).select(*key, F.lit(True).alias("__stays"))
    marked = records.join(stay, key, "left").withColumn("demoted", regular & F.col("__stays").isNull())
    return marked.withColumn(routed, F.when(F.col("demoted"), demoted).otherwise(F.col(routed))).drop("__stays")


def triage_caps(records: DataFrame, policy: TriagePolicy | None = None) -> DataFrame:
    """The soft cap of the record's journal and mode, in the funnel's order."""
    p = policy or TriagePolicy()
    order = [F.desc("score"), F.desc("publication_date"), F.lower("title_original"), F.col("canonical_id")]
    cap = F.coalesce(F.try_element_at(weights(p.soft_caps), F.col("processing_mode")), F.lit(0))
    return soft_cap(records, "journal_slug", order, cap, ["journal_slug", "canonical_id"], max(p.soft_caps.values()), bypass=p.bypass)


def reserve_index(records: DataFrame, policy: TriagePolicy | None = None) -> DataFrame:
    """Reserve records that are published: so many of a journal as its mode allows."""
    p = policy or TriagePolicy()
    order = [F.desc("score"), F.desc("publication_date"), F.lower("title_original"), F.col("canonical_id")]
    cap = F.coalesce(F.try_element_at(weights(p.reserve_caps), F.col("processing_mode")), F.lit(0))
    return top_per_group(records.filter("route = 'RESERVE'"), ["journal_slug"], order, cap, most=max(p.reserve_caps.values()))


def volume_guard(mode: Column, total: Column, policy: ProcessingPolicy | None = None) -> tuple[Column, Column]:
    """(effective mode, page limit): a large FULL edition is handled as TRIAGE."""
    p = policy or ProcessingPolicy()
    over = (mode == "FULL") & (total > p.triage_threshold)
    limit, reduced = (F.try_element_at(weights(t), mode) for t in (p.page_limits_by_mode, p.triage_page_limits_by_mode))
    return F.when(over, "TRIAGE").otherwise(mode), F.when(over, F.least(limit, reduced)).otherwise(limit)


def load_allowed(mode: Column, override: bool = False) -> tuple[Column, Column]:
    """(allowed, effective mode): suspended journals aren't loaded, but by an override, which treats them as FULL."""
    suspended = mode == "SUSPENDED"
    return ~suspended | F.lit(override), F.when(suspended & F.lit(override), "FULL").otherwise(mode)


def source_budget(requested: Column, mode: Column, policy: ProcessingPolicy | None = None, override: bool = False) -> Column:
    """How many records each source is asked for: what is requested, within the mode's limit unless overridden."""
    p = policy or ProcessingPolicy()
    return requested if override else F.least(requested, F.try_element_at(weights(p.source_limits_by_mode), mode))


def projection(articles: Column, limit: Column) -> tuple[Column, Column, Column]:
    """(NONE, LIMITED or INLINE_ALL; shown; omitted) of so many articles under a page limit."""
    shown = F.least(articles, F.greatest(F.lit(0), limit).cast("long"))
    return F.when(limit <= 0, "NONE").when(articles > limit, "LIMITED").otherwise("INLINE_ALL"), shown, articles - shown


#: Levels that a run states about itself: metadata only, nothing fetched or judged.
PROVENANCE = ("full_text_requested", "full_text_fetched", "evidence_evaluated")


def with_provenance(df: DataFrame) -> DataFrame:
    """Adds the constant flags of what was not done."""
    return df.withColumns({"acquisition_level": F.lit("BIBLIOGRAPHIC_METADATA"), **{c: F.lit(False) for c in PROVENANCE}})


def featured(rows: DataFrame, group: str, turn: list[Column], cap: int | Column, target: int, key: list[str], most: int | None = None) -> DataFrame:
    """Rows in turn, until a group's cap and then the global target is reached.

    Adds ordinal (null for those not featured) and reason. Groups are cut to
    their cap in each task before the shuffle (``most`` is the largest cap where
    it differs by row), the target is a top-k of what is left, and the rows are
    joined to both by ``key``: none of them meets all others in one task.
    """
    capped = rows.filter(F.coalesce(cap, F.lit(0)) > 0) if isinstance(cap, Column) else rows
    within = top_per_group(capped, [group], turn, cap, most, rank="__place").drop("__place")
    top = within.orderBy(*turn).limit(target)
    chosen = top.select(*key, F.row_number().over(Window.orderBy(*turn)).alias("ordinal"))  # of the target's rows alone
    marked = rows.join(within.select(*key, F.lit(True).alias("__in")), key, "left").join(F.broadcast(chosen), key, "left")
    reason = F.when(F.col("ordinal").isNotNull(), "SELECTED").when(F.col("__in").isNull(), "GROUP_CAP").otherwise("GLOBAL_TARGET")
    return marked.withColumn("reason", reason).drop("__in")


def volume_projection(rows: DataFrame, group: list[str], order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group, with the group's total and how many were left out."""
    n = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("total"))
    kept = top_per_group(rows, group, order, limit, rank="position").join(n, group)
    return kept.withColumn("omitted", F.greatest(F.lit(0).cast("long"), F.col("total") - limit))
