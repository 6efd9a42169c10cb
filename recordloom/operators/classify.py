"""Rule-based classification, additive scores, saturation and routes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.rules import CORRESPONDENCE, PATHS, ROLES, first_match, matched, weights
from recordloom.functions.text import blank_to_null
from recordloom.plans.policy import TriagePolicy


def role(title: Column) -> Column:
    """concern, correction, editorial or primary."""
    return first_match(F.trim(F.coalesce(title, F.lit(""))), ROLES, "primary")


def publication_role(title: Column) -> Column:
    """As role(), with correspondence told from primary content."""
    r = role(title)
    return F.when((r == "primary") & F.coalesce(title, F.lit("")).rlike(CORRESPONDENCE), "correspondence").otherwise(r)


def paths(title: Column, kind: Column, rules: Mapping[str, str] = PATHS) -> Column:
    """Sorted structural paths; integrity, corrections and editorials before any study term."""
    found = F.array_sort(F.array_distinct(matched(F.coalesce(title, F.lit("")), rules)))
    return (
        F.when(kind == "concern", F.array(F.lit("INTEGRITY_EVENT")))
        .when(kind == "correction", F.array(F.lit("CORRECTION_EVENT")))
        .when(kind.isin("editorial", "correspondence"), F.array(F.lit("EDITORIAL")))
        .when(F.size(found) == 0, F.array(F.lit("PRIMARY_METADATA")))
        .otherwise(found)
    )


def primary_path(found: Column, scores: Mapping[str, int]) -> Column:
    """The path of the highest score, of equal ones the last by name."""
    table = weights(dict(scores))
    return F.array_max(F.transform(found, lambda p: F.struct(F.coalesce(F.try_element_at(table, p), F.lit(0)).alias("score"), p.alias("name"))))["name"]


def identifier_bonus(policy: TriagePolicy) -> Column:
    has = lambda c: blank_to_null(F.col(c)).isNotNull()
    return F.when(has("pmcid"), policy.pmcid_bonus).when(has("pmid"), policy.pmid_bonus).otherwise(0) + F.when(has("doi"), policy.doi_bonus).otherwise(0)


def specificity_bonus(title: Column, policy: TriagePolicy) -> Column:
    n = F.regexp_count(F.coalesce(title, F.lit("")), F.lit(r"(?U)\w+"))
    return (n >= policy.specific_tokens).cast("int") + (n >= policy.very_specific_tokens).cast("int")


def score_titles(articles: DataFrame, policy: TriagePolicy | None = None, title: str = "title_original") -> DataFrame:
    """Adds publication_role, matched_paths, primary_path, base_score and raw_score (100 at most)."""
    p = policy or TriagePolicy()
    t = F.col(title)
    found = articles.withColumn("publication_role", publication_role(t))
    found = found.withColumn("matched_paths", paths(t, F.col("publication_role"))).withColumn("primary_path", primary_path(F.col("matched_paths"), p.scores))
    base = F.coalesce(F.try_element_at(weights(p.scores), F.col("primary_path")), F.lit(0))
    return found.withColumn("base_score", base).withColumn("raw_score", F.least(F.lit(100), F.col("base_score") + identifier_bonus(p) + specificity_bonus(t, p))).withColumn("score", F.col("raw_score"))


def saturate(
    records: DataFrame, group: str, matched_col: str = "matched_paths", primary: str = "primary_path", score: str = "score",
    policy: TriagePolicy | None = None,
) -> DataFrame:
    """Lowers scores of paths that are common in their group.

    Prevalence counts every matched path; the penalty falls on records whose
    primary path is a common one. Adds match_count, group_count, prevalence
    and saturated. Counts are partial aggregates joined back, so a large group
    isn't gathered.
    """
    p = policy or TriagePolicy()
    totals = records.groupBy(group).agg(F.count(F.lit(1)).alias("group_count"))
    counts = records.select(group, F.explode(F.array_distinct(matched_col)).alias("__path")).groupBy(group, "__path").agg(F.count(F.lit(1)).alias("match_count"))
    joined = records.join(totals, group).join(counts.withColumnRenamed(group, "__group"), (F.col(group) == F.col("__group")) & (F.col(primary) == F.col("__path")), "left").drop("__group", "__path")
    joined = joined.withColumn("match_count", F.coalesce("match_count", F.lit(0)))
    share = F.col("match_count") / F.col("group_count")
    hit = F.col(primary).isin(*p.saturation_paths) & (F.col("match_count") >= p.saturation_matches) & (share >= p.saturation_prevalence)
    return joined.withColumn("prevalence", F.round(share, 6)).withColumn("saturated", hit).withColumn(score, F.when(hit, F.greatest(F.lit(0), F.col(score) - p.saturation_penalty)).otherwise(F.col(score)))


def route(kind: Column, primary: Column, score: Column, policy: TriagePolicy | None = None) -> Column:
    p = policy or TriagePolicy()
    return (
        F.when(kind.isin("concern", "correction"), "INTEGRITY_REVIEW").when(primary == "EDITORIAL", "CATALOG_ONLY")
        .when(score >= p.fetch, "FETCH_CANDIDATE").when(score >= p.reserve, "RESERVE").otherwise("CATALOG_ONLY")
    )
