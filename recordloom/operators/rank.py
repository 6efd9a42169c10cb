"""Ranks within groups: latest revisions, mid-rank percentiles, interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.operators.caps import top_per_group
from recordloom.operators.joins import small
from recordloom.operators.orders import places


def latest(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The newest row of each group, with how many it had; rows with a null group aren't in any.

    Each task gives one row a group to the shuffle, and counts are partial.
    """
    n = df.groupBy(*group).agg(F.count(F.lit(1)).alias("revision_count"))
    return top_per_group(df, group, order, 1, rank="__rn").drop("__rn").join(n, group)


def mark_latest(df: DataFrame, group: list[str], order: list[Column], key: list[str]) -> DataFrame:
    """Every row with is_latest and revision_count; ``key`` names a row. Groups are ranked and counted in each task first."""
    newest = latest(df, group, order).select(*key, F.lit(True).alias("is_latest"))
    n = df.groupBy(*group).agg(F.count(F.lit(1)).alias("revision_count"))
    return df.join(n, group).join(newest, key, "left").withColumn("is_latest", F.coalesce("is_latest", F.lit(False)))


def latest_path(df: DataFrame, group: list[str], revision: str, path: str) -> DataFrame:
    """The path of each group's highest revision, by a partial aggregate."""
    return df.groupBy(*group).agg(F.max_by(path, revision).alias(path), F.max(revision).alias(revision))


def midrank(df: DataFrame, group: list[str], value: str, name: str = "percentile") -> DataFrame:
    """100 * (smaller + half of the equal ones, itself included) / all, within each group.

    Values are counted before they are ranked, so a group costs one row for
    each of its distinct values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("__equal"))
    w = Window.partitionBy(*group)
    below = F.coalesce(F.sum("__equal").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counts.withColumn(name, F.round(100.0 * (below + 0.5 * F.col("__equal")) / F.sum("__equal").over(w), 6)).drop("__equal")
    return df.join(ranked, [*group, value], "left")


def impact_priors(metrics: DataFrame, journals: DataFrame, neutral: float = 50.0, preference: tuple[str, ...] = ("JIF", "CITESCORE")) -> DataFrame:
    """(slug, registry_category_percentile, unknown_metric) of each journal.

    ``metrics`` has (slug, category, kind, value): a metric is compared with the
    same kind's values in each category, the preferred kind's percentiles are
    averaged, and a journal without a metric gets the neutral one.
    """
    ranked = midrank(metrics.filter("value is not null"), ["category", "kind"], "value")
    order = F.coalesce(F.array_position(F.array(*map(F.lit, preference)), F.col("kind")), F.lit(0))
    best = ranked.filter(order > 0).groupBy("slug", "kind").agg(F.avg("percentile").alias("p"), F.min(order).alias("o")).groupBy("slug").agg(F.min_by("p", "o").alias("p"))
    return journals.select("slug").distinct().join(best, "slug", "left").select("slug", F.round(F.coalesce("p", F.lit(neutral)), 6).alias("registry_category_percentile"), F.col("p").isNull().alias("unknown_metric"))


def interleave(df: DataFrame, group: list[str], lane: str, within: list[Column], lanes: Column, name: str = "turn") -> DataFrame:
    """Numbers each group's rows by taking one from every lane in turn; ``lanes`` orders the lanes. ``within`` ends with something unique."""
    ranked = places(df, [*group, lane], within, "__rn")
    return places(ranked, group, ["__rn", lanes, lane], name).drop("__rn")


def round_robin(df: DataFrame, lane: str, within: list[Column], best: Column) -> DataFrame:
    """Sort columns of one global round-robin: the row's place in its lane, then the lane's best value, then the lane.

    ``orderBy(round, desc(lane_best), lane)`` gives the turns, and ``orders.numbered`` their numbers.
    Lanes are few and large: their rows are placed by ranges, their best values are partial aggregates.
    """
    top = df.groupBy(F.col(lane).alias("__lane")).agg(F.max(best).alias("lane_best"))
    joined = places(df, [lane], within, "round").join(small(top), F.col(lane).eqNullSafe(F.col("__lane")))
    return joined.drop("__lane")
