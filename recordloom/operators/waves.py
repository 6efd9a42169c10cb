"""Fallback over sources in waves: each source is asked only for what the earlier ones left.

A wave is one source and one job for all records that are still wanted, not one
chain of requests a record. Its budget bounds the requests, in the plan's order;
every attempt leaves a receipt, and lineage is cut between waves, so an answer is
never asked for twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.operators.joins import terminal_status
from recordloom.plans.lineage import cut

#: What an attempt may end in, and final states by the first of their attempts' in order.
ABSTRACT_STATES = {"FOUND": "ABSTRACT_ACQUIRED", "FAILED": "ACQUISITION_INCONCLUSIVE", "FOUND_EMPTY": "ABSTRACT_NOT_PRESENT", "NOT_FOUND": "RECORD_NOT_FOUND", "DEFERRED": "RECORD_NOT_FOUND"}
FULLTEXT_STATES = {"FOUND": "FULLTEXT_ACQUIRED", "FAILED": "FULLTEXT_ACQUISITION_INCONCLUSIVE", "ACCESS_DENIED": "FULLTEXT_ACCESS_DENIED", "NO_ROUTE": "FULLTEXT_ROUTE_NOT_FOUND", "NOT_FOUND": "FULLTEXT_NOT_FOUND", "DEFERRED": "FULLTEXT_ROUTE_NOT_FOUND"}
#: Content types in the order in which a full text is taken.
CONTENT_RANK = {"text/xml": 0, "application/xml": 1, "text/plain": 2, "application/pdf": 3}


@dataclass(frozen=True)
class Source:
    """``ask`` takes the records asked for and gives (record_key, status, payload) of those it has an answer for; others are NOT_FOUND.

    ``applies`` says whether a record has what the source needs; ``budget`` is how many a wave may ask for (None: all).
    """

    name: str
    applies: Column
    ask: Callable[[DataFrame], DataFrame]
    budget: int | None = None


def best_links(links: DataFrame, by: str = "record_key") -> DataFrame:
    """One link (url, content_type, content_version) a record: by content, the version of record first, then by URL."""
    rank = F.coalesce(*(F.when(F.lower("content_type") == k, v) for k, v in CONTENT_RANK.items()))
    order = F.struct(rank.alias("r"), F.when(F.lower("content_version") == "vor", 0).otherwise(1).alias("v"), "url")
    known = links.filter(rank.isNotNull() & (F.col("url") != ""))
    return known.groupBy(by).agg(F.min_by(F.struct("url", "content_type", "content_version"), order).alias("b")).select(by, "b.*")


def fetch(plan: DataFrame, sources: list[Source], states: dict[str, str], skipped: str, order: str = "ordinal") -> tuple[DataFrame, DataFrame]:
    """(receipts, attempts) of a plan's records (record_key, ordinal and what sources need).

    ``attempts`` has record_key, wave, source and status, NOT_APPLICABLE where a
    source couldn't be asked and DEFERRED where its budget was spent; records
    that have been found aren't in later waves. ``receipts`` has record_key,
    status, source and payload: ``skipped`` where no source applied.
    """
    left, tries, found = plan, [], []
    for wave, s in enumerate(sources, 1):
        able = left.filter(F.coalesce(s.applies, F.lit(False)))
        asked = cut(able if s.budget is None else able.orderBy(order).limit(s.budget))
        said = s.ask(asked).select("record_key", "status", "payload")
        given = asked.select("record_key").join(said, "record_key", "left").withColumn("status", F.coalesce("status", F.lit("NOT_FOUND")))
        answers = cut(given)
        why = F.when(F.coalesce(s.applies, F.lit(False)), "DEFERRED").otherwise("NOT_APPLICABLE")
        others = left.join(asked.select("record_key"), "record_key", "left_anti").select("record_key", why.alias("status"))
        made = answers.select("record_key", "status").unionByName(others).withColumns({"wave": F.lit(wave), "source": F.lit(s.name)})
        tries.append(made)
        found.append(answers.filter("status = 'FOUND'").select("record_key", F.lit(s.name).alias("source"), "payload"))
        left = cut(left.join(found[-1].select("record_key"), "record_key", "left_anti"))
    attempts, got = tries[0], found[0]
    for a, f in zip(tries[1:], found[1:], strict=True):
        attempts, got = attempts.unionByName(a), got.unionByName(f)
    attempts = cut(attempts.select("record_key", "wave", "source", "status"))
    seen = attempts.filter("status <> 'NOT_APPLICABLE'").groupBy("record_key").agg(F.collect_set("status").alias("seen"))
    first = terminal_status(F.coalesce("seen", F.array().cast("array<string>")), tuple(states), "")
    final = F.coalesce(*(F.when(first == k, v) for k, v in states.items()), F.lit(skipped))
    receipts = plan.select("record_key").join(seen, "record_key", "left").join(got, "record_key", "left")
    return receipts.select("record_key", final.alias("status"), "source", "payload"), attempts


def requests(attempts: DataFrame) -> DataFrame:
    """(wave, source, asked, found, deferred): what each wave cost."""
    asked = ~F.col("status").isin("NOT_APPLICABLE", "DEFERRED")
    return attempts.groupBy("wave", "source").agg(F.count_if(asked).alias("asked"), F.count_if(F.col("status") == "FOUND").alias("found"), F.count_if(F.col("status") == "DEFERRED").alias("deferred"))
