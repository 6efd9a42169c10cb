"""The curation funnel end to end: triage, shortlist, abstract review, evaluated edition.

Each step takes and returns DataFrames, so a step's result can be written and
read before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.rules import weights
from recordloom.functions.text import ABSTRACT_STOP_WORDS, blank_to_null, title_tokens, topic_signature
from recordloom.operators import caps, classify, identity, rank, select, signals
from recordloom.plans.policy import EvaluationPolicy, ReviewPolicy, ShortlistPolicy, TriagePolicy


def triage(articles: DataFrame, policy: TriagePolicy | None = None) -> DataFrame:
    """Articles (journal_slug, canonical_id, title_original, identifiers, publication_date, processing_mode) scored, routed and capped."""
    p = policy or TriagePolicy()
    scored = classify.saturate(classify.score_titles(articles, p), "journal_slug", policy=p)
    routed = scored.withColumn("route", classify.route(F.col("publication_role"), F.col("primary_path"), F.col("score"), p))
    return caps.triage_caps(routed, p)


def shortlist(triaged: DataFrame, priors: DataFrame, policy: ShortlistPolicy | None = None, paths: TriagePolicy | None = None) -> DataFrame:
    """Every triaged record with shortlist_route, ordinal and reasons (an array).

    ``priors`` has slug, registry_category_percentile and unknown_metric.
    Paths come in the order of their scores, highest first.
    """
    p = policy or ShortlistPolicy()
    scores = (paths or TriagePolicy()).scores
    order = weights({k: i for i, k in enumerate(sorted(scores, key=lambda k: -scores[k]))})
    place = F.coalesce(F.try_element_at(order, F.col("primary_path")), F.lit(999))
    fetchable = F.greatest(*(blank_to_null(F.col(c)).isNotNull() for c in ("pmcid", "pmid", "doi")))
    tokens = title_tokens(F.col("title_original"))
    key = identity.record_key(F.col("journal_slug"), F.col("period_key"), F.col("revision"), F.col("canonical_id"))
    r = triaged.withColumn("record_key", key).withColumn("fetchable", fetchable).withColumn("tokens", tokens).withColumn("topic_signature", topic_signature(tokens, p.signature_tokens)).withColumn("path_rank", place)
    within = [F.col("path_rank"), F.desc("score"), F.desc("publication_date"), F.lower("title_original"), F.col("canonical_id")]
    eligible = r.filter(F.col("route").isin(*p.eligible)).withColumn("place", F.row_number().over(Window.partitionBy("journal_slug").orderBy(*within)))
    ready = rank.interleave(eligible, ["journal_slug", "route"], "primary_path", within, F.col("path_rank"))
    context = select.contexts(r, priors, p)
    chosen, blocks = select.diversified(ready, context, p)
    why = blocks.unionByName(select.final_blocks(ready, chosen, context, p)).groupBy("record_key").agg(F.array_sort(F.collect_set("block")).alias("blocks"))
    out = r.join(chosen.select("record_key", "ordinal", "reason"), "record_key", "left").join(why, "record_key", "left")
    routed = F.when(F.col("ordinal").isNotNull(), "FETCH_NOW").when(F.col("route").isin(*p.eligible), "HOLD_RESERVE").otherwise("CATALOG_ONLY")
    reasons = F.when(F.col("ordinal").isNotNull(), F.array("reason", F.lit("IDENTIFIER_AVAILABLE"))).otherwise(F.coalesce("blocks", F.array(F.concat(F.lit("ROUTE:"), F.col("route")))))
    return out.withColumn("shortlist_route", routed).withColumn("reasons", reasons).drop("reason", "blocks")


def abstract_review(shortlisted: DataFrame, abstracts: DataFrame, priors: DataFrame, policy: ReviewPolicy | None = None) -> DataFrame:
    """Shortlisted records with their abstracts (record_key, abstract) read: fulltext_route, ordinal, score, signals, information class."""
    p = policy or ReviewPolicy()
    got = shortlisted.filter("shortlist_route = 'FETCH_NOW'").drop("ordinal").join(abstracts, "record_key", "left")
    named = got.join(priors.select(F.col("slug").alias("journal_slug"), F.col("registry_category_percentile").alias("percentile")), "journal_slug", "left").withColumn("percentile", F.coalesce("percentile", F.lit(50.0)))
    read = signals.review(named.filter("abstract is not null").withColumn("prefetch_route", F.col("route")), "abstract", p)
    rows = read.select("journal_slug", "record_key", "processing_mode", F.col("fulltext_priority_score").cast("double").alias("score"), "percentile", F.col("raw_score").alias("prefetch_score"), F.coalesce("title_original", F.lit("")).alias("title"), title_tokens(F.col("title_original"), ABSTRACT_STOP_WORDS).alias("tokens"))
    chosen = select.review_selection(rows, p).drop("journal_slug")
    out = read.join(chosen, "record_key").withColumn("fulltext_route", F.when(F.col("ordinal").isNotNull(), "FULLTEXT_NOW").otherwise("FULLTEXT_RESERVE"))
    none = named.filter("abstract is null").withColumn("fulltext_route", F.lit("NO_ABSTRACT"))
    return out.unionByName(none, allowMissingColumns=True)


def evaluated_edition(reviewed: DataFrame, texts: DataFrame, policy: EvaluationPolicy | None = None) -> DataFrame:
    """Records with their full texts (record_key, text, flags) audited: editorial_route, featured_ordinal, score and reason."""
    p = policy or EvaluationPolicy()
    audited = signals.audit(reviewed.filter("fulltext_route = 'FULLTEXT_NOW'").drop("ordinal", "reason").join(texts, "record_key", "left"), "text", flags="flags", policy=p)
    limited = audited.filter("text is null").withColumn("editorial_route", F.lit("LIMITED_REVIEW")).withColumn("reason", F.lit("MACHINE_TEXT_UNAVAILABLE"))
    score = signals.editorial_score(F.col("fulltext_priority_score"), F.col("coverage"), F.col("critical_gaps"), F.col("abstract_information_class"), p)
    read = audited.filter("text is not null").withColumn("editorial_score", score)
    turns = rank.round_robin(read, "primary_path", [F.desc("editorial_score"), F.lower("title_original"), F.col("record_key")], F.col("editorial_score"))
    cap = F.coalesce(F.try_element_at(weights(p.journal_caps), F.col("processing_mode")), F.lit(0))
    placed = caps.featured(turns, "journal_slug", [F.col("round"), F.desc("lane_best"), F.col("primary_path")], cap, p.target, ["record_key"], max(p.journal_caps.values()))
    routed = placed.withColumn("editorial_route", F.when(F.col("ordinal").isNotNull(), "FEATURED").otherwise("EVIDENCE_RESERVE")).withColumnRenamed("ordinal", "featured_ordinal")
    return routed.drop("round", "lane_best").unionByName(limited, allowMissingColumns=True)
