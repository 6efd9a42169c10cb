"""Signals of texts, priorities, and audits against checklists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.rules import ABSTRACT_SIGNALS, REPORTING_SIGNALS, RESULT_SIGNAL, matched, weighted_sum, weights
from recordloom.plans.policy import EvaluationPolicy, ReviewPolicy


def abstract_signals(text: Column, policy: ReviewPolicy | None = None) -> Column:
    p = policy or ReviewPolicy()
    text = F.coalesce(text, F.lit(""))
    more = F.array_compact(F.array(F.when(F.length(text) < p.least_characters, F.lit("SHORT_ABSTRACT")), F.when(~text.rlike(RESULT_SIGNAL), F.lit("NO_RESULT_SIGNAL"))))
    return F.concat(matched(text, ABSTRACT_SIGNALS), more)


def information_class(signals: Column) -> Column:
    has = lambda s: F.array_contains(signals, s)
    high = has("RESULTS_SECTION") & (has("METHODS_SECTION") | has("SAMPLE_SIZE")) & ~has("NO_RESULT_SIGNAL")
    return F.when(high, "HIGH_INFORMATION").when(has("SHORT_ABSTRACT") | has("NO_RESULT_SIGNAL"), "LOW_INFORMATION").otherwise("MODERATE_INFORMATION")


def review(df: DataFrame, text: str = "abstract", policy: ReviewPolicy | None = None) -> DataFrame:
    """Adds abstract_signals, abstract_information_class and fulltext_priority_score; needs primary_path, prefetch_route and percentile."""
    p = policy or ReviewPolicy()
    base = F.coalesce(F.try_element_at(weights(p.path_base), F.coalesce("primary_path", F.lit("UNKNOWN"))), F.lit(p.unknown_path))
    bonus = F.when(F.col("prefetch_route") == "FETCH_CANDIDATE", p.candidate_bonus).otherwise(0)
    percentile = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.coalesce(F.col("percentile").cast("double"), F.lit(50.0))))
    metric = F.bround((percentile - 50) * p.percentile_weight, 0).cast("int")
    read = df.withColumn("abstract_signals", abstract_signals(F.col(text), p))
    return read.withColumn("abstract_information_class", information_class(F.col("abstract_signals"))).withColumn("fulltext_priority_score", base + bonus + weighted_sum(F.col("abstract_signals"), p.signal_weights) + metric)


def structural_audit(xml: Column) -> dict[str, Column]:
    """Section flags and counts of a JATS text, namespaces aside."""
    titles = F.lower(F.array_join(F.xpath(xml, F.lit("//*[local-name()='sec']/*[local-name()='title']//text()")), " | "))
    count = lambda tag: F.size(F.xpath(xml, F.lit(f"//*[local-name()='{tag}']/@id | //*[local-name()='{tag}'][not(@id)]/text()")))
    flags = {
        "METHODS_SECTION": "method|materials", "RESULTS_SECTION": "result|finding", "LIMITATIONS": "limitation",
        "DATA_OR_CODE_AVAILABILITY": "data availability|code availability", "FUNDING": "funding", "CONFLICT_OF_INTEREST": "conflict|competing interest",
    }
    return {code: F.coalesce(titles.rlike(p), F.lit(False)) for code, p in flags.items()} | {f"{t}_count": count(t) for t in ("ref", "table-wrap", "fig")}


def machine_text(payload: Column, content_type: Column) -> Column:
    """The text of XML and plain payloads; null for PDF and anything else."""
    kind = F.lower(content_type)
    xml = F.trim(F.regexp_replace(F.regexp_replace(payload, "<[^>]+>", " "), r"(?U)\s+", " "))
    plain = F.trim(F.regexp_replace(payload, r"(?U)\s+", " "))
    return F.nullif(F.when(kind.isin("application/xml", "text/xml"), xml).when(kind == "text/plain", plain), F.lit(""))


def audit(df: DataFrame, text: str, path: str = "primary_path", flags: str | None = None, policy: EvaluationPolicy | None = None) -> DataFrame:
    """Checks texts against the checklist of their path.

    ``flags`` names an array of codes that the text's structure already shows.
    Adds reported, critical_gaps, coverage and coverage_class; a null text is
    LIMITED_NO_MACHINE_TEXT with a coverage of 0.
    """
    p = policy or EvaluationPolicy()
    table = lambda d: F.create_map(*(x for k, v in d.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    pick = lambda d: F.coalesce(F.try_element_at(table(d), F.col(path)), F.array(*map(F.lit, d["DEFAULT"])))
    seen = matched(F.coalesce(F.col(text), F.lit("")), REPORTING_SIGNALS)
    read = df.withColumn("reported", F.array_sort(F.array_union(seen, F.coalesce(F.col(flags), F.array().cast("array<string>"))) if flags else seen))
    asked = pick(p.checklists)
    share = F.size(F.array_intersect(asked, "reported")) / F.size(asked)
    gaps = F.filter(asked, lambda c: F.array_contains(pick(p.critical), c) & ~F.array_contains(F.col("reported"), c))
    read = read.withColumn("critical_gaps", gaps).withColumn("coverage", F.when(F.col(text).isNull(), 0.0).otherwise(F.round(share, 6)))
    klass = (
        F.when(F.col(text).isNull(), "LIMITED_NO_MACHINE_TEXT")
        .when((share >= p.high_coverage) & (F.size("critical_gaps") == 0), "HIGH_REPORTING_COVERAGE")
        .when(share >= p.moderate_coverage, "MODERATE_REPORTING_COVERAGE").otherwise("LOW_REPORTING_COVERAGE")
    )
    return read.withColumn("coverage_class", klass)


def editorial_score(base: Column, coverage: Column, gaps: Column, information: Column, policy: EvaluationPolicy | None = None) -> Column:
    p = policy or EvaluationPolicy()
    info = F.when(information == "HIGH_INFORMATION", p.high_bonus).when(information == "MODERATE_INFORMATION", p.moderate_bonus).otherwise(0.0)
    return F.round(F.coalesce(base, F.lit(0)).cast("double") + coverage * p.coverage_weight - F.size(gaps) * p.gap_penalty + info, 6)
