"""Merging a delta into an immutable base snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import blank_to_null

UNITED, APPENDED = ("issns", "urls", "categories"), ("source_records", "authors")


def _fill(base: Column, new: Column, name: str, kind: str) -> Column:
    """Base first: lists are united, an empty scalar is filled, dates and everything else stay."""
    if name in UNITED:
        empty = F.array().cast(kind)
        return F.array_sort(F.array_union(F.coalesce(base, empty), F.coalesce(new, empty)))
    if name in APPENDED:
        empty = F.array().cast(kind)
        return F.array_distinct(F.concat(F.coalesce(base, empty), F.coalesce(new, empty)))
    return F.coalesce(blank_to_null(base), blank_to_null(new)) if kind == "string" else F.coalesce(base, new)


def fold_delta(delta: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key: repeated rows merged in input order, the first one leading."""
    rest = [c for c in delta.columns if c not in (key, order)]
    kinds = dict(delta.dtypes)
    rows = delta.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *rest))).alias("m"))

    def merge(a: Column, b: Column) -> Column:
        return F.struct(a[order].alias(order), *(_fill(a[c], b[c], c, kinds[c]).alias(c) for c in rest))

    folded = F.aggregate(F.slice("m", F.lit(2), F.greatest(F.size("m") - 1, F.lit(0))), F.col("m")[0], merge)
    return rows.select(key, folded.alias("s")).select(key, *(F.col(f"s.{c}").alias(c) for c in rest))


def merge_delta(base: DataFrame, delta: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Base and delta by key, base values first; adds origin: BASE, BOTH or DELTA.

    With ``order`` the delta may repeat keys, which are folded in that order.
    """
    one = fold_delta(delta, key, order) if order else delta
    columns = [c for c in base.columns if c != key]
    kinds = dict(base.dtypes)
    b = base.select(F.col(key).alias("__b"), *(F.col(c).alias(f"__b_{c}") for c in columns))
    d = one.select(F.col(key).alias("__d"), *(F.col(c).alias(f"__d_{c}") for c in columns))
    both = b.join(d, F.col("__b") == F.col("__d"), "full_outer")
    origin = F.when(F.col("__d").isNull(), "BASE").when(F.col("__b").isNull(), "DELTA").otherwise("BOTH")
    return both.select(F.coalesce("__b", "__d").alias(key), *(_fill(F.col(f"__b_{c}"), F.col(f"__d_{c}"), c, kinds[c]).alias(c) for c in columns), origin.alias("origin"))


def merge_counts(merged: DataFrame, delta_rows: DataFrame) -> DataFrame:
    """One row: base, delta, added, deduplicated and result counts."""
    c = merged.agg(
        F.count_if(F.col("origin") != "DELTA").alias("base_count"), F.count_if(F.col("origin") == "DELTA").alias("added_count"),
        F.count(F.lit(1)).alias("result_count"),
    )
    return c.crossJoin(F.broadcast(delta_rows.agg(F.count(F.lit(1)).alias("delta_count")))).select("base_count", "delta_count", "added_count", (F.col("delta_count") - F.col("added_count")).alias("deduplicated_count"), "result_count")


def backfill_violations(base: dict, delta: dict) -> list[str]:
    """Why a delta can't extend a base: both are one-row headers (journal, start, end, revision, status as values; the base's kind).

    The base is a month from its first day on, and the delta goes on the very
    next day, within that month, as the next revision of the same journal.
    """
    from datetime import timedelta

    wrong = []
    if base["journal"] != delta["journal"]:
        wrong.append("JOURNAL_DIFFERS")
    if base.get("kind", "month") != "month":
        wrong.append("BASE_NOT_MONTHLY")
    if base["start"].day != 1:
        wrong.append("BASE_NOT_FROM_FIRST_DAY")
    if delta["start"] > base["end"] + timedelta(days=1):
        wrong.append("GAP_BETWEEN_WINDOWS")
    if delta["start"] <= base["end"]:
        wrong.append("WINDOWS_OVERLAP")
    if (base["start"].year, base["start"].month) != (delta["end"].year, delta["end"].month):
        wrong.append("MONTH_DIFFERS")
    if delta["status"] in ("SOURCE_ACCESS_GAP", "PARTIAL_SOURCE_COVERAGE"):
        wrong.append("DELTA_INCOMPLETE")
    if delta.get("revision", base["revision"] + 1) != base["revision"] + 1:
        wrong.append("REVISION_NOT_NEXT")
    return wrong


def backfill_checks(pairs: DataFrame, key: Column) -> DataFrame:
    """The same rules over many pairs of headers (base_journal, base_kind, base_start, base_end, base_revision, delta_journal,
    delta_start, delta_end, delta_status, delta_revision), as rows (check, key, detail). A delta without a revision is the next one."""
    from recordloom.operators.checks import violations

    month = lambda c: F.trunc(c, "month")
    return violations(pairs, key, {
        "JOURNAL_DIFFERS": F.col("base_journal") == F.col("delta_journal"), "BASE_NOT_MONTHLY": F.coalesce("base_kind", F.lit("month")) == "month", "BASE_NOT_FROM_FIRST_DAY": F.dayofmonth("base_start") == 1,
        "GAP_BETWEEN_WINDOWS": F.col("delta_start") <= F.date_add("base_end", 1), "WINDOWS_OVERLAP": F.col("delta_start") > F.col("base_end"), "MONTH_DIFFERS": month("base_start") == month("delta_end"),
        "DELTA_INCOMPLETE": ~F.col("delta_status").isin("SOURCE_ACCESS_GAP", "PARTIAL_SOURCE_COVERAGE"), "REVISION_NOT_NEXT": F.coalesce("delta_revision", F.col("base_revision") + 1) == F.col("base_revision") + 1,
    })


def fill_missing(rows: DataFrame, known: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with what they lack filled from what is known of their key; what they have stays."""
    from recordloom.operators.joins import small

    k = known.select(F.col(key).alias("__k"), *(F.col(c).alias(f"__k_{c}") for c in columns))
    joined = rows.join(small(k), F.col(key) == F.col("__k"), "left")
    return joined.select(*(F.coalesce(c, f"__k_{c}").alias(c) if c in columns else F.col(c) for c in rows.columns))
