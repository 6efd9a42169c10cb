"""Constraint checks: each gives rows (check, key, detail) for what violates it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.period import overlaps, period_key
from recordloom.functions.text import blank_to_null, normalize_doi, safe_url


def violations(df: DataFrame, key: Column, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a row breaks; a rule holds where its condition is true, and a null breaks it.

    All rules are tried in one pass over the rows.
    """
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return df.select(F.explode(broken).alias("check"), key.cast("string").alias("key"), F.lit(None).cast("string").alias("detail"))


def unique(df: DataFrame, keys: list[str], name: str = "DUPLICATE_KEY") -> DataFrame:
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return n.select(F.lit(name).alias("check"), F.concat_ws("|", *keys).alias("key"), F.col("n").cast("string").alias("detail"))


def references(df: DataFrame, known: DataFrame, key: str, name: str = "UNKNOWN_REFERENCE") -> DataFrame:
    return df.select(key).distinct().join(known.select(key), key, "left_anti").select(F.lit(name).alias("check"), F.col(key).cast("string").alias("key"), F.lit(None).cast("string").alias("detail"))


def report(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_checks(checks: DataFrame) -> DataFrame:
    """Of source receipts (source, ordinal, requested_ordinal, status, accepted, seen, truncated)."""
    status = F.col("status")
    return report([violations(checks, F.col("source"), {
        "SOURCE_ORDER": F.col("ordinal") == F.col("requested_ordinal"),
        "STATUS_KNOWN": status.isin("SUCCESS", "NO_RESULTS", "PARTIAL", "FAILED", "NOT_ATTEMPTED"),
        "COUNTS": (F.col("accepted") >= 0) & (F.col("accepted") <= F.col("seen")),
        "PARTIAL_MEANS_TRUNCATED": (status == "PARTIAL") == F.col("truncated"),
        "EMPTY_MEANS_NONE": (status != "NO_RESULTS") | (F.col("accepted") == 0),
    }), unique(checks, ["source"], "SOURCE_REPEATS")])


def identity(editions: DataFrame) -> DataFrame:
    """Stored period keys against those that the dates give."""
    return violations(editions, F.col("journal_slug"), {
        "PERIOD_KEY": F.col("period_key").eqNullSafe(period_key(F.col("start"), F.col("end"))),
        "DATES_ORDERED": F.col("start") <= F.col("end"),
        "REVISION_POSITIVE": F.col("revision") >= 1,
    })


def articles(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    """Unique ids, dates that may fall in the window, normal DOIs and provenance."""
    return report([violations(rows, F.col("canonical_id"), {
        "TITLE": blank_to_null(F.col("title")).isNotNull(),
        "IN_WINDOW": overlaps(F.col("publication_date"), F.col("publication_date_precision"), start, end),
        "DOI_NORMAL": F.col("doi").isNull() | F.col("doi").eqNullSafe(normalize_doi(F.col("doi"))),
        "PROVENANCE": F.size("source_records") > 0,
    }), unique(rows, ["canonical_id"], "CANONICAL_ID_REPEATS")])


def translations(rows: DataFrame) -> DataFrame:
    both = blank_to_null(F.col("title_zh_tw")).isNotNull() & blank_to_null(F.col("summary_zh_tw")).isNotNull()
    return violations(rows, F.col("canonical_id"), {"TRANSLATION_STATUS": F.col("translation_status") == F.when(both, "COMPLETE").otherwise("PENDING")})


def translation_response(edition: DataFrame, response: DataFrame, key: str = "canonical_id") -> DataFrame:
    """Unknown, repeated and missing items of a response."""
    return report([references(response, edition, key, "UNKNOWN_ITEM"), unique(response, [key], "ITEM_REPEATS"), references(edition, response, key, "ITEM_MISSING")])


#: What a translation may rest on, and how long its parts may be.
BASES = ("TITLE_ONLY", "METADATA", "ABSTRACT", "FULL_TEXT")
LONGEST_TITLE, LONGEST_SUMMARY = 500, 1200


def translation_items(items: DataFrame, edition: DataFrame, bases: tuple[str, ...] = BASES, key: str = "canonical_id") -> DataFrame:
    """Items (title_zh_tw, summary_zh_tw, basis, source_url) against their articles (key, urls): texts that are there and not
    too long, a known basis, and a source that is one of the article's links unless the title alone is translated."""
    links = edition.select(F.col(key).alias("__key"), "urls")
    both = items.join(links, F.col(key) == F.col("__key"), "left")
    basis, link = F.upper(F.trim("basis")), safe_url(F.nullif(F.trim("source_url"), F.lit("")), idna=False)
    text = lambda c, most: F.length(F.trim(c)).between(1, most)
    return violations(both, F.col(key), {
        "TITLE": text("title_zh_tw", LONGEST_TITLE), "SUMMARY": text("summary_zh_tw", LONGEST_SUMMARY), "BASIS": basis.isin(*bases), "SOURCE_MISSING": (basis == "TITLE_ONLY") | link.isNotNull(),
        "SOURCE_NOT_BOUND": link.isNull() | F.col("__key").isNull() | F.array_contains(F.transform("urls", lambda u: safe_url(u, idna=False)), link),
    })


def binding(response: dict, edition_id: str, edition_sha256: str, request_sha256: str, language: str = "zh-TW") -> list[str]:
    """Why a response's header doesn't belong to an edition and its request."""
    wanted = {"edition_id": edition_id, "language": language, "source_edition_sha256": edition_sha256, "request_binding_sha256": request_sha256}
    wrong = [k.upper() for k, v in wanted.items() if response.get(k) != v]
    if response.get("request_id") not in (None, f"{edition_id}__{language}"):
        wrong.append("REQUEST_ID")
    if response.get("item_count") is not None and response["item_count"] != len(response.get("items") or ()):
        wrong.append("ITEM_COUNT")
    return wrong


def counters(declared: DataFrame, observed: DataFrame, keys: list[str], name: str = "COUNT_DIFFERS") -> DataFrame:
    """Declared against recomputed counts (keys, n): a violation for each that differs, or that one side lacks."""
    d = declared.select(*keys, F.col("n").alias("__declared"))
    both = d.join(observed.select(*keys, F.col("n").alias("__observed")), keys, "full_outer").filter(~F.col("__declared").eqNullSafe(F.col("__observed")))
    return both.select(F.lit(name).alias("check"), F.concat_ws("|", *keys).alias("key"), F.concat_ws("<>", F.col("__declared").cast("string"), F.col("__observed").cast("string")).alias("detail"))


def stored_status(runs: DataFrame, recomputed: DataFrame, key: str) -> DataFrame:
    """Runs whose stored run_status isn't what their sources' statuses give."""
    both = runs.select(key, "run_status").join(recomputed.select(key, F.col("run_status").alias("__is")), key, "left")
    return violations(both, F.col(key), {"RUN_STATUS": F.col("run_status") == F.col("__is")})


def manifests(declared: DataFrame, stored: DataFrame) -> DataFrame:
    """Files that manifests name (path, sha256, bytes) against those stored (path, sha256, bytes)."""
    s = stored.select("path", F.col("sha256").alias("__sha"), F.col("bytes").alias("__bytes"))
    both = declared.join(s, "path", "left")
    return violations(both, F.col("path"), {
        "FILE_PRESENT": F.col("__sha").isNotNull(), "FILE_DIGEST": F.col("__sha").isNull() | (F.col("sha256") == F.col("__sha")), "FILE_SIZE": F.col("__sha").isNull() | (F.col("bytes") == F.col("__bytes")),
    })


#: What a publication's manifest repeats of its edition.
REPEATED = ("edition_id", "publication_id", "journal_slug", "period_key", "revision", "article_count", "translated_article_count")


def publications(declared: DataFrame, editions: DataFrame, key: str = "publication_id") -> DataFrame:
    """Manifests against the editions that they describe: identity and counts agree, and each has its edition."""
    e = editions.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in REPEATED))
    both = declared.join(e, F.col(key) == F.col("__key"), "left")
    same = {f"{c.upper()}_DIFFERS": F.col("__key").isNull() | F.col(c).eqNullSafe(F.col(f"__{c}")) for c in REPEATED}
    return violations(both, F.col(key), {"EDITION_PRESENT": F.col("__key").isNotNull(), **same})


def payloads(receipts: DataFrame, vault: DataFrame) -> DataFrame:
    """Receipts (record_key, sha256, bytes) against stored payloads (sha256, content): absent, altered, resized, or unclaimed."""
    stored = vault.select(F.col("sha256").alias("name"), F.sha2("content", 256).alias("is"), F.length("content").cast("long").alias("size"))
    both = receipts.join(stored, F.col("sha256") == F.col("name"), "full_outer")
    return violations(both, F.coalesce("record_key", "name"), {
        "PAYLOAD_PRESENT": F.col("name").isNotNull(), "PAYLOAD_CLAIMED": F.col("record_key").isNotNull(),
        "PAYLOAD_DIGEST": F.col("name").isNull() | (F.col("is") == F.col("name")),
        "PAYLOAD_SIZE": F.col("name").isNull() | F.col("record_key").isNull() | (F.col("size") == F.col("bytes")),
    })


def plan(items: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """A fetch plan: unique keys, all PLANNED, only allowed sources, ordinals from 1 without gaps."""
    allowed = F.array(*map(F.lit, sources))
    n = items.agg(F.count(F.lit(1)).alias("n"), F.max("ordinal").alias("m"), F.min("ordinal").alias("f")).filter("n > 0 AND (m <> n OR f <> 1)")
    return report([
        violations(items, F.col("record_key"), {"PLANNED": F.col("status") == "PLANNED", "SOURCES": F.size(F.array_except("source_order", allowed)) == 0}),
        unique(items, ["record_key"]), n.select(F.lit("ORDINALS").alias("check"), F.lit("").alias("key"), F.col("n").cast("string").alias("detail")),
    ])


def enforce(found: DataFrame, what: str) -> None:
    """Fails with the first few violations, if there are any."""
    some = found.limit(5).collect()
    if some:
        raise ValueError(f"{what}: " + "; ".join(f"{r['check']} {r['key']}" for r in some))
