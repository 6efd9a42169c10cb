"""The funnel's operators on the driver's tables, with titles, abstracts and texts written from keys.

What a row's text says is chosen by its key, so the SQL knows the answer
without any pattern, and the patterns are held against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions import period, text
from recordloom.operators import caps, checks, classify, identity, joins, merge, orders, publish, select, signals, textindex, waves
from recordloom.plans.lineage import cut, scratch, spread
from recordloom.plans.policy import FirstShortlistPolicy, ReviewPolicy
from recordloom.plans.table_queries import _TOKENS_SQL, query

#: Beginnings of titles, and the path, role and base score that each must get.
TITLES = (
    ("Guidelines for the use of", "GUIDANCE", "primary", 92), ("A systematic review of", "EVIDENCE_SYNTHESIS", "primary", 88), ("A randomized controlled trial of", "RANDOMIZED_TRIAL", "primary", 86),
    ("External validation of", "REPLICATION_VALIDATION", "primary", 84), ("Drug safety and", "SAFETY_SIGNAL", "primary", 82), ("A benchmark of", "RESOURCE_BENCHMARK", "primary", 80),
    ("A prospective study of", "PROSPECTIVE_LONGITUDINAL", "primary", 74), ("A retrospective look at", "OBSERVATIONAL_DESIGN", "primary", 66), ("A survey of", "SURVEY", "primary", 58),
    ("Study protocol: ", "PROTOCOL", "primary", 38), ("A case report on", "CASE_REPORT", "primary", 42), ("Retraction note:", "INTEGRITY_EVENT", "concern", 100), ("Erratum:", "CORRECTION_EVENT", "correction", 90),
    ("Editorial: on", "EDITORIAL", "editorial", 25), ("Re: a systematic review of", "EDITORIAL", "correspondence", 25), ("A non-randomised trial of", "PRIMARY_METADATA", "primary", 50), ("Notes on", "PRIMARY_METADATA", "primary", 50),
)


def _pick(values, k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


def _sql_pick(values, k: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][{k} % {len(values)} + 1]"


def _titled(t) -> DataFrame:
    k = F.col("p_partkey")
    return spread(t("part").select("p_partkey", "p_brand", "p_size", "p_name"), "p_partkey").select(
        "p_partkey", "p_brand", "p_size", F.concat_ws(" ", _pick([x[0] for x in TITLES], k), F.lower("p_name")).alias("title_original"),
        F.when(k % 3 == 0, F.concat(F.lit("10.5555/"), k.cast("string"))).alias("doi"), F.when(k % 5 == 0, k.cast("string")).alias("pmid"), F.when(k % 7 == 0, F.concat(F.lit("PMC"), k.cast("string"))).alias("pmcid"),
    )


_SCORE_SQL = f"least(100, {_sql_pick([x[3] for x in TITLES], 'p_partkey')} + CASE WHEN p_partkey % 7 = 0 THEN 6 WHEN p_partkey % 5 = 0 THEN 2 ELSE 0 END + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN n >= 12 THEN 1 ELSE 0 END + CASE WHEN n >= 20 THEN 1 ELSE 0 END)"
_TITLE_SQL = f"""
WITH p AS (SELECT p_partkey, p_brand, {_sql_pick([x[1] for x in TITLES], 'p_partkey')} AS primary_path, {_sql_pick([x[2] for x in TITLES], 'p_partkey')} AS publication_role, len(regexp_extract_all({_sql_pick([x[0] for x in TITLES], 'p_partkey')} || ' ' || lower(p_name), '[A-Za-z0-9_]+')) AS n FROM part),
s AS (SELECT *, {_SCORE_SQL} AS raw_score FROM p),
r AS (SELECT *, CASE WHEN publication_role IN ('concern', 'correction') THEN 'INTEGRITY_REVIEW' WHEN primary_path = 'EDITORIAL' THEN 'CATALOG_ONLY' WHEN raw_score >= 80 THEN 'FETCH_CANDIDATE' WHEN raw_score >= 65 THEN 'RESERVE' ELSE 'CATALOG_ONLY' END AS route FROM s)
"""


def _routed(t) -> DataFrame:
    s = classify.score_titles(_titled(t))
    return s.withColumn("route", classify.route(F.col("publication_role"), F.col("primary_path"), F.col("raw_score")))


@query(_TITLE_SQL + "SELECT p_partkey, publication_role, primary_path, raw_score, route FROM r")
def title_paths(t) -> DataFrame:
    return _routed(t).select("p_partkey", "publication_role", "primary_path", "raw_score", "route")


@query(_TITLE_SQL + """SELECT p_brand, count(*) AS total, count(*) FILTER (route = 'INTEGRITY_REVIEW') AS integrity_review, count(*) FILTER (route = 'FETCH_CANDIDATE') AS fetch_candidate, count(*) FILTER (route = 'RESERVE') AS reserve, count(*) FILTER (route = 'CATALOG_ONLY') AS catalog_only FROM r GROUP BY p_brand""")
def triage_summary(t) -> DataFrame:
    return publish.conditional_counts(_routed(t), ["p_brand"], "route", ("INTEGRITY_REVIEW", "FETCH_CANDIDATE", "RESERVE", "CATALOG_ONLY"))


@query(_TITLE_SQL + """SELECT p_brand, count(*) AS n, string_agg(p_partkey || '=' || primary_path, ',' ORDER BY raw_score, p_partkey) AS items FROM r WHERE route = 'FETCH_CANDIDATE' GROUP BY p_brand""")
def edition_artifacts(t) -> DataFrame:
    g = publish.grouped_items(_routed(t), ["p_brand"], ["raw_score", "p_partkey"], ["primary_path"], where=F.col("route") == "FETCH_CANDIDATE")
    return g.select("p_brand", "n", F.array_join(F.transform("items", lambda x: F.concat_ws("=", x["p_partkey"], x["primary_path"])), ",").alias("items"))


@query(_TITLE_SQL + """
, c AS (SELECT p_brand AS journal_slug, count(*) AS articles, count(*) FILTER (route IN ('FETCH_CANDIDATE', 'RESERVE')) AS eligible, count(*) FILTER (route IN ('FETCH_CANDIDATE', 'RESERVE') AND p_partkey % 2 = 0) AS fetchable, count(*) FILTER (route = 'FETCH_CANDIDATE' AND p_partkey % 2 = 0) AS candidates, CAST(ascii(right(p_brand, 1)) % 5 * 25 AS DOUBLE) AS percentile FROM r GROUP BY p_brand),
d AS (SELECT *, CASE WHEN percentile >= 90 THEN 1.0 WHEN percentile >= 75 THEN 0.9 WHEN percentile >= 50 THEN 0.8 ELSE 0.7 END AS rate FROM c)
SELECT journal_slug, articles, eligible, fetchable, candidates, CAST(rate AS DOUBLE) AS capture_rate, CAST(least(fetchable, 40, greatest(candidates, ceil(round(fetchable * rate, 9)))) AS BIGINT) AS target FROM d""")
def journal_contexts(t) -> DataFrame:
    r = _routed(t).select(F.col("p_brand").alias("journal_slug"), "route", F.lit("FULL").alias("processing_mode"), (F.col("p_partkey") % 2 == 0).alias("fetchable"))
    priors = r.select(F.col("journal_slug").alias("slug")).distinct().select("slug", (F.ascii(F.substring("slug", -1, 1)) % 5 * 25).cast("double").alias("registry_category_percentile"), F.lit(False).alias("unknown_metric"))
    return select.contexts(r, priors).select("journal_slug", "articles", "eligible", "fetchable", "candidates", F.col("capture_rate").cast("double").alias("capture_rate"), F.col("target").cast("long").alias("target"))


#: Sentences that a text holds by the bits of its key, and the signal that each gives.
ABSTRACT = (("Methods: we looked.", "METHODS_SECTION", 5), ("Results: it fell.", "RESULTS_SECTION", 7), ("We enrolled 250 of them.", "SAMPLE_SIZE", 5), ("The hazard ratio was low.", "EFFECT_ESTIMATE", 5), ("See clinicaltrials.gov for it.", "REGISTRATION", 4), ("It has limitations.", "LIMITATIONS", 2))
_PAD = "Word after word follows here without any meaning at all. " * 5


@query(f"""
WITH o AS (SELECT o_orderkey, o_orderkey % 64 AS k, o_orderkey % 3 = 0 AS long FROM orders),
s AS (SELECT o_orderkey, k, long, k & 2 > 0 AS res, list_filter([{', '.join(f"CASE WHEN k & {1 << i} > 0 THEN '{x[1]}' END" for i, x in enumerate(ABSTRACT))}, CASE WHEN NOT long THEN 'SHORT_ABSTRACT' END, CASE WHEN k & 2 = 0 THEN 'NO_RESULT_SIGNAL' END], lambda x: x IS NOT NULL) AS signals FROM o)
SELECT o_orderkey, array_to_string(signals, ',') AS signals, CAST({_sql_pick([80, 55, 50], 'o_orderkey')} + CASE WHEN o_orderkey % 2 = 0 THEN 8 ELSE 0 END + {' + '.join(f'CASE WHEN k & {1 << i} > 0 THEN {x[2]} ELSE 0 END' for i, x in enumerate(ABSTRACT))} - CASE WHEN long THEN 0 ELSE 8 END - CASE WHEN res THEN 0 ELSE 6 END + CASE o_orderkey % 3 WHEN 0 THEN 4 WHEN 1 THEN -2 ELSE 0 END AS INT) AS score,
  CASE WHEN res AND (k & 1 > 0 OR k & 4 > 0) THEN 'HIGH_INFORMATION' WHEN NOT long OR NOT res THEN 'LOW_INFORMATION' ELSE 'MODERATE_INFORMATION' END AS information FROM s""")
def abstract_review(t) -> DataFrame:
    k = F.col("o_orderkey")
    said = F.concat_ws(" ", *(F.when((k % 64).bitwiseAND(1 << i) > 0, F.lit(x[0])) for i, x in enumerate(ABSTRACT)), F.when(k % 3 == 0, F.lit(_PAD)))
    rows = t("orders").select(
        "o_orderkey", said.alias("abstract"), _pick(["RANDOMIZED_TRIAL", "SURVEY", "OTHER"], k).alias("primary_path"), F.when(k % 2 == 0, "FETCH_CANDIDATE").otherwise("RESERVE").alias("prefetch_route"), _pick([85.0, 25.0, 55.0], k).alias("percentile"),
    )
    r = signals.review(rows)
    return r.select("o_orderkey", F.array_join("abstract_signals", ",").alias("signals"), F.col("fulltext_priority_score").alias("score"), F.col("abstract_information_class").alias("information"))


REPORT = (("We recommend it.", "RECOMMENDATION_LANGUAGE"), ("Competing interests: none.", "CONFLICT_OF_INTEREST"), ("Funding came late.", "FUNDING"))


@query("""
WITH o AS (SELECT o_orderkey, o_orderkey % 16 AS k, o_orderkey % 11 = 0 AS none FROM orders),
c AS (SELECT o_orderkey, none, (k & 1 > 0)::INT + (k & 2 > 0)::INT + (k & 4 > 0)::INT + (k & 8 > 0)::INT AS present, array_to_string(list_filter([CASE WHEN none OR k & 8 = 0 THEN 'METHODS_SECTION' END, CASE WHEN none OR k & 1 = 0 THEN 'RECOMMENDATION_LANGUAGE' END, CASE WHEN none OR k & 2 = 0 THEN 'CONFLICT_OF_INTEREST' END], lambda x: x IS NOT NULL), ',') AS gaps,
  (none OR k & 8 = 0)::INT + (none OR k & 1 = 0)::INT + (none OR k & 2 = 0)::INT AS n_gaps FROM o)
SELECT o_orderkey, CASE WHEN none THEN 0.0 ELSE present / 4 END AS coverage, gaps, CASE WHEN none THEN 'LIMITED_NO_MACHINE_TEXT' WHEN present >= 3 AND gaps = '' THEN 'HIGH_REPORTING_COVERAGE' WHEN present >= 2 THEN 'MODERATE_REPORTING_COVERAGE' ELSE 'LOW_REPORTING_COVERAGE' END AS coverage_class, 60 + CASE WHEN none THEN 0 ELSE present / 4 * 24 END - 6.0 * n_gaps + 2 AS score FROM c""")
def reporting_audit(t) -> DataFrame:
    k = F.col("o_orderkey")
    bit = lambda i: (k % 16).bitwiseAND(1 << i) > 0
    said = F.when(k % 11 != 0, F.concat_ws(" ", F.lit("A text."), *(F.when(bit(i), F.lit(x[0])) for i, x in enumerate(REPORT))))
    flags = F.when((k % 11 != 0) & bit(3), F.array(F.lit("METHODS_SECTION"))).otherwise(F.array().cast("array<string>"))
    a = signals.audit(t("orders").select("o_orderkey", said.alias("text"), flags.alias("flags"), F.lit("GUIDANCE").alias("primary_path")), "text", flags="flags")
    return a.select("o_orderkey", "coverage", F.array_join("critical_gaps", ",").alias("gaps"), "coverage_class", signals.editorial_score(F.lit(60), F.col("coverage"), F.col("critical_gaps"), F.lit("MODERATE_INFORMATION")).alias("score"))


@query("""SELECT count(DISTINCT o_custkey) AS journals, count(DISTINCT (o_custkey, strftime(o_orderdate, '%Y-%m'))) AS periods, count(*) AS revisions, max(strftime(o_orderdate, '%Y-%m')) AS latest_month, count(DISTINCT o_custkey) FILTER (strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)) AS in_latest_month FROM orders""")
def catalog_counts(t) -> DataFrame:
    return publish.catalog_counts(t("orders").select(F.col("o_custkey").alias("journal"), F.date_format("o_orderdate", "yyyy-MM").alias("month")))


@query("""SELECT p_brand, count(*) FILTER (p_size > 10) AS known, count(*) FILTER (p_size <= 10) AS unknown, round(count(*) FILTER (p_size > 10) / count(*), 6) AS fraction FROM part GROUP BY p_brand""")
def metric_coverage(t) -> DataFrame:
    return publish.coverage(t("part"), ["p_brand"], F.col("p_size") > 10)


@query("SELECT count(*) AS providers, CAST(sum(p_size) AS BIGINT) AS p_size, CAST(sum(p_partkey % 7) AS BIGINT) AS articles FROM part")
def provider_totals(t) -> DataFrame:
    return publish.provider_totals(t("part").withColumn("articles", F.col("p_partkey") % 7), ["p_size", "articles"])


@query("SELECT l_suppkey, CASE WHEN count(*) > 580 AND count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 7) > 0 THEN 'primary' ELSE 'all' END AS default_role FROM lineitem GROUP BY l_suppkey")
def default_role(t) -> DataFrame:
    role = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), "primary").otherwise("editorial")
    return publish.default_role(t("lineitem").select("l_suppkey", role.alias("curation_role")), ["l_suppkey"], many=580)


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, max(CASE WHEN l_quantity > 25 THEN l_returnflag ELSE '' END) AS flag, list(l_linestatus) AS u FROM lineitem GROUP BY ALL)
SELECT l_orderkey, coalesce(min_by(flag, l_linenumber) FILTER (flag <> ''), '') AS flag, array_to_string(list_sort(list_distinct(flatten(list(u)))), ',') AS urls FROM l GROUP BY l_orderkey""")
def ordered_fold(t) -> DataFrame:
    d = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max(F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).otherwise("")).alias("flag"), F.array_sort(F.collect_set("l_linestatus")).alias("urls"))
    return merge.fold_delta(d, "l_orderkey", "l_linenumber").select("l_orderkey", F.coalesce(text.blank_to_null(F.col("flag")), F.lit("")).alias("flag"), F.array_join("urls", ",").alias("urls"))


_ROUTED = ("INTEGRITY_REVIEW", "FETCH_CANDIDATE", "RESERVE", "CATALOG_ONLY", "OTHER")
_PLACE_SQL = "CASE event_id % 5 WHEN 4 THEN 99 ELSE event_id % 5 END"


def _ordered(t) -> DataFrame:
    """Events as records with everything that an output order needs."""
    k = F.col("event_id")
    return t("events").select(
        "event_id", _pick(_ROUTED, k).alias("route"), (k % 11).cast("int").alias("score"), F.concat(F.lit("J"), (k % 4).cast("string")).alias("journal"), F.date_format("ts", "yyyy-MM-dd").alias("publication_date"),
        F.concat(F.lit("T"), (k % 3).cast("string")).alias("title_original"), F.lpad(k.cast("string"), 9, "0").alias("canonical_id"), F.lpad(k.cast("string"), 9, "0").alias("record_key"), (k % 11).cast("int").alias("prefetch_score"),
        F.when(k % 6 > 0, (k % 6 * 15).cast("double")).alias("percentile"), _pick(("FETCH_CANDIDATE", "RESERVE"), k).alias("prefetch_route"), _pick(("FETCH_NOW", "HOLD_RESERVE", "CATALOG_ONLY"), k).alias("editorial_route"),
        F.when(k % 3 == 0, (k % 1000 + 1).cast("int")).alias("selection_ordinal"), _pick(("FULLTEXT_NOW", "FULLTEXT_RESERVE", "NO_ABSTRACT"), k).alias("fulltext_route"), (k % 17).cast("int").alias("fulltext_priority_score"),
        F.date_format("ts", "yyyy-MM").alias("period_end"), k.alias("revision"),
    )


def _in_order(t, order: list) -> DataFrame:
    return orders.numbered(_ordered(t), order).select("event_id", "ordinal")


@query(f"SELECT event_id, row_number() OVER (ORDER BY {_PLACE_SQL}, event_id % 11 DESC, event_id % 4, strftime(ts, '%Y-%m-%d'), event_id % 3, event_id) AS ordinal FROM events")
def triage_order(t) -> DataFrame:
    return _in_order(t, orders.triage_order())


@query("SELECT event_id, row_number() OVER (ORDER BY CASE WHEN event_id % 5 > 2 THEN 99 ELSE event_id % 5 END, event_id % 11 DESC, strftime(ts, '%Y-%m-%d') DESC, event_id % 3, event_id) AS ordinal FROM events")
def portfolio_order(t) -> DataFrame:
    return _in_order(t, orders.portfolio_order())


@query("SELECT event_id, row_number() OVER (ORDER BY event_id % 2, CASE WHEN event_id % 6 = 0 THEN 50 ELSE event_id % 6 * 15 END DESC, event_id % 11 DESC, event_id % 4, event_id % 3, event_id) AS ordinal FROM events")
def hold_order(t) -> DataFrame:
    return _in_order(t, [*orders.hold_order(), "event_id"])


@query("SELECT event_id, row_number() OVER (ORDER BY event_id % 3, CASE WHEN event_id % 3 = 0 THEN event_id % 1000 + 1 ELSE 999999 END, event_id % 11 DESC, event_id % 3, event_id) AS ordinal FROM events")
def audit_order(t) -> DataFrame:
    return _in_order(t, orders.audit_order())


@query("SELECT event_id, row_number() OVER (ORDER BY event_id % 3, event_id % 17 DESC, event_id % 4, event_id) AS ordinal FROM events")
def review_order(t) -> DataFrame:
    return _in_order(t, [*orders.review_order(), "event_id"])


@query("SELECT event_id, row_number() OVER (ORDER BY strftime(ts, '%Y-%m') DESC, event_id % 4 DESC, event_id DESC) AS ordinal FROM events")
def publication_order(t) -> DataFrame:
    return _in_order(t, orders.publication_order())


@query(_TITLE_SQL + ", j AS (SELECT p_brand AS journal, count(*) FILTER (route = 'FETCH_CANDIDATE') AS f, count(*) FILTER (route = 'INTEGRITY_REVIEW') AS i FROM r GROUP BY p_brand) SELECT journal, row_number() OVER (ORDER BY f DESC, i DESC, lower(journal)) AS ordinal FROM j")
def journal_order(t) -> DataFrame:
    counted = publish.conditional_counts(_routed(t).withColumnRenamed("p_brand", "journal"), ["journal"], "route", orders.TRIAGE_ROUTES)
    return orders.numbered(counted, orders.journal_order()).select("journal", "ordinal")


@query("""
SELECT o_orderkey, o_orderkey % 4 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 AS same FROM orders""")
def fetched_identity(t) -> DataFrame:
    """A record has three identifiers; a fetched text agrees in some of them, in other spellings."""
    k = F.col("o_orderkey")
    said = lambda pre, n: F.concat(F.lit(pre), F.when(k % n == 0, k).otherwise(-k - 1).cast("string"))
    found = {"pmcid": said("pmc", 4), "pmid": said("", 5), "doi": F.concat(F.lit("https://doi.org/"), said("10.5/X", 7))}
    wanted = {"pmcid": F.concat(F.lit("PMC"), k.cast("string")), "pmid": k.cast("string"), "doi": F.concat(F.lit("10.5/x"), k.cast("string"))}
    return t("orders").select("o_orderkey", identity.same_record(found, wanted).alias("same"))


@query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'https://www.sciencedirect.com/science/article/pii/S' || c_custkey WHEN 1 THEN 'https://linkinghub.elsevier.com/retrieve/other/S' || c_custkey ELSE 'http://example.org/retrieve/pii/S' || c_custkey END AS link FROM customer""")
def publisher_links(t) -> DataFrame:
    link = F.concat(_pick(["https://LinkingHub.elsevier.com/retrieve/pii/S", "https://linkinghub.elsevier.com/retrieve/other/S", "http://example.org/retrieve/pii/S"], F.col("c_custkey")), F.col("c_custkey").cast("string"))
    return t("customer").select("c_custkey", text.publisher_url(link, idna=False).alias("link"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE n_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS publisher FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def filled_identities(t) -> DataFrame:
    """What a registry's rows lack comes from what is known of them."""
    c = t("customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("publisher"))
    known = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("name"), F.lit("").alias("publisher"))
    return merge.fill_missing(c, known, "c_nationkey", ["name", "publisher"]).select("c_custkey", "name", "publisher")


@query("""
SELECT c_custkey AS slug, 'core' AS kind, c_mktsegment AS segment FROM customer WHERE c_custkey % 4 = 0 UNION ALL
SELECT s_suppkey, 'provider', '' FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey IN (SELECT l_suppkey FROM lineitem)""")
def provider_union(t) -> DataFrame:
    core = t("customer").filter("c_custkey % 4 = 0").select(F.col("c_custkey").alias("slug"), F.lit("core").alias("kind"), F.col("c_mktsegment").alias("segment"))
    found = joins.published_providers(t("supplier").select(F.col("s_suppkey").alias("slug")), t("lineitem").select(F.col("l_suppkey").alias("slug")), core)
    return core.unionByName(found.withColumn("kind", F.lit("provider")), allowMissingColumns=True).select("slug", "kind", text.filled(F.col("segment"), "").alias("segment"))


@query("""
WITH f AS (SELECT o_custkey, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY o_custkey)
SELECT c_custkey, coalesce(first_order, -1) AS first_order, coalesce(last_order, -1) AS last_order FROM customer LEFT JOIN f ON c_custkey = o_custkey""")
def record_lookup(t) -> DataFrame:
    o = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.struct("o_orderdate", "o_orderkey").alias("at"))
    c = t("customer").select("c_custkey")
    first = joins.lookup(c, o, ["c_custkey"], "first", F.col("at")).select("c_custkey", F.coalesce("o_orderkey", F.lit(-1)).alias("first_order"))
    last = joins.lookup(c, o, ["c_custkey"], "last", F.col("at")).select("c_custkey", F.coalesce("o_orderkey", F.lit(-1)).alias("last_order"))
    return first.join(last, "c_custkey")


@query("""
SELECT 'PRICE_POSITIVE' AS "check", CAST(p_partkey AS VARCHAR) AS key FROM part WHERE NOT p_retailprice > 1000 UNION ALL SELECT 'SIZE_RANGE', CAST(p_partkey AS VARCHAR) FROM part WHERE NOT p_size BETWEEN 3 AND 48
UNION ALL SELECT 'NAME_REPEATS', p_name FROM part GROUP BY p_name HAVING count(*) > 1 UNION ALL SELECT 'UNKNOWN_REFERENCE', CAST(l_partkey AS VARCHAR) FROM (SELECT DISTINCT l_partkey FROM lineitem) WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""")
def violation_report(t) -> DataFrame:
    p = t("part")
    known = p.filter("p_size > 5").select(F.col("p_partkey").alias("l_partkey"))
    return checks.report([
        checks.violations(p, F.col("p_partkey"), {"PRICE_POSITIVE": F.col("p_retailprice") > 1000, "SIZE_RANGE": F.col("p_size").between(3, 48)}),
        checks.unique(p, ["p_name"], "NAME_REPEATS"), checks.references(t("lineitem"), known, "l_partkey"),
    ]).select("check", "key")


@query("""
WITH v AS (SELECT DISTINCT sha256(text) AS name, min(doc_id) OVER (PARTITION BY text) AS k FROM documents), r AS (SELECT doc_id, sha256(text) AS name FROM documents WHERE doc_id % 9 <> 0),
b AS (SELECT coalesce('r' || doc_id, v.name) AS key, doc_id, r.name AS claimed, v.name AS stored, k FROM r FULL JOIN (SELECT * FROM v WHERE k % 11 <> 0) v ON r.name = v.name)
SELECT 'PAYLOAD_PRESENT' AS "check", key FROM b WHERE stored IS NULL UNION ALL SELECT 'PAYLOAD_CLAIMED', key FROM b WHERE doc_id IS NULL
UNION ALL SELECT 'PAYLOAD_DIGEST', key FROM b WHERE stored IS NOT NULL AND k % 10 = 1 UNION ALL SELECT 'PAYLOAD_SIZE', key FROM b WHERE stored IS NOT NULL AND doc_id IS NOT NULL AND ((k % 10 = 1) <> (doc_id % 10 = 2))""")
def payload_integrity(t) -> DataFrame:
    """Each text is stored once; some are absent, altered by a byte, not claimed or claimed with a byte too many."""
    d = t("documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    stored = d.groupBy(F.sha2("content", 256).alias("sha256")).agg(F.min("doc_id").alias("k"), F.min("content").alias("content")).filter("k % 11 <> 0")
    altered = stored.select("sha256", F.when(F.col("k") % 10 == 1, F.concat("content", F.lit("!").cast("binary"))).otherwise(F.col("content")).alias("content"))
    receipts = d.filter("doc_id % 9 <> 0").select(F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("record_key"), F.sha2("content", 256).alias("sha256"), (F.length("content") + F.when(F.col("doc_id") % 10 == 2, 1).otherwise(0)).cast("long").alias("bytes"))
    return checks.payloads(receipts, altered).select("check", "key")


@query("""
WITH r AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 50 = 1 UNION ALL SELECT -o_orderkey - 1 FROM orders WHERE o_orderkey % 90 = 0)
SELECT 'UNKNOWN_ITEM' AS "check", CAST(k AS VARCHAR) AS key FROM (SELECT DISTINCT k FROM r) WHERE k < 0 UNION ALL SELECT 'ITEM_REPEATS', CAST(k AS VARCHAR) FROM r GROUP BY k HAVING count(*) > 1 UNION ALL SELECT 'ITEM_MISSING', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey NOT IN (SELECT k FROM r)""")
def translation_checks(t) -> DataFrame:
    o = t("orders").select(F.col("o_orderkey").alias("canonical_id"))
    k = F.col("canonical_id")
    r = o.filter(k % 3 != 0).unionByName(o.filter(k % 50 == 1)).unionByName(o.filter(k % 90 == 0).select((-k - 1).alias("canonical_id")))
    return checks.translation_response(o, r).select("check", "key")


@query("""
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, 'none') AS value, CASE WHEN c_custkey % 2 = 0 THEN 'A' WHEN c_custkey % 3 = 0 THEN 'B' ELSE 'none' END AS source FROM customer""")
def source_fallback(t) -> DataFrame:
    c = t("customer")
    a, b = c.filter("c_custkey % 2 = 0").select("c_custkey", F.col("c_name").alias("a")), c.filter("c_custkey % 3 = 0").select("c_custkey", F.col("c_mktsegment").alias("b"))
    value, source = joins.best_available({"A": F.col("a"), "B": F.col("b")})
    return c.select("c_custkey").join(a, "c_custkey", "left").join(b, "c_custkey", "left").select("c_custkey", F.coalesce(value, F.lit("none")).alias("value"), F.coalesce(source, F.lit("none")).alias("source"))


@query("""
SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END, CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END, l_linenumber, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def ranked_link(t) -> DataFrame:
    content = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    version = F.when(F.col("l_linestatus") == "O", 0).otherwise(1)
    return caps.top_per_group(t("lineitem"), ["l_orderkey"], [content, version, F.col("l_linenumber"), F.col("l_extendedprice")], 1).select("l_orderkey", "l_linenumber")


@query("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y') END AS shown, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS number, CASE WHEN regexp_matches(o_orderpriority, '^[A-Za-z]') THEN upper(left(o_orderpriority, 1)) ELSE '#' END AS letter FROM orders""")
def display_fields(t) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t("orders").select("o_orderkey", text.display_date(d, _pick(["DAY", "MONTH", "YEAR"], F.col("o_orderkey"))).alias("shown"), text.date_number(d).alias("number"), text.first_letter(F.col("o_orderpriority")).alias("letter"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 2 THEN strftime(o_orderdate, '%Y-01-01') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 4 THEN strftime(o_orderdate, '%Y-%m-01') ELSE 'none' END AS date,
  CASE o_orderkey % 6 WHEN 0 THEN 'DAY' WHEN 1 THEN 'MONTH' WHEN 2 THEN 'YEAR' WHEN 3 THEN 'DAY' WHEN 4 THEN 'MONTH' ELSE 'none' END AS precision FROM orders""")
def loose_dates(t) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    said = F.when(k == 0, F.date_format(d, "yyyy-MM-dd'T'HH")).when(k == 1, F.date_format(d, "yyyy-MM")).when(k == 2, F.date_format(d, "yyyy")).when(k == 3, F.date_format(d, "yyyy MMM d")).when(k == 4, F.date_format(d, "yyyy MMMM")).otherwise("unknown")
    p = text.parse_loose_date(said, text.strip_tags)
    return t("orders").select("o_orderkey", F.coalesce(p["date"].cast("string"), F.lit("none")).alias("date"), F.coalesce(p["precision"], F.lit("none")).alias("precision"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN 'none' ELSE '10.5555/a' || c_custkey END AS doi, CASE WHEN c_custkey % 5 = 0 THEN 'none' ELSE lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '-' || '123X' END AS issn FROM customer""")
def normal_identifiers(t) -> DataFrame:
    k = F.col("c_custkey")
    doi = F.concat(_pick(["https://doi.org/", "doi: ", " http://dx.doi.org/", ""], k), F.when(k % 4 != 3, F.concat(F.lit("10.5555/A"), k.cast("string"), F.lit(".);"))).otherwise(""))
    issn = F.concat(F.lpad((k % 10000).cast("string"), 4, "0"), F.when(k % 5 == 0, "12").otherwise(" 123x"))
    return t("customer").select("c_custkey", F.coalesce(text.normalize_doi(doi, text.strip_tags), F.lit("none")).alias("doi"), F.coalesce(text.normalize_issn(issn), F.lit("none")).alias("issn"))


@query("""
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS united, array_to_string(list_transform(list_sort(list_zip(f.at, f.kinds)), lambda x: x[2]), ',') AS appended FROM events JOIN (SELECT user_id, list(first_at) AS at, list(event_type) AS kinds FROM (SELECT user_id, event_type, min(event_id) AS first_at FROM events GROUP BY ALL) GROUP BY user_id) f USING (user_id) GROUP BY user_id, f.at, f.kinds""")
def array_unions(t) -> DataFrame:
    """Sorted distinct union, and ordered distinct union in input order; first places are found by a partial aggregate."""
    first = t("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("at"))
    rows = first.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("at", "event_type"))).alias("a"))
    kinds = F.transform("a", lambda x: x["event_type"])
    return rows.select("user_id", F.array_join(F.array_sort(kinds), ",").alias("united"), F.array_join(F.array_distinct(kinds), ",").alias("appended"))


@query("""SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_type)), '|') AS categories, coalesce(CASE WHEN list_contains(list(p_type), 'PROMO') THEN 'PROMO' END, CASE WHEN list_contains(list(p_type), 'SMALL') THEN 'SMALL' END, list_sort(list(DISTINCT p_type))[1]) AS main FROM part GROUP BY p_brand""")
def primary_category(t) -> DataFrame:
    c = t("part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("c"))
    return c.select("p_brand", F.array_join("c", "|").alias("categories"), publish.primary_category(F.col("c"), ["PROMO", "SMALL"]).alias("main"))


@query("""SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_custkey % 2 = 0 THEN 'EUROPE_PMC_PMCID' END, CASE WHEN c_custkey % 3 = 0 THEN 'PUBMED_PMID' END, CASE WHEN c_custkey % 5 = 0 THEN 'CROSSREF_DOI' END], lambda x: x IS NOT NULL), ',') AS sources, CASE WHEN c_custkey % 2 = 0 THEN 'ACQUIRED' WHEN c_custkey % 3 = 0 THEN 'NOT_FOUND' ELSE 'SKIPPED_NO_IDENTIFIER' END AS status FROM customer""")
def source_order(t) -> DataFrame:
    k = F.col("c_custkey")
    has = lambda n: F.when(k % n == 0, k.cast("string")).otherwise("")
    attempts = F.array_compact(F.array(F.when(k % 3 == 0, F.lit("NOT_FOUND")), F.when(k % 2 == 0, F.lit("ACQUIRED"))))
    return t("customer").select("c_custkey", F.array_join(publish.source_order(has(2), has(3), has(5), {"EUROPE_PMC_PMCID": "pmcid", "PUBMED_PMID": "pmid", "CROSSREF_DOI": "doi"}), ",").alias("sources"), joins.terminal_status(attempts, ("ACQUIRED", "NOT_FOUND"), "SKIPPED_NO_IDENTIFIER").alias("status"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'day__' || strftime(o_orderdate, '%Y-%m-%d') ELSE 'month__' || strftime(o_orderdate, '%Y-%m') END || '__r' || lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0') AS identity FROM orders""")
def edition_identities(t) -> DataFrame:
    d = F.to_date("o_orderdate")
    even = F.col("o_orderkey") % 2 == 0
    a, b = F.when(even, d).otherwise(F.trunc(d, "month")), F.when(even, d).otherwise(F.last_day(d))
    return t("orders").select("o_orderkey", period.edition_identity(period.period_kind(a, b), period.period_key(a, b), (F.col("o_orderkey") % 12 + 1).cast("int")).alias("identity"))


@query("""
WITH a AS (SELECT doc_id, unnest(['lang:' || lang || ':' || source, 'mod:' || doc_id % 97]) AS alias FROM documents)
SELECT alias, count(*) AS holders, min(doc_id) AS first_doc FROM a GROUP BY alias HAVING count(*) > 1""")
def shared_aliases(t) -> DataFrame:
    a = t("documents").select("doc_id", F.explode(F.array(F.concat_ws(":", F.lit("lang"), "lang", "source"), F.concat(F.lit("mod:"), (F.col("doc_id") % 97).cast("string")))).alias("alias"))
    return a.groupBy("alias").agg(F.count(F.lit(1)).alias("holders"), F.min("doc_id").alias("first_doc")).filter("holders > 1")


@query("""SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '"}') AS digest FROM documents""")
def row_digest(t) -> DataFrame:
    return t("documents").select("doc_id", text.digest_json(source=F.col("source"), lang=F.col("lang"), doc_id=F.col("doc_id")).alias("digest"))


def _by_source(t) -> DataFrame:
    tokens = text.title_tokens(F.split_part("text", F.lit("\n"), F.lit(1)), ascii_only=True)
    return t("documents").select(F.coalesce("source", F.lit("")).alias("journal_slug"), F.col("doc_id").cast("string").alias("record_key"), F.lit("FULL").alias("processing_mode"), F.col("n_chars").cast("double").alias("score"), F.lit(50.0).alias("percentile"), F.lit(0).alias("prefetch_score"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), tokens.alias("tokens"), F.coalesce("lang", F.lit("")).alias("primary_path"), "doc_id", "n_chars")


@query(f"""
WITH RECURSIVE d AS (SELECT coalesce(source, '') AS g, CAST(doc_id AS VARCHAR) AS k, CAST(n_chars AS DOUBLE) AS score, split_part(text, chr(10), 1) AS title, list_distinct({_TOKENS_SQL}) AS tok FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY score DESC, lower(title), k) AS round FROM d),
s(g, n, pos, titles) AS (
  SELECT DISTINCT g, 0, CAST(0 AS BIGINT), CAST([] AS VARCHAR[][]) FROM r
  UNION ALL
  SELECT g, n + 1, round, list_append(titles, tok) FROM (
    SELECT s.g, s.n, s.titles, r.round, r.tok, row_number() OVER (PARTITION BY s.g ORDER BY r.round) AS i FROM s JOIN r ON r.g = s.g AND r.round > s.pos
    WHERE s.n < 20 AND len(list_filter(s.titles, lambda x: len(x) > 0 AND len(r.tok) > 0 AND len(list_intersect(x, r.tok)) / len(list_distinct(list_concat(x, r.tok))) >= 0.85)) = 0
  ) WHERE i = 1),
t AS (SELECT g, pos FROM s WHERE n > 0), top AS (SELECT g, max(score) AS best FROM r GROUP BY g),
o AS (SELECT r.g, r.k, r.round, top.best, row_number() OVER (ORDER BY r.round, top.best DESC, r.g) AS ordinal FROM r JOIN t ON t.g = r.g AND t.pos = r.round JOIN top ON top.g = r.g),
last AS (SELECT round, best, g, (SELECT count(*) FROM o) AS n FROM o WHERE ordinal = (SELECT least(120, max(ordinal)) FROM o)),
m AS (SELECT r.g, r.k, r.round, o.ordinal, (SELECT count(*) FROM t WHERE t.g = r.g AND t.pos < r.round) AS held,
  (SELECT n FROM last) >= 120 AND (r.round, -top.best, r.g) > (SELECT (round, -best, g) FROM last) AS late FROM r JOIN top ON top.g = r.g LEFT JOIN o ON o.g = r.g AND o.k = r.k)
SELECT g AS journal_slug, k AS record_key, CAST(CASE WHEN late THEN 0 ELSE coalesce(ordinal, 0) END AS BIGINT) AS ordinal,
  CASE WHEN late THEN 'FULLTEXT_GLOBAL_TARGET_OR_RELATIVE_PRIORITY' WHEN ordinal IS NOT NULL THEN 'ABSTRACT_STRUCTURAL_REVIEW' WHEN held >= 20 THEN 'JOURNAL_FULLTEXT_CAP' ELSE 'NEAR_DUPLICATE_ABSTRACT_CANDIDATE' END AS reason FROM m""")
def review_selection(t) -> DataFrame:
    """Turns over sources, best first; the SQL takes one row of each source a step."""
    return select.review_selection(_by_source(t), ReviewPolicy()).withColumn("ordinal", F.coalesce("ordinal", F.lit(0)))


@query()
def first_shortlist(t) -> DataFrame:
    """The first selection over parts as records; a sequential model in the tests gives the same rows."""
    r = _routed(t)
    tokens = text.title_tokens(F.col("title_original"), ascii_only=True)
    rows = r.select(
        F.col("p_partkey").cast("string").alias("record_key"), F.col("p_brand").alias("journal_slug"), F.col("p_brand").alias("journal"), F.lit("TRIAGE").alias("processing_mode"), "route", "primary_path",
        _pick(tuple(FirstShortlistPolicy().categories), F.col("p_partkey")).alias("primary_category"), F.col("raw_score").alias("score"), (F.col("p_partkey") % 31 + 20260701).alias("publication_date"), F.col("title_original").alias("title"),
        tokens.alias("tokens"), text.topic_signature(tokens).alias("topic_signature"), (F.col("p_partkey") % 3 > 0).alias("fetchable"),
    )
    return select.first_shortlist(rows).select("record_key", "editorial_route", "ordinal", "hold_ordinal", "reason", F.array_join("blocks", "|").alias("block"))


@query("""
SELECT o_orderkey, o_orderkey & 1 > 0 AS methods, o_orderkey & 2 > 0 AS results, o_orderkey & 4 > 0 AS limitations, o_orderkey & 8 > 0 AS funding, CAST(o_orderkey % 4 AS INT) AS refs, CAST(o_orderkey % 3 AS INT) AS figures FROM orders""")
def xml_structure(t) -> DataFrame:
    """Section flags and counts, read by local names from a text with a namespace."""
    k = F.col("o_orderkey")
    part = lambda bit, title: F.when(k.bitwiseAND(bit) > 0, F.lit(f"<sec><title>{title}</title><p>x</p></sec>")).otherwise("")
    many = lambda tag, n: F.array_join(F.transform(F.when(n > 0, F.sequence(F.lit(1).cast("long"), n)).otherwise(F.array().cast("array<long>")), lambda i: F.concat(F.lit(f"<{tag} id='"), i.cast("string"), F.lit("'/>"))), "")
    xml = F.concat(F.lit("<article xmlns='urn:x'><body>"), part(1, "Materials and <i>methods</i>"), part(2, "Results"), part(4, "Limitations"), part(8, "Funding"), many("fig", k % 3), F.lit("</body><back>"), many("ref", k % 4), F.lit("</back></article>"))
    a = signals.structural_audit(F.col("xml"))
    return t("orders").select("o_orderkey", xml.alias("xml")).select("o_orderkey", a["METHODS_SECTION"].alias("methods"), a["RESULTS_SECTION"].alias("results"), a["LIMITATIONS"].alias("limitations"), a["FUNDING"].alias("funding"), a["ref_count"].alias("refs"), a["fig_count"].alias("figures"))


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'a ' || c_name || ' b' WHEN 1 THEN c_name || ' c' ELSE 'none' END AS said FROM customer""")
def machine_text(t) -> DataFrame:
    k = F.col("c_custkey")
    payload = F.when(k % 4 == 0, F.concat(F.lit("<a>a</a>\n<b>"), F.col("c_name"), F.lit("</b> b"))).otherwise(F.concat(F.col("c_name"), F.lit("  \n c ")))
    kind = _pick(["application/xml", "text/plain", "application/pdf", "image/png"], k)
    return t("customer").select("c_custkey", F.coalesce(signals.machine_text(payload, kind), F.lit("none")).alias("said"))


@query("SELECT c_custkey, c_custkey % 4 < 2 AS open FROM customer")
def open_licences(t) -> DataFrame:
    link = F.concat(_pick(["https://creativecommons.org/by/", "http://api.CreativeCommons.org:80/", "https://notcreativecommons.org/", "https://creativecommons.org.example/"], F.col("c_custkey")), F.col("c_custkey").cast("string"))
    return t("customer").select("c_custkey", text.open_licence_host(link).alias("open"))


@query("""SELECT c_custkey, CAST(CASE WHEN c_custkey % 11 = 0 THEN 0.75 WHEN c_custkey % 101 >= 90 THEN 1.0 WHEN c_custkey % 101 >= 75 THEN 0.9 WHEN c_custkey % 101 >= 50 THEN 0.8 ELSE 0.7 END AS DOUBLE) AS rate FROM customer""")
def capture_bands(t) -> DataFrame:
    from recordloom.plans.policy import ShortlistPolicy

    k = F.col("c_custkey")
    return t("customer").select("c_custkey", select.capture((k % 101).cast("double"), k % 11 == 0, ShortlistPolicy()).cast("double").alias("rate"))


@query("""SELECT c_custkey, c_name FROM customer WHERE c_nationkey % 2 = 0 AND c_mktsegment = 'BUILDING' AND c_acctbal > 0""")
def registry_filter(t) -> DataFrame:
    from recordloom.sources.landed import registry_filter as chosen

    j = t("customer").select(
        "c_custkey", "c_name", F.col("c_name").alias("journal"), F.col("c_custkey").alias("slug"), F.when(F.col("c_nationkey") % 2 == 0, "ACTIVE").otherwise("PAUSED").alias("status"),
        F.array("c_mktsegment").alias("categories"), F.lit("X").alias("publisher"), (F.col("c_acctbal") > 0).alias("enabled"), F.lit("FULL").alias("processing_mode"),
    )
    return chosen(j, status="ACTIVE", category="BUILDING", publisher="x", mode="FULL").select("c_custkey", "c_name")


@query("""SELECT c_custkey, CAST(least(c_custkey % 900, CASE c_custkey % 4 WHEN 3 THEN 0 ELSE 500 END) AS INT) AS budget, CASE WHEN c_custkey % 4 = 3 THEN 'NONE' WHEN c_custkey % 900 > 250 THEN 'LIMITED' ELSE 'INLINE_ALL' END AS projection, c_custkey % 4 = 3 AS suspended FROM customer""")
def source_budget(t) -> DataFrame:
    from recordloom.plans.policy import MODES

    k = F.col("c_custkey")
    mode, n = _pick(list(MODES), k), (k % 900).cast("int")
    shown, _, _ = caps.projection(n.cast("long"), F.when(mode == "SUSPENDED", 0).otherwise(250))
    return t("customer").select("c_custkey", caps.source_budget(n, mode).alias("budget"), shown.alias("projection"), (~caps.load_allowed(mode)[0]).alias("suspended"))


@query("""
SELECT p_partkey, p_name FROM part WHERE contains(lower(concat_ws(' ', p_name, p_type)), 'st') AND p_size >= 10 ORDER BY p_retailprice DESC, p_partkey LIMIT 50 OFFSET 20""")
def indexed_page(t) -> DataFrame:
    """The page of ``filter_page`` with a needle too short for trigrams: the index's texts are looked through."""
    return _indexed(t, "ST", {"p_size": 10})


@query("""
SELECT p_partkey, p_name FROM part WHERE contains(lower(concat_ws(' ', p_name, p_type)), 'g econ') ORDER BY p_retailprice DESC, p_partkey LIMIT 50""")
def indexed_search(t) -> DataFrame:
    """A page of what holds a needle, by posting lists and a look at the candidates alone."""
    return _indexed(t, "g ECON", {}, offset=0)


def _indexed(t, needle: str, least: dict, offset: int = 20) -> DataFrame:
    part = t("part")
    with scratch(part.sparkSession, "index") as folder:
        textindex.build(part, ["p_name", "p_type"], ["p_partkey"], folder)
        found = textindex.search(part.sparkSession, folder, needle)
        return cut(publish.filter_page(found, least=least, order=[F.desc("p_retailprice"), F.col("p_partkey")], offset=offset, limit=50).select("p_partkey", "p_name"))


_WAVES_SQL = """
WITH p AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) AS o, c_custkey % 2 = 0 AS pm, c_custkey % 3 <> 1 AS doi FROM customer),
a AS (SELECT *, pm AS ask1 FROM p), b AS (SELECT *, ask1 AND k % 5 < 2 AS got1 FROM a),
c AS (SELECT *, NOT got1 AND doi AS able2 FROM b), d AS (SELECT *, able2 AND sum(CASE WHEN able2 THEN 1 ELSE 0 END) OVER (ORDER BY o) <= 40 AS ask2 FROM c),
e AS (SELECT *, ask2 AND k % 7 < 3 AS got2, ask2 AND k % 7 = 3 AS failed2 FROM d)
"""


@query(_WAVES_SQL + """
SELECT k AS record_key, CASE WHEN got1 OR got2 THEN 'ABSTRACT_ACQUIRED' WHEN NOT ask1 AND NOT able2 THEN 'SKIPPED_NO_IDENTIFIER' WHEN failed2 THEN 'ACQUISITION_INCONCLUSIVE' ELSE 'RECORD_NOT_FOUND' END AS status, CASE WHEN got1 THEN 'ONE' WHEN got2 THEN 'TWO' END AS source FROM e""")
def fallback_receipts(t) -> DataFrame:
    """Customers as a plan over two sources, the second with a budget."""
    return _waves(t)[0].select("record_key", "status", "source")


@query(_WAVES_SQL + """
SELECT 1 AS wave, 'ONE' AS source, count(*) FILTER (ask1) AS asked, count(*) FILTER (got1) AS found, CAST(0 AS BIGINT) AS deferred FROM e UNION ALL SELECT 2, 'TWO', count(*) FILTER (ask2), count(*) FILTER (got2), count(*) FILTER (able2 AND NOT ask2) FROM e""")
def fallback_requests(t) -> DataFrame:
    """How many requests each wave cost."""
    return waves.requests(_waves(t)[1])


def _waves(t) -> tuple[DataFrame, DataFrame]:
    k = F.col("record_key")
    plan = t("customer").select(F.col("c_custkey").alias("record_key"), F.col("c_custkey").alias("ordinal"), F.when(F.col("c_custkey") % 2 == 0, "pm").alias("pmid"), F.when(F.col("c_custkey") % 3 != 1, "10.5/x").alias("doi"))
    one = waves.Source("ONE", F.col("pmid").isNotNull(), lambda asked: asked.filter(k % 5 < 2).select("record_key", F.lit("FOUND").alias("status"), F.lit("text").alias("payload")))
    two = waves.Source("TWO", F.col("doi").isNotNull(), lambda asked: asked.filter(k % 7 <= 3).select("record_key", F.when(k % 7 < 3, "FOUND").otherwise("FAILED").alias("status"), F.lit("text").alias("payload")), budget=40)
    return waves.fetch(plan, [one, two], waves.ABSTRACT_STATES, "SKIPPED_NO_IDENTIFIER")


@query("""
WITH x AS (SELECT l_orderkey, 'u' || l_partkey || '-' || l_linenumber AS url, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 2 ELSE 3 END AS r, CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS v FROM lineitem WHERE l_linenumber <> 4)
SELECT l_orderkey AS record_key, min_by(url, (r, v, url)) AS url, CAST(min_by(r, (r, v, url)) AS INT) AS content FROM x GROUP BY l_orderkey""")
def best_links(t) -> DataFrame:
    """One full-text link an order: XML before text before PDF, the version of record first; other types are none."""
    flag = F.col("l_returnflag")
    links = t("lineitem").select(F.col("l_orderkey").alias("record_key"), F.concat(F.lit("u"), "l_partkey", F.lit("-"), "l_linenumber").alias("url"), F.when(F.col("l_linenumber") == 4, "text/html").when(flag == "A", "TEXT/xml").when(flag == "N", "text/plain").otherwise("application/pdf").alias("content_type"), F.when(F.col("l_linestatus") == "O", "VOR").otherwise("am").alias("content_version"))
    rank = F.when(F.lower("content_type") == "text/xml", 0).when(F.col("content_type") == "text/plain", 2).otherwise(3)
    return waves.best_links(links).select("record_key", "url", rank.alias("content"))


@query("""SELECT p_partkey, 'BIBLIOGRAPHIC_METADATA' AS acquisition_level, FALSE AS full_text_requested, FALSE AS full_text_fetched, FALSE AS evidence_evaluated FROM part""")
def provenance_flags(t) -> DataFrame:
    """Every record with the constant flags of what was not done."""
    return caps.with_provenance(t("part").select("p_partkey"))
