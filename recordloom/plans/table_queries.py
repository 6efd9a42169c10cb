"""The operators applied to the driver's tables, each with the SQL of its result.

Every query runs over its whole tables. Columns that a policy needs and the
tables lack are derived from keys, in the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.functions import period, text
from recordloom.functions.rules import first_match, matched, weighted_sum
from recordloom.operators import caps, classify, identity, incremental, joins, merge, orders, publish, rank, select
from recordloom.plans.lineage import cut, scratch
from recordloom.plans.policy import ShortlistPolicy, TriagePolicy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


EVENT_POLICY = TriagePolicy(saturation_matches=10, saturation_prevalence=0.2, saturation_paths=("click", "view", "purchase", "login", "error", "search", "signup"))


def _event_records(t) -> DataFrame:
    e = t("events")
    base = F.when(F.col("event_type").rlike("(?i)^(purchase|signup)"), 80).when(F.col("event_type").rlike("(?i)^(click|search)"), 70).otherwise(50)
    bonus = F.when(F.col("value") >= 50, 6).when(F.col("value") >= 20, 2).otherwise(0)
    return e.select("event_id", "user_id", "event_type", F.array("event_type").alias("paths"), F.least(F.lit(100), base + bonus).alias("score"))


_EVENT_SQL = """
WITH r AS (
  SELECT event_id, user_id, event_type, least(100, CASE WHEN regexp_matches(event_type, '(?i)^(purchase|signup)') THEN 80 WHEN regexp_matches(event_type, '(?i)^(click|search)') THEN 70 ELSE 50 END
    + CASE WHEN value >= 50 THEN 6 WHEN value >= 20 THEN 2 ELSE 0 END) AS raw FROM events
), s AS (
  SELECT *, count(*) OVER (PARTITION BY user_id) AS group_count, count(*) OVER (PARTITION BY user_id, event_type) AS match_count FROM r
), p AS (
  SELECT *, event_type IN ('click', 'view', 'purchase', 'login', 'error', 'search', 'signup') AND match_count >= 10 AND match_count / group_count >= 0.2 AS saturated FROM s
), q AS (
  SELECT *, CASE WHEN saturated THEN greatest(0, raw - 12) ELSE raw END AS score FROM p
)
"""


@query(_EVENT_SQL + """
, c AS (SELECT *, CASE WHEN score >= 66 THEN 'FETCH_CANDIDATE' WHEN score >= 50 THEN 'RESERVE' ELSE 'CATALOG_ONLY' END AS route0 FROM q),
x AS (SELECT *, route0 = 'FETCH_CANDIDATE' AND score >= 84 AS exceptional, route0 = 'FETCH_CANDIDATE' AND score < 84 AS regular FROM c),
y AS (SELECT *, row_number() OVER (PARTITION BY user_id, regular ORDER BY score DESC, event_id) AS place, greatest(0, 20 - sum(exceptional::int) OVER (PARTITION BY user_id)) AS room FROM x),
z AS (SELECT user_id, saturated, CASE WHEN regular AND place > room THEN 'RESERVE' ELSE route0 END AS route, regular AND place > room AS demoted FROM y)
SELECT user_id, count(*) AS total, count(*) FILTER (route = 'FETCH_CANDIDATE') AS fetch_candidate, count(*) FILTER (route = 'RESERVE') AS reserve, count(*) FILTER (route = 'CATALOG_ONLY') AS catalog_only,
  count(*) FILTER (demoted) AS demoted, count(*) FILTER (saturated) AS saturated FROM z GROUP BY user_id
""")
def triage_topk(t) -> DataFrame:
    """Flagship: classify, score, saturate, route, cap with bypass, summarise."""
    p = EVENT_POLICY
    s = classify.saturate(_event_records(t), "user_id", "paths", "event_type", policy=p)
    routed = s.withColumn("route", F.when(F.col("score") >= 66, "FETCH_CANDIDATE").when(F.col("score") >= 50, "RESERVE").otherwise("CATALOG_ONLY"))
    capped = caps.soft_cap(routed, "user_id", [F.desc("score"), F.col("event_id")], F.lit(20), ["event_id"], 20, bypass=84)
    return capped.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total"), *(F.count_if(F.col("route") == r).alias(r.lower()) for r in ("FETCH_CANDIDATE", "RESERVE", "CATALOG_ONLY")),
        F.count_if("demoted").alias("demoted"), F.count_if("saturated").alias("saturated"),
    )


@query(_EVENT_SQL + "SELECT event_id, group_count, match_count, round(match_count / group_count, 6) AS prevalence, saturated, score FROM q")
def saturation(t) -> DataFrame:
    return classify.saturate(_event_records(t), "user_id", "paths", "event_type", policy=EVENT_POLICY).select("event_id", "group_count", "match_count", "prevalence", "saturated", "score")


@query("""
SELECT o_custkey, month, o_orderkey, revision_count FROM (
  SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, count(*) OVER w AS revision_count, row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey DESC) AS rn
  FROM orders WINDOW w AS (PARTITION BY o_custkey, strftime(o_orderdate, '%Y-%m'))) WHERE rn = 1""")
def latest_revision(t) -> DataFrame:
    o = t("orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey")
    return rank.latest(o, ["o_custkey", "month"], [F.desc("o_orderkey")])


@query("""
WITH p AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 3 AS k FROM orders),
i AS (SELECT o_orderkey, CASE k WHEN 0 THEN d WHEN 1 THEN date_trunc('month', d)::DATE ELSE date_trunc('year', d)::DATE END AS obs_start,
  CASE k WHEN 0 THEN d WHEN 1 THEN last_day(d) ELSE (date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE END AS obs_end FROM p)
SELECT o_orderkey, strftime(obs_start, '%Y-%m-%d') AS obs_start, strftime(obs_end, '%Y-%m-%d') AS obs_end FROM i WHERE obs_start <= DATE '1996-08-16' AND obs_end >= DATE '1996-08-10'""")
def period_overlap(t) -> DataFrame:
    precision = F.element_at(F.array(F.lit("DAY"), F.lit("MONTH"), F.lit("YEAR")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    o = t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), precision.alias("p"))
    a, b = period.interval(F.col("d"), F.col("p"))
    return period.in_period(o, "d", "p", "1996-08-10", "1996-08-16").select("o_orderkey", a.cast("string").alias("obs_start"), b.cast("string").alias("obs_end"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'doi:10.1/' || c_custkey WHEN c_custkey % 4 = 1 THEN 'pmid:' || c_custkey WHEN c_custkey % 4 = 2 THEN 'pmcid:PMC' || c_custkey ELSE 'fingerprint:' || c_name || '|' || c_nationkey END AS canonical_id,
  concat_ws('|', c_mktsegment, c_nationkey, 1, c_custkey) AS record_key FROM customer""")
def canonical_id(t) -> DataFrame:
    k = F.col("c_custkey")
    tried = {n: F.when(k % 4 == i, F.concat(F.lit(pre), k.cast("string"))).otherwise("") for i, (n, pre) in enumerate((("doi", "10.1/"), ("pmid", ""), ("pmcid", "PMC")))}
    return t("customer").select("c_custkey", identity.canonical_id(tried, F.concat_ws("|", "c_name", F.col("c_nationkey").cast("string"))).alias("canonical_id"), identity.record_key(F.col("c_mktsegment"), F.col("c_nationkey"), F.lit(1), k).alias("record_key"))


_PART_RULES = {"metal": "(?i)(steel|brass|copper|tin|nickel)", "finish": "(?i)(polished|burnished|plated|brushed|anodized)", "size": "(?i)(small|medium|large|economy|promo|standard)"}


@query("""
SELECT p_partkey, role, paths, CASE WHEN p_size < 5 THEN 'INTEGRITY_REVIEW' WHEN role = 'size' THEN 'CATALOG_ONLY' WHEN p_size >= 30 THEN 'FETCH_CANDIDATE' WHEN p_size >= 15 THEN 'RESERVE' ELSE 'CATALOG_ONLY' END AS route FROM (
  SELECT p_partkey, p_size, CASE WHEN regexp_matches(s, '(?i)(steel|brass|copper|tin|nickel)') THEN 'metal' WHEN regexp_matches(s, '(?i)(polished|burnished|plated|brushed|anodized)') THEN 'finish' WHEN regexp_matches(s, '(?i)(small|medium|large|economy|promo|standard)') THEN 'size' ELSE 'primary' END AS role,
    array_to_string(list_filter([CASE WHEN regexp_matches(s, '(?i)(steel|brass|copper|tin|nickel)') THEN 'metal' END, CASE WHEN regexp_matches(s, '(?i)(polished|burnished|plated|brushed|anodized)') THEN 'finish' END, CASE WHEN regexp_matches(s, '(?i)(small|medium|large|economy|promo|standard)') THEN 'size' END], lambda x: x IS NOT NULL), ',') AS paths
  FROM (SELECT *, p_name || ' ' || p_type AS s FROM part))""")
def role_route(t) -> DataFrame:
    s = F.concat_ws(" ", "p_name", "p_type")
    r = t("part").select("p_partkey", "p_size", first_match(s, _PART_RULES, "primary").alias("role"), F.array_join(matched(s, _PART_RULES), ",").alias("paths"))
    chain = F.when(F.col("p_size") < 5, "INTEGRITY_REVIEW").when(F.col("role") == "size", "CATALOG_ONLY").when(F.col("p_size") >= 30, "FETCH_CANDIDATE").when(F.col("p_size") >= 15, "RESERVE").otherwise("CATALOG_ONLY")
    return r.select("p_partkey", "role", "paths", chain.alias("route"))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS INT) AS score, CASE WHEN l_quantity >= 40 THEN 'FETCH_CANDIDATE' WHEN l_quantity >= 20 THEN 'RESERVE' ELSE 'CATALOG_ONLY' END AS route0 FROM lineitem),
y AS (SELECT *, route0 = 'FETCH_CANDIDATE' AND score < 49 AS regular, row_number() OVER (PARTITION BY l_suppkey, route0 = 'FETCH_CANDIDATE' AND score < 49 ORDER BY score DESC, l_orderkey, l_linenumber) AS place,
  greatest(0, 30 - sum((route0 = 'FETCH_CANDIDATE' AND score >= 49)::int) OVER (PARTITION BY l_suppkey)) AS room FROM r)
SELECT l_suppkey, route, demoted, count(*) AS n, CAST(sum(score) AS BIGINT) AS total FROM (SELECT *, regular AND place > room AS demoted, CASE WHEN regular AND place > room THEN 'RESERVE' ELSE route0 END AS route FROM y) GROUP BY ALL""")
def soft_cap_bypass(t) -> DataFrame:
    q = F.col("l_quantity")
    r = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", q.cast("int").alias("score"), F.when(q >= 40, "FETCH_CANDIDATE").when(q >= 20, "RESERVE").otherwise("CATALOG_ONLY").alias("route"))
    capped = caps.soft_cap(r, "l_suppkey", [F.desc("score"), F.col("l_orderkey"), F.col("l_linenumber")], F.lit(30), ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"], 30, bypass=49)
    return capped.groupBy("l_suppkey", "route", "demoted").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))


@query("""
SELECT l_suppkey, l_orderkey, l_linenumber, CAST(rank_in_group AS INT) AS rank_in_group FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank_in_group FROM lineitem)
WHERE rank_in_group <= CASE WHEN l_suppkey % 2 = 0 THEN 50 ELSE 25 END""")
def reserve_cap(t) -> DataFrame:
    cap = F.when(F.col("l_suppkey") % 2 == 0, 50).otherwise(25)
    return caps.top_per_group(t("lineitem"), ["l_suppkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], cap, most=50).select("l_suppkey", "l_orderkey", "l_linenumber", "rank_in_group")


@query("""
SELECT p.p_partkey, round(100.0 * (count(q.p_partkey) FILTER (q.p_retailprice < p.p_retailprice) + 0.5 * count(q.p_partkey) FILTER (q.p_retailprice = p.p_retailprice)) / count(q.p_partkey), 6) AS percentile
FROM part p JOIN part q ON p.p_brand = q.p_brand AND p.p_type = q.p_type GROUP BY p.p_partkey""")
def midrank(t) -> DataFrame:
    return rank.midrank(t("part"), ["p_brand", "p_type"], "p_retailprice").select("p_partkey", "percentile")


@query("""
WITH k AS (SELECT p_brand AS slug, p_type AS category, 'JIF' AS kind, p_retailprice AS value FROM part WHERE p_size <= 25 UNION ALL SELECT p_brand, p_type, 'CITESCORE', p_size FROM part WHERE p_size > 25),
r AS (SELECT a.slug, a.category, a.kind, a.value, round(100.0 * (count(*) FILTER (b.value < a.value) + 0.5 * count(*) FILTER (b.value = a.value)) / count(*), 6) AS p
  FROM (SELECT *, row_number() OVER () AS i FROM k) a JOIN k b ON a.category = b.category AND a.kind = b.kind GROUP BY a.i, a.slug, a.category, a.kind, a.value),
m AS (SELECT slug, kind, avg(p) AS p FROM r GROUP BY slug, kind), best AS (SELECT slug, min_by(p, CASE kind WHEN 'JIF' THEN 1 ELSE 2 END) AS p FROM m GROUP BY slug)
SELECT slug, round(p, 4) AS percentile, false AS unknown_metric FROM best UNION ALL SELECT 'Brand#none', 50.0, true""")
def impact_prior(t) -> DataFrame:
    p = t("part")
    k = p.filter("p_size <= 25").select(F.col("p_brand").alias("slug"), F.col("p_type").alias("category"), F.lit("JIF").alias("kind"), F.col("p_retailprice").alias("value"))
    k = k.unionByName(p.filter("p_size > 25").select(F.col("p_brand").alias("slug"), F.col("p_type").alias("category"), F.lit("CITESCORE").alias("kind"), F.col("p_size").cast("double").alias("value")))
    journals = p.select(F.col("p_brand").alias("slug")).unionByName(p.sparkSession.range(1).select(F.lit("Brand#none").alias("slug")))
    return rank.impact_priors(k, journals).select("slug", F.round("registry_category_percentile", 4).alias("percentile"), "unknown_metric")


@query("""
WITH r AS (SELECT p_partkey, p_brand, p_type, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part)
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY rn, p_type) AS INT) AS turn FROM r""")
def interleave(t) -> DataFrame:
    return rank.interleave(t("part"), ["p_brand"], "p_type", [F.desc("p_retailprice"), F.col("p_partkey")], F.col("p_type")).select("p_partkey", "turn")


@query("""
WITH r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn, max(o_totalprice) OVER (PARTITION BY o_orderpriority) AS best, o_orderpriority FROM orders)
SELECT o_orderkey, row_number() OVER (ORDER BY rn, best DESC, o_orderpriority) AS turn FROM r""")
def path_round_robin(t) -> DataFrame:
    r = rank.round_robin(t("orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_orderpriority", [F.desc("o_totalprice"), F.col("o_orderkey")], F.col("o_totalprice"))
    return orders.numbered(r, ["round", F.desc("lane_best"), "o_orderpriority"], "turn").select("o_orderkey", "turn")


@query("""
WITH c AS (SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2 AS within FROM orders),
n AS (SELECT *, CASE WHEN within THEN row_number() OVER (PARTITION BY within ORDER BY o_totalprice DESC, o_orderkey) END AS k FROM c)
SELECT o_orderkey, CAST(CASE WHEN within AND k <= 36 THEN k ELSE 0 END AS INT) AS ordinal, CASE WHEN within AND k <= 36 THEN 'SELECTED' WHEN NOT within THEN 'GROUP_CAP' ELSE 'GLOBAL_TARGET' END AS reason FROM n""")
def featured_cap(t) -> DataFrame:
    return caps.featured(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", [F.desc("o_totalprice"), F.col("o_orderkey")], 2, 36, ["o_orderkey"]).select("o_orderkey", F.coalesce("ordinal", F.lit(0)).alias("ordinal"), "reason")


@query("""
WITH n AS (SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, CASE WHEN total > 500 THEN 'TRIAGE' ELSE 'FULL' END AS mode, least(total, CASE WHEN total > 500 THEN 250 ELSE 1000 END) AS shown, total - least(total, CASE WHEN total > 500 THEN 250 ELSE 1000 END) AS omitted FROM n""")
def volume_projection(t) -> DataFrame:
    from recordloom.plans.policy import ProcessingPolicy

    n = t("lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("total"))
    mode, limit = caps.volume_guard(F.lit("FULL"), F.col("total"), ProcessingPolicy(triage_threshold=500))
    shown = F.least(F.col("total"), limit.cast("long"))
    return n.select("l_suppkey", mode.alias("mode"), shown.alias("shown"), (F.col("total") - shown).alias("omitted"))


@query("""
SELECT l_suppkey, l_orderkey, l_linenumber, total, greatest(0, total - 40) AS omitted FROM (SELECT *, count(*) OVER (PARTITION BY l_suppkey) AS total, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn <= 40""")
def bounded_index(t) -> DataFrame:
    return caps.volume_projection(t("lineitem"), ["l_suppkey"], [F.desc("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")], 40).select("l_suppkey", "l_orderkey", "l_linenumber", "total", "omitted")


def _document_aliases(t) -> DataFrame:
    """A document's aliases: its whole text, and its source with its whole title (the first line) where that says anything."""
    title = text.normalize_title_key(F.substring_index("text", "\n", 1), ascii_only=True)
    # Columns of their own, so that each is worked out once however often it is named.
    docs = t("documents").select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("digest"), title.alias("title"))
    docs = docs.withColumn("named", F.concat(F.lit("title:"), text.blank_to_null(F.col("title")), F.lit("|"), F.coalesce("source", F.lit(""))))
    return docs.select("doc_id", "lang", "source", "n_chars", F.array_compact(F.array(F.concat(F.lit("text:"), "digest"), identity.short_alias(F.col("named")))).alias("aliases"))


_ALIAS_SQL = """
WITH RECURSIVE h AS (SELECT doc_id, lang, source, text, regexp_replace(lower(trim(regexp_replace(regexp_replace(split_part(text, chr(10), 1), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))), '[^a-z0-9]+', '', 'g') AS title FROM documents),
a AS (SELECT doc_id, 'text:' || sha256(text) AS alias FROM h UNION SELECT doc_id, 'title:' || title || '|' || coalesce(source, '') FROM h WHERE title <> ''),
e AS (SELECT x.doc_id AS a, y.doc_id AS b FROM a x JOIN (SELECT alias, min(doc_id) AS doc_id FROM a GROUP BY alias) y USING (alias) WHERE x.doc_id <> y.doc_id),
ee AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, ee.b FROM r JOIN ee ON r.b = ee.a),
c AS (SELECT a AS doc_id, min(b) AS component FROM r GROUP BY a)
"""


@query(_ALIAS_SQL + "SELECT doc_id, component FROM c")
def dedup_components(t) -> DataFrame:
    return identity.components(_document_aliases(t), "doc_id", "aliases").select("doc_id", "component")


@query(_ALIAS_SQL + "SELECT doc_id, component FROM c")
def incremental_components(t) -> DataFrame:
    """The same components from a store that takes the documents in three batches, the longest first."""
    # Texts are read once; the batches are told apart by rows of a few hundred bytes.
    rows = cut(_document_aliases(t).select("doc_id", "n_chars", "aliases"))
    with scratch(rows.sparkSession, "components") as folder:
        store = incremental.Components(rows.sparkSession, folder, buckets=8)
        for n, part in enumerate((F.col("n_chars") > 2000, F.col("n_chars").between(500, 2000), F.coalesce(F.col("n_chars") < 500, F.lit(True)))):
            store.add(rows.filter(part), n, "doc_id")
        return cut(store.labels().select(F.col("record").alias("doc_id"), "component"))


@query(_ALIAS_SQL + """
, m AS (SELECT component, doc_id, lang, source, CAST(doc_id % 7 AS INT) AS n, DATE '2026-01-01' + CAST(doc_id % 40 AS INT) AS d FROM c JOIN documents USING (doc_id))
SELECT component, CAST(count(*) AS INT) AS members, min_by(doc_id, doc_id) AS idx, strftime(min(d), '%Y-%m-%d') AS publication_date, coalesce(min_by('10.5/' || doc_id, doc_id) FILTER (doc_id % 3 = 0), '') AS doi,
  array_to_string(list_sort(list_distinct(list(coalesce(lang, '')))), ',') AS issns, array_to_string(list_sort(list_distinct(list('u' || doc_id % 5))), ',') AS urls, CAST(max(n) AS INT) AS authors, min_by(doc_id, (-n, doc_id)) AS authors_of FROM m GROUP BY component""")
def survivor_merge(t) -> DataFrame:
    """Each component folded in input order: first scalars, the longest authors, united lists, the earliest of equally fine dates."""
    k = F.col("doc_id")
    author = F.transform(F.array_repeat(k.cast("string"), (k % 7).cast("int")), lambda x, i: F.concat(x, F.lit("-"), i.cast("string")))
    none = {c: F.lit(None).cast("string").alias(c) for c in identity.FIRST_SCALARS if c != "doi"}
    docs = t("documents").select(
        k.alias("idx"), F.date_add(F.lit("2026-01-01").cast("date"), (k % 40).cast("int")).alias("publication_date"), F.lit("DAY").alias("publication_date_precision"), author.alias("authors"),
        F.array(F.coalesce("lang", F.lit(""))).alias("issns"), F.array(F.concat(F.lit("u"), (k % 5).cast("string"))).alias("urls"), F.array(F.struct(F.lit("s").alias("source"), k.cast("string").alias("source_id"))).alias("source_records"),
        F.when(k % 3 == 0, F.concat(F.lit("10.5/"), k.cast("string"))).otherwise("").alias("doi"), *none.values(),
    )
    parts = identity.components(_document_aliases(t).withColumnRenamed("doc_id", "idx"), "idx", "aliases")
    made = identity.merge_survivors(docs.join(parts, "idx"))
    owner = F.coalesce(F.split_part(F.try_element_at("authors", F.lit(1)), F.lit("-"), F.lit(1)).cast("long"), F.col("idx"))
    return made.select("component", "members", "idx", F.date_format("publication_date", "yyyy-MM-dd").alias("publication_date"), F.coalesce("doi", F.lit("")).alias("doi"), F.array_join("issns", ",").alias("issns"), F.array_join("urls", ",").alias("urls"), F.size("authors").alias("authors"), owner.alias("authors_of"))


@query("SELECT source, count(DISTINCT sha256(text)) AS n FROM documents WHERE source IS NOT NULL GROUP BY source")
def ids_by_source(t) -> DataFrame:
    d = t("documents").filter("source is not null").select(F.sha2("text", 256).alias("canonical_id"), F.array(F.struct("source")).alias("source_records"))
    return identity.counts_by_source(d)


@query("SELECT source, coalesce(nullif(lang, ''), 'unspecified') AS lang, count(*) AS n, count(DISTINCT doc_id) AS ids FROM documents GROUP BY ALL")
def source_counts(t) -> DataFrame:
    return t("documents").groupBy("source", text.filled(F.col("lang"), "unspecified").alias("lang")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"))


@query("""
WITH s AS (SELECT user_id, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'search' THEN 'PARTIAL' WHEN 'view' THEN 'PARTIAL' ELSE 'SUCCESS' END AS status, value FROM events)
SELECT user_id, CASE WHEN bool_and(status = 'FAILED') THEN 'SOURCE_ACCESS_GAP' WHEN bool_or(status IN ('FAILED', 'PARTIAL')) THEN 'PARTIAL_SOURCE_COVERAGE' WHEN max(value) > 0 THEN 'COMPLETE' ELSE 'NO_MATCHING_ARTICLES' END AS run_status FROM s GROUP BY user_id""")
def run_status(t) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type").isin("search", "view"), "PARTIAL").otherwise("SUCCESS")
    return publish.run_status(t("events").withColumn("status", status), ["user_id"], "status", F.col("value"))


@query("""
WITH b AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_orderkey % 5 = 0),
d AS (SELECT o_orderkey, o_orderpriority AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT coalesce(b.o_orderkey, d.o_orderkey) AS o_orderkey, coalesce(b.o_orderstatus, d.o_orderstatus) AS o_orderstatus, round(coalesce(b.o_totalprice, d.o_totalprice), 2) AS o_totalprice,
  CASE WHEN d.o_orderkey IS NULL THEN 'BASE' WHEN b.o_orderkey IS NULL THEN 'DELTA' ELSE 'BOTH' END AS origin FROM b FULL JOIN d USING (o_orderkey)""")
def delta_merge(t) -> DataFrame:
    o = t("orders")
    late = F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp")
    base = o.filter(~late | (F.col("o_orderkey") % 5 == 0)).select("o_orderkey", "o_orderstatus", "o_totalprice")
    delta = o.filter(late).select("o_orderkey", F.col("o_orderpriority").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return merge.merge_delta(base, delta, "o_orderkey").withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("""
WITH b AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_orderkey % 5 = 0), d AS (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT (SELECT count(*) FROM b) AS base_count, (SELECT count(*) FROM d) AS delta_count, (SELECT count(*) FROM d ANTI JOIN b USING (o_orderkey)) AS added_count, (SELECT count(*) FROM d SEMI JOIN b USING (o_orderkey)) AS deduplicated_count, (SELECT count(*) FROM (SELECT * FROM b UNION SELECT * FROM d)) AS result_count""")
def delta_counts(t) -> DataFrame:
    o = t("orders")
    late = F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp")
    base, delta = o.filter(~late | (F.col("o_orderkey") % 5 == 0)).select("o_orderkey"), o.filter(late).select("o_orderkey")
    return merge.merge_counts(merge.merge_delta(base, delta, "o_orderkey"), delta)


@query("""
SELECT 'with_orders' AS kind, c_custkey AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'without_orders', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'unlabelled', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def semi_anti(t) -> DataFrame:
    c, o = t("customer").select("c_custkey"), t("orders").select(F.col("o_custkey").alias("c_custkey"))
    parts = [("with_orders", joins.matching(c, o, ["c_custkey"])), ("without_orders", joins.missing(c, o, ["c_custkey"])), ("unlabelled", joins.missing(t("documents").select("doc_id"), t("labels"), ["doc_id"]))]
    made = [d.select(F.lit(k).alias("kind"), F.col(d.columns[0]).alias("id")) for k, d in parts]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query("""
SELECT DISTINCT s_suppkey, c_custkey FROM supplier JOIN customer ON (CAST(floor(s_acctbal / 10) AS BIGINT) = CAST(floor(c_acctbal / 10) AS BIGINT)) OR (s_suppkey = c_custkey)""")
def or_join(t) -> DataFrame:
    s = t("supplier").select("s_suppkey", F.floor(F.col("s_acctbal") / 10).alias("s_bucket"))
    c = t("customer").select("c_custkey", F.floor(F.col("c_acctbal") / 10).alias("c_bucket"))
    return joins.either_key(s, c, [("s_bucket", "c_bucket"), ("s_suppkey", "c_custkey")], "s_suppkey", "c_custkey")


@query("""
SELECT source, count(*) AS n, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs, count(DISTINCT lang) AS n_lang FROM documents GROUP BY source""")
def facets(t) -> DataFrame:
    return publish.facets(t("documents"), ["source"], ["lang"]).select("source", "n", F.array_join("lang_values", ",").alias("langs"), "n_lang")


@query("""
SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source""")
def facet_counts(t) -> DataFrame:
    return publish.counts(t("documents"), ["lang", "source"])


_STOPS = ",".join(f"'{w}'" for w in text.TITLE_STOP_WORDS)
_TOKENS_SQL = f"list_filter(regexp_extract_all(lower(split_part(text, chr(10), 1)), '[A-Za-z0-9]+'), lambda x: length(x) > 2 AND x NOT IN ({_STOPS}))"


@query(f"""
SELECT doc_id, CAST(len(w) AS INT) AS n_tokens, coalesce(nullif(array_to_string(list_transform(list_filter(list_zip(w, range(len(w))), lambda x: list_position(w, x[1]) = x[2] + 1)[1:4], lambda x: x[1]), '|'), ''), 'untitled') AS signature FROM (SELECT doc_id, {_TOKENS_SQL} AS w FROM documents)""")
def tokens_signature(t) -> DataFrame:
    """Tokens of a document's title, its first line."""
    tokens = text.title_tokens(F.split_part("text", F.lit("\n"), F.lit(1)), ascii_only=True)
    return t("documents").select("doc_id", F.size(tokens).alias("n_tokens"), text.topic_signature(tokens).alias("signature"))


@query(f"""
WITH w AS (SELECT doc_id, list_distinct({_TOKENS_SQL}) AS w FROM documents), b AS (SELECT doc_id, w, w[1] AS k FROM (SELECT doc_id, list_sort(w) AS w FROM w) WHERE len(w) > 0),
f AS (SELECT k, min(doc_id) AS rep FROM b GROUP BY k)
SELECT b.doc_id, f.rep, round(len(list_intersect(b.w, r.w)) / len(list_distinct(list_concat(b.w, r.w))), 6) AS jaccard FROM b JOIN f USING (k) JOIN b r ON r.doc_id = f.rep""")
def jaccard_pairs(t) -> DataFrame:
    """Titles against the first of those that share their smallest token."""
    tokens = F.array_sort(F.array_distinct(text.title_tokens(F.split_part("text", F.lit("\n"), F.lit(1)), ascii_only=True)))
    d = t("documents").select("doc_id", tokens.alias("w")).filter(F.size("w") > 0).withColumn("k", F.col("w")[0])
    first = d.groupBy("k").agg(F.min_by(F.struct("doc_id", "w"), "doc_id").alias("r"))
    return d.join(first, "k").select("doc_id", F.col("r.doc_id").alias("rep"), F.round(text.jaccard(F.col("w"), F.col("r.w")), 6).alias("jaccard"))


_TEXT_RULES = {"NUMBERS": r"\d{2,}", "CAPITALS": r"[A-Z]{4,}", "KEY_VALUE": r"(?i)(password|token|secret|key)\s*[:=]", "LICENSE": r"(?i)licen[sc]ed? under", "LINK": r"https?://"}
_TEXT_WEIGHTS = {"NUMBERS": 2, "CAPITALS": -3, "KEY_VALUE": -8, "LICENSE": 1, "LINK": 1, "SHORT": -6}
_SIGNALS_SQL = "list_filter([{}], lambda x: x IS NOT NULL)".format(", ".join([*(f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in _TEXT_RULES.items()), "CASE WHEN length(text) < 250 THEN 'SHORT' END"]))


@query(f"""
SELECT doc_id, array_to_string(s, ',') AS signals, CAST(50 + coalesce(list_sum(list_transform(s, lambda x: CASE x WHEN 'NUMBERS' THEN 2 WHEN 'CAPITALS' THEN -3 WHEN 'KEY_VALUE' THEN -8 WHEN 'LICENSE' THEN 1 WHEN 'LINK' THEN 1 ELSE -6 END)), 0) AS INT) AS score,
  CASE WHEN list_contains(s, 'NUMBERS') AND NOT list_contains(s, 'SHORT') THEN 'HIGH_INFORMATION' WHEN list_contains(s, 'SHORT') THEN 'LOW_INFORMATION' ELSE 'MODERATE_INFORMATION' END AS information FROM (SELECT doc_id, {_SIGNALS_SQL} AS s FROM documents)""")
def text_signals(t) -> DataFrame:
    found = F.concat(matched(F.col("text"), _TEXT_RULES), F.array_compact(F.array(F.when(F.length("text") < 250, F.lit("SHORT")))))
    d = t("documents").select("doc_id", found.alias("s"))
    has = lambda k: F.array_contains("s", k)
    info = F.when(has("NUMBERS") & ~has("SHORT"), "HIGH_INFORMATION").when(has("SHORT"), "LOW_INFORMATION").otherwise("MODERATE_INFORMATION")
    return d.select("doc_id", F.array_join("s", ",").alias("signals"), (50 + weighted_sum(F.col("s"), _TEXT_WEIGHTS)).alias("score"), info.alias("information"))


_CHECKLISTS = {"en": ["NUMBERS", "LINK", "LICENSE", "CAPITALS"], "de": ["NUMBERS", "LINK"], "DEFAULT": ["NUMBERS", "LICENSE", "KEY_VALUE"]}
_CRITICAL = {"en": ["NUMBERS"], "de": ["LINK"], "DEFAULT": ["NUMBERS"]}


@query(f"""
WITH d AS (SELECT doc_id, {_SIGNALS_SQL} AS s, CASE lang WHEN 'en' THEN ['NUMBERS', 'LINK', 'LICENSE', 'CAPITALS'] WHEN 'de' THEN ['NUMBERS', 'LINK'] ELSE ['NUMBERS', 'LICENSE', 'KEY_VALUE'] END AS asked, CASE lang WHEN 'de' THEN ['LINK'] ELSE ['NUMBERS'] END AS critical FROM documents),
e AS (SELECT doc_id, len(list_intersect(asked, s)) / len(asked) AS share, array_to_string(list_filter(critical, lambda c: NOT list_contains(s, c)), ',') AS gaps FROM d)
SELECT doc_id, round(share, 6) AS coverage, gaps, CASE WHEN share >= 0.75 AND gaps = '' THEN 'HIGH' WHEN share >= 0.5 THEN 'MODERATE' ELSE 'LOW' END AS class, round(50 + share * 24 - (gaps <> '')::INT * 6, 6) AS score FROM e""")
def checklist(t) -> DataFrame:
    table = lambda d: F.create_map(*(x for k, v in d.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    pick = lambda d: F.coalesce(F.try_element_at(table(d), F.col("lang")), F.array(*map(F.lit, d["DEFAULT"])))
    d = t("documents").select("doc_id", matched(F.col("text"), _TEXT_RULES).alias("s"), pick(_CHECKLISTS).alias("asked"), pick(_CRITICAL).alias("critical"))
    share = F.size(F.array_intersect("asked", "s")) / F.size("asked")
    gaps = F.array_except("critical", "s")
    klass = F.when((share >= 0.75) & (F.size(gaps) == 0), "HIGH").when(share >= 0.5, "MODERATE").otherwise("LOW")
    return d.select("doc_id", F.round(share, 6).alias("coverage"), F.array_join(gaps, ",").alias("gaps"), klass.alias("class"), F.round(50 + share * 24 - F.size(gaps) * 6, 6).alias("score"))


@query(r"""SELECT page_id, sha256(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS clean_sha256 FROM pages""")
def clean_html(t) -> DataFrame:
    return t("pages").select("page_id", text.sha256_text(text.strip_tags(F.col("html"))).alias("clean_sha256"))


@query(r"""
SELECT page_id, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) AS host,
  lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]+)', 1)) || CASE WHEN regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) END || CASE WHEN length(regexp_extract(url, '(\?[^#]*)', 1)) > 1 THEN regexp_extract(url, '(\?[^#]*)', 1) ELSE '' END AS safe FROM pages""")
def url_parts(t) -> DataFrame:
    u = F.col("url")
    return t("pages").select("page_id", F.lower(F.regexp_extract(u, "^([A-Za-z]+)://", 1)).alias("scheme"), F.lower(F.regexp_extract(u, "^[A-Za-z]+://([^/?#:]+)", 1)).alias("host"), text.safe_url(u, idna=False).alias("safe"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def digest(t) -> DataFrame:
    return t("documents").select("doc_id", text.sha256_text(F.col("text")).alias("digest"))


@query("""
SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'ACQUIRED' WHEN bool_or(event_type = 'error') THEN 'FAILED' WHEN bool_or(event_type = 'click') THEN 'NOT_FOUND' ELSE 'SKIPPED' END AS status FROM events GROUP BY user_id""")
def status_machine(t) -> DataFrame:
    codes = F.create_map(F.lit("purchase"), F.lit("ACQUIRED"), F.lit("error"), F.lit("FAILED"), F.lit("click"), F.lit("NOT_FOUND"))
    a = t("events").groupBy("user_id").agg(F.collect_set(F.try_element_at(codes, F.col("event_type"))).alias("attempts"))
    return a.select("user_id", joins.terminal_status(F.col("attempts"), ("ACQUIRED", "FAILED", "NOT_FOUND"), "SKIPPED").alias("status"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 7 ELSE CASE r_name WHEN 'ASIA' THEN 30 WHEN 'EUROPE' THEN 20 ELSE 10 END END AS cap, CASE WHEN c_custkey % 50 = 0 THEN 'override' ELSE lower(r_name) END AS label
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def policy_layering(t) -> DataFrame:
    c = t("customer").join(joins.small(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey")
    defaults = t("region").select(F.col("r_regionkey").alias("n_regionkey"), F.when(F.col("r_name") == "ASIA", 30).when(F.col("r_name") == "EUROPE", 20).otherwise(10).alias("cap"), F.lower("r_name").alias("label"))
    overrides = t("customer").filter(F.col("c_custkey") % 50 == 0).select("c_custkey", F.lit(7).alias("cap"), F.lit("override").alias("label"))
    return joins.resolve_policy(c, defaults, overrides, "c_custkey", "n_regionkey", ["cap", "label"]).select("c_custkey", "cap", "label")


@query("""
SELECT p_partkey, p_name FROM part WHERE contains(lower(concat_ws(' ', p_name, p_type)), 'st') AND p_size >= 10 ORDER BY p_retailprice DESC, p_partkey LIMIT 50 OFFSET 20""")
def filter_page(t) -> DataFrame:
    return publish.filter_page(t("part"), "ST", ["p_name", "p_type"], least={"p_size": 10}, present=["p_brand"], order=[F.desc("p_retailprice"), F.col("p_partkey")], offset=20, limit=50).select("p_partkey", "p_name")


@query("""
WITH o AS (SELECT o_orderkey, o_orderkey % 7 AS declared FROM orders), l AS (SELECT l_orderkey, count(*) AS observed FROM lineitem GROUP BY l_orderkey)
SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, coalesce(declared, 0) AS declared, coalesce(observed, 0) AS observed, coalesce(declared, 0) = coalesce(observed, 0) AS agrees FROM o FULL JOIN l ON o_orderkey = l_orderkey""")
def ledger_check(t) -> DataFrame:
    o = t("orders").select("o_orderkey", (F.col("o_orderkey") % 7).alias("d"))
    n = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return publish.ledger(o, n, "o_orderkey", "d", "n")


@query("SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t) -> DataFrame:
    return publish.duplicate_keys(t("lineitem"), ["l_partkey", "l_suppkey"])


@query("""
WITH f AS (SELECT c_custkey AS id, 'fetch' AS part FROM customer WHERE c_acctbal > 5000), h AS (SELECT c_custkey, 'hold' FROM customer WHERE c_acctbal > 0 AND c_acctbal <= 5000)
SELECT * FROM f UNION ALL SELECT * FROM h UNION ALL SELECT c_custkey, 'integrity' FROM customer WHERE c_nationkey = 3 AND c_acctbal <= 0""")
def root_items(t) -> DataFrame:
    """Fetch, then hold, then the integrity items that are in neither."""
    c = t("customer").select(F.col("c_custkey").alias("id"), "c_acctbal", "c_nationkey")
    fetch, hold = c.filter("c_acctbal > 5000"), c.filter("c_acctbal > 0 AND c_acctbal <= 5000")
    both = fetch.select("id", F.lit("fetch").alias("part")).unionByName(hold.select("id", F.lit("hold").alias("part")))
    rest = joins.missing(c.filter("c_nationkey = 3").select("id"), both, ["id"])
    return both.unionByName(rest.select("id", F.lit("integrity").alias("part")))


@query("""
SELECT e.event_id, m.event_id AS rep FROM events e JOIN (SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL) m USING (user_id, event_type)""")
def first_match_lookup(t) -> DataFrame:
    e = t("events").select("event_id", "user_id", "event_type")
    named = e.select("user_id", "event_type", F.col("event_id").alias("rep"))
    return joins.lookup(e, named, ["user_id", "event_type"], "first", F.col("rep")).select("event_id", "rep")


@query("""
SELECT event_id, period_kind, period_key FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'month' ELSE 'week' END AS period_kind,
  CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m') ELSE strftime(ts, '%G-W%V') END AS period_key FROM events)""")
def period_keys(t) -> DataFrame:
    d = F.to_date("ts")
    week = F.date_sub(d, F.weekday(d))
    k = F.col("event_id") % 3
    e = t("events").select("event_id", F.when(k == 0, d).when(k == 1, F.trunc(d, "month")).otherwise(week).alias("a"), F.when(k == 0, d).when(k == 1, F.last_day(d)).otherwise(F.date_add(week, 6)).alias("b"))
    return e.select("event_id", period.period_kind(F.col("a"), F.col("b")).alias("period_kind"), period.period_key(F.col("a"), F.col("b")).alias("period_key"))


@query()
def diversified_select(t) -> DataFrame:
    """Documents by source as journals: candidates first, capped, near-duplicate free, in turns; a property test holds it to a sequential model."""
    p = ShortlistPolicy(target=120, journal_caps={"FULL": 12, "TRIAGE": 12, "INDEX_ONLY": 2, "SUSPENDED": 0})
    tokens = text.title_tokens(F.split_part("text", F.lit("\n"), F.lit(1)), ascii_only=True)
    d = t("documents").select(
        F.coalesce("source", F.lit("")).alias("journal_slug"), F.col("doc_id").cast("string").alias("record_key"), F.when(F.col("n_chars") > 3000, "FETCH_CANDIDATE").when(F.col("n_chars") > 300, "RESERVE").otherwise("CATALOG_ONLY").alias("route"),
        F.lit("FULL").alias("processing_mode"), F.lit(True).alias("fetchable"), tokens.alias("tokens"), text.topic_signature(tokens).alias("topic_signature"), "n_chars", "lang", "doc_id",
    )
    w = Window.partitionBy("journal_slug").orderBy(F.desc("n_chars"), "doc_id")
    placed = rank.interleave(d.withColumn("place", F.row_number().over(w)), ["journal_slug", "route"], "lang", [F.col("place")], F.col("lang"))
    priors = d.select(F.col("journal_slug").alias("slug")).distinct().withColumn("registry_category_percentile", F.pmod(F.xxhash64("slug"), F.lit(100)).cast("double")).withColumn("unknown_metric", F.lit(False))
    context = select.contexts(d, priors, p)
    return select.diversified(placed, context, p)[0].select("record_key", "journal_slug", "ordinal", "reason")
