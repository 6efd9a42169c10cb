import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import caps, checks, classify, graph, greedy, identity, joins, merge, orders, publish, rank, select, signals
from recordloom.operators.graph import connected_components
from recordloom.plans import record_queries
from recordloom.plans.policy import MODES, EvaluationPolicy, PolicyError, ReviewPolicy, ShortlistPolicy, TriagePolicy

ARTICLE = (
    "idx int, title string, journal string, publication_date date, publication_date_precision string, doi string, pmid string, pmcid string, issns array<string>, authors array<string>, "
    "article_type string, urls array<string>, source_records array<struct<source:string,source_id:string,url:string>>, title_zh_tw string, summary_zh_tw string, translation_basis string, translation_source_url string"
)


def article(i, title="T", date=dt.date(2026, 8, 1), precision="DAY", doi=None, pmid=None, pmcid=None, issns=(), authors=(), source="s", urls=()):
    return (i, title, "J", date, precision, doi, pmid, pmcid, list(issns), list(authors), None, list(urls), [(source, str(i), "u")], None, None, None, None)


def test_same_doi_in_two_spellings(spark):
    df = spark.createDataFrame([article(0, "A", doi="10.1/X", pmid="1", source="pubmed"), article(1, "B", doi="https://doi.org/10.1/x", pmcid="PMC9", source="epmc", authors=["a", "b"])], ARTICLE)
    r = identity.deduplicate(df).collect()
    assert len(r) == 1 and (r[0]["pmid"], r[0]["pmcid"], r[0]["title"], len(r[0]["source_records"]), r[0]["authors"]) == ("1", "PMC9", "A", 2, ["a", "b"])


def test_transitive_chain_and_dates(spark):
    df = spark.createDataFrame([
        article(0, "A", doi="10.1/x", date=dt.date(2026, 8, 1), precision="MONTH"), article(1, "B", pmid="7", date=dt.date(2026, 8, 20)), article(2, "C", doi="10.1/x", pmid="7", date=dt.date(2026, 8, 13)),
        article(3, "D", date=dt.date(2026, 7, 1)),
    ], ARTICLE)
    r = identity.deduplicate(df).collect()
    assert [x["title"] for x in r] == ["A", "D"]
    # The month gives way to a day inside it, and that to an earlier day.
    assert r[0]["publication_date"] == dt.date(2026, 8, 13) and r[0]["publication_date_precision"] == "DAY"


def folded(members, rule):
    """A component's members one after the other, as (date, precision, authors, issns, urls, records, doi, title, idx)."""
    rank = lambda p: {"DAY": 3, "MONTH": 2, "YEAR": 1}.get((p or "").upper(), 0)

    def span(d, p):
        if d is None or not rank(p):
            return None
        return {3: (d, d), 2: (d.replace(day=1), (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)), 1: (d.replace(month=1, day=1), d.replace(month=12, day=31))}[rank(p)]

    def swaps(d, p, e, q):
        if d is None or e is None:
            return False
        if rule == "earliest":
            return e < d or (e == d and rank(q) > rank(p))
        a, b = span(d, p), span(e, q)
        if a and b and a[0] <= b[1] and b[0] <= a[1] and rank(p) != rank(q):
            return rank(q) > rank(p)
        return rank(p) == rank(q) and e < d

    first, *rest = sorted(members)
    out = list(first)
    if not rest:
        return (*first[:4], sorted({*first[4]}), sorted({*first[5]}), list(dict.fromkeys(first[6])), *first[7:])
    for m in rest:
        if swaps(out[1], out[2], m[1], m[2]):
            out[1:3] = m[1:3]
        if len(m[3]) > len(out[3]):
            out[3] = m[3]
        for i in (4, 5):
            out[i] = sorted({*out[i], *m[i]})
        out[6] = out[6] + [r for r in dict.fromkeys(m[6]) if r not in out[6]]
        out[7] = out[7] or m[7]
    return (*out[:4], sorted({*out[4]}), sorted({*out[5]}), list(dict.fromkeys(out[6])), out[7] or None, out[8])


@pytest.mark.parametrize(("rule", "seed"), [("finer", 1), ("finer", 2), ("earliest", 3)])
def test_survivors_are_those_of_the_fold(spark, rule, seed, monkeypatch):
    monkeypatch.setattr(identity, "BLOCK_BITS", (16, 3)[seed % 2])
    rng = random.Random(seed)
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(0, 120, 3)] + [dt.date(2025, 6, 2), None]
    parts = {}
    for c in range(60):
        for i in rng.sample(range(200), rng.choice([1, 2, 3, 12, 60])):
            parts.setdefault(c, []).append((i, rng.choice(days), rng.choice(["DAY", "day", "MONTH", "MONTH", "YEAR", "YEAR", "", None]), [f"a{k}" for k in range(rng.randint(0, 4))] and [f"{i}-{k}" for k in range(rng.randint(0, 4))], [rng.choice("xyz")], [rng.choice("uvw") for _ in range(2)], [(rng.choice("st"), rng.choice("12"), "u") for _ in range(rng.randint(0, 3))], rng.choice(["", None, "10.1/a", "10.1/b"]), f"T{i}"))
    none = {c: F.lit(None).cast("string") for c in identity.FIRST_SCALARS if c != "doi"}
    df = spark.createDataFrame([(c, *m) for c, ms in parts.items() for m in ms], "component long, idx long, publication_date date, publication_date_precision string, authors array<string>, issns array<string>, urls array<string>, source_records array<struct<source:string,source_id:string,url:string>>, doi string, title string").withColumns(none)
    got = {r["component"]: (r["idx"], r["publication_date"], r["publication_date_precision"], r["authors"], r["issns"], r["urls"], [tuple(x) for x in r["source_records"]], r["doi"], r["title"]) for r in identity.merge_survivors(df, rule=rule).collect()}
    assert got == {c: folded(ms, rule) for c, ms in parts.items()}


@pytest.mark.parametrize("least", [graph.LEAST_HUB, 2])
def test_components_are_union_finds(spark, monkeypatch, least):
    monkeypatch.setattr(graph, "LEAST_HUB", least)
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(3, 3), (None, 4)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


TITLES = {
    "Checkpoint control of DNA replication in yeast": ("primary", "PRIMARY_METADATA"),
    "Matcher revisited: reproducibility of a small image model": ("primary", "REPLICATION_VALIDATION"),
    "A guidelines-aligned menu and blood lipids: a randomised controlled trial": ("primary", "RANDOMIZED_TRIAL"),
    "Adherence to guidelines for sepsis: a retrospective cohort study": ("primary", "OBSERVATIONAL_DESIGN"),
    "Beyond scores: safety-minded guidelines for judging agents": ("primary", "GUIDANCE"),
    "Judging diagnostic agents against expert consensus": ("primary", "PRIMARY_METADATA"),
    "Re: sleep and stroke: a systematic review": ("correspondence", "EDITORIAL"),
    "Comment on mortality after surgery": ("correspondence", "EDITORIAL"),
    "Phase II non-randomised trial of a dye": ("primary", "PRIMARY_METADATA"),
    "Ancestry in the Big Cohort Dataset": ("primary", "PRIMARY_METADATA"),
    "A novel dataset and model of drivers' gaze": ("primary", "RESOURCE_BENCHMARK"),
    "Barriers to longitudinal care in asthma": ("primary", "PRIMARY_METADATA"),
    "Outcomes in a prospective multicentre cohort study": ("primary", "PROSPECTIVE_LONGITUDINAL"),
    "Retraction note: warm plasma": ("concern", "INTEGRITY_EVENT"),
    "Author correction: cold plasma": ("correction", "CORRECTION_EVENT"),
    "Guest editorial: plasma": ("editorial", "EDITORIAL"),
    "Statins in stroke: study protocol for a randomized controlled trial": ("primary", "RANDOMIZED_TRIAL"),
}


def test_titles(spark):
    df = spark.createDataFrame([(t, None, None, None) for t in TITLES], "title_original string, doi string, pmid string, pmcid string")
    assert {r["title_original"]: (r["publication_role"], r["primary_path"]) for r in classify.score_titles(df).collect()} == TITLES


def triage(spark, titles):
    df = spark.createDataFrame([(t, f"10.1/{i}", None, None, f"doi:10.1/{i}", "j", dt.date(2026, 8, 1), "TRIAGE") for i, t in enumerate(titles)], "title_original string, doi string, pmid string, pmcid string, canonical_id string, journal_slug string, publication_date date, processing_mode string")
    s = classify.saturate(classify.score_titles(df), "journal_slug")
    return caps.triage_caps(s.withColumn("route", classify.route(F.col("publication_role"), F.col("primary_path"), F.col("score"))))


def test_volume_cap(spark):
    r = triage(spark, [f"Randomized controlled trial number {i}" for i in range(4397)])
    n = {x["route"]: x["count"] for x in r.groupBy("route").count().collect()}
    assert n == {"FETCH_CANDIDATE": 20, "RESERVE": 4377}
    assert caps.reserve_index(r).count() == 50


def test_saturation(spark):
    r = triage(spark, [f"Dataset of things {i}" for i in range(50)])
    assert r.filter("route = 'FETCH_CANDIDATE'").count() == 0 and r.filter("route = 'RESERVE' AND saturated").count() == 50


def test_midrank(spark):
    df = spark.createDataFrame([("a", "c", "CITESCORE", 5.0), ("b", "c", "CITESCORE", 20.0), ("x", "c", "CITESCORE", 18.0), ("x", "d", "CITESCORE", 18.0)], "slug string, category string, kind string, value double")
    got = {r["slug"]: (r["registry_category_percentile"], r["unknown_metric"]) for r in rank.impact_priors(df, spark.createDataFrame([("x",), ("n",)], "slug string")).collect()}
    assert got == {"x": (50.0, False), "n": (50.0, True)}


def test_review_signals(spark):
    text = "Methods: we enrolled 240 patients. Results: hazard ratio 0.8 (95% CI 0.7-0.9). " + "x" * 250
    df = spark.createDataFrame([("RANDOMIZED_TRIAL", "FETCH_CANDIDATE", 55.0, text), ("SURVEY", "RESERVE", 50.0, "short"), (None, None, None, None)], "primary_path string, prefetch_route string, percentile double, abstract string")
    a, b, c = signals.review(df).collect()
    assert a["abstract_information_class"] == "HIGH_INFORMATION" and a["fulltext_priority_score"] == 80 + 8 + 5 + 7 + 5 + 5 + 0
    assert b["abstract_signals"] == ["SHORT_ABSTRACT", "NO_RESULT_SIGNAL"] and b["fulltext_priority_score"] == 55 - 14
    assert c["fulltext_priority_score"] == 50 - 14


def test_audit(spark):
    full = "We recommend care. Competing interests: none. Funding: none."
    df = spark.createDataFrame([("GUIDANCE", full, ["METHODS_SECTION"]), ("GUIDANCE", full, []), ("NEW", None, [])], "primary_path string, text string, flags array<string>")
    a, b, c = signals.audit(df, "text", flags="flags").collect()
    assert (a["coverage"], a["coverage_class"], a["critical_gaps"]) == (1.0, "HIGH_REPORTING_COVERAGE", [])
    assert (b["coverage"], b["coverage_class"], b["critical_gaps"]) == (0.75, "MODERATE_REPORTING_COVERAGE", ["METHODS_SECTION"])
    assert c["coverage_class"] == "LIMITED_NO_MACHINE_TEXT"


def test_xml_structure(spark):
    xml = "<article xmlns='urn:x'><body><sec><title>Methods</title><p>a</p></sec><sec><title>Results</title></sec></body><back><ref id='1'/><ref id='2'/></back></article>"
    audit = signals.structural_audit(F.col("x"))
    r = spark.createDataFrame([(xml,)], "x string").select(*(c.alias(k) for k, c in audit.items())).first()
    assert r["METHODS_SECTION"] and r["RESULTS_SECTION"] and not r["FUNDING"] and r["ref_count"] == 2


def sequential(rows, ctx, p):
    """The selection as one loop over all journals: brute force for the decomposed one."""
    held = {j: [] for j in ctx}
    topics, chosen, blocks = {}, [], {}

    def blocked(r, caps_, hard):
        c = ctx[r["j"]]
        if len(held[r["j"]]) >= c["cap"]:
            return "JOURNAL_FETCH_HARD_CAP"
        if any(greedy.jaccard(frozenset(r["tokens"]), frozenset(x["tokens"])) >= p.near_duplicate for x in held[r["j"]]):
            return "NEAR_DUPLICATE_TITLE"
        if topics.get((r["j"], r["topic"]), 0) >= caps_:
            return "TOPIC_HARD_CAP" if hard else "TOPIC_SOFT_CAP"
        return None

    def phase(pools, key, caps_, hard, stop=lambda j: False):
        while len(chosen) < p.target:
            moved = False
            for j in sorted((j for j in pools if pools[j] and not stop(j)), key=lambda j: key(j, pools)):
                while pools[j]:
                    r = pools[j].pop(0)
                    if r["key"] in {x["key"] for x in chosen}:
                        continue
                    why = blocked(r, caps_, hard)
                    if why:
                        blocks.setdefault(r["key"], set()).add(why)
                        continue
                    held[j].append(r)
                    topics[j, r["topic"]] = topics.get((j, r["topic"]), 0) + 1
                    chosen.append(r)
                    moved = True
                    break
                if len(chosen) >= p.target:
                    break
            if not moved:
                break

    soft, hard = p.topic_soft_caps["FULL"], p.topic_hard_caps["FULL"]
    by = lambda route: {j: sorted((r for r in rows if r["j"] == j and r["route"] == route), key=lambda r: r["turn"]) for j in ctx}
    phase(by("FETCH_CANDIDATE"), lambda j, _: (len(held[j]) / max(1, ctx[j]["candidates"]), j), soft, False)
    phase(by("RESERVE"), lambda j, _: (-ctx[j]["pct"], len(held[j]) / max(1, ctx[j]["target"]), j), soft, False, lambda j: len(held[j]) >= ctx[j]["target"])
    taken = {x["key"] for x in chosen}
    rest = {j: sorted((r for r in rows if r["j"] == j and r["key"] not in taken), key=lambda r: (r["route"] != "FETCH_CANDIDATE", r["place"])) for j in ctx}
    phase(rest, lambda j, pools: (-ctx[j]["pct"], len(held[j]) / max(1, ctx[j]["fetchable"]), -len(pools[j]), j), hard, True)
    return [r["key"] for r in chosen], blocks


@pytest.mark.parametrize("seed", range(4))
def test_decomposed_selection_is_the_sequential_one(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(greedy, "FRONTIER", (256, 256, 5)[seed % 3])
    monkeypatch.setattr(greedy, "MAX_STATES", (0, 2000)[seed % 2])
    p = ShortlistPolicy(target=rng.choice([5, 20, 60]), near_duplicate=rng.choice([0.5, 0.82]), topic_soft_caps=dict.fromkeys(("FULL", "TRIAGE", "INDEX_ONLY", "SUSPENDED"), rng.randint(1, 3)), topic_hard_caps=dict.fromkeys(("FULL", "TRIAGE", "INDEX_ONLY", "SUSPENDED"), 5))
    rows, ctx = [], {}
    for j in (f"j{i}" for i in range(rng.randint(2, 6))):
        own = [{"j": j, "key": f"{j}-{i}", "route": rng.choice(["FETCH_CANDIDATE", "RESERVE"]), "tokens": rng.sample("abcdef", rng.randint(1, 4)), "topic": rng.choice("xyz"), "place": i} for i in range(rng.randint(1, 25))]
        for route in ("FETCH_CANDIDATE", "RESERVE"):
            some = [r for r in own if r["route"] == route]
            for n, r in enumerate(rng.sample(some, len(some)), 1):
                r["turn"] = n
        n_c = sum(r["route"] == "FETCH_CANDIDATE" for r in own)
        ctx[j] = {"cap": rng.randint(1, 15), "candidates": n_c, "target": rng.randint(0, 12), "fetchable": len(own), "pct": float(rng.choice([20, 50, 90]))}
        rows += own
    records = spark.createDataFrame([(r["j"], r["key"], r["route"], "FULL", True, r["tokens"], r["topic"], r["place"], r["turn"]) for r in rows], "journal_slug string, record_key string, route string, processing_mode string, fetchable boolean, tokens array<string>, topic_signature string, place int, turn int")
    context = spark.createDataFrame([(j, c["pct"], c["cap"], c["candidates"], c["target"], c["fetchable"]) for j, c in ctx.items()], "journal_slug string, percentile double, hard_cap int, candidates int, target int, fetchable int")
    chosen, blocks = sequential(rows, ctx, p)
    got, why = select.diversified(records, context, p)
    assert [r["record_key"] for r in got.orderBy("ordinal").collect()] == chosen
    made: dict = {}
    for r in why.collect():
        made.setdefault(r["record_key"], set()).add(r["block"])
    assert made == blocks
    left = {r["record_key"] for r in select.final_blocks(records, got, context, p).collect()}
    assert left == {r["key"] for r in rows} - set(chosen)


def test_review_selection(spark):
    rows = [("a", f"a{i}", "INDEX_ONLY", 90.0 - i, 50.0, 0, f"t{i}", [f"w{i}"]) for i in range(6)] + [("b", f"b{i}", "FULL", 80.0 - i, 50.0, 0, "same", ["x", "y"]) for i in range(3)]
    df = spark.createDataFrame(rows, "journal_slug string, record_key string, processing_mode string, score double, percentile double, prefetch_score int, title string, tokens array<string>")
    r = {x["record_key"]: (x["ordinal"], x["reason"]) for x in select.review_selection(df, ReviewPolicy(target=4)).collect()}
    assert [r[k][0] for k in ("a0", "b0", "a1", "a2", "a3")] == [1, 2, 3, 4, None]
    assert r["b1"][1] == "NEAR_DUPLICATE_ABSTRACT_CANDIDATE" and r["a5"][1] == "FULLTEXT_GLOBAL_TARGET_OR_RELATIVE_PRIORITY"


def sequential_review(rows, p):
    """Journals in turn by their best rows; a row that is turned down uses up its turn."""
    key = lambda r: (-r[3], -r[4], -r[5], r[6].lower(), r[1])
    lanes = {}
    for r in sorted(rows, key=key):
        lanes.setdefault(r[0], []).append(r)
    held, out, n = {j: [] for j in lanes}, {}, 0
    for k in range(max(map(len, lanes.values()))):
        for j in sorted(lanes, key=lambda j: (-lanes[j][0][3], -lanes[j][0][4], j)):
            if k < len(lanes[j]) and n < p.target:
                r = lanes[j][k]
                if len(held[j]) >= p.journal_caps.get(r[2], 0):
                    out[r[1]] = (None, "JOURNAL_FULLTEXT_CAP")
                elif any(greedy.jaccard(frozenset(r[7]), x) >= p.near_duplicate for x in held[j]):
                    out[r[1]] = (None, "NEAR_DUPLICATE_ABSTRACT_CANDIDATE")
                else:
                    n += 1
                    held[j].append(frozenset(r[7]))
                    out[r[1]] = (n, "ABSTRACT_STRUCTURAL_REVIEW")
    return {r[1]: out.get(r[1], (None, "FULLTEXT_GLOBAL_TARGET_OR_RELATIVE_PRIORITY")) for r in rows}


@pytest.mark.parametrize("seed", range(2))
def test_review_selection_is_the_sequential_one(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(greedy, "FRONTIER", (3, 256)[seed])
    p = ReviewPolicy(target=rng.choice([3, 12, 200]), near_duplicate=rng.choice([0.4, 0.85]), journal_caps={"FULL": 5, "TRIAGE": 9, "INDEX_ONLY": 1, "SUSPENDED": 0})
    modes = ["FULL", "TRIAGE", "INDEX_ONLY", "SUSPENDED"]
    rows = [(f"j{j}", f"{j}-{i}", modes[j % 4], float(rng.randint(0, 5)), float(rng.choice([20, 50])), rng.randint(0, 2), rng.choice("aB"), [rng.choice("abcdef") for _ in range(rng.randint(0, 4))]) for j in range(6) for i in range(rng.randint(1, 30))]
    df = spark.createDataFrame(rows, "journal_slug string, record_key string, processing_mode string, score double, percentile double, prefetch_score int, title string, tokens array<string>")
    got = {r["record_key"]: (r["ordinal"], r["reason"]) for r in select.review_selection(df, p).collect()}
    assert got == sequential_review(rows, p)


def test_no_task_of_a_selection_holds_a_journal(spark, monkeypatch):
    sizes = []
    top = greedy.top_per_group
    monkeypatch.setattr(greedy, "top_per_group", lambda df, *a, **k: sizes.append((made := top(df, *a, **k)).groupBy("g").count().agg(F.max("count")).first()[0]) or made)
    monkeypatch.setattr(greedy, "FRONTIER", 50)
    n = 5_000
    rows = spark.range(n).select(F.lit("hot").alias("journal_slug"), F.format_string("%06d", F.col("id")).alias("record_key"), F.lit("FULL").alias("processing_mode"), (-F.col("id")).cast("double").alias("score"), F.lit(50.0).alias("percentile"), F.lit(0).alias("prefetch_score"), F.lit("t").alias("title"),
                                 F.array(F.concat(F.lit("w"), (F.col("id") / 700).cast("int").cast("string"))).alias("tokens"))
    got = select.review_selection(rows, ReviewPolicy()).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in got} == {"ABSTRACT_STRUCTURAL_REVIEW": 8, "NEAR_DUPLICATE_ABSTRACT_CANDIDATE": n - 8}
    assert max(s for s in sizes if s) <= 50 and len(sizes) <= 9  # a title of 700 near copies costs a frontier


def test_places_are_the_window_s_whatever_a_group_holds(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None, "c"]), rng.randint(0, 1) or None, rng.random(), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, h int, x double, i int")
    want = sorted(map(tuple, orders.places(df, ["g", "h"], ["x"], "n").collect()), key=str)
    for most in (0, 60):
        assert sorted(map(tuple, orders.places(df, ["g", "h"], ["x"], "n", most).collect()), key=str) == want


def test_delta_merge(spark):
    base = spark.createDataFrame([("1", "x", ["u"]), ("2", "", ["u"])], "id string, name string, urls array<string>")
    delta = spark.createDataFrame([(0, "2", "n", ["v"]), (1, "3", "", ["w"]), (2, "3", "m", ["w"])], "idx int, id string, name string, urls array<string>")
    m = merge.merge_delta(base, delta, "id", "idx")
    assert {r["id"]: (r["name"], r["urls"], r["origin"]) for r in m.collect()} == {"1": ("x", ["u"], "BASE"), "2": ("n", ["u", "v"], "BOTH"), "3": ("m", ["w"], "DELTA")}
    assert tuple(merge.merge_counts(m, delta).first()) == (2, 3, 1, 2, 3)


def test_backfill_contract():
    base = {"journal": "j", "start": dt.date(2026, 8, 1), "end": dt.date(2026, 8, 14), "revision": 1, "status": "COMPLETE"}
    good = {"journal": "j", "start": dt.date(2026, 8, 15), "end": dt.date(2026, 8, 19), "revision": 2, "status": "COMPLETE"}
    assert merge.backfill_violations(base, good) == []
    assert merge.backfill_violations(base, good | {"start": dt.date(2026, 8, 16)}) == ["GAP_BETWEEN_WINDOWS"]
    assert merge.backfill_violations(base, good | {"status": "PARTIAL_SOURCE_COVERAGE"}) == ["DELTA_INCOMPLETE"]
    assert merge.backfill_violations(base, good | {"start": dt.date(2026, 8, 6)}) == ["WINDOWS_OVERLAP"]
    assert merge.backfill_violations(base | {"start": dt.date(2026, 8, 2), "kind": "range"}, good) == ["BASE_NOT_MONTHLY", "BASE_NOT_FROM_FIRST_DAY"]


def test_search_index(spark):
    pubs = spark.createDataFrame([("a", "p", 1), ("a", "p", 2), ("b", "p", 1)], "journal_slug string, period_key string, revision int")
    arts = spark.createDataFrame([("a", "p", 1, i) for i in range(100)] + [("a", "p", 2, i) for i in range(20)] + [("b", "p", 1, i) for i in range(300)], "journal_slug string, period_key string, revision int, position int")
    n = {(r["journal_slug"], r["revision"]): (r["count"], r["total"]) for r in publish.search_index(pubs, arts).groupBy("journal_slug", "revision", "total").count().collect()}
    assert n == {("a", 2): (20, 20), ("b", 1): (250, 300)}


def test_checks(spark):
    receipts = spark.createDataFrame([("k1", "a" * 64, 3)], "record_key string, sha256 string, bytes long")
    vault = spark.createDataFrame([("a" * 64, bytearray(b"xyz")), ("b" * 64, bytearray(b"q"))], "sha256 string, content binary")
    found = sorted(r["check"] for r in checks.payloads(receipts, vault).collect())
    assert found == ["PAYLOAD_CLAIMED", "PAYLOAD_DIGEST", "PAYLOAD_DIGEST"]
    with pytest.raises(ValueError):
        checks.enforce(checks.payloads(receipts, vault), "vault")
    plan = spark.createDataFrame([("a", 1, "PLANNED", ["X"]), ("a", 3, "DONE", ["Y"])], "record_key string, ordinal int, status string, source_order array<string>")
    assert {r["check"] for r in checks.plan(plan, ("X",)).collect()} == {"PLANNED", "SOURCES", "DUPLICATE_KEY", "ORDINALS"}


def test_stored_against_recomputed(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "source string, n long")
    b = spark.createDataFrame([("x", 1), ("z", 3)], "source string, n long")
    assert sorted((r["key"], r["detail"]) for r in checks.counters(a, b, ["source"]).collect()) == [("y", "2"), ("z", "3")]
    runs, now = (spark.createDataFrame(r, "id string, run_status string") for r in ([("r", "COMPLETE"), ("s", "COMPLETE")], [("r", "COMPLETE"), ("s", "PARTIAL_SOURCE_COVERAGE")]))
    assert [r["key"] for r in checks.stored_status(runs, now, "id").collect()] == ["s"]
    declared, stored = (spark.createDataFrame(r, "path string, sha256 string, bytes long") for r in ([("a", "1", 1), ("b", "2", 2), ("c", "3", 3)], [("a", "1", 1), ("b", "x", 9)]))
    assert sorted((r["check"], r["key"]) for r in checks.manifests(declared, stored).collect()) == [("FILE_DIGEST", "b"), ("FILE_PRESENT", "c"), ("FILE_SIZE", "b")]
    columns = "edition_id string, publication_id string, journal_slug string, period_key string, revision int, article_count int, translated_article_count int"
    m, e = spark.createDataFrame([("e", "p", "j", "k", 1, 5, 0), ("e", "q", "j", "k", 1, 5, 0)], columns), spark.createDataFrame([("e", "p", "j", "k", 2, 5, 0)], columns)
    assert sorted((r["check"], r["key"]) for r in checks.publications(m, e).collect()) == [("EDITION_PRESENT", "q"), ("REVISION_DIFFERS", "p")]


def test_suspended_journals_and_provenance(spark):
    df = caps.with_provenance(spark.createDataFrame([("FULL", 900), ("SUSPENDED", 900)], "mode string, n int"))
    assert {(r["acquisition_level"], *(r[c] for c in caps.PROVENANCE)) for r in df.collect()} == {("BIBLIOGRAPHIC_METADATA", False, False, False)}
    plain, forced = caps.load_allowed(F.col("mode")), caps.load_allowed(F.col("mode"), override=True)
    got = df.select(plain[0].alias("a"), plain[1].alias("b"), forced[0].alias("c"), forced[1].alias("d"), caps.source_budget(F.col("n"), F.col("mode")).alias("e"), caps.source_budget(F.col("n"), F.col("mode"), override=True).alias("f")).collect()
    assert [tuple(r) for r in got] == [(True, "FULL", True, "FULL", 500, 900), (False, "SUSPENDED", True, "FULL", 0, 900)]
    shown = spark.range(1).select(*(F.struct(*caps.projection(F.lit(n).cast("long"), F.lit(limit))).alias(f"p{i}") for i, (n, limit) in enumerate([(5, 0), (5, 3), (3, 5)]))).first()
    assert [tuple(x) for x in shown] == [("NONE", 0, 5), ("LIMITED", 3, 2), ("INLINE_ALL", 3, 0)]


def test_translation_items(spark):
    edition = spark.createDataFrame([("a", ["https://x.org/1"])], "canonical_id string, urls array<string>")
    rows = [("a", "t", "s", "abstract", "https://X.org/1"), ("a", "t" * 501, "", "rumour", None), ("a", "t", "s", "ABSTRACT", "https://y.org/"), ("a", "t", "s", "TITLE_ONLY", None)]
    items = spark.createDataFrame(rows, "canonical_id string, title_zh_tw string, summary_zh_tw string, basis string, source_url string")
    assert sorted(r["check"] for r in checks.translation_items(items, edition).collect()) == ["BASIS", "SOURCE_MISSING", "SOURCE_NOT_BOUND", "SUMMARY", "TITLE"]
    assert checks.binding({"edition_id": "e", "language": "zh-TW", "source_edition_sha256": "1", "request_binding_sha256": "2", "items": []}, "e", "1", "2") == []
    assert checks.binding({"edition_id": "e", "language": "de", "item_count": 1}, "e", "1", "2") == ["LANGUAGE", "SOURCE_EDITION_SHA256", "REQUEST_BINDING_SHA256", "ITEM_COUNT"]


def test_article_ids(spark):
    none = (None, None, None)
    rows = [("Some Title", dt.date(2026, 8, 1), *none, []), ("T", dt.date(2026, 8, 1), *none, [("tmlr_official_snapshot", " aB-1_ ")]), ("T", dt.date(2026, 8, 1), "https://doi.org/10.1/X", "5", None, []), ("T", dt.date(2026, 8, 1), None, " 5 ", "pmc1", []), ("T", dt.date(2026, 8, 1), "", "", "pmc1", [("tmlr_official_snapshot", "a b")])]
    df = spark.createDataFrame(rows, "title string, publication_date date, doi string, pmid string, pmcid string, source_records array<struct<source: string, source_id: string>>")
    assert [r["i"] for r in df.select(identity.article_id().alias("i")).collect()] == ["fingerprint:sometitle|2026-08-01", "openreview:aB-1_", "doi:10.1/x", "pmid:5", "pmcid:PMC1"]


def test_required_lookup_fails(spark):
    left, right = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(Exception, match="shortlist missing b"):
        joins.required(left, right, ["k"], "shortlist").collect()


def test_policies():
    assert TriagePolicy().digest() != TriagePolicy(fetch=81).digest()
    for bad in (lambda: TriagePolicy(fetch=60).check(), lambda: ShortlistPolicy(bands=((50.0, 1.0),)).check(), lambda: ReviewPolicy(journal_caps={"FULL": 1}).check(), lambda: EvaluationPolicy(target=-1).check()):
        with pytest.raises(PolicyError):
            bad()


def sequential_shortlist(rows, p):
    """Who is taken, in order, by walking all rows one after the other for every turn."""
    taken, counts = [], {}
    n = lambda *k: counts.get(k, 0)
    near = lambda a, b: len(a & b) / len(a | b) >= p.near_duplicate if a and b else False
    best = lambda r: (-r["score"], -r["publication_date"], r["journal"].lower(), r["title"].lower(), r["record_key"])

    def turns(pool, lead=lambda r: 0):
        lanes = {}
        for r in sorted(pool, key=lambda r: (lead(r), best(r))):
            lanes.setdefault(r["journal_slug"], []).append(r)
        order = sorted(lanes.values(), key=lambda v: (lead(v[0]), best(v[0])))
        return [v[i] for i in range(max(map(len, order), default=0)) for v in order if i < len(v)]

    blocks = {}

    def why_not(r, k):
        if not r["fetchable"]:
            return "NO_FETCHABLE_IDENTIFIER"
        if any(x["journal_slug"] == r["journal_slug"] and near(set(r["tokens"]), set(x["tokens"])) for x, _ in taken):
            return "NEAR_DUPLICATE_TITLE"
        if n("t", r["journal_slug"], r["topic_signature"]) >= p.topic_cap:
            return "TOPIC_SOFT_CAP"
        if n("j", r["journal_slug"]) >= p.journal_caps.get(r["processing_mode"] or "FULL", 0):
            return "JOURNAL_FETCH_CAP"
        for word, key, caps_, of in (("PATH", "p", p.paths, "primary_path"), ("CATEGORY", "c", p.categories, "primary_category")):
            if n(key, r[of]) >= caps_.get(r[of], (0, p.target, p.target))[k]:
                return f"{word}_{'SOFT' if k == 1 else 'HARD'}_CAP"
        return None

    def fits(r, k):
        if any(r is x for x, _ in taken):
            return False
        if why := why_not(r, k):
            blocks.setdefault(r["record_key"], set()).add(why)
        return not why

    def first(pool, k, why):
        for r in pool:
            if fits(r, k):
                taken.append((r, why))
                for key in (("j", r["journal_slug"]), ("t", r["journal_slug"], r["topic_signature"]), ("p", r["primary_path"]), ("c", r["primary_category"])):
                    counts[key] = counts.get(key, 0) + 1
                return True
        return False

    def fill(pools, k, why):
        while len(taken) < p.target and sum(first(pools[x], k, why) for x in p.paths if len(taken) < p.target):
            pass

    order = list(p.paths)
    sources = [r for r in rows if r["route"] in p.sources and r["primary_path"] in p.paths]
    of = lambda pool: {x: turns([r for r in pool if r["primary_path"] == x]) for x in order}
    for c, (floor, _, _) in p.categories.items():
        pool = turns([r for r in sources if r["primary_category"] == c], lambda r: order.index(r["primary_path"]))
        while n("c", c) < floor and first(pool, 1, f"CATEGORY_FLOOR:{c}"):
            pass
    pools = of(sources)
    for x, (floor, _, _) in p.paths.items():
        while n("p", x) < floor and first(pools[x], 1, f"PATH_FLOOR:{x}"):
            pass
    fill(pools, 1, "BALANCED_SOFT_FILL")
    fill(pools, 2, "BALANCED_HARD_FILL")
    spare = [r for r in rows if r["route"] == "RESERVE" and r["primary_path"] in p.paths]
    fill(of(spare), 2, "PREFETCH_RESERVE_BACKFILL")
    for r in rows:
        if r["route"] != "CATALOG_ONLY" and fits(r, 2):
            blocks.setdefault(r["record_key"], set()).add("FETCH_NOW_GLOBAL_TARGET")
    held, journal, topic = [], {}, {}
    for route in ("FETCH_CANDIDATE", "RESERVE"):
        left = [r for r in rows if r["route"] == route and all(r is not x for x, _ in taken)]
        for r in [y for x in order for y in turns([r for r in left if r["primary_path"] == x])] + turns([r for r in left if r["primary_path"] not in p.paths]):
            j, k = r["journal_slug"], (r["journal_slug"], r["topic_signature"])
            if len(held) < p.hold_target and journal.get(j, 0) < p.hold_caps_by_mode.get(r["processing_mode"] or "FULL", 0) and topic.get(k, 0) < p.hold_topic_cap:
                held.append(r["record_key"])
                journal[j], topic[k] = journal.get(j, 0) + 1, topic.get(k, 0) + 1
    return [(r["record_key"], why) for r, why in taken], held, {k: v for k, v in blocks.items() if all(r["record_key"] != k for r, _ in taken)}


@pytest.mark.parametrize(("seed", "batch", "many"), [(1, 240, 0), (2, 2, 0), (3, 240, 600)])
def test_first_shortlist_is_the_sequential_one(spark, seed, batch, many, monkeypatch):
    from recordloom.plans.policy import FirstShortlistPolicy

    rng = random.Random(seed)
    p = FirstShortlistPolicy()
    if seed == 2:
        p = FirstShortlistPolicy(target=300, hold_target=40)
    rows = []
    for i in range(many + 250):
        hot = i < many
        tokens = ["hot", "same", "title"] if hot else rng.sample("alpha beta gamma delta epsilon zeta eta theta".split(), 4)
        rows.append({
            "record_key": f"k{i:04}", "journal_slug": "hot" if hot else rng.choice("abcdefghij"), "processing_mode": "FULL" if hot else None, "route": "FETCH_CANDIDATE" if hot else rng.choice(["FETCH_CANDIDATE", "RESERVE", "CATALOG_ONLY"]),
            "primary_path": rng.choice([*p.paths, "OTHER"]), "primary_category": rng.choice(list(p.categories)), "score": 100 if hot else rng.randint(60, 99), "publication_date": 20260800 + rng.randint(1, 28), "title": f"T{i % 50}",
            "tokens": tokens, "topic_signature": "|".join(tokens[:2]), "fetchable": rng.random() < 0.9,
        })
    for r in rows:
        r["processing_mode"], r["journal"] = r["processing_mode"] or {"a": "FULL", "b": "TRIAGE", "c": "INDEX_ONLY", "d": "SUSPENDED"}.get(r["journal_slug"]), r["journal_slug"].upper()
    want, held, blocks = sequential_shortlist(rows, p)
    df = spark.createDataFrame(rows, "record_key string, journal_slug string, journal string, processing_mode string, route string, primary_path string, primary_category string, score int, publication_date int, title string, tokens array<string>, topic_signature string, fetchable boolean")
    fetches, fetch = [], select._Pools._fetch
    monkeypatch.setattr(select._Pools, "_fetch", lambda self: fetches.append(1) or fetch(self))
    got = select.first_shortlist(df, p, batch).collect()
    assert [(r["record_key"], r["reason"]) for r in sorted((r for r in got if r["ordinal"]), key=lambda r: r["ordinal"])] == want and len(want) > 20
    assert [r["record_key"] for r in sorted((r for r in got if r["hold_ordinal"]), key=lambda r: r["hold_ordinal"])] == held
    assert len(got) == len(rows) and {r["editorial_route"] for r in got} == {"FETCH_NOW", "HOLD_RESERVE", "CATALOG_ONLY"}
    assert {r["record_key"]: set(r["blocks"]) for r in got if r["blocks"] is not None} == blocks
    assert len(fetches) <= (2000 if batch == 2 else 6)  # a job a pass, and one more where near copies use up a cell



def test_pairs_by_either_key_are_gathered_for_ids_of_several_rows_alone(spark, monkeypatch):
    rng = random.Random(11)
    some = lambda n, ids: [(rng.randrange(ids), rng.choice([None, *range(6)]), rng.choice([None, "a", "b"])) for _ in range(n)]
    for left, right in ((some(60, 40), some(80, 50)), ([(i, i % 5, "a") for i in range(30)], [(i, i % 5, "b" if i % 3 else "a") for i in range(30)] * 2)):
        x, y = spark.createDataFrame(left, "l int, a int, b string"), spark.createDataFrame(right, "r int, c int, d string")
        made = joins.either_key(x, y, [("a", "c"), ("b", "d")], "l", "r")
        want = sorted({(i, j) for i, a, b in left for j, c, d in right if (a is not None and a == c) or (b is not None and b == d)})
        assert made.columns == ["l", "r"] and sorted(tuple(r) for r in made.collect()) == want
    # Here each id has one row, so the grouping of pairs at the end gets none.
    gathered = []
    distinct = type(x).distinct
    monkeypatch.setattr(type(x), "distinct", lambda df: (gathered.append(df.count()) if df.columns == ["__x", "__y"] else None) or distinct(df))
    joins.either_key(x, y, [("a", "c"), ("b", "d")], "l", "r")
    assert gathered == [0]


def test_resolution_gathers_no_table_on_the_driver(spark, monkeypatch):
    seen, linked = [], identity.connected_components
    monkeypatch.setattr(identity, "connected_components", lambda edges: seen.append(edges) or linked(edges))
    df = record_queries._articles(lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet"))
    for made in (identity.deduplicate(df), seen[0]):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    # The aliases' Python functions ran before, once.
    assert "EvalPython" not in plan


def test_component_rounds_broadcast_hubs_alone(spark, monkeypatch):
    plans, write = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    assert connected_components(spark.range(9).selectExpr("id a", "id + 1 b")).agg(F.max("component")).first()[0] == 0
    # A large star meets hubs thrice by broadcast (once for each direction of an edge to leave them out) and the rest once; the small star's join comes on top.
    assert len(plans) > 1 and all(0 < p.count("BroadcastHashJoin") == 3 * (p.count("SortMergeJoin") - 1) for p in plans[1:])


def test_lookup_beyond_the_bound_is_shuffled(spark):
    left, right = spark.range(10), spark.range(5)
    for most, kind in ((5, "BroadcastHashJoin"), (4, "SortMergeJoin")):
        joined = left.join(joins.small(right, most), "id")
        assert kind in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 5
