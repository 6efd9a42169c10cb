import datetime as dt
import random

from pyspark.sql import functions as F

from recordloom.operators import coverage, intervals, joins
from recordloom.plans import record_queries, table_queries  # noqa: F401

DAY = dt.timedelta(days=1)
FIRST = dt.date(2026, 1, 1)


def test_islands_gaps_and_months_are_those_of_the_days(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abc"), FIRST + DAY * (s := rng.randrange(300)), FIRST + DAY * (s + rng.choice([-2, 0, 1, 5, 40]))) for _ in range(60)] + [("d", FIRST, None), ("a", None, FIRST)]
    days = {}
    for g, s, e in rows:
        if s and e and s <= e:
            days.setdefault(g, set()).update(s + DAY * i for i in range((e - s).days + 1))
    covered = coverage.islands(spark.createDataFrame(rows, "g string, start date, end date"), ["g"])
    want = sorted((g, s, e) for g, ds in days.items() for s in ds if s - DAY not in ds for e in [next(x for x in (s + DAY * i for i in range(500)) if x + DAY not in ds)])
    assert sorted((r["g"], r["start"], r["end"]) for r in covered.collect()) == want
    assert covered.agg(F.sum("windows")).first()[0] == sum(1 for _, s, e in rows if s and e and s <= e)
    missing = sorted((g, min(ds) + DAY * i) for g, ds in days.items() for i in range((max(ds) - min(ds)).days) if min(ds) + DAY * i not in ds)
    assert sorted(tuple(r) for r in coverage.missing_days(covered, ["g"]).collect()) == missing
    for r in coverage.months(covered, ["g"]).collect():
        n = sum((d.year, d.month) == (r["month"].year, r["month"].month) for d in days[r["g"]])
        whole = ((r["month"] + DAY * 31).replace(day=1) - r["month"]).days
        assert (r["days"], r["flag"]) == (n, "COMPLETE" if n == whole else "PARTIAL")
    registry = spark.createDataFrame([("a",), ("zz",)], "g string")
    assert {r["g"]: r["flag"] for r in coverage.registry_months(registry, covered, "g", "2026-02-01").collect()}["zz"] == "NONE"


def test_overlap_join_is_the_plain_condition(spark, monkeypatch):
    rng = random.Random(7)
    some = lambda n, lengths: [(i, FIRST + DAY * (s := rng.randrange(-900, 900)), FIRST + DAY * (s + rng.choice(lengths))) for i in range(n)]
    left, right = some(150, [0, 0, 1, 30, 365, -1]), some(120, [0, 6, 31, 366, 3000, 40_000])
    left += [(999, None, FIRST)]
    x, y = spark.createDataFrame(left, "i int, a date, b date"), spark.createDataFrame(right, "j int, c date, d date")
    want = sorted((i, j) for i, a, b in left if a and a <= b for j, c, d in right if c <= d and a <= d and c <= b)
    for most in (joins.MAX_BROADCAST, 0):
        monkeypatch.setattr(intervals, "small", lambda df, most=most: joins.small(df, most))
        made = intervals.overlap_join(x, y, ("a", "b"), ("c", "d"))
        assert sorted((r["i"], r["j"]) for r in made.collect()) == want
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert made.columns == ["i", "a", "b", "j", "c", "d"]
    widest = intervals._listed(y, "c", "d", "y").groupBy("j").count().agg(F.max("count")).first()[0]
    assert widest <= 2 * len(intervals.WIDTHS)


def test_totals_of_editions_meet_by_period_and_never_by_row(spark, monkeypatch):
    rng = random.Random(8)
    articles = [(i, rng.choice([None, FIRST, FIRST + DAY * rng.randrange(60)]), rng.choice(["DAY", "MONTH", "YEAR", "ODD"])) for i in range(300)]
    editions = [(i % 90, s := FIRST + DAY * rng.randrange(50), s + DAY * rng.choice([-1, 0, 6, 400])) for i in range(100)] + [(900, None, FIRST), (901, FIRST - DAY * 900, FIRST - DAY * 800)]
    x, y = spark.createDataFrame(articles, "i int, day date, kind string"), spark.createDataFrame(editions, "j int, c date, d date")
    met, rows = intervals.overlap_join, []
    monkeypatch.setattr(intervals, "overlap_join", lambda a, b, *ends: rows.append((a.count(), b.count())) or met(a, b, *ends))
    totals = {"n": (F.count(F.lit(1)), F.sum), "first": (F.min("i"), F.min), "keys": (F.sum("i"), F.sum)}
    made = intervals.dated_totals(x, y, "day", "kind", "c", "d", totals)
    assert made.columns == ["j", "c", "d", "n", "first", "keys"]
    pairs = intervals.dated_in(x, y, "day", "kind", "c", "d").groupBy("j", "c", "d", "i").count().collect()
    copies, want = {}, {}
    for j, c, d in editions:
        copies[j, c, d] = copies.get((j, c, d), 0) + 1
    for p in pairs:
        n, first, keys = want.get((p["j"], p["c"], p["d"]), (0, 10**6, 0))
        want[p["j"], p["c"], p["d"]] = (n + 1, min(first, p["i"]), keys + p["i"])
    assert sorted(tuple(r) for r in made.collect()) == sorted((*e, *t) for e, t in want.items() for _ in range(copies[e]))
    assert rows[0][0] <= 60 + 12 + 1 and rows[0][1] == len({e[1:] for e in editions})


def test_edition_matches_makes_no_pair_of_an_article_and_an_edition(spark, monkeypatch):
    met, rows = intervals.overlap_join, []
    monkeypatch.setattr(intervals, "overlap_join", lambda a, b, *ends: rows.append((a.count(), a.select("__from", "__to").distinct().count())) or met(a, b, *ends))
    table_queries.QUERIES["edition_matches"](spark, "/root/testdata/sf0.001").count()
    assert rows[0][0] == rows[0][1]
