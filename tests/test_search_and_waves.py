import random

from pyspark.sql import functions as F

from recordloom.operators import textindex, waves


def test_index_gives_what_a_scan_gives_and_reads_no_other_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "BLOCK", 16)
    rng = random.Random(9)
    words = ["alpha", "Alphabet", "ﬁne", "fine", "STRASSE", "straße", "beta", "a%b_c", "漢字仮名", "xx"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 5))), rng.choice([None, "Beta", "gamma"])) for i in range(300)]
    path = f"file://{tmp_path}/i"
    textindex.build(spark.createDataFrame(rows, "id int, title string, other string"), ["title", "other"], ["id"], path)
    for needle in ("alpha", "ALPHAB", "fine", "strasse", "a%b", "漢字仮", "a", "", "no such text", "ta gamma", "beta beta"):
        want = sorted(i for i, t, o in rows if textindex.fold(needle) in textindex.fold(" ".join(x for x in (t, o) if x is not None)))
        made = textindex.search(spark, path, needle)
        assert sorted(r["id"] for r in made.collect()) == want, needle
        assert made.columns == ["id", "title", "other", "at"]
    made = textindex.search(spark, path, "ta gamma")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "block" in plan.split("PartitionFilters")[1][:300]  # texts of other blocks aren't opened
    longest = spark.read.parquet(f"{path}/postings").agg(F.max(F.size("steps"))).first()[0]
    assert longest <= 16


def test_waves_ask_only_for_what_is_left(spark):
    asked = {"A": [], "B": [], "C": []}

    def source(name, answers):
        def ask(df):
            keys = [r["record_key"] for r in df.collect()]
            asked[name] += keys
            said = [(k, *answers[k]) for k in keys if k in answers]
            return spark.createDataFrame(said, "record_key string, status string, payload string")

        return ask

    plan = spark.createDataFrame([("r1", 1, "x"), ("r2", 2, "x"), ("r3", 3, None), ("r4", 4, "x"), ("r5", 5, None)], "record_key string, ordinal int, pmcid string")
    has = F.col("pmcid").isNotNull()
    sources = [
        waves.Source("A", has, source("A", {"r1": ("FOUND", "one"), "r2": ("NO_ROUTE", None)}), budget=2),
        waves.Source("B", F.lit(True), source("B", {"r2": ("FAILED", None), "r3": ("FOUND", "three"), "r4": ("ACCESS_DENIED", None)})),
        waves.Source("C", has, source("C", {"r2": ("FOUND", "two")})),
    ]
    receipts, attempts = waves.fetch(plan, sources, waves.FULLTEXT_STATES, "SKIPPED_NO_FULLTEXT_SOURCE")
    assert {r["record_key"]: (r["status"], r["source"], r["payload"]) for r in receipts.collect()} == {
        "r1": ("FULLTEXT_ACQUIRED", "A", "one"), "r2": ("FULLTEXT_ACQUIRED", "C", "two"), "r3": ("FULLTEXT_ACQUIRED", "B", "three"), "r4": ("FULLTEXT_ACCESS_DENIED", None, None), "r5": ("FULLTEXT_NOT_FOUND", None, None),
    }
    assert {k: sorted(v) for k, v in asked.items()} == {"A": ["r1", "r2"], "B": ["r2", "r3", "r4", "r5"], "C": ["r2", "r4"]}
    assert {(r["record_key"], r["wave"]): r["status"] for r in attempts.collect()}[("r4", 1)] == "DEFERRED"
    assert sorted(tuple(r) for r in waves.requests(attempts).collect()) == [(1, "A", 2, 1, 1), (2, "B", 4, 1, 0), (3, "C", 2, 1, 0)]
    none = waves.fetch(plan.filter(~has), sources[:1], waves.ABSTRACT_STATES, "SKIPPED_NO_IDENTIFIER")[0]
    assert {r["status"] for r in none.collect()} == {"SKIPPED_NO_IDENTIFIER"}
