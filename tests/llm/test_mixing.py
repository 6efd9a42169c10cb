import random
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from recordloom.llm import mixing
from tests.llm import cases

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights=(1, 2, 3), most=3):
    """Targets by resharing what is above, round by round; None sorts last."""
    keys = sorted(sizes, key=lambda k: (k is None, (k or "").encode()))
    w = {k: weights[i % len(weights)] for i, k in enumerate(keys)}
    total, capped = sum(sizes.values()), set()
    if not total:
        return dict.fromkeys(keys, 0.0)
    while True:
        rest = total - sum(most * sizes[k] for k in capped)
        free = sum(w[k] for k in keys if k not in capped)
        made = {k: most * sizes[k] if k in capped else rest * w[k] / free for k in keys}
        over = {k for k in keys if k not in capped and made[k] > most * sizes[k]}
        if not over:
            return made
        capped |= over


def hashed(seed, *values):
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return h


def settled(items, seed):
    """The pairing in plain Python: ((id, up), ...) in order, and what is left (id, x)."""
    out, left = [], None
    for h, i, size, x in items:
        if left is None:
            left = (h, i, size, x)
            continue
        rh, ri, rs, rx = left
        up, down = min(rs * (1 - rx), size * x), min(rs * rx, size * (1 - x))
        rises = (hashed(seed, rh, h) >> 11) / (1 << 53) * (up + down) < down
        words = up if rises else -down
        if rs * (1 - rx) <= size * x if rises else rs * rx <= size * (1 - x):
            out.append((ri, int(rises)))
            left = (h, i, size, x - words / size)
        else:
            out.append((i, int(not rises)))
            left = (rh, ri, rs, rx + words / rs)
        if left[3] < mixing.NEAR or left[3] > 1 - mixing.NEAR:
            out.append((left[1], int(left[3] > 0.5)))
            left = None
    return out, left and (left[1], left[3])


def test_settling_is_the_plain_pairing(spark):
    rng = random.Random(3)
    rows = [(g, rng.randrange(-(1 << 62), 1 << 62), i, i, rng.choice([1, 2, 2, 5, 40, 900]), x) for g in range(12) for x in [rng.random()] for i in range(rng.choice([1, 2, 3, 50]))]
    df = spark.createDataFrame(rows, "g long, h long, doc_id long, t long, size long, x double")
    item = F.struct((-F.col("size")).alias("o"), "h", "doc_id", "t", "size", "x").alias("u")
    got = mixing._settle_groups(df.select("g", item), ["g"], 5).collect()
    assert len(got) == 12
    for r in got:
        items = sorted((-s, h, d, x) for g, h, d, _, s, x in rows if g == r["g"])
        out, left = settled([(h, d, -s, x) for s, h, d, x in items], 5)
        assert [(s["doc_id"], s["up"]) for s in r["settled"]] == out
        assert (r["left"] is None) == (left is None)
        if left:
            assert r["left"]["doc_id"] == left[0] and r["left"]["x"] == pytest.approx(left[1])


def test_a_source_takes_its_target_to_within_a_document_and_expectations_stay(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.choice([0, 1, 3, 10, 30, 300]), "abcd"[min(3, i % 7)] if i % 11 else None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").persist()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t))
    want = shares(sizes)
    taken, runs = Counter(), 6
    for seed in range(runs):
        got = mixing.mix(docs, seed=seed).collect()
        assert len(got) == len(rows)
        by = Counter()
        for r in got:
            x = want[r["source"]] / sizes[r["source"]]
            assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
            assert r["copies"] - x < 1 and x - r["copies"] < 1 and r["copies"] <= 3
            by[r["source"]] += r["copies"] * r["size"]
            taken[r["source"], r["doc_id"] % 5] += r["copies"] * r["size"]
        assert all(abs(by[s] - want[s]) <= 300 for s in sizes)
    # No part of a source is preferred: its expectation is its share, whatever the draws.
    part = Counter()
    for i, t, s in rows:
        part[s, i % 5] += len(WORD.findall(t))
    for k, n in part.items():
        assert taken[k] / runs == pytest.approx(n * want[k[0]] / sizes[k[0]], rel=0.15)


def test_small_documents_end_a_source(spark):
    rows = [(i, "w " * (5000 if i < 8 else 2), "ab"[i % 2]) for i in range(20_000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("n")).collect()
    assert all(abs(r["n"] - r["target"]) <= 4 for r in got)


def test_reruns_agree_however_rows_are_partitioned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.filter("doc_id % 3 = 0")).unionByName(docs.limit(1)).withColumn("source", F.expr("if(doc_id % 4 = 0, null, source)"))
    once = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    again = sorted(map(tuple, mixing.mix(docs.repartition(7, "n_chars")).collect()), key=str)
    assert once == again and len(once) == docs.count()


def test_targets_stop_at_three_times(spark):
    sizes = {"a": 10, "b": 1, "c": 2, "d": 1000, "é": 5, "z": 0, "￿": 7, "𐀀": 9, None: 3}
    counts = spark.createDataFrame([(k, 1, 1, v, 1) for k, v in sizes.items()], "key string, doc_id long, t long, size long, rows long")
    got = {None if r["g"] == "b" else r["g"][1:]: r["target"] for r in mixing.targets(counts).collect()}
    want = shares(sizes)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_odd_rows_and_no_rows(spark):
    got = mixing.mix(cases.documents(spark)).collect()
    assert len(got) == len(cases.rows()) and {r["source"] for r in got} == {None}
    assert all(r["copies"] * r["size"] == r["size"] for r in got)  # one source takes all of itself once
    assert mixing.mix(cases.nothing(spark)).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, " \t", None)], "doc_id long, text string, source string")
    assert [(r["copies"] * r["size"], r["target"]) for r in mixing.mix(blank).collect()] == [(0, 0.0)] * 2


def test_the_mixture_holds_each_row_as_often_as_it_is_taken(spark):
    docs = spark.createDataFrame([(i % 5, "w " * (i % 5 + 1), "ab"[i % 2 if i < 8 else 0], i) for i in range(40)], "doc_id long, text string, source string, other int")
    mixed = mixing.mix(docs)
    made = mixing.mixture(docs, mixed)
    want, got = defaultdict(int), Counter((r["source"], r["doc_id"]) for r in made.collect())
    for r in mixed.collect():
        want[r["source"], r["doc_id"]] += r["copies"]
    assert got == {k: n for k, n in want.items() if n} and made.columns == [*docs.columns, "copy"]


def test_the_query_is_native_and_whole(spark):
    got = entry.queries()["op11_mixing"](spark, SF)
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().executedPlan().toString())
    rows = {r["doc_id"]: r for r in got.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sizes, of = Counter(), {}
    for r in docs:
        n = len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += n
        of[r["doc_id"]] = (n, r["source"])
    want = shares(sizes)
    assert rows.keys() == of.keys()
    for i, r in rows.items():
        n, s = of[i]
        assert (r["size"], r["source_size"]) == (n, sizes[s]) and r["target"] == pytest.approx(want[s])
        assert r["taken"] % max(1, n) == 0 and r["taken"] <= 3 * n
