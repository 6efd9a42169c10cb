import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

import __spark_entry__ as entry
from recordloom.llm import divergence
from tests.compare import same
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    assert same(spark, entry, "op12_divergence", f"/root/testdata/{sf}") > 100


def brute(rows, least=30, shown=50):
    n, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        said = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n[lang, source].update(said)
        held[lang].update(set(said))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, c in held[lang].items() if c >= least]
        share = lambda c, kept=kept: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        own = {s: share(n[lang, s]) for x, s in groups if x == lang}
        q = share(sum((n[lang, s] for s in own), Counter()))
        for s, p in own.items():
            parts = {"pair": [(sum(abs(p[t] - r[t]) for t in kept), o) for o, r in own.items() if o != s], "term": [(p[t] - q[t], t) for t in kept if n[lang, s][t] and p[t] > q[t]]}
            for part, found in parts.items():
                for k, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or k <= shown:
                        out.append((lang, s, part, item, value, k))
    return sorted(out)


def test_small_tables_equal_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)] + ["Äß", "äß", "漢字", "😀x", "É"]
    rows = [(" ".join(rng.choice(words[: rng.choice([5, 85])]).upper() if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "de", None, "fr"]), rng.choice(["a", "a", "b", "é", "z", None, ""])) for _ in range(400)]
    rows += [(None, "xx", "a"), ("", "xx", "b"), ("12 3", "en", "no terms"), *rows[:40]]
    docs = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], "text string, lang string, source string, n int, term string, p int")
    for least, shown in ((30, 50), (3, 4)):
        got = divergence.audit(docs, least, shown)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, shown)


def test_odd_rows_and_no_rows(spark):
    rows = [(r[1], r[2], r[3]) for r in cases.rows()]
    assert sorted(tuple(r) for r in divergence.audit(cases.documents(spark), 1).collect()) == brute(rows, 1)
    got = divergence.audit(cases.nothing(spark))
    assert got.collect() == [] and got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_shares_are_exact_beyond_what_doubles_hold(spark):
    groups = spark.createDataFrame([("en", "a", 1), ("en", "b", 2)], "lang string, source string, g long")
    counts = spark.createDataFrame([(1, "x", 9_007_199_254_740_993, 40), (1, "y", 7, 40), (2, "x", 10**16 + 1, 40)], "g long, term string, n long, docs long")
    got = {(r["source"], r["term"]): r["p"] for r in divergence.shares(groups, counts).collect()}
    for s, c in (("a", {"x": 9_007_199_254_740_993, "y": 7}), ("b", {"x": 10**16 + 1, "y": 0})):
        assert all(got[s, t] == 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 10) for t in "xy")


def test_terms_of_a_task_are_counted_without_a_row_each(spark, monkeypatch):
    rng = random.Random(9)
    pieces = ["Ab", "ab", "É", "é", "漢字", "😀", " ", "-", "1", "\x00", "\x7f", "{", "@", "[", "`", "x" * 300]
    texts = ["", "a", "A", "b ", " b", *("".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(300)), "", "a"]
    groups = [rng.choice([3, 8, 11]) for _ in texts]
    n, docs = Counter(), Counter()
    for g, t in zip(groups, texts, strict=True):
        said = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        n.update((g, w) for w in said)
        docs.update((g, w) for w in set(said))
    batch = pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(texts)], names=["g", "text"])
    for most in (1, 500, divergence.SLICE):
        got, seen, rows = Counter(), Counter(), 0
        for part in divergence._slices([batch.slice(0, 100), batch.slice(100), batch.slice(0, 0)], most):
            rows += part.num_rows
            for g, term, a, b in zip(*(c.to_pylist() for c in divergence._counted(part).columns), strict=True):
                got[g, term] += a
                seen[g, term] += b
        assert (got, seen, rows) == (n, docs, len(texts))
    plans = []
    cut = divergence.cut
    monkeypatch.setattr(divergence, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    counts = divergence.term_counts(spark.createDataFrame([("a b A", "en", "s"), ("a", "en", "s")], "text string, lang string, source string"))[1]
    assert sorted((r["term"], r["n"], r["docs"]) for r in counts.collect()) == [("a", 3, 2), ("b", 1, 1)]
    assert any("MapInArrow" in p for p in plans) and not any("Generate" in p for p in plans)
