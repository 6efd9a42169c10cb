"""Scores and discoveries worked out again, one text and one symbol at a time."""

import math
import random
import re

import pytest

from recordloom.llm import secrets, toxicity
from tests.llm import cases

LETTERS = re.compile(r"[^\W\d_]+")


def plain_features(text, lexicon):
    """The features of a text, counted word by word."""
    text = text or ""
    said = LETTERS.findall(text)
    low = [w.lower() for w in said]
    n = max(1, len(said))

    def strength(w):
        known = [lexicon[e] for e in (w, *(w[:k] + "*" for k in (4, 5, 6) if len(w) > k)) if e in lexicon]
        return max(known) if known else 3.0 if w in toxicity.SEED_WORDS else 0.0

    hit = [i for i, w in enumerate(low) if strength(w) > 0]
    you = [i for i, w in enumerate(low) if w in toxicity.SECOND]
    near = sum(1 for i in hit if any(abs(i - j) <= 4 for j in you))
    seeds = sum(1 for i in hit if low[i] in toxicity.SEED_WORDS)
    odd = [w.strip(".,;:!?\"'()[]") for w in text.split() if not w.isalpha() and re.search(r"[^\W\d_][0-9@$*!._-]+[^\W\d_]", w)]
    leet = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "_": "", "-": ""}
    hidden = sum(1 for w in odd if strength("".join(leet.get(c, c) for c in w.lower())) > 0)
    strengths = [strength(low[i]) for i in hit]
    per = lambda chars: sum(c in chars for c in text) / max(1, len(text))
    return [
        len(hit), len(hit) / n, len({low[i] for i in hit}), seeds, seeds / n, max(strengths, default=0.0), sum(strengths) / max(1, len(hit)), near, len(you) / n,
        sum(w[0].isupper() for w in said) / n, sum(w.isupper() for w in said) / n, per("!"), per(".,;:?'\""), per("#$%&*@^~|"),
        len(odd) / n, len(re.findall(r"([^\W\d_])\1{3,}", text)) / n, hidden, math.log1p(len(said)), sum(said[i].isupper() for i in hit),
    ]


def plain_score(x, trees):
    """One row down each tree, then the straight line between two knots."""
    f = trees.start
    for tree in trees.trees:
        k = 0
        while tree[k][0] is not None:
            j, cut, left, right = tree[k]
            k = left if sum(e <= x[j] for e in trees.edges[j]) <= cut else right
        f += tree[k][1]
    at, rate = trees.knots
    if f <= at[0]:
        return rate[0]
    if f >= at[-1]:
        return rate[-1]
    k = max(i for i in range(len(at)) if at[i] <= f)
    return rate[k] + (rate[k + 1] - rate[k]) * (f - at[k]) / (at[k + 1] - at[k])


def test_toxicity_is_lexicon_trees_and_knots(spark):
    model = toxicity.model_of(spark, "/root/testdata/sf0.01")
    assert model.read.lexicon and model.trees.trees
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").limit(250)
    some = docs.union(cases.documents(spark).select("doc_id", "text").filter("doc_id is not null").selectExpr("doc_id - 1000", "text"))
    odd = [(-1, "You ARE an id10t and a St*pid L.O.S.E.R!!! scum, tu idiot sooooo"), (-2, "ÉCOLE l'idiot moron@home m0ron $cum")]
    some = some.union(spark.createDataFrame(odd, "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in some.collect()}
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(some, model).collect()}
    assert len(got) == len(texts) > 200 and len({round(v, 6) for v in got.values()}) > 2
    for i, text in texts.items():
        x = plain_features(text, model.read.lexicon)
        assert model.read(text) == pytest.approx(x), i
        assert got[i] == pytest.approx(plain_score(x, model.trees)), i


def normal(z):
    return 1 / (1 + math.exp(-(1.5976 * z + 0.07056 * z**3)))


def discoveries(text):
    """(start, end) of the tokens that the three tests and the Benjamini-Hochberg rule let through."""
    tests = []
    for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text):
        said = m[0]
        if not (re.search("[0-9]", said) and re.search("[A-Za-z]", said)):
            continue
        letters = next((a for form, a in secrets.ALPHABETS if re.fullmatch(form[1:-1], said)), secrets.BASE64)
        plain = said.replace("-", "+").replace("_", "/") if letters == secrets.BASE64 else said
        at = [letters.index(c) for c in plain if c in letters]
        n, size = len(at), len(letters)
        if n < secrets.LEAST_SECRET:
            continue
        chi = sum((at.count(s) - n / size) ** 2 / (n / size) for s in range(size))
        even = 1 - normal((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))
        sides = [v >= size / 2 for v in at]
        high, runs = sum(sides), 1 + sum(a != b for a, b in zip(sides, sides[1:], strict=False))
        expected = 1 + 2 * high * (n - high) / n
        variance = (expected - 1) * (expected - 2) / (n - 1)
        of_runs = 2 * normal(-abs((runs - expected) / math.sqrt(variance))) if variance > 0 else 0.0
        mean = sum(at) / n
        spread = sum((v - mean) ** 2 for v in at)
        lagged = sum((a - mean) * (b - mean) for a, b in zip(at, at[1:], strict=False))
        serial = 2 * normal(-abs((lagged / spread + 1 / n) * math.sqrt(n))) if spread > 0 else 0.0
        half = -sum(math.log(max(v, 1e-12)) for v in (even, of_runs, serial))
        habit = size * max(secrets.COINCIDENCE, 1.6 / size)
        p = normal((chi - (size - 1) - (n - 1) * (habit - 1)) / math.sqrt(2 * (size - 1) * habit))
        tests.append((p, math.exp(-half) * (1 + half + half * half / 2), m.start(), m.end()))
    level = max([-1.0, *(secrets.LEVEL * j / len(tests) for j, p in enumerate(sorted(t[0] for t in tests), 1) if p <= secrets.LEVEL * j / len(tests))])
    return [(s, e) for p, fits, s, e in tests if p <= level and fits >= secrets.CONSISTENT]


def test_discoveries_are_those_of_the_plain_battery(spark):
    rng = random.Random(12)
    kinds = [secrets.BASE64, "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdefghijklmnopqrstuvwxyz", "abc123"]

    def token():
        letters = rng.choice(kinds)
        return rng.choice(["".join(rng.choice(letters) for _ in range(rng.choice([20, 24, 32, 48, 80]))), "chapter-one-of-the-book-2024", "averylongwordofmanyletters2", "aaaaaaaaaaaaaaaaaaaa1"])

    texts = [" 😀 ".join(token() for _ in range(rng.randint(0, 6))) for _ in range(250)]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    found = 0
    for i, text in enumerate(texts):
        base = [tuple(map(int, s.split(":")[1:])) for s in got[i].split(",") if s and not s.startswith("random")]
        want = [(s, e) for s, e in discoveries(text) if not any(a <= s and b >= e for a, b in base)]
        assert [tuple(map(int, s.split(":")[1:])) for s in got[i].split(",") if s.startswith("random")] == want
        found += len(want)
    assert found > 100
