"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learned from training texts: words, and word beginnings of four to
six letters, that stand in toxic texts far more often than elsewhere, beside a
few public ones. Features are the densities of lexicon hits, their nearness to
the second person, capitals, punctuation and obfuscation. Trees of up to eight
leaves are boosted on histograms; isotonic regression on a part of the sample
that the trees haven't seen turns their sums into probabilities.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.sampling import fold, labelled
from recordloom.llm.tables import map_texts, table

#: Labelled documents that lexicon and model are fitted on, at most about; lexicon entries at most.
SAMPLE, ENTRIES = 12_000, 400
#: Toxic texts, likelihood ratio and log-odds that an entry needs.
LEAST_TEXTS, LEAST_RATIO, LEAST_ODDS = 4, 20.0, 2.0
TREES, DEPTH, RATE, BINS, LEAST = 80, 3, 0.2, 64, 8
#: Insults known from public word lists.
SEED_WORDS = frozenset("idiot moron stupid loser scum trash clown pathetic worthless disgusting imbecile dumb jerk".split())
#: Second-person words of English, German, French and Spanish.
SECOND = frozenset("you your yours yourself u du dich dir dein deine euch euer ihr tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
FEATURES = (
    "hits", "hit_density", "distinct_hits", "seed_hits", "seed_density", "strength", "mean_strength", "near_second", "second", "capitals", "upper_words",
    "bangs", "punctuation", "symbols", "mixed_words", "stretched", "disguised_hits", "log_words", "hit_in_capitals",
)
_WORDS = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"[^\W\d_][0-9@$*!._-]+[^\W\d_]")
_STRETCH = re.compile(r"([^\W\d_])\1{3,}")
_EDGES = ".,;:!?\"'()[]"
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, ".": None, "_": None, "-": None})
BEGINNINGS = (4, 5, 6)


def entries(word: str) -> list[str]:
    """What the lexicon may know a word by: itself, and its beginnings marked by a star."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def learn_lexicon(sample: DataFrame, most: int = ENTRIES) -> dict[str, float]:
    """Log-odds by entry, from rows (text, y); a text that repeats counts once.

    Each task counts the texts that hold an entry; the counts are summed by
    entry, and at most ``most`` entries reach the driver, strongest first (by
    likelihood ratio, then name), none that chance would put among thousands.
    """
    once = sample.groupBy(F.xxhash64("text").alias("t"), "y").agg(F.first("text").alias("text"))
    total = {r["y"]: r["n"] for r in once.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    if not n1 or not n0:
        return {}

    def count(batches):
        import pyarrow as pa

        seen: tuple[Counter, Counter] = Counter(), Counter()

        def out():
            names = list(seen[0].keys() | seen[1].keys())
            made = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([s[x] for x in names], pa.int64()) for s in seen)], names=["entry", "k0", "k1"])
            for s in seen:
                s.clear()
            return made

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(_WORDS.findall((text or "").lower()))
                seen[y].update({e for w in words for e in entries(w)})
                if len(seen[0]) + len(seen[1]) > 400_000:
                    yield out()
        yield out()

    sums = once.select("text", "y").mapInArrow(count, "entry string, k0 long, k1 long").groupBy("entry").agg(F.sum("k0").alias("k0"), F.sum("k1").alias("k1"))
    k0, k1, rate = F.col("k0"), F.col("k1"), n1 / (n0 + n1)
    odds = F.log((k1 + 0.5) / (n1 - k1 + 0.5)) - F.log((k0 + 0.5) / (n0 - k0 + 0.5))
    part = lambda k, share: F.when(k > 0, k * F.log(k / ((k0 + k1) * share))).otherwise(0.0)
    ratio = 2 * (part(k1, rate) + part(k0, 1 - rate))
    best = sums.select("entry", "k1", odds.alias("odds"), ratio.alias("ratio")).filter((F.col("k1") >= LEAST_TEXTS) & (F.col("ratio") >= LEAST_RATIO) & (F.col("odds") >= LEAST_ODDS))
    rows = best.orderBy(F.desc("ratio"), "entry").limit(most).collect()
    return {r["entry"]: r["odds"] for r in rows}


class Reader:
    """Features of whole texts, by a lexicon."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self.heads = {e[:4] for e in [*lexicon, *SEED_WORDS]}

    def strength(self, word: str) -> float:
        known = [self.lexicon[e] for e in entries(word) if e in self.lexicon]
        return max(known) if known else 3.0 if word in SEED_WORDS else 0.0

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        said = _WORDS.findall(text)
        n = len(said)
        words = " ".join(said).lower().split(" ") if said else []
        heads = self.heads
        hits = [(i, s) for i, w in enumerate(words) if (w[:4] in heads or w in heads) and (s := self.strength(w))]
        near = second = 0
        you = [i for i, w in enumerate(words) if w in SECOND]
        second = len(you)
        if hits and you:
            at = np.array(you)
            near = sum(int(np.abs(at - i).min() <= 4) for i, _ in hits)
        seeds = sum(words[i] in SEED_WORDS for i, _ in hits)
        odd = [w.strip(_EDGES) for w in text.split() if not w.isalpha() and _ODD.search(w)]
        hidden = sum(1 for w in odd if self.strength(w.lower().translate(_LEET)) > 0)
        size = max(1, len(text))
        strengths = [s for _, s in hits]
        capitals = sum(map(str.isupper, said))
        return [
            float(len(hits)), len(hits) / max(1, n), float(len({words[i] for i, _ in hits})), float(seeds), seeds / max(1, n),
            max(strengths, default=0.0), sum(strengths) / max(1, len(hits)), float(near), second / max(1, n),
            sum(w[0].isupper() for w in said) / max(1, n), capitals / max(1, n), text.count("!") / size,
            sum(map(text.count, ".,;:?'\"")) / size, sum(map(text.count, "#$%&*@^~|")) / size,
            len(odd) / max(1, n), len(_STRETCH.findall(text)) / max(1, n), float(hidden), float(np.log1p(n)),
            float(sum(said[i].isupper() for i, _ in hits)),
        ]


class Trees:
    """Boosted trees on binned features, calibrated."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0) for c in x.T]
        self.trees: list[list[tuple]] = []
        self.start, self.knots = 0.0, (np.array([0.0]), np.array([0.5]))
        if not len(y) or y.min() == y.max():
            if len(y):
                self.knots = np.array([0.0]), np.array([float(y[0])])
            return
        b = self.bins(x)
        # The rows come in the order of a hash: every fifth calibrates.
        held = np.arange(len(y)) % 5 == 4
        if not (0 < y[held].sum() < held.sum()) or len(y) < 200:
            held = np.zeros(len(y), bool)
        rate = y[~held].mean()
        self.start = float(np.log(rate / (1 - rate)))
        bt, yt = b[~held], y[~held]
        f = np.full(len(yt), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(bt, yt - p, p * (1 - p))
            self.trees.append(tree)
            f += self._leaves(tree, bt)
        use = held if held.any() else ~held
        self.knots = self._isotonic(self.raw(b[use]), y[use])

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T, strict=True)], 1)

    @staticmethod
    def _grow(b: np.ndarray, g: np.ndarray, h: np.ndarray) -> list[tuple]:
        """Nodes (feature, bin, left, right) or (None, value); the first is the root."""
        nodes: list = []

        def node(rows: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append((None, RATE * float(g[rows].sum() / (h[rows].sum() + 1.0))))
            if depth < DEPTH and len(rows) >= 2 * LEAST:
                gr, hr = g[rows], h[rows]
                whole = gr.sum() ** 2 / (hr.sum() + 1.0)
                best, where = 1e-6, None
                for j in range(b.shape[1]):
                    c = b[rows, j]
                    cg, ch, cn = (np.bincount(c, w, BINS).cumsum()[:-1] for w in (gr, hr, None))
                    gain = cg**2 / (ch + 1.0) + (gr.sum() - cg) ** 2 / (hr.sum() - ch + 1.0) - whole
                    gain[(cn < LEAST) | (len(rows) - cn < LEAST)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, where = float(gain[k]), (j, k)
                if where:
                    low = b[rows, where[0]] <= where[1]
                    left = node(rows[low], depth + 1)
                    right = node(rows[~low], depth + 1)
                    nodes[at] = (*where, left, right)
            return at

        node(np.arange(len(g)), 0)
        return nodes

    @staticmethod
    def _leaves(tree: list[tuple], b: np.ndarray) -> np.ndarray:
        out = np.empty(len(b))
        wait = [(0, np.arange(len(b)))]
        while wait:
            k, rows = wait.pop()
            if tree[k][0] is None:
                out[rows] = tree[k][1]
            else:
                j, cut, left, right = tree[k]
                low = b[rows, j] <= cut
                wait += [(left, rows[low]), (right, rows[~low])]
        return out

    def raw(self, b: np.ndarray) -> np.ndarray:
        return self.start + sum((self._leaves(t, b) for t in self.trees), np.zeros(len(b)))

    @staticmethod
    def _isotonic(f: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pool adjacent violators: knots of sums and their rising rates, each pool counted with half a case on either side."""
        order = np.argsort(f, kind="stable")
        pools: list[list[float]] = []
        for v, t in zip(f[order].tolist(), y[order].tolist(), strict=True):
            pools.append([v, v, t, 1.0])
            while len(pools) > 1 and (pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3] or pools[-2][1] == pools[-1][0]):
                last = pools.pop()
                pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
        at, rate = [], []
        for lo, hi, ones, n in pools:
            for v in dict.fromkeys((lo, hi)):
                at.append(v)
                rate.append((ones + 0.5) / (n + 1.0))
        return np.array(at), np.maximum.accumulate(rate)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(self.bins(x)), *self.knots), 0.0, 1.0)


class Model:
    def __init__(self, lexicon: dict[str, float], trees: Trees) -> None:
        self.read, self.trees = Reader(lexicon), trees

    def score(self, texts: list[str | None]) -> np.ndarray:
        return self.trees.score(np.array([self.read(t) for t in texts]))


def fit(sample: DataFrame) -> Model:
    """A model from rows (text, y); without any, one that scores 0.5. Features and at most ENTRIES words reach the driver."""
    lexicon = learn_lexicon(sample)
    read = Reader(lexicon)
    rows = map_texts(sample.withColumn("order", F.xxhash64("text")), lambda: lambda text: (read(text),), [("x", T.ArrayType(T.DoubleType()))], keep=("order", "y")).collect()
    rows.sort(key=lambda r: (r["order"], r["y"]))
    return Model(lexicon, Trees(np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES)), np.array([r["y"] for r in rows], float)))


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` with ``score``, from 0 to 1.

    Null and empty texts are scored as texts without words, and very long ones
    whole. Repeated rows are each returned with the same score, an empty table
    gives none, and columns outside ``keep`` are ignored. Without labels of both
    kinds to learn from, every score is the same.
    """
    return map_texts(docs, lambda: lambda texts: [(float(v),) for v in model.score(texts)], [("score", T.DoubleType())], keep=keep, batched=True)


def model_of(spark: SparkSession, sf_dir: str) -> Model:
    """Fitted on documents and labels whose ids' remainder by 5 isn't 0."""
    return fit(labelled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", fold(F.col("doc_id"), 5) != 0, SAMPLE))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(table(spark, sf_dir, "documents"), model_of(spark, sf_dir))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
