"""Quality classification by a generalised additive model with pairwise interactions.

Features of a whole text are cut into bins by quantiles. Boosting goes round the
features, and each step adds a small tree of at most three leaves over one
feature's bins to that feature's lookup table; then the pairs of features whose
residuals interact most get tables of their own, from trees of one cut a side.
A score is the sum of the looked-up bins, through the logistic function.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.sampling import fold, labelled
from recordloom.llm.tables import map_texts, table

#: Labelled documents that a model is fitted on, at most about.
SAMPLE = 8000
BINS, COARSE, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, LEAST = 32, 8, 150, 60, 6, 0.1, 5
FEATURES = (
    "log_words", "word_length", "long_words", "distinct_words", "top_word", "repeated_next", "repeated_lines", "upper", "digit",
    "symbol", "bang", "bar", "punctuation", "line_end", "space", "not_ascii", "symbol_words", "upper_words", "stop_ends", "bytes_kinds",
)
_WORD = re.compile(r"\S+")
_BLOCK = 1 << 20
_CLASSES = np.zeros(256, np.int64)
for _kind, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*+<=>@^_`~{}[]\\/", b"!?", b"|", b".,;:'\"()-", b"\n", b" \t\r\x0b\x0c"), 1):
    _CLASSES[list(_chars)] = _kind
_CLASSES[128:] = 9
_SYMBOLS = re.compile(r"[#$%&*<=>@^|~]")


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text; all zero for a null or blank one."""
    raw = (text or "").encode("utf-8", "replace")
    words = _WORD.findall(text or "")
    if not words:
        return [0.0] * len(FEATURES)
    seen = np.zeros(256, np.int64)
    for at in range(0, len(raw), _BLOCK):
        seen += np.bincount(np.frombuffer(raw, np.uint8, min(_BLOCK, len(raw) - at), at), minlength=256)
    kinds = np.bincount(_CLASSES, seen, 10) / len(raw)
    n = len(words)
    often = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split("\n") if x.strip()]
    same = sum(map(str.__eq__, words, itertools.islice(words, 1, None)))
    marked = sum(v for w, v in often.items() if _SYMBOLS.search(w))
    upper = sum(v for w, v in often.items() if len(w) > 1 and w.isupper())
    ends = sum(v for w, v in often.items() if w[-1] in ".!?:")
    return [
        float(np.log1p(n)), float(lengths.mean()), float((lengths > 20).mean()), len(often) / n, max(often.values()) / n, same / n, 1 - len(set(lines)) / len(lines),
        *(float(k) for k in kinds[1:7]), float(kinds[7]), float(kinds[8]), float(kinds[9]), marked / n, upper / n, ends / n, float(np.count_nonzero(seen)),
    ]


def feature_rows(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return map_texts(docs, lambda: lambda text: (features(text),), [("x", T.ArrayType(T.DoubleType()))], keep=keep)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


class Gam:
    """Cut points by feature, one table a feature and one a pair, and an intercept."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> None:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        b = self.bins(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
        self.start = float(np.log(rate / (1 - rate)))
        self.tables = [np.zeros(BINS) for _ in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if not len(y) or y.min() == y.max():
            return
        f = np.full(len(y), self.start)
        for _ in range(rounds):
            for j, t in enumerate(self.tables):
                step = self._tree(b[:, j], *self._slopes(f, y))
                t += step
                f += step[b[:, j]]
        coarse = b * COARSE // BINS
        ranked = sorted(itertools.combinations(range(len(self.edges)), 2), key=lambda p: -self._interaction(coarse, p, *self._slopes(f, y)))
        self.pairs = ranked[:pairs]
        self.pair_tables = [np.zeros((COARSE, COARSE)) for _ in self.pairs]
        for _ in range(PAIR_ROUNDS if self.pairs else 0):
            for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
                step = self._quarter(coarse[:, i], coarse[:, j], *self._slopes(f, y))
                t += step
                f += step[coarse[:, i], coarse[:, j]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T, strict=True)], 1)

    @staticmethod
    def _slopes(f: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    @staticmethod
    def _tree(b: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One tree over a feature's bins, as a table: its best cut, then the best in either half."""
        gs, hs, n = (np.bincount(b, w, BINS) for w in (g, h, None))
        parts = [(0, BINS)]
        for _ in range(2):
            best = (1e-9, None)
            for lo, hi in parts:
                if hi - lo < 2:
                    continue
                cg, ch, cn = (np.cumsum(v[lo:hi]) for v in (gs, hs, n))
                gain = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - _gain(cg[-1], ch[-1])
                gain[(cn[:-1] < LEAST) | (cn[-1] - cn[:-1] < LEAST)] = 0
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), (lo, lo + k + 1, hi)), key=lambda v: v[0])
            if best[1] is None:
                break
            lo, mid, hi = best[1]
            parts.remove((lo, hi))
            parts += [(lo, mid), (mid, hi)]
        out = np.zeros(BINS)
        if len(parts) > 1:
            for lo, hi in parts:
                out[lo:hi] = RATE * gs[lo:hi].sum() / (hs[lo:hi].sum() + 1.0)
        return out

    @staticmethod
    def _grid(a: np.ndarray, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = a * COARSE + b
        return tuple(np.bincount(at, w, COARSE * COARSE).reshape(COARSE, COARSE) for w in (g, h))

    @classmethod
    def _cuts(cls, a, b, g, h):
        """Gains of all ways to cut a pair into quarters, and the quarters' sums."""
        gs, hs = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in cls._grid(a, b, g, h))
        quarters = [(v[:, :], v[:, -1:] - v, v[-1:, :] - v, v[-1, -1] - v[-1:, :] - v[:, -1:] + v) for v in (gs, hs)]
        return sum(_gain(x, y) for x, y in zip(*quarters, strict=True)), quarters

    @classmethod
    def _interaction(cls, coarse, pair, g, h) -> float:
        i, j = pair
        gain, _ = cls._cuts(coarse[:, i], coarse[:, j], g, h)
        return float(gain[1:-1, 1:-1].max() - max(gain[1:-1, -1].max(), gain[-1, 1:-1].max()))

    @classmethod
    def _quarter(cls, a, b, g, h) -> np.ndarray:
        gain, (gs, hs) = cls._cuts(a, b, g, h)
        r, c = np.unravel_index(gain[1:-1, 1:-1].argmax(), (COARSE - 1, COARSE - 1))
        v = [RATE * x[r + 1, c + 1] / (y[r + 1, c + 1] + 5.0) for x, y in zip(gs, hs, strict=True)]
        out = np.empty((COARSE, COARSE))
        out[:r + 1, :c + 1], out[:r + 1, c + 1:], out[r + 1:, :c + 1], out[r + 1:, c + 1:] = v
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        f = self.start + sum(t[b[:, j]] for j, t in enumerate(self.tables))
        coarse = b * COARSE // BINS
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            f = f + t[coarse[:, i], coarse[:, j]]
        return 1 / (1 + np.exp(-f))


def fit(sample: DataFrame) -> Gam:
    """A model from rows (text, y); without any, one that scores 0.5. The rows' features reach the driver."""
    rows = sorted((tuple(r["x"]), r["y"]) for r in feature_rows(sample, keep=("y",)).collect())
    x = np.array([r[0] for r in rows]).reshape(-1, len(FEATURES))
    return Gam(x if len(x) else np.zeros((1, len(FEATURES))), np.array([r[1] for r in rows], float)) if rows else Gam(np.zeros((1, len(FEATURES))), np.array([]))


def scored(docs: DataFrame, model: Gam, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` with ``score``, from 0 to 1.

    Null and empty texts are scored as texts without words, and very long ones
    whole. Repeated rows are each returned with the same score, an empty table
    gives none, and columns outside ``keep`` are ignored. Without labels of both
    kinds to learn from, every score is the same.
    """

    def make():
        return lambda texts: [(float(v),) for v in model.score(np.array([features(t) for t in texts]))]

    return map_texts(docs, make, [("score", T.DoubleType())], keep=keep, batched=True)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = fold(F.col("doc_id"), 3) == 1
    model = fit(labelled(docs, table(spark, sf_dir, "labels"), "quality", ~out, SAMPLE))
    return scored(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
