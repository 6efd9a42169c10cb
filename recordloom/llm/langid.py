"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's byte 1-, 2- and 3-grams (lower case, everything but letters as one
space) are counted in hashed bins, damped, weighted by IDF and normalised. Each
language has several centroids, found by spherical k-means; a text takes the
language of the centroid nearest by cosine. A text further from every centroid
than nearly all training texts of that language were is marked as rejected.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.sampling import _STEPS, fold
from recordloom.llm.tables import map_texts, table
from recordloom.operators.joins import small
from recordloom.plans.lineage import cut

#: Texts that are fitted in all languages together, at the most.
MOST_ROWS = 50_000

#: Hashed bins; training texts taken for a language; centroids for each.
BINS, SAMPLE, CENTROIDS = 4096, 400, 3
#: Share of a language's training texts that lie beyond its limit of distance.
REJECTED = 0.005
#: Bytes counted at a time.
BLOCK = 1 << 20
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_PLAIN = np.arange(256, dtype=np.uint32)
_PLAIN[:128] = [b if 97 <= b <= 122 else 32 for b in range(128)]


def has_letter(text: str) -> bool:
    """Whether a character is a letter: of a kind of its own, unlike ½, ² or Ⅷ, which are numbers."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def counts(text: str) -> np.ndarray:
    """How often each bin's n-grams occur in a whole text."""
    data = _PLAIN[np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)]
    data = data[np.concatenate([[True], (data[1:] != 32) | (data[:-1] != 32)])]
    total = np.zeros(BINS, np.int64)
    for at in range(0, max(1, len(data) - 2), BLOCK):
        x = data[at:at + BLOCK + 2]
        two = x[:-1] << np.uint32(8) | x[1:]
        three = two[:-1] << np.uint32(8) | x[2:]
        for grams, salt in ((x[:BLOCK] + np.uint32(7), 0x85EBCA6B), (two[:BLOCK], 0xC2B2AE35), (three, 0x9E3779B1)):
            total += np.bincount(grams * np.uint32(salt) >> np.uint32(20), minlength=BINS)
    return total


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


class Model:
    """Centroids (rows), the language of each, IDF weights, and each language's least cosine."""

    def __init__(self, texts: list[tuple[np.ndarray, np.ndarray]], langs: list[str]) -> None:
        """From each text's non-empty bins and their counts; only one language's texts are dense at a time."""
        self.languages = sorted(set(langs))
        of: dict[str, list] = {k: [] for k in self.languages}
        seen = np.zeros(BINS, np.int64)
        for text, lang in zip(texts, langs, strict=True):
            of[lang].append(text)
            seen[text[0]] += 1
        self.idf = np.log((1 + len(texts)) / (1 + seen)) + 1
        rng = np.random.default_rng(4)
        rows, owner, least = [], [], []
        for k, lang in enumerate(self.languages):
            tf = np.zeros((len(of[lang]), BINS), np.float32)
            for i, (bins, n) in enumerate(of[lang]):
                tf[i, bins] = n
            own = self.vectors(tf)
            c = own[rng.permutation(len(own))[:CENTROIDS]]
            for _ in range(12):
                near = (own @ c.T).argmax(1)
                c = _unit(np.stack([own[near == j].sum(0) if (near == j).any() else c[j] for j in range(len(c))]))
            rows.append(c)
            owner += [k] * len(c)
            least.append(np.quantile((own @ c.T).max(1), REJECTED))
        self.centroids, self.owner, self.least = np.concatenate(rows), np.array(owner), np.array(least)

    def vectors(self, tf: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(tf) * self.idf)

    def cosines(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid's cosine, for each language."""
        all_c = x @ self.centroids.T
        return np.stack([all_c[:, self.owner == k].max(1) for k in range(len(self.languages))], 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the text is too far from it."""
        if not text or not has_letter(text):
            return UNKNOWN, 0.0, True
        cos = self.cosines(self.vectors(counts(text)[None, :]))[0]
        k = int(cos.argmax())
        share = np.exp(30 * (cos - cos[k]))
        return self.languages[k], float(1 / share.sum()), bool(cos[k] < self.least[k])


def fit(docs: DataFrame, sample: int = SAMPLE, most: int = MOST_ROWS) -> Model | None:
    """A model from documents with a language; None where there are none.

    Every language that occurs is fitted. Of each at most about ``sample`` texts
    are taken, by a hash of doc_id, and of all together about ``most``: where
    languages are many, each gives fewer, one at least; the ``most`` most frequent
    ones give any. The sample's counts alone reach the driver.
    """
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = cut(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most))
    each = max(1, min(sample, most // max(1, sizes.count())))
    shares = sizes.select("lang", F.least(F.lit(_STEPS), F.floor(F.lit(float(_STEPS) * each) / F.col("n")).cast("long")).alias("share"))
    some = known.join(small(shares), "lang").filter(F.pmod(F.xxhash64("doc_id"), F.lit(_STEPS)) < F.col("share"))

    # Of rows that share an id one is taken, so the sample is bounded in rows.
    some = some.groupBy("lang", "doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("row")).select("lang", "row.text")

    def make():
        def one(text):
            c = counts(text)
            at = np.flatnonzero(c)
            return at.tolist(), c[at].tolist()

        return one

    rows = map_texts(some, make, [("bins", T.ArrayType(T.IntegerType())), ("n", T.ArrayType(T.LongType()))], keep=("lang",)).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["bins"], r["n"]))
    return Model([(np.array(r["bins"], np.int32), np.array(r["n"], np.int64)) for r in rows], [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row with lang_pred, score and rejected.

    A text that is null or has no letter is ``und`` with score 0, and so is
    every text where nothing was learned. Letters are what Unicode calls so, not
    numbers. Texts are read whole, however long; of equal cosines the first
    language by name wins. Repeated rows are each returned, an empty table gives
    none, and extra columns are ignored.
    """

    def make():
        return model.predict if model else lambda text: (UNKNOWN, 0.0, True)

    return map_texts(docs, make, [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())], keep=keep)


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = fold(F.col("doc_id"), 3) == 1
    found = predict(docs, fit(docs.filter(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")
