import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import langid, quality, sampling, toxicity
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_folds_are_crc32(spark):
    got = [r["f"] for r in spark.range(200).select(sampling.fold(F.col("id"), 5).alias("f")).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 for i in range(200)]


def test_language_by_held_out_documents(spark):
    found = langid.op4_langid(spark, SF).join(read(spark, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_quality_by_held_out_labels(spark):
    r = quality.op10_quality(spark, SF).join(read(spark, "labels"), "doc_id").filter("held_out").collect()
    assert np.mean([x["predicted"] == x["quality"] for x in r]) > 0.95


def test_toxicity_by_held_out_labels(spark):
    r = toxicity.op6_toxicity(spark, SF).join(read(spark, "labels"), "doc_id").filter("held_out").collect()
    assert np.mean([x["predicted"] for x in r if not x["toxic"]]) < 0.05
    words = [x for x in r if x["toxic"]]
    assert np.mean([x["predicted"] for x in words]) > 0.5  # this little table has toxic labels without any toxic word


def test_toxic_stems_of_other_languages_are_learned(spark):
    rng = np.random.default_rng(1)
    plain = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    ends = ["".join(rng.choice(list("ijklmn"), 4)) for _ in range(60)]

    def text(toxic):
        w = list(rng.choice(plain, 60))
        for _ in range(3 if toxic else 0):
            w.insert(int(rng.integers(60)), "zorq" + str(rng.choice(ends)))
        return " ".join(w)

    y = [int(i % 4 == 0) for i in range(800)]
    docs = spark.createDataFrame([(i, text(t)) for i, t in enumerate(y)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(y)], "doc_id long, toxic int")
    model = toxicity.fit(sampling.labelled(docs, labels, "toxic", F.col("doc_id") < 600, 500))
    got = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.scored(docs, model).filter("doc_id >= 600").collect()}
    assert np.mean([got[i] == bool(y[i]) for i in got]) > 0.97


def test_the_sample_is_bounded(spark):
    docs, labels = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    n = sampling.labelled(docs, labels, "quality", F.lit(True), 1000).count()
    assert 850 < n < 1150


def test_toxicity_by_held_out_labels_of_the_larger_table(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    r = toxicity.op6_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out").collect()
    found, toxic = [x for x in r if x["predicted"]], [x for x in r if x["toxic"]]
    assert np.mean([x["toxic"] for x in found]) > 0.97 and np.mean([x["predicted"] for x in toxic]) > 0.88


def test_isotonic_rises_and_pools():
    f, y = np.array([0.0, 1, 2, 3, 4, 5]), np.array([0, 1, 0, 0, 1, 1.0])
    at, rate = toxicity.Trees._isotonic(f, y)
    assert (np.diff(at) >= 0).all() and (np.diff(rate) >= 0).all() and rate[0] < 0.5 < rate[-1]


def test_gam_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    m = quality.Gam(x[:3000], y[:3000], rounds=20, pairs=2)
    assert (0, 2) in m.pairs and np.mean((m.score(x[3000:]) >= 0.5) == y[3000:]) > 0.9


@pytest.mark.parametrize("learned", [True, False])
def test_cases(spark, learned):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int").filter(F.lit(learned))
    q = quality.scored(docs, quality.fit(sampling.labelled(docs, labels, "quality", F.lit(True), 100))).collect()
    t = toxicity.scored(docs, toxicity.fit(sampling.labelled(docs, labels, "toxic", F.lit(True), 100))).collect()
    model = langid.fit(docs if learned else docs.limit(0))
    lang = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    assert len(q) == len(t) == len(cases.rows()) and all(0 <= r["score"] <= 1 for r in [*q, *t, *lang.values()])
    assert all(lang[i]["lang_pred"] == "und" for i in (0, 1, 2)) and (lang[4]["lang_pred"] == "en") is learned
    for empty in (quality.scored(cases.nothing(spark), quality.Gam(np.zeros((1, len(quality.FEATURES))), np.array([]))), langid.predict(cases.nothing(spark), None)):
        assert empty.count() == 0


def test_numbers_are_no_letters():
    model = langid.Model([(np.array([1]), np.array([2]))], ["en"])
    assert [model.predict(t)[0] for t in ("½ ² Ⅷ", "１２３ _", "a", "漢", "²b")] == ["und", "und", "en", "en", "en"]


def test_samples_are_bounded_in_rows(spark):
    docs = spark.range(500).select(F.lit(1).alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 7).cast("string")).alias("text"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([(1, 1)], "doc_id int, quality int")
    assert sampling.labelled(docs, labels, "quality", F.lit(True), 100).count() == 1
    assert langid.fit(docs).languages == ["en"]


def test_every_language_is_fitted(spark):
    rng = np.random.default_rng(6)
    words = {f"l{k:02}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for k in range(70)}
    rows = [(i, " ".join(rng.choice(words[lang], 60)), lang) for i, lang in enumerate(x for x in words for _ in range(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == sorted(words)
    found = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert all(found[i] == lang for i, _, lang in rows)


def test_additive_scores_are_sums_of_table_entries(spark):
    """Each score again, one table entry after the other."""
    docs, labels = read(spark, "documents"), read(spark, "labels")
    model = quality.fit(sampling.labelled(docs, labels, "quality", F.lit(True), 300))
    some = docs.limit(60).cache()
    for r in quality.feature_rows(some).collect():
        bins = [sum(float(v) >= edge for edge in edges) for v, edges in zip(r["x"], model.edges, strict=True)]
        f = float(model.start) + sum(float(t[b]) for t, b in zip(model.tables, bins, strict=True))
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            f += float(t[bins[i] * quality.COARSE // quality.BINS][bins[j] * quality.COARSE // quality.BINS])
        got = {x["doc_id"]: x["score"] for x in quality.scored(some.filter(F.col("doc_id") == r["doc_id"]), model).collect()} if r["doc_id"] % 20 == 0 else {}
        assert all(abs(v - 1 / (1 + np.exp(-f))) < 1e-9 for v in got.values())
        assert abs(float(model.score(np.array([r["x"]]))[0]) - 1 / (1 + np.exp(-f))) < 1e-9


def test_language_scores_are_cosines_of_plain_vectors(spark):
    """Each prediction again: log counts by idf, and the cosine with every centroid, without matrices."""
    docs = read(spark, "documents")
    model = langid.fit(docs)
    some = docs.filter("text is not null and length(text) between 1 and 3000").limit(25)
    got = {r["doc_id"]: r for r in langid.predict(some, model).collect()}
    for r in some.collect():
        if not langid.has_letter(r["text"]):
            continue
        v = [float(np.log(1 + c)) * float(w) for c, w in zip(langid.counts(r["text"]), model.idf, strict=True)]
        size = sum(x * x for x in v) ** 0.5
        best = {}
        for c, owner in zip(model.centroids, model.owner, strict=True):
            cos = sum(x * float(y) for x, y in zip(v, c, strict=True) if x) / size / float(np.linalg.norm(c))
            best[model.languages[owner]] = max(cos, best.get(model.languages[owner], -1.0))
        top = max(best.values())
        share = 1 / sum(np.exp(30 * (x - top)) for x in best.values())
        assert abs(got[r["doc_id"]]["score"] - share) < 1e-3 and best[got[r["doc_id"]]["lang_pred"]] > top - 1e-5


def test_the_fitted_sample_is_bounded_over_all_languages(spark):
    docs = spark.createDataFrame([(i, f"word{i % 9} text and more of it", f"l{i % 40:02}" if i % 7 else "zz") for i in range(1500)], "doc_id long, text string, lang string")
    assert len(langid.fit(docs, most=120).languages) > 20  # three texts a language on average
    few = langid.fit(docs, most=5)
    assert 1 <= len(few.languages) <= 5 and "zz" in few.languages
    assert len(langid.fit(docs).languages) == 41
