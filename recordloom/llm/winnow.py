r"""Benchmark decontamination by winnowing, in DataFrame operations alone.

A window of ``WINDOW`` words holds ``WINDOW - GRAM + 1`` word k-grams and keeps
the smallest of their hashes, the last of equal ones, as its fingerprint.
Neighbouring windows mostly keep the same gram, so a text selects one
fingerprint where the kept gram changes, about two for seven words. Equal
windows keep equal grams, so every shared span of a window or more meets in the
join of training and test fingerprints. A hit is extended to each window that
can keep its gram, and those are compared word by word; the words that equal
windows cover are counted.

Documents are read and cut into words once. What leaves that pass is a row with
a document's word count and its hits, and both are combined before the shuffle.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.tables import table
from recordloom.plans.lineage import cut

WINDOW, GRAM = 10, 5
#: What parts words. Splitting is far cheaper in Spark than extracting every match of the words' own class.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Benchmark windows and their item lists are broadcast up to so many bytes; beyond, documents' hits are shuffled to them.
MAX_BROADCAST = 64 << 20
#: Fingerprints (8 bytes each) are broadcast up to so many.
MAX_PRINTS = 2_000_000
SALTS = 16


def _words(text: Column) -> Column:
    """Words of a text: runs of a-z, 0-9 and what isn't ASCII, A-Z lowered."""
    parts = F.split(F.coalesce(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), F.lit("")), GAP, -1)
    lead, trail = ((F.get(parts, i) == "").cast("int") for i in (F.lit(0), F.size(parts) - 1))
    return F.slice(parts, 1 + lead, F.greatest(F.size(parts) - lead - trail, F.lit(0)))


def _hashed(df: DataFrame, *keep: Column | str) -> DataFrame:
    return df.select(*keep, _words(F.col("text")).alias("w")).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))


def _gram(at: Column, size: int) -> Column:
    """The hash of ``size`` words from ``at`` on: their hashes, each turned by another number of bits."""
    out = F.get("h", at)
    for k in range(1, size):
        x, bits = F.get("h", at + k), 13 * k % 64
        out = out.bitwiseXOR(F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits)))
    return out


def _kept(size: int) -> Column:
    """The fingerprint of the window of ``size`` words at word ``i``."""
    gram = min(GRAM, size)
    grams = [_gram(F.col("i") + j, gram) for j in range(size - gram + 1)]
    return _not_zero(F.least(*grams) if len(grams) > 1 else grams[0])


def _not_zero(x: Column) -> Column:
    """0 marks what isn't selected, so it isn't a fingerprint."""
    return F.when(x == 0, F.lit(1).cast("long")).otherwise(x)


def _selected(size: int) -> Column:
    """The window's fingerprint where it keeps another gram than the window before it; else, and beyond the text, 0."""
    i, gram = F.col("i"), min(GRAM, size)
    inside = (i >= 0) & (i <= F.size("w") - size)
    count = size - gram + 1
    if count == 1:
        return F.coalesce(F.when(inside, _not_zero(_gram(i, gram))), F.lit(0).cast("long"))
    both = [_gram(i + j, gram) for j in range(count - 1)]
    middle = F.least(*both) if len(both) > 1 else both[0]
    old, new = _gram(i - 1, gram), _gram(i + count - 1, gram)
    changed = (i == 0) | (new <= F.least(old, middle)) | (old < middle)
    return F.coalesce(F.when(inside & changed, _not_zero(F.least(middle, new))), F.lit(0).cast("long"))


def _said(size: int, at: Column | None = None) -> Column:
    return F.array_join(F.slice("w", (F.col("i") if at is None else at) + 1, size), " ")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (size, f, said, items): each distinct window with its fingerprint and the items that hold it."""
    words = _hashed(benchmark, F.col("item_id").cast("string").alias("item"))
    parts = []
    for size in range(1, window + 1):
        held = words.filter(F.size("w") >= size if size == window else F.size("w") == size)
        at = held.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("w") - size)))
        parts.append(at.select(F.lit(size).alias("size"), _kept(size).alias("f"), _said(size).alias("said"), "item"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("size", "f", "said").agg(F.array_sort(F.collect_set("item")).alias("items"))


def selections(docs: DataFrame, sizes: list[int], *keep: Column | str) -> DataFrame:
    """Rows (keep, w, i, f<size>...) of every word position; a row with i = -1 stands for the text itself."""
    last = F.size("w") - min(sizes, default=1)
    at = _hashed(docs, *keep).withColumn("i", F.explode(F.sequence(F.lit(-1), F.greatest(last, F.lit(-1)))))
    return at.select(*(c for c in at.columns if c != "h"), *(_selected(s).alias(f"f{s}") for s in sizes))


def _reach(size: int) -> int:
    """How many windows after the one that selects a gram can keep it too."""
    return size - min(GRAM, size)


def _tally(rows: DataFrame) -> DataFrame:
    """One row per (doc_id, t): how many rows the document has, its words, the spans that were hit and the items."""
    return rows.groupBy("doc_id", "t").agg(
        F.sum("rows").alias("rows"), F.max("n_words").alias("n_words"), F.collect_set("span").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, t, spans, items), one for each doc_id and text that holds a window; t is a hash of the text."""
    return tallies(docs, benchmark, window).filter(F.size("spans") > 0).select("doc_id", "t", "spans", "items")


def tallies(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, t, rows, n_words, spans, items), one for each doc_id and text, hit or not."""
    wanted = cut(benchmark_windows(benchmark, window))
    cost = F.octet_length("said") + F.aggregate("items", F.lit(0), lambda acc, x: acc + F.octet_length(x))
    found = {r["size"]: (r["n"], r["bytes"]) for r in wanted.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum(cost).alias("bytes")).collect()}
    sizes = sorted(found)
    light = sum(b + 64 * n for n, b in found.values()) <= MAX_BROADCAST
    small = light and sum(n for n, _ in found.values()) <= MAX_PRINTS
    at = selections(docs, sizes, "doc_id", F.xxhash64("text").alias("t"))
    prints = {s: wanted.filter(F.col("size") == s).select(F.col("f").alias(f"p{s}")).distinct() for s in sizes}
    if small:
        for s in sizes:
            at = at.join(F.broadcast(prints[s]), F.col(f"f{s}") == F.col(f"p{s}"), "left")
        touched = {s: F.col(f"p{s}").isNotNull() for s in sizes}
        far, wide = max(map(_reach, sizes), default=0), max((s + _reach(s) for s in sizes), default=0)
        text_row = F.col("i") < 0
        some = text_row
        for hit in touched.values():
            some = some | hit
        # Only the words that a hit can reach leave the stage that reads a text, never the text with each of them.
        near = at.filter(some).select("doc_id", "t", "i", F.size("w").alias("n_words"), *(f"p{s}" for s in sizes), F.slice("w", F.greatest(F.col("i"), F.lit(0)) + 1, wide).alias("w"))
        near = near.withColumn("o", F.explode(F.sequence(F.lit(0), F.when(text_row, 0).otherwise(far)))).withColumn("n", F.explode(F.array(*map(F.lit, [0, *sizes]))))
        fits = text_row & (F.col("n") == 0)
        for s, hit in touched.items():
            fits = fits | ((F.col("n") == s) & hit & (F.col("o") <= _reach(s)) & (F.col("i") + F.col("o") + s <= F.col("n_words")))
        said = near.filter(fits).select(
            "doc_id", "t", F.when(text_row, F.col("n_words")).cast("long").alias("n_words"),
            F.when(F.col("n") > 0, F.struct((F.col("i") + F.col("o")).alias("i"), "n")).alias("span"), F.when(F.col("n") > 0, F.array_join(F.slice("w", F.col("o") + 1, F.col("n")), " ")).alias("words"),
        )
        same = said.join(F.broadcast(wanted.select("said", "items")), F.col("words") == F.col("said"), "left").filter("span is null or items is not null")
        return _tally(same.select("doc_id", "t", F.col("span").isNull().cast("long").alias("rows"), "n_words", "span", "items"))
    # Beyond the bounds, fingerprints of all sizes leave the one stage that reads a text as rows of their own, and a row
    # of size 0 stands for the text. Its keys are hashes that nothing else has, so no join gathers those rows.
    wide = max((s + _reach(s) for s in sizes), default=0)
    some = F.col("i") < 0
    for s in sizes:
        some = some | (F.col(f"f{s}") != 0)
    # Only the words that a window can reach leave the stage that reads a text, never the text with each of them.
    rows = at.filter(some).select("doc_id", "t", "i", F.size("w").cast("long").alias("n_words"), *(f"f{s}" for s in sizes), F.slice("w", F.greatest(F.col("i"), F.lit(0)) + 1, wide).alias("w"))
    every = [F.struct(F.lit(0).alias("size"), F.when(F.col("i") < 0, F.xxhash64("doc_id", "t")).otherwise(0).alias("f")), *(F.struct(F.lit(s).alias("size"), F.when(F.col("i") >= 0, F.col(f"f{s}")).otherwise(0).alias("f")) for s in sizes)]
    one = rows.withColumn("x", F.explode(F.array(*every))).filter("(x.size = 0 and i < 0) or (x.size > 0 and x.f <> 0)").select("doc_id", "t", "i", "n_words", "x.size", "x.f", "w")
    # Selected fingerprints alone meet first: by broadcast where they are few, else spread over SALTS tasks each.
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    own_salt = F.pmod(F.xxhash64("doc_id", "i"), F.lit(SALTS))
    known = wanted.select("size", "f").distinct()
    if sum(n for n, _ in found.values()) <= MAX_PRINTS:
        near = one.join(F.broadcast(known.withColumn("known", F.lit(True))), ["size", "f"], "left")
    else:
        near = one.withColumn("salt", own_salt).join(known.select("size", "f", salts, F.lit(True).alias("known")), ["size", "f", "salt"], "left").drop("salt")
    near = near.filter("size = 0 or known")
    reach = F.col("size") - F.least(F.lit(GRAM), F.col("size"))
    starts = F.when(F.col("size") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.least(reach, F.size("w") - F.col("size"))))
    spans = near.withColumn("o", F.explode(starts)).select(
        "doc_id", "t", "n_words", "size", F.when(F.col("size") > 0, F.struct((F.col("i") + F.col("o")).alias("i"), F.col("size").alias("n"))).alias("span"),
        F.when(F.col("size") == 0, F.concat(F.lit("\x00"), F.hex("f"))).otherwise(F.array_join(F.slice("w", F.col("o") + 1, F.col("size")), " ")).alias("said"), own_salt.alias("salt"),
    )
    same = spans.join(wanted.select("said", "items", salts), ["said", "salt"], "left").filter("size = 0 or items is not null")
    return _tally(same.select("doc_id", "t", (F.col("size") == 0).cast("long").alias("rows"), F.when(F.col("size") == 0, F.col("n_words")).alias("n_words"), "span", "items"))


def _covered(spans: Column) -> Column:
    """How many words the spans cover together."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def add(acc: Column, s: Column) -> Column:
        end = s["i"] + s["n"]
        more = F.greatest(F.lit(0), end - F.greatest(s["i"], acc["end"]))
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), start, add, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """For every row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of lower-cased ASCII letters, digits and non-ASCII
    characters. An item of fewer words than a window is one window; one
    without words never occurs. Null and empty texts have no words and no
    hits, and an empty benchmark hits nothing. Repeated rows are each returned;
    rows that share a doc_id but not a text are kept apart. Extra columns are
    ignored, and a null item_id can't be named, so such items are skipped.
    Texts of any length count whole; an empty table gives an empty one.
    """
    found = tallies(docs.select("doc_id", "text"), benchmark.select("item_id", "text").filter("item_id is not null"), window)
    n_hit = _covered(F.col("spans"))
    each = found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "rows",
    )
    return each.withColumn("rows", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).drop("rows")


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS said
       FROM (SELECT item, w, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS said
       FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, dw.n, i, item FROM dw JOIN bw ON dw.n = bw.n AND dw.said = bw.said),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(said, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
