r"""Source divergence audit: which sources of a language speak unlike it, and in which terms.

Terms are cut out and counted in each task over arrays of bytes; all else is
relational. Counts are grouped by language, source and term; a language keeps the
terms that enough of its documents hold; its sources are joined to those terms,
so that a term a source never says counts as zero; shares are integers, smoothed
and exact; and pairs of sources meet term by term.

Counts are pre-aggregated in each task, so a term or source with a third of all
words is a few rows a task when it is shuffled. Sources are joined to their
language's terms by broadcast while they are few, and pairs are dealt by
(language, term), so a large language is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.llm.tables import table
from recordloom.operators.joins import small
from recordloom.operators.orders import numbered
from recordloom.plans.lineage import cut

#: Each byte as it stands in a term, A-Z lower-cased; 0 for what stands between terms.
LOWERED = np.array([c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0 for c in range(256)], np.uint8)
#: Bytes of text whose terms are counted at once.
SLICE = 8_000_000
LEAST_DOCS, TERMS_SHOWN, UNIT, PRIOR = 30, 50, 1_000_000_000, 5


def _terms(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The terms of texts in order: each one's text, by place, and the term itself.

    What a term may hold is told byte by byte: all else is ASCII, so no
    character of more bytes is cut.
    """
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    lowered, ends = LOWERED[data], ends - ends[0]
    within = lowered != 0
    first = within.copy()
    first[1:] &= ~within[:-1]
    # A text begins a term whatever the one before it ends with.
    begins = ends[:-1][ends[:-1] < len(data)]
    first[begins] = within[begins]
    said = lowered[within]
    starts = np.append(np.flatnonzero(first[within]), len(said)).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(said)])
    return np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(np.flatnonzero(first), ends))), terms.dictionary_encode()


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(g, term, n, docs) of a batch (g, text) without nulls."""
    groups, of = np.unique(batch.column(0).to_numpy(), return_inverse=True)
    doc, terms = _terms(batch.column(1))
    code, many = terms.indices.to_numpy().astype(np.int64), max(1, len(terms.dictionary))
    each = np.unique(doc * many + code)
    met, docs = np.unique(of[each // many] * many + each % many, return_counts=True)
    n = np.unique(of[doc] * many + code, return_counts=True)[1]
    term = terms.dictionary.take(pa.array(met % many)).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(groups[met // many], pa.int64()), term, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["g", "term", "n", "docs"])


def _slices(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of no more than ``most`` bytes of text, or of one text."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def term_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, counts): (lang, source, g) of each group that occurs, and (g, term, n, docs): occurrences, and documents that hold the term.

    A number stands for a group while its terms are counted: in each task over
    arrays of some MB of text, then by one grouping of what these leave.
    """
    filled = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    groups = cut(numbered(filled.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows")), ["lang", "source"], "g").select("lang", "source", "g"))
    texts = filled.join(small(groups), ["lang", "source"]).select(F.col("g").cast("long").alias("g"), "text")
    each = texts.mapInArrow(lambda batches: map(_counted, _slices(batches, SLICE)), "g long, term string, n long, docs long")
    return groups, cut(each.groupBy("g", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + PRIOR) / (total + PRIOR * kept)), exact at any size."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", wide(n + PRIOR) * F.lit(UNIT).cast("decimal(10,0)"), wide(total + PRIOR * kept))


def shares(groups: DataFrame, counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Each group with every kept term of its language: lang, source, term, n (0 where the source never says it), p (its share in the source) and q (in the language)."""
    of = small(groups)
    kept = counts.join(of, "g").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang")).filter(F.col("docs") >= least_docs)
    kept = cut(kept.select("lang", "term", "in_lang"))
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("lang_total"))
    said = cut(counts.join(of, "g").join(small(kept.select("lang", "term")), ["lang", "term"], "left_semi").select("lang", "source", "term", "n"))
    sized = groups.select("lang", "source").join(said.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(of_lang, "lang")
    dense = kept.join(small(cut(sized)), "lang").join(said, ["lang", "source", "term"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    p, q = _share(F.col("n"), F.coalesce("total", F.lit(0)), F.col("v")), _share(F.col("in_lang"), F.col("lang_total"), F.col("v"))
    return cut(dense.select("lang", "source", "term", "n", p.alias("p"), q.alias("q")))


def pairs(groups: DataFrame, dense: DataFrame) -> DataFrame:
    """(lang, source, item, value): how far each other source of the language is, summed over the kept terms; 0 where none is kept."""
    mine = dense.select("lang", "term", "source", "p")
    other = dense.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("r"))
    half = mine.join(other, ["lang", "term"]).filter("source < item").groupBy("lang", "source", "item").agg(F.sum(F.abs(F.col("p") - F.col("r"))).alias("value"))
    half = cut(half)
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    all_pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    return all_pairs.join(both, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, shown: int = TERMS_SHOWN) -> DataFrame:
    """(lang, source, part, item, value, rank) for documents.

    Part ``pair`` ranks each other source of a language by its distance, part
    ``term`` the terms that a source says more often than its language, as many
    as ``shown``. Null langs, sources and texts are empty ones; a source without
    terms is a group; repeated rows are documents of their own; ties rank by the
    item's bytes. Texts of any length count whole, an empty table gives no rows,
    and extra columns are ignored.
    """
    groups, counts = term_counts(docs)
    dense = shares(groups, counts, least_docs)
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    of_terms = dense.filter("n > 0 and p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(by))
    of_pairs = ranked(pairs(groups, dense)).withColumn("part", F.lit("pair"))
    top = ranked(of_terms).filter(F.col("rank") <= shown).withColumn("part", F.lit("term"))
    return of_pairs.unionByName(top).select("lang", "source", "part", "item", "value", "rank")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
v AS (SELECT lang, term FROM (SELECT DISTINCT r, lang, term FROM t) GROUP BY lang, term HAVING count(*) >= 30),
k AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n FROM g JOIN v ON g.lang = v.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
s AS (SELECT *, sum(n) OVER (PARTITION BY lang, term) AS m, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang) AS lang_total, count(*) OVER (PARTITION BY lang, source) AS v FROM k),
p AS (SELECT lang, source, term, n,
  CAST(1 + CAST(1000000000 AS HUGEINT) * (n + 5) // (total + 5 * v) AS BIGINT) AS p,
  CAST(1 + CAST(1000000000 AS HUGEINT) * (m + 5) // (lang_total + 5 * v) AS BIGINT) AS q FROM s),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), y AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM x)
SELECT lang, source, part, item, value, rank FROM y WHERE part = 'pair' OR rank <= 50
"""
