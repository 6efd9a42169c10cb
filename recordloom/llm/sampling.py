"""Folds, and bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.plans.lineage import cut

_STEPS = 1 << 30


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def labelled(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int) -> DataFrame:
    """Rows (doc_id, text, y) of about ``most`` labelled training documents at the most.

    ``train`` is a condition on doc_id. All are taken where there are fewer;
    else each document is in or out by a hash of its id, so the sample is
    spread over the whole table and the same in every run. Labels other than 0
    and 1 are skipped, and of several labels of a document the largest holds.
    Of rows that share an id the one of the smallest text hash is taken, so the
    sample is bounded in rows. Its ids are broadcast to the documents, which
    aren't shuffled; its rows are written, so fitting reads the documents once.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).filter(train).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    n = known.count()
    some = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(_STEPS)) < int(_STEPS * min(1.0, most / max(1, n))))
    found = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    one = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "y")).alias("row"))
    return cut(one.select("doc_id", "row.text", "row.y"))
