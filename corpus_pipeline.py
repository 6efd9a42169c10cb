"""Corpus pipeline: stages over documents, each written as Parquet and read again.

Toxicity, SimHash near-dedup and benchmark decontamination drop documents,
secret scans redact texts, and the last stage encodes what is left. A stage
works on all its predecessor kept. Decisions are joined to the documents by
doc_id and a hash of the text, null-safe, so that documents with no doc_id and
different texts under one are documents of their own. Columns beside those of
documents are left out first, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import bpe, secrets, simhash, toxicity, winnow
from recordloom.operators.joins import small
from recordloom.plans.lineage import cut, delete, scratch

#: Names of documents that go (40 bytes each) are broadcast up to so many; beyond, both sides are shuffled.
MAX_NAMES = 500_000
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; scored where they stand, with no shuffle.

    Null and empty texts have no toxic words and stay with what the model gives
    them; repeated rows share their fate; an empty table gives an empty one.
    Very long texts are read whole.
    """
    return toxicity.scored(docs, toxicity.model_of(spark, sf_dir), keep=(*COLUMNS,)).filter("score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest doc_id, none last, and of its texts the smallest hash.

    Null and wordless texts have fingerprint zero and are one group. Of rows
    that repeat a doc_id and a text one stays. What goes is looked up, not what
    stays: while those names are few they are broadcast and no text is shuffled.
    """
    docs = docs.select(*COLUMNS)
    kind = docs.schema["doc_id"].dataType
    name = F.struct(F.col("doc_id").isNull().alias("unknown"), F.coalesce("doc_id", F.lit("0").cast(kind)).alias("id"), F.xxhash64("text").alias("text"))
    found = simhash.near_duplicates(docs.select(name.alias("doc_id"), "text")).groupBy(F.col("doc_id").alias("name")).agg(F.min(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("rows"))
    odd = cut(found.filter("not stays or rows > 1"))
    named = docs.withColumn("name", name)
    once = named.join(small(odd.select("name"), MAX_NAMES), "name", "left_anti")
    repeated = named.join(small(odd.filter("stays").select("name"), MAX_NAMES), "name", "left_semi").dropDuplicates(["name"])
    return once.unionByName(repeated).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Null and empty texts hold none; repeated rows share their fate. The names
    of those that do are broadcast while they are few, so no text is shuffled.
    """
    docs = docs.select(*COLUMNS)
    bad = winnow.hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").filter("item_id is not null"))
    bad = small(cut(bad.select(F.col("doc_id").alias("d"), "t")), MAX_NAMES)
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("t")), "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets found in its text replaced by a mark; a null text stays null, and n_chars follows the text.

    Repeated rows are each returned, and an empty table gives an empty one.
    """
    found = secrets.scan(docs, keep=COLUMNS)
    text = secrets.redact(F.col("text"), F.col("spans"))
    return found.withColumn("text", F.when(F.col("text").isNotNull(), text)).withColumn("n_chars", F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token count, and the digests of its ids and of what they decode to; a null text counts as empty.

    Repeated rows are each returned, and an empty table gives an empty one.
    """
    return bpe.digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

#: Trees that are fitted on the spot have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for documents.

    What lies between is written to the shared folder, and deleted once the next
    stage is written; the last stage's few columns are cut, so nothing stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    with scratch(spark, "pipeline") as folder:
        for k, (name, stage) in enumerate(STAGES):
            made = stage(spark, docs, sf_dir)
            if k == len(STAGES) - 1:
                return cut(made)
            made.write.parquet(at := f"{folder}/{k}-{name}")
            if before:
                delete(spark, before)
            docs, before = spark.read.parquet(at), at
    return docs
