"""Search by substring over an inverted index of character trigrams.

Rows are numbered in an order and lie in blocks of BLOCK numbers. A posting list
is one trigram's numbers within one block, as steps from one to the next, so it
is no longer than a block however common the trigram is. A needle's lists are
read by their folders, summed up, intersected, and what is left is held against
the text itself, since trigrams don't say in which order they stand.

    postings/bucket=B   gram, block, steps
    rows/block=N        at, text (as it is searched), and the row
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.functions.text import folded_nfkc
from recordloom.operators.joins import small
from recordloom.operators.orders import numbered
from recordloom.plans.lineage import cut

BLOCK, BUCKETS, GRAM = 1 << 16, 64, 3
#: Up to so many blocks that hold candidates are named to the reader of rows; beyond, it reads all of them.
MAX_BLOCKS = 1_000


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def fold(needle: str) -> str:
    """A needle in the form of the texts: NFKC, folded case."""
    return unicodedata.normalize("NFKC", needle).casefold()


def build(df: DataFrame, over: list[str], order: list[Column | str], path: str) -> None:
    """Writes the index of the fields ``over``, joined by spaces. Order by something unique; null fields are left out."""
    text = folded_nfkc(F.concat_ws(" ", *over))
    placed = numbered(df, order, "at").withColumn("at", F.col("at") - 1).withColumn("text", text).withColumn("block", F.floor(F.col("at") / BLOCK).cast("int"))
    placed.write.mode("overwrite").partitionBy("block").parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("text") - (GRAM - 1)), lambda i: F.substring("text", i, F.lit(GRAM))))
    each = rows.filter(F.length("text") >= GRAM).select("block", (F.col("at") % BLOCK).cast("int").alias("at"), F.explode(grams).alias("gram"))
    steps = lambda s: F.transform(s, lambda x, i: x - F.coalesce(F.get(s, i - 1), F.lit(0)))
    lists = each.groupBy("gram", "block").agg(F.array_sort(F.collect_list("at")).alias("places"))
    coded = lists.select("gram", "block", F.get(F.transform(F.array("places"), steps), F.lit(0)).alias("steps"), _bucket(F.col("gram")).alias("bucket"))
    coded.repartition("bucket").sortWithinPartitions("gram", "block").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")


def search(spark: SparkSession, path: str, needle: str) -> DataFrame:
    """The rows whose fields hold the needle, with ``at``, their number. A needle shorter than a trigram is looked for in all texts."""
    wanted = fold(needle)
    rows = spark.read.parquet(f"{path}/rows")
    grams = sorted({wanted[i:i + GRAM] for i in range(len(wanted) - GRAM + 1)})
    if not grams:
        return rows.filter(F.col("text").contains(wanted)).drop("text", "block")
    buckets = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "g string").select(_bucket(F.col("g"))).distinct().collect()]
    lists = spark.read.parquet(f"{path}/postings").filter(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
    steps = lists.select("block", "gram", F.posexplode("steps").alias("i", "step"))
    within = Window.partitionBy("block", "gram").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    places = steps.select("block", F.sum("step").over(within).alias("place"))
    near = places.groupBy("block", "place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams))
    found = cut(near.select("block", (F.col("block").cast("long") * BLOCK + F.col("place")).alias("at")))
    blocks = [r[0] for r in found.select("block").distinct().limit(MAX_BLOCKS + 1).collect()]
    if len(blocks) <= MAX_BLOCKS:
        rows = rows.filter(F.col("block").isin(blocks))
    shown = [c for c in rows.columns if c not in ("text", "block")]
    return rows.join(small(found), ["block", "at"]).filter(F.col("text").contains(wanted)).select(*shown)
