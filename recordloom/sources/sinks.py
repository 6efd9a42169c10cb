"""Sinks: immutable snapshots, digests of what was written, and public receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators import hashtree
from recordloom.plans.lineage import cut

LAYOUT = ("journal_slug", "year", "month", "revision")


class Conflict(ValueError):
    """A snapshot exists with other rows."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def _finish(df: DataFrame, path: str, keys: list[str], nodes: DataFrame) -> None:
    """The snapshot's tree and its files' digests, beside the rows in folders that readers skip; the tree comes last."""
    spark = df.sparkSession
    manifest(spark, path).coalesce(1).write.mode("overwrite").json(f"{path}/_files")
    nodes.coalesce(8).write.mode("overwrite").parquet(f"{path}/_tree")


def write_immutable(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keys: tuple[str, ...] = ()) -> str:
    """Rows with a tree of their digests and a manifest of their files, as one act.

    WRITTEN; or UNCHANGED where the path holds the same rows, by SHA-256, not by
    a sum. Other rows there are a Conflict that names the key ranges in which
    they differ. A folder whose writing broke off has no ``_SUCCESS`` or no tree:
    it isn't a snapshot yet, and is written anew, or finished where its rows are
    whole and the same (RECOVERED). ``keys`` name a row (default: all columns).
    """
    spark, named = df.sparkSession, list(keys or df.columns)
    if not _exists(spark, path):
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
        stored = spark.read.parquet(path).select(*df.columns)
        _finish(df, path, named, hashtree.tree(stored, named))
        return "WRITTEN"
    if not _exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        _finish(df, path, named, hashtree.tree(spark.read.parquet(path).select(*df.columns), named))
        return "RECOVERED"
    whole = _exists(spark, f"{path}/_tree/_SUCCESS")
    kept = spark.read.parquet(f"{path}/_tree") if whole else hashtree.tree(spark.read.parquet(path).select(*df.columns), named)
    depth = kept.agg(F.max(F.length("prefix"))).first()[0] or None
    given = hashtree.tree(df, named, depth)
    if hashtree.root(kept) != hashtree.root(given):
        ranges = [r["prefix"] for r in hashtree.differing(kept, given).orderBy("prefix").limit(5).collect()]
        raise Conflict(f"{path} holds other rows, in key ranges {', '.join(ranges) or 'all'}")
    if not whole:
        _finish(df, path, named, kept)
        return "RECOVERED"
    return "UNCHANGED"


def verify_snapshot(spark: SparkSession, path: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(check, key, detail) of what is wrong with a written snapshot: files that are missing, added or altered, and key ranges whose rows differ from its tree."""
    rows = spark.read.parquet(path)
    declared, found = spark.read.json(f"{path}/_files"), manifest(spark, path)
    f = found.select("path", F.col("sha256").alias("is"))
    both = declared.select("path", "sha256").join(f, "path", "full_outer")
    files = both.select(F.when(F.col("is").isNull(), "FILE_MISSING").when(F.col("sha256").isNull(), "FILE_ADDED").when(F.col("sha256") != F.col("is"), "FILE_ALTERED").alias("check"), F.col("path").alias("key")).filter("check is not null")
    kept = spark.read.parquet(f"{path}/_tree")
    depth = kept.agg(F.max(F.length("prefix"))).first()[0] or None
    now = hashtree.tree(rows, list(keys or rows.columns), depth)
    ranges = hashtree.differing(kept, now).select(F.lit("ROWS_DIFFER").alias("check"), F.col("prefix").alias("key"))
    return files.unionByName(ranges).withColumn("detail", F.lit(path))


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, sha256) of the files below a folder, by their paths in it; what readers skip is left out."""
    base = _path(spark, root)[0]
    base = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(base).toUri().getPath()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    inside = F.expr(f"substring(parse_url(replace(replace(path, ' ', '%20'), '=', '%3D'), 'PATH'), {len(base) + 2})")
    return files.select(F.url_decode(inside).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def store_payloads(payloads: DataFrame, path: str, content: str = "content") -> DataFrame:
    """Payloads by digest, each once; gives (sha256, bytes, stored) of what was given: whether it is new.

    A vault is dealt to 256 folders by the first two hex digits. Only the
    digests in the folders that the given ones belong to are read, no content,
    and only what isn't there is appended; a repeat of the same call adds nothing.
    """
    spark = payloads.sparkSession
    given = cut(payloads.filter(F.col(content).isNotNull()).select(F.sha2(content, 256).alias("sha256"), F.col(content).alias("content")).dropDuplicates(["sha256"]).withColumn("shard", F.substring("sha256", 1, 2)))
    fresh = given
    if _exists(spark, path):
        touched = [r[0] for r in given.select("shard").distinct().collect()]  # 256 at the most
        known = spark.read.schema("sha256 string, bytes long, content binary, shard string").parquet(path).filter(F.col("shard").isin(touched)).select("sha256")
        fresh = cut(given.join(known, "sha256", "left_anti"))
    fresh.select("sha256", F.length("content").cast("long").alias("bytes"), "content", "shard").repartition("shard").write.mode("append").partitionBy("shard").parquet(path)
    new = fresh.select("sha256", F.lit(True).alias("stored"))
    return given.select("sha256", F.length("content").cast("long").alias("bytes")).join(new, "sha256", "left").withColumn("stored", F.coalesce("stored", F.lit(False)))


def forbidden_fields(schema: T.DataType, words: tuple[str, ...] = ("abstract_text", "fulltext_text", "payload", "content", "token", "email"), at: str = "") -> list[str]:
    """Paths of fields that a public receipt must not have."""
    if isinstance(schema, T.StructType):
        own = [f"{at}{f.name}" for f in schema.fields if f.name.lower() in words]
        return own + [x for f in schema.fields for x in forbidden_fields(f.dataType, words, f"{at}{f.name}.")]
    if isinstance(schema, T.ArrayType):
        return forbidden_fields(schema.elementType, words, at)
    if isinstance(schema, T.MapType):
        return forbidden_fields(schema.valueType, words, at)
    return []


def publish_receipts(df: DataFrame, path: str) -> None:
    found = forbidden_fields(df.schema)
    if found:
        raise ValueError(f"not for publication: {found}")
    df.coalesce(1).write.mode("errorifexists").json(path)
