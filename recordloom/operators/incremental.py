"""Components kept in a store and updated by what is new.

A component's name is its smallest record, so names and records are one set of
nodes: a batch's records are linked to each other by shared aliases, and to the
names of the components that already hold their aliases. Only that graph is
contracted; of the store, only the buckets of the batch's aliases and records
are read. Components that a batch joins aren't rewritten: a table of roots says
which name each merged one goes by now, with chains resolved as it is written.

    aliases/batch=N/bucket=B   alias, component (its name when the batch came)
    records/batch=N/bucket=B   record, component
    roots/batch=N              component, root: whole after every batch

A batch is in force once its roots are written, which comes last; what a broken
attempt left is written over by the next, and a batch that is in force is not
taken again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.graph import connected_components
from recordloom.operators.joins import small
from recordloom.plans.lineage import cut

BUCKETS = 256


def _bucket(c: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


class Components:
    """A store of components at a folder that all executors share. Records are whole numbers; ``buckets`` stays what it was when the store began."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets or BUCKETS

    def _done(self) -> list[int]:
        """The batches in force, in order."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/roots/batch=*/_SUCCESS")
        found = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
        return sorted(int(f.getPath().getParent().getName().partition("=")[2]) for f in found)

    def _read(self, name: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
        done = self._done()
        if not done:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, batch long, bucket int").parquet(f"{self.path}/{name}").filter(F.col("batch").isin(done))
        return (rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))).drop("batch", "bucket")

    def roots(self) -> DataFrame:
        done = self._done()
        return self.spark.read.parquet(f"{self.path}/roots/batch={done[-1]}") if done else self.spark.createDataFrame([], "component long, root long")

    def _rooted(self, rows: DataFrame) -> DataFrame:
        return rows.join(small(self.roots()), "component", "left").withColumn("component", F.coalesce("root", "component")).drop("root")

    def labels(self) -> DataFrame:
        """(record, component) of every record in the store."""
        return self._rooted(self._read("records", "record long, component long")).select("record", "component")

    def _write(self, rows: DataFrame, name: str, key: str, batch: int) -> None:
        # Tasks by size, not one a bucket: a bucket of many rows is written by several.
        rows.withColumn("bucket", _bucket(key, self.buckets)).hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/batch={batch}")

    def add(self, records: DataFrame, batch: int, record: str = "record", aliases: str = "aliases") -> bool:
        """Takes in records with an array of aliases; says whether the batch was new.

        Records that the store holds already keep what they have; new aliases of
        theirs count. Null records and aliases are ignored, repeated rows are one.
        """
        if batch in self._done():
            return False
        given = cut(records.filter(F.col(record).isNotNull()).select(F.col(record).cast("long").alias("record"), F.explode_outer(aliases).alias("alias")).distinct())
        # No more numbers than there are buckets.
        touched = {c: [r[0] for r in given.filter(f"{c} is not null").select(_bucket(c, self.buckets)).distinct().collect()] for c in ("record", "alias")}
        known = self._rooted(self._read("records", "record long, component long", touched["record"]).join(given.select("record").distinct(), "record", "left_semi"))
        held = self._rooted(self._read("aliases", "alias string, component long", touched["alias"]).join(given.select("alias").distinct(), "alias", "left_semi")).groupBy("alias").agg(F.min("component").alias("component"))
        known, held, said = cut(known), cut(held), given.filter("alias is not null")
        first = cut(said.groupBy("alias").agg(F.min("record").alias("first"), F.count(F.lit(1)).alias("n")).join(held, "alias", "left"))
        shared = first.filter("n > 1 or component is not null").select("alias", F.coalesce("component", "first").alias("to"))
        edges = said.join(shared, "alias").select(F.col("record").alias("a"), F.col("to").alias("b")).unionByName(known.select(F.col("record").alias("a"), F.col("component").alias("b")))
        # An alias may name several components of the store only if a batch joined them, and then they share a root.
        linked = cut(connected_components(edges))
        label = lambda df, c: df.join(linked.select(F.col("node").alias(c), F.col("component").alias("now")), c, "left").withColumn("now", F.coalesce("now", c))
        fresh = label(given.select("record").distinct().join(known.select("record"), "record", "left_anti"), "record")
        self._write(fresh.select("record", F.col("now").alias("component")), "records", "record", batch)
        # The roots rename what an alias has been given before, so only new ones are written.
        self._write(label(first.filter("component is null"), "first").select("alias", F.col("now").alias("component")), "aliases", "alias", batch)
        old = held.select("component").unionByName(known.select("component")).distinct()
        moved = cut(label(old, "component").filter("now <> component").select("component", F.col("now").alias("root")))
        kept = self.roots().join(moved.select(F.col("component").alias("root"), F.col("root").alias("newer")), "root", "left").select("component", F.coalesce("newer", "root").alias("root"))
        kept.unionByName(moved).coalesce(8).write.mode("overwrite").parquet(f"{self.path}/roots/batch={batch}")
        return True


def add_stream(stream: DataFrame, store: Components, checkpoint: str):
    """Keeps a store by a stream of (record, aliases); each micro-batch is a batch, taken once whatever is tried again."""
    return stream.writeStream.foreachBatch(lambda df, n: store.add(df, int(n)) and None).option("checkpointLocation", checkpoint)
