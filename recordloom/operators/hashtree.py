"""Trees of SHA-256 digests over the rows of a table, however they are partitioned.

A row's digest is that of its JSON with sorted names and nulls kept. Rows are
dealt to leaves by the first hex digits of their key's digest; a leaf's digest is
that of its rows' in order, with how often each is there, and a node's that of its
children. A tree is a table (prefix, digest, rows), the root's prefix empty. Two
tables are equal if their roots are; where not, the differing leaves are found by
descending, and only their rows need be looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.operators.joins import small
from recordloom.plans.lineage import cut

#: Different rows of a leaf that a tree is made for, and the deepest it gets (16 ** 6 leaves).
LEAF_ROWS, DEEPEST = 2_048, 6


def _digest(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def depth_for(rows: int) -> int:
    depth = 1
    while depth < DEEPEST and rows > LEAF_ROWS * 16**depth:
        depth += 1
    return depth


def _rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """(place, row, times): equal rows meet in each task first, so many copies of one are one row here."""
    return df.select(_digest(keys).alias("place"), _digest(df.columns).alias("row")).groupBy("place", "row").agg(F.count(F.lit(1)).alias("times"))


def tree(df: DataFrame, keys: list[str], depth: int | None = None) -> DataFrame:
    """(prefix, digest, rows) of every node, root and leaves included; an empty table has a root alone."""
    rows = cut(_rows(df, keys))
    depth = depth or depth_for(rows.count())
    said = F.concat_ws("|", F.transform(F.array_sort(F.collect_list(F.struct("row", "times"))), lambda r: F.concat(r["row"], F.lit(":"), r["times"].cast("string"))))
    level = cut(rows.groupBy(F.substring("place", 1, depth).alias("prefix")).agg(F.sha2(said, 256).alias("digest"), F.sum("times").alias("rows")))
    nodes = level
    for d in range(depth - 1, -1, -1):
        joined = F.concat_ws("|", F.transform(F.array_sort(F.collect_list(F.struct("prefix", "digest"))), lambda c: F.concat(c["prefix"], F.lit(":"), c["digest"])))
        by = F.substring("prefix", 1, d) if d else F.lit("")
        level = level.groupBy(by.alias("parent")).agg(F.sha2(joined, 256).alias("digest"), F.sum("rows").alias("rows")).select(F.col("parent").alias("prefix"), "digest", "rows")
        nodes = nodes.unionByName(level)
    if rows.limit(1).count():
        return nodes
    return rows.sparkSession.range(1).select(F.lit("").alias("prefix"), F.sha2(F.lit(""), 256).alias("digest"), F.lit(0).cast("long").alias("rows"))


def root(nodes: DataFrame) -> str:
    return nodes.filter("prefix = ''").first()["digest"]


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(prefix) of the leaves in which two trees of one depth differ; a level is compared only below what differs above it."""
    depth = max(x.agg(F.max(F.length("prefix"))).first()[0] for x in (a, b))
    found = None
    for d in range(depth + 1):
        x, y = (t.filter(F.length("prefix") == d) for t in (a, b))
        if found is not None:
            x, y = (t.join(small(found.withColumnRenamed("prefix", "above")), F.substring("prefix", 1, d - 1) == F.col("above") if d > 1 else F.col("above") == "", "left_semi") for t in (x, y))
        both = x.select("prefix", "digest").join(y.select("prefix", F.col("digest").alias("other")), "prefix", "full_outer")
        found = cut(both.filter(~F.col("digest").eqNullSafe(F.col("other"))).select("prefix"))
    return found


def changed(before: DataFrame, after: DataFrame, keys: list[str], a: DataFrame | None = None, b: DataFrame | None = None) -> DataFrame:
    """(keys, change, prefix): rows ADDED, REMOVED or CHANGED, found by way of the trees; rows of equal leaves are only filtered out."""
    if a is None or b is None:
        depth = depth_for(before.count())
        a, b = a or tree(before, keys, depth), b or tree(after, keys, depth)
    leaves = differing(a, b)
    depth = max(1, leaves.agg(F.max(F.length("prefix"))).first()[0] or 1)
    only = small(leaves)
    near = lambda df, name: df.withColumn("prefix", F.substring(_digest(keys), 1, depth)).join(only, "prefix", "left_semi").groupBy(*keys, "prefix").agg(F.array_sort(F.collect_list(_digest(df.columns))).alias(name))
    both = near(before, "was").join(near(after, "now"), [*keys, "prefix"], "full_outer").filter(~F.col("was").eqNullSafe(F.col("now")))
    return both.select(*keys, F.when(F.col("was").isNull(), "ADDED").when(F.col("now").isNull(), "REMOVED").otherwise("CHANGED").alias("change"), "prefix")
