"""Connected components by alternating star contraction.

Each round applies a large-star and a small-star step (Kiveris et al., 2014)
as a grouped minimum and an equi-join. Minima are pre-aggregated before the
shuffle. A hub's edges would all meet in one task of the join, so the nodes of
the highest degrees are joined by broadcast instead: those with more than
1/HUBS of all edge ends, of which there can be no more than HUBS. No other minima
are broadcast, however small Spark takes them to be. Rounds are cut
by checkpoint(); nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.joins import shuffled
from recordloom.plans.lineage import cut

MAX_ROUNDS, HUBS, LEAST_HUB = 60, 50_000, 1000
LEAST_FILES, EDGES_A_FILE = 8, 200_000


def _with_lowest(ends: DataFrame, edges: int) -> DataFrame:
    """Rows (u, v) with m, the smallest node among u and its v."""
    low = ends.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    hub = F.col("n") > max(LEAST_HUB, 2 * edges // HUBS)
    hubs = F.broadcast(low.filter(hub).select("u", "m"))
    plain = ends.join(hubs.select("u"), "u", "left_anti").join(shuffled(low.filter(~hub).select("u", "m")), "u")
    return ends.join(hubs, "u").unionByName(plain)


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _with_lowest(both, n).filter("v > u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Links that lead to a part's smallest node leave no node with many smaller neighbours here.
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(shuffled(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``(node, component)`` for every node that has an edge to another.

    ``component`` is the smallest node that can be reached. Self loops, repeats
    and edges with a null end are ignored; an empty input gives an empty result.
    """
    measure = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    e = cut(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct())
    mark = measure(e)
    for _ in range(MAX_ROUNDS):
        if mark[0] == 0:
            break
        # A round never adds edges, so the count before it bounds every step's, and says how many files they need.
        e = cut(_small_star(_large_star(e, mark[0])).coalesce(max(LEAST_FILES, mark[0] // EDGES_A_FILE)))
        now = measure(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
