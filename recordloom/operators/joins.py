"""Lookups with the semantics of the curation funnel, as equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A lookup table is broadcast up to so many rows, counted before it is.
MAX_BROADCAST = 100_000


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, marked to be joined by shuffling both sides.

    Spark guesses sizes from those of files. Rows that are made from a key of a
    few bits are far larger, and would be gathered on the driver for a broadcast.
    """
    return df.hint("merge")


def small(df: DataFrame, most: int = MAX_BROADCAST) -> DataFrame:
    """``df``, marked for broadcast if it has no more than ``most`` rows, else for a shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else shuffled(df)


def hot_join(left: DataFrame, right: DataFrame, on: str, weight: str, most: int = 10_000, least: int = 200) -> DataFrame:
    """Inner join to a right side of one row a key, whose ``weight`` says how many left rows hold the key.

    A key of more than 1/most of all left rows, of which there can be no more
    than ``most``, is joined by broadcast, so its rows stay where they are and
    no task gathers them; all others are shuffled.
    """
    total = right.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    is_hot = F.col(weight) > max(least, total // most)
    hot = F.broadcast(right.filter(is_hot))
    rest = left.join(hot.select(on), on, "left_anti").join(right.filter(~is_hot), on)
    return left.join(hot, on).unionByName(rest)


def lookup(left: DataFrame, right: DataFrame, on: list[str], keep: str = "last", order: Column | None = None) -> DataFrame:
    """Left join to the first or last right row of a key, in ``order``."""
    if order is None:
        return left.join(right, on, "left")
    by = Window.partitionBy(*on).orderBy(order.asc() if keep == "first" else order.desc())
    one = right.withColumn("__rn", F.row_number().over(by)).filter("__rn = 1").drop("__rn")
    return left.join(one, on, "left")


def required(left: DataFrame, right: DataFrame, on: list[str], what: str) -> DataFrame:
    """Inner join that fails on the first left row without a partner."""
    found = left.join(right.withColumn("__found", F.lit(True)), on, "left")
    fail = F.raise_error(F.concat(F.lit(f"{what} missing "), F.concat_ws("|", *on)))
    return found.withColumn("__found", F.when(F.col("__found").isNull(), fail.cast("boolean")).otherwise(F.col("__found"))).filter("__found").drop("__found")


def matching(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), on, "left_semi")


def missing(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left rows whose key the right side lacks: unresolved references."""
    return left.join(right.select(*on), on, "left_anti")


def either_key(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id) that agree in any of the key pairs, each once: a union of equi-joins, not a nested loop.

    Two rows meet in the first key pair in which they agree and in no later one.
    Pairs of ids that one row each has are therefore different, and leave the
    join as they are made; only pairs with an id of several rows are gathered,
    to be told apart. So no task holds pairs, of which there may be as many as
    both sides' rows multiplied.
    """
    x, y = _by_rows(left, left_id, [a for a, _ in pairs], "__x"), _by_rows(right, right_id, [b for _, b in pairs], "__y")

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        found, before = None, F.lit(False)
        for i in range(len(pairs)):
            agree = F.col(f"__x{i}") == F.col(f"__y{i}")
            one = x.filter(F.col(f"__x{i}").isNotNull()).join(y.filter(F.col(f"__y{i}").isNotNull()), agree & ~before).select("__x", "__y")
            found, before = one if found is None else found.unionByName(one), before | F.coalesce(agree, F.lit(False))
        return found

    single = met(x.filter("not __xmany"), y.filter("not __ymany"))
    shared = met(x.filter("__xmany"), y).unionByName(met(x.filter("not __xmany"), y.filter("__ymany"))).distinct()
    return single.unionByName(shared).select(F.col("__x").alias(left_id), F.col("__y").alias(right_id))


def _by_rows(df: DataFrame, key: str, columns: list[str], name: str) -> DataFrame:
    """Different rows of an id and columns (``name``, and ``name`` with a number), and whether the id has several."""
    rows = df.select(F.col(key).alias(name), *(F.col(c).alias(f"{name}{i}") for i, c in enumerate(columns))).distinct()
    several = rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(name).alias("__id"))
    return rows.join(several, F.col(name).eqNullSafe(F.col("__id")), "left").withColumn(f"{name}many", F.col("__id").isNotNull()).drop("__id")


def published_providers(providers: DataFrame, editions: DataFrame, core: DataFrame, slug: str = "slug") -> DataFrame:
    """Provider journals that have an edition and aren't core journals, one row each."""
    return matching(missing(providers, core, [slug]), editions, [slug]).dropDuplicates([slug])


def resolve_policy(journals: DataFrame, defaults: DataFrame, overrides: DataFrame, slug: str, mode: str, settings: list[str]) -> DataFrame:
    """Settings by journal: its override, else its mode's default."""
    o = overrides.select(slug, *(F.col(s).alias(f"__o_{s}") for s in settings))
    d = defaults.select(mode, *(F.col(s).alias(f"__d_{s}") for s in settings))
    joined = journals.join(small(o), slug, "left").join(small(d), mode, "left")
    return joined.select(*journals.columns, *(F.coalesce(f"__o_{s}", f"__d_{s}").alias(s) for s in settings))


def terminal_status(attempts: Column, precedence: tuple[str, ...], default: str) -> Column:
    """The first status of ``precedence`` that any attempt has."""
    chain = None
    for s in precedence:
        chain = (F if chain is None else chain).when(F.array_contains(attempts, s), s)
    return chain.otherwise(default)


def best_available(found: dict[str, Column]) -> tuple[Column, Column]:
    """(value, source) of the first source that has a value."""
    return F.coalesce(*found.values()), F.coalesce(*(F.when(c.isNotNull(), F.lit(name)) for name, c in found.items()))
