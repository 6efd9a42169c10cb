r"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations alone.

A source whose target is x times its size takes each of its documents x times
in expectation: floor(x) times for certain, and once more with the probability
that is left over. Two documents at a time are settled: words move from one to
the other, in a direction drawn so that neither's expectation changes, until
one of them is taken or not for certain. Moving words keeps what the two take
together, so of all a source's documents only one remains unsettled at the end,
and the source takes its target to within that document.

Documents of more than 1/LARGE of a source, of which it can hold no more than
LARGE, are settled first, and what is unsettled of them against all the smaller
ones together, whose probabilities rise or fall a little. So the last one is small.

The smaller ones are dealt to buckets of about FAN by a hash; each bucket leaves
at most one unsettled document, FAN buckets meet in one of the next level, and so
on to one a source: a tree whose groups are small at every level, whatever a
source holds. All draws are hashes of the seed and the documents, so reruns agree
however rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.tables import table
from recordloom.operators.joins import hot_join
from recordloom.operators.orders import numbered
from recordloom.plans.lineage import cut

#: Words, as the mix counts them.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, MOST = (1, 2, 3), 3
FAN, LARGE, SEED = 64, 1000, 11
#: Probabilities within this of 0 or 1 are settled.
NEAR = 1e-9
#: Copies of one row are dealt out this many at a time.
_BLOCK = 4096


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _draw(seed: int, *of: Column | str) -> Column:
    """A number from 0 up to 1 that depends on the seed and ``of`` alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11) / F.lit(float(1 << 53))


def _item(of: Column, x: Column) -> Column:
    return F.struct((-of["size"]).alias("o"), *(of[c].alias(c) for c in ("h", "doc_id", "t", "size")), x.alias("x"))


def _settled(of: Column, up: Column) -> Column:
    return F.struct(*(of[c].alias(c) for c in ("doc_id", "t", "size")), up.cast("int").alias("up"))


def settle(items: Column, seed: int) -> Column:
    """(settled, left) of an array of items (o, h, doc_id, t, size, x): all but one at most are settled, the array's order is theirs."""
    state = lambda out, left: F.struct(out.alias("settled"), left.alias("left"))

    def pair(acc: Column, e: Column) -> Column:
        r = acc["left"]
        rise, fall = r["size"] * (1 - r["x"]), r["size"] * r["x"]
        gives, takes = e["size"] * e["x"], e["size"] * (1 - e["x"])
        up, down = F.least(rise, gives), F.least(fall, takes)
        drawn = F.struct(up.alias("up"), down.alias("down"), (_draw(seed, r["h"], e["h"]) * (up + down) < down).alias("rises"))

        def moved(d: Column) -> Column:
            first = F.when(d["rises"], rise <= gives).otherwise(fall <= takes)
            one = F.when(first, _settled(r, d["rises"])).otherwise(_settled(e, ~d["rises"]))
            words = F.when(d["rises"], d["up"]).otherwise(-d["down"])
            left = F.when(first, _item(e, e["x"] - words / e["size"])).otherwise(_item(r, r["x"] + words / r["size"]))
            return F.struct(one.alias("one"), left.alias("left"))

        def kept(m: Column) -> Column:
            sure = (m["left"]["x"] < NEAR) | (m["left"]["x"] > 1 - NEAR)
            both = F.when(sure, F.array(m["one"], _settled(m["left"], m["left"]["x"] > 0.5))).otherwise(F.array(m["one"]))
            return state(F.concat(acc["settled"], both), F.when(~sure, m["left"]))

        return _let(_let(drawn, moved), kept)

    nothing = state(F.slice(F.transform(items, lambda e: _settled(e, F.lit(0))), 1, 0), F.get(items, F.lit(-1)))
    return F.aggregate(items, nothing, lambda acc, e: F.when(acc["left"].isNull(), state(acc["settled"], e)).otherwise(pair(acc, e)))


def _settle_groups(units: DataFrame, by: list[str], seed: int) -> DataFrame:
    """One row a group of items ``u``: settled, left, and all its words."""
    groups = units.groupBy(*by).agg(F.array_sort(F.collect_list("u")).alias("items"), F.sum("u.size").alias("words"))
    return groups.select(*by, "words", settle(F.col("items"), seed).alias("s")).select(*by, "words", "s.settled", "s.left")


def _named(key: Column) -> Column:
    """A name for every key, null too, that sorts by code point with null last."""
    return F.when(key.isNull(), "b").otherwise(F.concat(F.lit("a"), key.cast("string")))


def word_counts(docs: DataFrame, key: str = "source") -> DataFrame:
    """(key, doc_id, t, size, rows): each different row once, with its words and how often it is there; t is a hash of its text."""
    slim = docs.select(F.col(key).alias("key"), "doc_id", F.xxhash64("text").alias("t"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return slim.groupBy("key", "doc_id", "t", "size").agg(F.count(F.lit(1)).alias("rows"))


def targets(counts: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(g, n, source_size, target): a row for each key of ``word_counts``.

    Keys in code point order, null last, weigh as ``weights``, repeating, and
    share the size of all; a target stops at ``most`` times its source's size,
    and the excess is reshared by weight until none is above. The shares of a
    round follow from three sums, which alone reach the driver.
    """
    sums = cut(counts.groupBy(_named(F.col("key")).alias("g")).agg(F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("size")).alias("source_size")))
    weight = F.get(F.array(*map(F.lit, weights)), ((F.col("at") - 1) % len(weights)).cast("int"))
    of = cut(numbered(sums, ["g"], "at").select("g", "n", "source_size", weight.alias("w")))
    total = of.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while total:
        above = F.lit(level) * F.col("w") > most * F.col("source_size")
        held, w, n = of.agg(F.sum(F.when(above, most * F.col("source_size"))), F.sum(F.when(~above, F.col("w"))), F.count_if(above)).first()
        if n == full:
            break
        full, level = n, (total - (held or 0)) / w
    return of.select("g", "n", "source_size", F.least((most * F.col("source_size")).cast("double"), F.lit(level) * F.col("w")).alias("target"))


def mix(docs: DataFrame, key: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """(key, doc_id, t, size, copies, source_size, target) of every row: how often the mix takes it.

    Null and blank texts have size 0 and are taken 0 times; null keys are a
    source of their own; null doc_ids and repeated rows are rows like any other,
    settled one by one; ties in size are in the order of their hashes. A text of
    any length counts whole. An empty table gives an empty result, and extra
    columns are ignored.
    """
    counts = cut(word_counts(docs, key))
    of = targets(counts, weights, most).withColumn("x", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    of = cut(of.withColumn("base", F.floor(F.col("x") + NEAR)).withColumn("x", F.greatest(F.col("x") - F.col("base"), F.lit(0.0))))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / _BLOCK)))
    each = F.explode(F.sequence(F.col("k") * _BLOCK, F.least(F.col("rows") - 1, F.col("k") * _BLOCK + (_BLOCK - 1))))
    units = counts.withColumn("k", block).withColumn("k", each).select(_named(F.col("key")).alias("g"), "doc_id", "t", "size", F.xxhash64(F.lit(seed), "doc_id", "t", "size", "k").alias("h"))
    item = F.struct((-F.col("size")).alias("o"), "h", "doc_id", "t", "size", "x").alias("u")
    is_open, is_large = (F.col("size") > 0) & (F.col("x") > NEAR), F.col("size") * LARGE > F.col("source_size")

    drawn = hot_join(units, of.select("g", "n", "source_size", "x"), "g", "n")
    still = drawn.filter(~is_open).select("g", F.struct("doc_id", "t", "size", F.lit(0).alias("up")).alias("s"))
    big = cut(_settle_groups(drawn.filter(is_open & is_large).select("g", item), ["g"], seed))

    # What is unsettled of the large ones, against all smaller ones together.
    r, rest = F.col("left"), F.col("source_size") - F.coalesce("words", F.lit(0))
    lower, higher = F.col("x") - F.try_divide(r["size"] * (1 - r["x"]), rest), F.col("x") + F.try_divide(r["size"] * r["x"], rest)
    fits = F.coalesce((lower >= 0) & (higher <= 1), F.lit(False))
    rises = _draw(seed + 1, r["h"]) < r["x"]
    moved = cut(of.filter(F.col("x") > NEAR).join(big, "g", "left").select(
        "g", "n", "source_size", F.when(fits & rises, lower).when(fits, higher).otherwise(F.col("x")).alias("x"),
        F.when(fits, _settled(r, rises)).alias("one"), F.when(~fits, r).alias("left"), F.ceil(F.col("n") / FAN).alias("buckets"),
    ))
    small = hot_join(units, moved.drop("one", "left"), "g", "n").filter((F.col("size") > 0) & ~is_large)
    sure = (F.col("x") < NEAR) | (F.col("x") > 1 - NEAR)
    done = [
        still, big.select("g", F.explode("settled").alias("s")), moved.filter("one is not null").select("g", F.col("one").alias("s")),
        small.filter(sure).select("g", F.struct("doc_id", "t", "size", (F.col("x") > 0.5).cast("int").alias("up")).alias("s")),
    ]

    level, rows, depth = small.filter(~sure).select("g", F.pmod("h", "buckets").alias("b"), item), of.agg(F.max("n")).first()[0] or 0, 0
    while depth == 0 or FAN ** depth < rows:
        depth += 1
        at = cut(_settle_groups(level, ["g", "b"], seed + 1 + depth))
        done.append(at.select("g", F.explode("settled").alias("s")))
        level = at.filter("left is not null").select("g", F.floor(F.col("b") / FAN).alias("b"), F.col("left").alias("u"))
    last = _settle_groups(level.select("g", "u").unionByName(moved.filter("left is not null").select("g", F.col("left").alias("u"))), ["g"], seed)
    alone = _settled(F.col("left"), _draw(seed + 1, F.col("left.h")) < F.col("left.x"))
    done.append(last.select("g", F.explode(F.when(F.col("left").isNull(), F.col("settled")).otherwise(F.concat("settled", F.array(alone)))).alias("s")))

    every = reduce(DataFrame.unionByName, done).select("g", "s.*")
    joined = hot_join(every, of.select("g", "n", "source_size", "target", "base"), "g", "n")
    return joined.select(F.expr("CASE WHEN g <> 'b' THEN substring(g, 2) END").alias(key), "doc_id", "t", "size", (F.col("base") + F.col("up")).alias("copies"), "source_size", "target")


def mixture(docs: DataFrame, mixed: DataFrame, key: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them, with a column ``copy`` from 1.

    Rows that repeat a key, doc_id and text stand for each other: the first of
    them gives all their copies.
    """
    same = [key, "doc_id", "t"]
    copies = mixed.groupBy(*same).agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows")).filter("__copies > 0")
    copies = copies.select(*(F.col(c).alias(f"__{c}") for c in same), "__copies", "__rows")
    on = F.col(key).cast("string").eqNullSafe(F.col(f"__{key}")) & F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.xxhash64("text") == F.col("__t"))
    found = docs.join(copies, on)
    names = [f"__{c}" for c in same]
    one = found.filter("__rows = 1").unionByName(found.filter("__rows > 1").dropDuplicates(names))
    return one.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns, "copy")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
