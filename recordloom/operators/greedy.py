"""Greedy choice within groups: each row in order is taken unless what was taken before it blocks it.

What blocks a row once blocks it for good, as titles are only added and counts
only rise. So a group is gone through by frontiers: the first rows that nothing
blocks yet, so many of each group, are played against what the group holds; what
is blocked by then is dropped where it stands, and the next frontier begins
behind the last. A frontier and a group's choice are small whatever the group
holds, and each frontier takes a row at least, so a group needs no more of them
than it may take; most need one.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.operators.caps import top_per_group
from recordloom.plans.lineage import cut

#: Rows of a group that are played at a time, and taken rows (or groups) up to which choices are broadcast.
FRONTIER, MAX_STATES = 256, 2_000
TAKEN = "g string, phase int, turn int, held int, pos long, rest long, key string, tokens array<string>, topic string"


def jaccard(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a and b else 0.0


def similar(a: Column, b: Column, near: float) -> Column:
    """Whether two arrays, as sets, are at least so alike; empty ones are like nothing. Sets of too different sizes aren't compared."""
    m, n = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    return (F.least(m, n) > 0) & (F.least(m, n) >= near * F.greatest(m, n)) & (both / F.greatest(m + n - both, F.lit(1)) >= near)


def blocked(held: Column, tokens: Column, topic: Column, near: float, topic_cap: Column) -> Column:
    """Whether the rows ``held`` (tokens, topic) block another."""
    return F.exists(held, lambda h: similar(h["tokens"], tokens, near)) | (F.size(F.filter(held, lambda h: h["topic"].eqNullSafe(topic))) >= topic_cap)


def histories(taken: DataFrame) -> DataFrame:
    """(g, hist): what each group has taken, in order; never more than its cap."""
    columns = ("phase", "turn", "held", "pos", "rest", "key", "tokens", "topic")
    return taken.groupBy("g").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("hist"))


def _play(phase: int, near: float, frontier: int):
    def group(front: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        titles, topics, keys = [frozenset(t) for t in held["tokens"]], Counter(held["topic"]), set(held["key"])
        turn, out, room = int((held["phase"] == phase).sum()), [], True
        front = front.sort_values("pos")
        for r in front.itertuples():
            room = len(titles) < r.stop
            if not room:
                break
            tokens = frozenset(r.tokens)
            if r.key in keys or topics[r.topic] >= r.topic_cap or any(jaccard(tokens, t) >= near for t in titles):
                continue
            turn += 1
            out.append((r.g, phase, turn, len(titles), r.pos, r.rest, r.key, list(r.tokens), r.topic))
            titles.append(tokens)
            topics[r.topic] += 1
            keys.add(r.key)
        if room and len(front) == frontier:
            last = front.iloc[-1]
            out.append((last.g, phase, None, None, last.pos, None, None, None, None))
        made = pd.DataFrame(out, columns=[c.split(" ")[0] for c in TAKEN.split(", ")])
        return made.astype({c: "Int64" for c in ("phase", "turn", "held", "pos", "rest")})

    return group


def choose(rows: DataFrame, taken: DataFrame, phase: int, near: float, frontier: int | None = None) -> DataFrame:
    """``taken`` and what a phase adds to it.

    ``rows``: g, key, pos (their order within a group), rest (a place that is
    kept along), tokens, topic, topic_cap and stop, the number of rows at which
    the group is full. Arrays hold no element twice. ``taken`` has the columns
    of ``TAKEN``.
    """
    frontier, more, n_more, n_taken, round_ = frontier or FRONTIER, None, 0, taken.count(), 0
    few = lambda df, n: F.broadcast(df) if n <= MAX_STATES else df
    while True:
        left = rows if more is None else rows.join(few(more, n_more), "g").filter("pos > after").drop("after")
        if n_taken:
            free = left.join(few(histories(taken), n_taken), "g", "left")
            is_free = (F.size("hist") < F.col("stop")) & ~blocked(F.col("hist"), F.col("tokens"), F.col("topic"), near, F.col("topic_cap"))
            left = free.filter(F.when(F.col("hist").isNull(), F.lit(True)).otherwise(is_free)).drop("hist")
        front = top_per_group(left, ["g"], [F.col("pos")], frontier, rank="__n").drop("__n")
        made = cut(front.groupBy("g").cogroup(taken.groupBy("g")).applyInPandas(_play(phase, near, frontier), TAKEN))
        # Two numbers reach the driver: rows taken, and groups that have rows behind their frontier.
        n_new, n_more = made.agg(F.count("key"), F.count_if(F.col("key").isNull())).first()
        taken, n_taken, round_ = taken.unionByName(made.filter("key is not null")), n_taken + n_new, round_ + 1
        if round_ % 8 == 0:
            taken = cut(taken.coalesce(8))
        if not n_more:
            return cut(taken.coalesce(8)) if round_ > 1 else taken
        more = made.filter("key is null").select("g", F.col("pos").alias("after"))
