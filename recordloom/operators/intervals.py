"""Joins of closed intervals of days on overlap, as equi-joins on bins.

An interval belongs to the narrowest width of bins that isn't shorter than it,
so it touches two of them at the most. Two intervals that overlap share a bin of
the wider one's width, and meet there: each is listed under its own width and
every wider one, no more than two bins each, whatever its length. Of two bins
that a pair shares the later of their first ones counts, so pairs come once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.period import interval
from recordloom.operators.joins import small

#: Days of a bin: a day, a month, a year, and so on by tens; longer intervals are listed by the last one's bins.
WIDTHS = (1, 31, 366, 3_660, 36_600, 366_000, 3_660_000)


def _listed(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """Each row once for each bin of its own and every wider width."""
    a, b = F.unix_date(start), F.unix_date(end)
    level = F.lit(len(WIDTHS) - 1)
    for i in range(len(WIDTHS) - 2, -1, -1):
        level = F.when(b - a < WIDTHS[i], i).otherwise(level)
    bins = lambda day, i: F.floor(day / F.lit(WIDTHS[i])).cast("int")
    lists = [F.when(level <= i, F.transform(F.sequence(bins(a, i), bins(b, i)), _at(i, bins(a, i)))).otherwise(F.array().cast("array<struct<width:int,bin:int,first:int>>")) for i in range(len(WIDTHS))]
    return df.filter(F.col(start) <= F.col(end)).withColumn(f"__{name}", level).withColumn("__b", F.explode(F.flatten(F.array(*lists)))).withColumns({"__width": F.col("__b.width"), "__bin": F.col("__b.bin"), f"__{name}_first": F.col("__b.first")}).drop("__b")


def _at(width: int, first: Column):
    return lambda n: F.struct(F.lit(width).alias("width"), n.alias("bin"), first.alias("first"))


def overlap_join(left: DataFrame, right: DataFrame, left_ends: tuple[str, str], right_ends: tuple[str, str]) -> DataFrame:
    """Every pair of rows whose intervals share a day; column names of the sides must differ. Intervals without an end, or that end before they start, meet nothing."""
    x, y = _listed(left, *left_ends, "x"), _listed(right, *right_ends, "y")
    pairs = x.join(small(y), ["__width", "__bin"])
    once = (F.col("__width") == F.greatest("__x", "__y")) & (F.col("__bin") == F.greatest("__x_first", "__y_first"))
    meet = (F.col(left_ends[0]) <= F.col(right_ends[1])) & (F.col(right_ends[0]) <= F.col(left_ends[1]))
    return pairs.filter(once & meet).drop("__width", "__bin", "__x", "__y", "__x_first", "__y_first")


def dated_in(articles: DataFrame, editions: DataFrame, date: str, precision: str, start: str, end: str) -> DataFrame:
    """Articles, dated by day, month or year, beside every edition whose period their date may fall in."""
    a, b = interval(F.col(date), F.col(precision))
    return overlap_join(articles.withColumns({"__from": a, "__to": b}), editions, ("__from", "__to"), (start, end)).drop("__from", "__to")


def dated_totals(articles: DataFrame, editions: DataFrame, date: str, precision: str, start: str, end: str, totals: dict[str, tuple[Column, Callable[[str], Column]]]) -> DataFrame:
    """Every edition that articles may fall in, beside what they come to: for each name an aggregate of articles, and how two of its values make one.

    Articles meet as one row a period that they may mean, and editions as one a
    period, so no pair of an article and an edition is made: there are no more
    meetings than pairs of different periods.
    """
    a, b = interval(F.col(date), F.col(precision))
    meant = articles.withColumns({"__from": a, "__to": b}).filter("__from <= __to").groupBy("__from", "__to").agg(*(each.alias(n) for n, (each, _) in totals.items()))
    periods = editions.select(F.col(start).alias("__opens"), F.col(end).alias("__closes")).distinct()
    met = overlap_join(meant, periods, ("__from", "__to"), ("__opens", "__closes")).groupBy("__opens", "__closes").agg(*(merge(n).alias(n) for n, (_, merge) in totals.items()))
    return editions.join(met, (F.col(start) == F.col("__opens")) & (F.col(end) == F.col("__closes"))).drop("__opens", "__closes")
