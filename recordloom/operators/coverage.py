"""Which days of each group are covered: windows merged into islands, the gaps between them, and months by how whole they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def islands(windows: DataFrame, group: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """(group, start, end, windows): closed windows of days that overlap or touch, as one.

    Windows that end before they start, or lack an end, cover nothing. Of the
    windows that start on one day only the last end matters, and that is found
    in each task first, so a group costs a row a day of the calendar at the
    most, however many windows it has.
    """
    valid = windows.filter(F.col(start) <= F.col(end)).groupBy(*group, F.col(start).alias("start")).agg(F.max(end).alias("end"), F.count(F.lit(1)).alias("windows"))
    order = Window.partitionBy(*group).orderBy("start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > F.date_add(reach, 1), F.lit(True))
    numbered = valid.withColumn("__opens", opens.cast("int")).withColumn("__n", F.sum("__opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*group, "__n").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("windows").alias("windows")).drop("__n")


def gaps(covered: DataFrame, group: list[str]) -> DataFrame:
    """(group, start, end, days) of what lies between the islands of a group."""
    order = Window.partitionBy(*group).orderBy("start")
    between = covered.withColumn("__from", F.date_add(F.lag("end").over(order), 1)).filter("__from is not null")
    return between.select(*group, F.col("__from").alias("start"), F.date_sub("start", 1).alias("end")).withColumn("days", F.datediff("end", "start") + 1)


def months(covered: DataFrame, group: list[str]) -> DataFrame:
    """(group, month, days, flag) of each month that an island touches: COMPLETE, or PARTIAL."""
    each = covered.withColumn("month", F.explode(F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month"))))
    inside = F.datediff(F.least("end", F.last_day("month")), F.greatest("start", F.col("month"))) + 1
    days = each.groupBy(*group, "month").agg(F.sum(inside).cast("int").alias("days"))
    return days.withColumn("flag", F.when(F.col("days") == F.dayofmonth(F.last_day("month")), "COMPLETE").otherwise("PARTIAL"))


def missing_days(covered: DataFrame, group: list[str]) -> DataFrame:
    """(group, day): every day between a group's first and last that nothing covers."""
    return gaps(covered, group).select(*group, F.explode(F.sequence("start", "end")).alias("day"))


def registry_months(registry: DataFrame, covered: DataFrame, slug: str, month: str) -> DataFrame:
    """Every journal of a registry with how whole a month is: COMPLETE, PARTIAL or NONE, and its covered days."""
    own = months(covered, [slug]).filter(F.col("month") == F.lit(month).cast("date")).select(slug, "days", "flag")
    return registry.join(own, slug, "left").withColumns({"days": F.coalesce("days", F.lit(0)), "flag": F.coalesce("flag", F.lit("NONE"))})
