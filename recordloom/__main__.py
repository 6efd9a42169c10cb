"""Command line: python -m recordloom COMMAND --help."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="recordloom")
    sub = parser.add_subparsers(dest="command", required=True)
    j = sub.add_parser("journals", help="list the registry")
    j.add_argument("registry")
    for name in ("status", "category", "publisher", "mode"):
        j.add_argument(f"--{name}")
    for name, text in (("resolve", "resolve duplicate articles"), ("triage", "score, route and cap articles"), ("shortlist", "select from triaged records")):
        c = sub.add_parser(name, help=text)
        c.add_argument("source", help="Parquet")
        c.add_argument("out", help="Parquet to write")
        c.add_argument("--policy", help="JSON of the settings that differ")
        if name == "shortlist":
            c.add_argument("--priors", required=True, help="Parquet of slug, registry_category_percentile, unknown_metric")
    b = sub.add_parser("backfill", help="merge a delta into a base snapshot")
    b.add_argument("base")
    b.add_argument("delta")
    b.add_argument("out")
    b.add_argument("--key", default="canonical_id")
    b.add_argument("--order", help="column that orders a delta's repeated rows")
    v = sub.add_parser("validate", help="check articles; exit 1 if any rule is broken")
    v.add_argument("source")
    v.add_argument("start")
    v.add_argument("end")
    a = parser.parse_args(args)

    from pyspark.sql import functions as F

    from recordloom.operators import checks, identity, merge
    from recordloom.plans import funnel
    from recordloom.plans.policy import ShortlistPolicy, TriagePolicy
    from recordloom.sources import landed, sinks

    spark = SparkSession.builder.getOrCreate()
    read = spark.read.parquet
    if a.command == "journals":
        landed.registry_filter(landed.registry(spark, a.registry), a.status, a.category, a.publisher, a.mode).show(1000, truncate=False)
    elif a.command == "resolve":
        identity.deduplicate(read(a.source)).write.parquet(a.out)
    elif a.command == "triage":
        funnel.triage(read(a.source), TriagePolicy.load(a.policy)).write.parquet(a.out)
    elif a.command == "shortlist":
        funnel.shortlist(read(a.source), read(a.priors), ShortlistPolicy.load(a.policy)).write.parquet(a.out)
    elif a.command == "backfill":
        print(sinks.write_immutable(merge.merge_delta(read(a.base), read(a.delta), a.key, a.order).drop("origin"), a.out))
    else:
        found = checks.articles(read(a.source), F.lit(a.start).cast("date"), F.lit(a.end).cast("date"))
        found.show(1000, truncate=False)
        return int(not found.isEmpty())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
