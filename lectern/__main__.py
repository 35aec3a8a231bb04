"""Command line: ``python -m lectern list``, ``run QUERY TABLES [OUT]`` and ``lint TABLES [--rule R] [--limit N]``.

``run`` writes a query's result as Parquet, or shows its first rows. ``lint`` shows the first violations of each rule and
ends with status 1 where there are any.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(args: list[str], spark: SparkSession | None = None) -> int:
    from lectern import catalog

    parser = argparse.ArgumentParser(prog="lectern", description=__doc__)
    verbs = parser.add_subparsers(dest="verb", required=True)
    verbs.add_parser("list")
    run = verbs.add_parser("run")
    run.add_argument("query")
    run.add_argument("tables")
    run.add_argument("out", nargs="?")
    lint = verbs.add_parser("lint")
    lint.add_argument("tables")
    lint.add_argument("--rule")
    lint.add_argument("--limit", type=int, default=8)
    given = parser.parse_args(args)
    if given.verb == "list":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    spark = spark or SparkSession.builder.appName("lectern").getOrCreate()
    if given.verb == "run":
        if given.query not in catalog.QUERIES:
            print(f"no query {given.query}", file=sys.stderr)
            return 2
        rows = catalog.QUERIES[given.query](spark, given.tables)
        rows.write.mode("overwrite").parquet(given.out) if given.out else rows.show(20, truncate=False)
        return 0
    from lectern.operators import rules

    found = rules.examples(catalog.lint_of(spark, given.tables), given.limit, given.rule).orderBy("rule", "place").collect()
    for r in found:
        print(f"{r.rule}\t{r.slug}\t{r.message}")
    return 1 if found else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
