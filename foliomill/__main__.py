"""Command line: list the queries, or run one over a folder of tables and write its rows.

    python -m foliomill list
    python -m foliomill run NAME FOLDER OUT [--format parquet|json|csv] [--master local[*]]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.all import QUERIES


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="foliomill", description=__doc__.splitlines()[0])
    todo = parser.add_subparsers(dest="todo", required=True)
    todo.add_parser("list", help="names of all queries")
    run = todo.add_parser("run", help="run a query and write its rows")
    run.add_argument("name", choices=sorted(QUERIES), metavar="NAME")
    run.add_argument("folder", help="folder of the tables, one Parquet each")
    run.add_argument("out", help="folder to write, which must not exist")
    run.add_argument("--format", choices=("parquet", "json", "csv"), default="parquet")
    run.add_argument("--master", help="Spark master; that of the environment if absent")
    given = parser.parse_args(argv)
    if given.todo == "list":
        print(*sorted(QUERIES), sep="\n")
        return 0
    builder = SparkSession.builder.appName(f"foliomill {given.name}").config("spark.sql.session.timeZone", "UTC")
    spark = (builder.master(given.master) if given.master else builder).getOrCreate()
    QUERIES[given.name](spark, given.folder).write.format(given.format).save(given.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
