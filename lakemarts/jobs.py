"""Command line for spark-submit: land, silver, gold, refresh, audit, pages.

    spark-submit --py-files lakemarts.zip lakemarts/jobs.py refresh audit --location /lake

Steps run in the given order in one session. With ``--location``, tables of
earlier runs are found again in sessions without a lasting catalog. Secrets are read
from environment variables, whose names are given, and so stay off the command line.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from lakemarts.plans import medallion
from lakemarts.schemas import TABLES, TableSpec
from lakemarts.settings import LakeSettings, cluster_session, shuffle_partitions
from lakemarts.sources import readers

GIGABYTE = 1024**3
STEPS = ("land", "silver", "gold", "refresh", "audit", "pages")


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lakemarts")
    parser.add_argument("steps", nargs="+", choices=STEPS)
    parser.add_argument("--catalog", help="catalog in front of the database names")
    parser.add_argument("--database-prefix", default="")
    parser.add_argument("--location", help="folder of the databases")
    parser.add_argument("--table-format", default="parquet")
    parser.add_argument("--blank-pii", choices=("hash", "null"), default="hash")
    parser.add_argument("--salt-env", help="variable with what is put before personal values")
    parser.add_argument("--full-dedup", action="store_true", help="compare whole rows only")
    parser.add_argument("--strict", action="store_true", help="stop on broken rules")
    parser.add_argument("--parallel-tables", type=int, default=4)
    parser.add_argument(
        "--bucket",
        nargs=3,
        action="append",
        default=[],
        metavar=("TABLE", "COLUMN", "NUMBER"),
        help="write a Silver table in buckets of a column without hot keys",
    )
    parser.add_argument("--shuffled-gb", type=int, help="size of the largest shuffle")
    parser.add_argument("--source-format", choices=("parquet", "csv", "jdbc"), default="parquet")
    parser.add_argument(
        "--source",
        help="folder with one folder or file per table, or a JDBC URL in which {domain}"
        " stands for the database",
    )
    parser.add_argument("--jdbc-partitions", type=int, default=64)
    parser.add_argument("--jdbc-user-env", help="variable with the user of the database")
    parser.add_argument("--jdbc-password-env", help="variable with that user's password")
    parser.add_argument("--multi-line", action="store_true", help="CSV text may hold line breaks")
    return parser.parse_args(argv)


def secret(variable: str | None) -> str | None:
    """The value of a named environment variable; it has to be set."""
    if variable is None:
        return None
    if variable not in os.environ:
        raise SystemExit(f"the environment variable {variable} is not set")
    return os.environ[variable]


def settings_of(args: argparse.Namespace) -> LakeSettings:
    return LakeSettings(
        catalog=args.catalog,
        database_prefix=args.database_prefix,
        table_format=args.table_format,
        location=args.location,
        blank_pii=args.blank_pii,
        salt=secret(args.salt_env),
        dedup_by_key=not args.full_dedup,
        strict=args.strict,
        parallel_tables=args.parallel_tables,
        buckets={name: (column, int(number)) for name, column, number in args.bucket},
        # Without a size given, each write is sized by what it reads.
        size_shuffles=args.shuffled_gb is None,
    )


def source_table(spark: SparkSession, args: argparse.Namespace, spec: TableSpec) -> DataFrame:
    if args.source_format == "jdbc":
        url = args.source.replace("{domain}", spec.domain)
        named = {"user": secret(args.jdbc_user_env), "password": secret(args.jdbc_password_env)}
        given = {name: value for name, value in named.items() if value is not None}
        return readers.read_jdbc(spark, spec, url, args.jdbc_partitions, **given)
    path = f"{args.source.rstrip('/')}/{spec.name}"
    if args.source_format == "csv":
        return readers.read_csv(spark, path, spec, args.multi_line)
    return readers.read_parquet(spark, path)


def size_shuffles(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Shuffle partitions for the largest of the tables, by the size of its files.

    At least as many as the session has; columns unpack to about three times their files.
    """
    largest = max([0, *map(readers.input_bytes, tables.values())])
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = shuffle_partitions(3 * largest, at_least)
    spark.conf.set("spark.sql.shuffle.partitions", str(number))


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    """The steps in order; returns the small reports and the pages."""
    settings = settings_of(args)
    if settings.location:
        medallion.attach_lake(spark, settings)
    reports = {}
    for step in args.steps:
        if step == "land":
            if not args.source:
                raise SystemExit("land needs --source")
            sources = {name: source_table(spark, args, spec) for name, spec in TABLES.items()}
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            if args.shuffled_gb is None and args.source_format != "jdbc":
                size_shuffles(spark, sources)
            medallion.land_bronze(spark, sources, settings, now)
        elif step == "silver":
            medallion.build_silver(spark, settings)
        elif step == "gold":
            medallion.build_gold(spark, settings)
        elif step == "refresh":
            reports[step] = medallion.refresh_lakehouse(spark, settings)
        elif step == "audit":
            reports[step] = medallion.lake_broken_rules(spark, settings)
        else:
            pages = medallion.gold_pages(spark, settings)
            reports |= {f"page {name}": page for name, page in pages.items()}
    return reports


def main() -> None:
    args = parse()
    shuffled = args.shuffled_gb * GIGABYTE if args.shuffled_gb else None
    spark = cluster_session("lakemarts-" + "-".join(args.steps), shuffled)
    for report in run(spark, args).values():
        report.show(200, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
