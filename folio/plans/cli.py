"""Command line, for ``spark-submit``:

    cli.py curate  SOURCE CURATED [--format parquet] [--quarantine TABLE]
    cli.py genres  CURATED
    cli.py collect CURATED STORE LOG --run-id ID [--sample 2000] [--images FOLDER]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from folio.operators.curate import MIN_RATINGS
from folio.operators.genres import MIN_COUNT, TOP_GENRES
from folio.operators.sample import RUN_SAMPLE, SEED
from folio.plans.catalogue import curate_to, genre_profile
from folio.plans.covers import run
from folio.session import build_session, drop_work
from folio.sources.fetch import requests_transport


#: Rows of a list that are printed; the whole list is stored.
SHOWN = 1000


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="folio")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("curate")
    one.add_argument("source")
    one.add_argument("curated")
    one.add_argument("--format", default="parquet")
    one.add_argument("--min-ratings", type=int, default=MIN_RATINGS)
    one.add_argument("--quarantine", help="table for records that are no books")
    two = commands.add_parser("genres")
    two.add_argument("curated")
    two.add_argument("--top", type=int, default=TOP_GENRES)
    two.add_argument("--min-count", type=int, default=MIN_COUNT)
    two.add_argument("--fail", action="store_true", help="stop at a malformed genre text")
    two.add_argument("--report", help="folder for the whole histogram and the count of malformed texts")
    three = commands.add_parser("collect")
    three.add_argument("curated")
    three.add_argument("store")
    three.add_argument("log")
    three.add_argument("--run-id", required=True)
    three.add_argument("--sample", type=int, default=RUN_SAMPLE, help="0 takes all books")
    three.add_argument("--seed", type=int, default=SEED)
    three.add_argument("--slices", type=int, help="parts each attempt is fetched in; by default as many as its addresses need")
    three.add_argument("--images", help="folder of {id}.jpg files: books that have one are not tried, new covers are put there")
    three.add_argument("--report", help="folder for the tables of failed addresses, progress and counters; beside the log by default")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session()
    try:
        run_command(spark, args)
    finally:
        drop_work(spark)


def print_all(df: DataFrame) -> None:
    """Print every row, read partition by partition."""
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*row, sep="\t")


def print_first(df: DataFrame, what: str, rows: int = SHOWN) -> None:
    """Print the first rows and say how many there are."""
    print(*df.columns, sep="\t")
    for row in df.limit(rows).collect():
        print(*row, sep="\t")
    print(f"{df.count()} {what}, the first {rows} at most shown")


def store_report(folder: str, **tables: DataFrame) -> None:
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def run_command(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "curate":
        done = curate_to(spark, args.source, args.curated, args.format, args.min_ratings, args.quarantine)
        print(done.funnel)
        print(f"records that are no books: {done.n_bad}")
    elif args.command == "genres":
        profile = genre_profile(spark.read.parquet(args.curated), args.top, args.min_count, args.fail)
        profile.top.show(args.top, truncate=False)
        profile.distinct.show()
        profile.parsed.show()
        print_all(profile.frequent)
        if args.report:
            store_report(args.report, counts=profile.counts, parsed=profile.parsed)
    else:
        result = run(
            spark,
            args.curated,
            args.store,
            args.log,
            requests_transport,
            args.run_id,
            sample_size=args.sample or None,
            seed=args.seed,
            slices=args.slices,
            images=args.images,
        )
        # What the run found outlives its work folder; the list of failures may be as long as the catalogue.
        report = args.report or f"{args.log.rstrip('/')}-report/run={args.run_id}"
        store_report(report, failed=result.failed, progress=result.progress, counters=result.counters)
        print_first(spark.read.parquet(f"{report}/failed").orderBy("ord"), "failed")
        print_first(result.progress.orderBy("i"), "progress lines")
        result.counters.show()
        print(f"whole report: {report}")


if __name__ == "__main__":
    main()
