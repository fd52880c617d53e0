"""The jobs from the command line, for ``spark-submit`` or a scheduler.

    python -m barloom ingest --root s3a://lake --then-gold
    python -m barloom rebuild --root s3a://lake
    python -m barloom compact --root s3a://lake --min-batches 8
    python -m barloom export --root s3a://lake --url jdbc:... --property user=...
"""

from __future__ import annotations

import argparse
import datetime

from barloom.plans import (
    Lake,
    bronze_to_silver,
    compact_silver,
    fragmented_months,
    silver_to_gold,
    update_gold,
)
from barloom.session import build_session
from barloom.sources import export_tables, read_gold
from barloom.streaming import ingest_new


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values)


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--root", required=True, help="folder of the layers")
    common.add_argument("--fmt", default="parquet", help="table format")
    common.add_argument("--multi-line", action="store_true", help="pretty-printed documents")
    common.add_argument("--scale", type=int, help="decimals of exact price sums")
    common.add_argument("--key", default="symbol,datetime", help="what identifies a bar")
    common.add_argument("--retention", type=float, default=24.0, metavar="HOURS",
                        help="how long replaced folders stay for readers")
    common.add_argument("--conf", action="append", default=[], metavar="NAME=VALUE")

    parser = argparse.ArgumentParser(prog="barloom", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    ingest = jobs.add_parser("ingest", parents=[common], help="new documents to silver")
    ingest.add_argument("--full-listing", action="store_true", help="look into closed folders, too")
    ingest.add_argument("--then-gold", action="store_true", help="and refresh the metric tables")
    jobs.add_parser("rebuild", parents=[common], help="all documents to silver and gold")
    compact = jobs.add_parser("compact", parents=[common], help="bring batches of a month together")
    compact.add_argument("--min-batches", type=int, default=8, help="only months in so many")
    export = jobs.add_parser("export", parents=[common], help="metric tables to a database")
    export.add_argument("--url", required=True)
    export.add_argument("--property", action="append", default=[], metavar="NAME=VALUE")
    export.add_argument("--connections", type=int, default=8)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    options = parse(argv)
    spark = build_session(f"barloom-{options.job}", conf=_pairs(options.conf))
    lake = Lake(
        options.root,
        fmt=options.fmt,
        key=tuple(options.key.split(",")),
        multi_line=options.multi_line,
        retention=datetime.timedelta(hours=options.retention),
    )
    if options.job == "ingest":
        ingest_new(spark, lake, full_listing=options.full_listing)
        if options.then_gold:
            update_gold(spark, lake, scale=options.scale)
    elif options.job == "compact":
        months = fragmented_months(spark, lake, min_batches=options.min_batches)
        compact_silver(spark, lake, months)
    elif options.job == "rebuild":
        if bronze_to_silver(spark, lake):
            silver_to_gold(spark, lake, scale=options.scale)
    else:
        gold = read_gold(spark, lake.gold, fmt=lake.fmt)
        export_tables(
            gold._asdict(),
            options.url,
            properties=_pairs(options.property),
            connections=options.connections,
        )


if __name__ == "__main__":
    main()
