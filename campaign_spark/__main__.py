"""Command line / spark-submit entry point.

    spark-submit -m campaign_spark etl --input DIR --output DIR --strategy 3 [--jdbc-url URL]
    spark-submit -m campaign_spark popularity --movies F --ratings F --output DIR --how count|mean

(``python -m campaign_spark ...`` works the same on a local session.)

``etl`` reads the four campaign CSVs (``camp_data``, ``business_vertical``,
``channel_name``, ``country``), materializes the joined, cleansed and
engineered stages under the session's checkpoint folder, and writes the
totals by country / channel / vertical and the strategy's running totals as
sorted CSVs (and database tables with ``--jdbc-url``). ``popularity`` reads
movies and ratings CSVs (ratings typed with malformed rows quarantined) and
writes item and genre popularity.
"""

from __future__ import annotations

import argparse
import sys

from campaign_spark.plans.campaign import export_results, join_campaign, run_materialized
from campaign_spark.plans.popularity import run_popularity
from campaign_spark.schemas import ITEMS, RATINGS_TEXT
from campaign_spark.session import build_session
from campaign_spark.sources.files import read_campaign_csvs, read_csv, typed_ratings
from campaign_spark.sources.sinks import write_csv


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="campaign_spark")
    sub = parser.add_subparsers(dest="command", required=True)
    etl = sub.add_parser("etl", help="campaign join, cleansing, totals and running totals")
    etl.add_argument("--input", required=True, help="folder with the four campaign CSVs")
    etl.add_argument("--output", required=True, help="folder for the result CSVs")
    etl.add_argument("--strategy", type=int, required=True, help="strategy id for the running totals")
    etl.add_argument("--jdbc-url", default=None, help="also replace database tables at this URL")
    etl.add_argument("--refresh", action="store_true", help="rebuild stages that already exist")
    pop = sub.add_parser("popularity", help="movie and genre popularity")
    pop.add_argument("--movies", required=True)
    pop.add_argument("--ratings", required=True)
    pop.add_argument("--output", required=True)
    pop.add_argument("--how", choices=["count", "mean"], default="count")
    args = parser.parse_args(argv)

    spark = build_session()
    if args.command == "etl":
        t = read_campaign_csvs(spark, args.input)
        stages = run_materialized(
            spark,
            lambda: join_campaign(t["camp_data"], t["business_vertical"], t["country"], t["channel_name"]),
            strategy_id=args.strategy, refresh=args.refresh)
        export_results(stages, args.output, jdbc_url=args.jdbc_url)
    else:
        # Columns are taken by position: movies (id, title, genres), ratings
        # (user, movie, rating, further columns ignored).
        items = read_csv(spark, args.movies, ITEMS)
        raw = read_csv(spark, args.ratings, mode="PERMISSIVE")
        raw = raw.select(*[raw[i].alias(f.name) for i, f in enumerate(RATINGS_TEXT.fields)])
        good, rejected = typed_ratings(raw)
        write_csv(rejected, f"{args.output.rstrip('/')}/rejected_ratings")
        run_popularity(spark, good, items, args.how, out_dir=args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
