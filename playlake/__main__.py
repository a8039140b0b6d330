"""Run a build on raw files, for example ``spark-submit playlake/__main__.py star --songs S --logs L --out O``.

Paths are any that Spark can read; credentials and storage settings belong to the Spark session.
"""

import argparse

from pyspark.sql import DataFrame, SparkSession

from playlake.plans import build_lake, build_serving, build_star, build_warehouse
from playlake.sinks import create_database
from playlake.streaming import incremental
from playlake.streaming.star_load import StarLoad, read_lines


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="playlake", description="Build tables from song metadata and event logs.")
    top.add_argument("--no-report", action="store_true", help="neither count the tables nor check their constraints")
    builds = top.add_subparsers(dest="build", required=True)

    def build(name: str, text: str, *options: str) -> argparse.ArgumentParser:
        sub = builds.add_parser(name, help=text)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    build("lake", "partitioned Parquet, title match, distinct dimensions", "songs", "logs", "out")
    build("warehouse", "staging and star tables, title and artist match", "songs", "logs", "database").add_argument(
        "--location", help="folder of the database"
    )
    build("star", "one row per key, exact match, serial ids", "songs", "logs", "out")
    build("serving", "consolidated CSV and one table per access path", "csv", "out")
    load = build("load", "take new log and song files into a star, batch by batch", "out", "checkpoint")
    load.add_argument("--logs", help="folder of log files, one object to a line")
    load.add_argument("--songs", help="folder of song files, one object to a file; they may come after the plays")
    load.add_argument("--star", help="a built star whose songs and artists are there from the start")
    load.add_argument("--go-on", action="store_true", help="its users, times and plays are there too, and ids go on from its last")
    load.add_argument("--star-logs", help="folder of logs that count as loaded, with --go-on")
    load.add_argument("--star-songs", help="folder of songs that count as loaded")
    load.add_argument("--files-per-batch", type=int, default=1)
    for sub in (load, builds.choices["serving"]):
        sub.add_argument("--null-keys", choices=("error", "drop"), default="error", help="stop at rows without a key, or leave them out")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    if args.build == "lake":
        return build_lake(spark, args.songs, args.logs, args.out)
    if args.build == "warehouse":
        create_database(spark, args.database, args.location)
        return build_warehouse(spark, args.songs, args.logs, args.database)
    if args.build == "star":
        return build_star(spark, args.songs, args.logs, args.out)
    if args.build == "serving":
        return build_serving(spark, args.csv, args.out, args.null_keys)
    star = StarLoad(spark, args.out, null_keys=args.null_keys)
    if args.star and not star.manifest.version():
        star.seed(args.star, args.star_songs, args.star_logs, args.go_on)
    if args.songs:
        songs = read_lines(spark, args.songs, args.files_per_batch, whole=True)
        incremental.run_batches(songs, star.load_songs, f"{args.checkpoint}/songs").awaitTermination()
    if args.logs:
        logs = read_lines(spark, args.logs, args.files_per_batch)
        incremental.run_batches(logs, star.load_events, f"{args.checkpoint}/logs").awaitTermination()
    return star.tables()


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"playlake-{args.build}").getOrCreate()
    tables = run(spark, args)
    if not args.no_report:
        for name, table in tables.items():
            print(f"{name}: {table.count()} rows")


if __name__ == "__main__":
    main()
