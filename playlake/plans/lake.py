"""JSON files to a star schema in partitioned Parquet: title match, distinct dimensions, whole seconds."""

from pyspark.sql import DataFrame, SparkSession

from playlake.operators import dims, facts
from playlake.operators.ids import spread_ids
from playlake.schemas import CORRUPT_COLUMN, EVENT_LOG, SONG_META, SONGS
from playlake.sinks.files import write_parquet
from playlake.sources.files import read_json_lines, split_corrupt
from playlake.sources.tables import read_partitioned

# Partition columns of the written tables. Songs may also be parted by ("year", "artist_id").
SONG_PARTITIONS = ("year",)
MONTH_PARTITIONS = ("year", "month")


def build_lake(
    spark: SparkSession,
    song_path: str,
    log_path: str,
    out: str,
    page: str = dims.PLAY_PAGE,
    song_partitions: tuple[str, ...] = SONG_PARTITIONS,
) -> dict[str, DataFrame]:
    """Write ``songs``, ``artist``, ``users``, ``time_table`` and ``songplays`` below ``out``, return them as read back.

    The raw text is parsed once, into ``out/staging``; lines that do not parse are returned as ``rejected_songs`` and
    ``rejected_events``. Partitioning songs by artist as well makes a directory per artist and year.
    """
    songs, bad_songs = split_corrupt(
        read_json_lines(spark, song_path, SONG_META, CORRUPT_COLUMN), path=f"{out}/staging/songs"
    )
    events, bad_events = split_corrupt(
        read_json_lines(spark, log_path, EVENT_LOG, CORRUPT_COLUMN), path=f"{out}/staging/events"
    )

    write_parquet(dims.distinct_songs(songs), f"{out}/songs", song_partitions)
    write_parquet(dims.distinct_artists(songs, raw_names=True), f"{out}/artist")
    write_parquet(dims.distinct_users(events, page, raw_names=True), f"{out}/users")
    times = dims.time_dimension(events, page, keep_ts=True)
    write_parquet(times, f"{out}/time_table", MONTH_PARTITIONS)

    catalog = read_partitioned(spark, f"{out}/songs", SONGS)
    matched = facts.match_songs(dims.dedupe_rows(dims.plays(events, page)), catalog, "title")
    rows = facts.with_year_month(facts.songplay_rows(matched)).hint("rebalance", *MONTH_PARTITIONS)
    songplays = spread_ids(rows)
    write_parquet(songplays, f"{out}/songplays", MONTH_PARTITIONS, rebalance=False)

    return {
        "songs": catalog,
        "artist": spark.read.parquet(f"{out}/artist"),
        "users": spark.read.parquet(f"{out}/users"),
        "time_table": read_partitioned(spark, f"{out}/time_table", times.schema),
        "songplays": read_partitioned(spark, f"{out}/songplays", songplays.schema),
        "rejected_songs": bad_songs,
        "rejected_events": bad_events,
    }
