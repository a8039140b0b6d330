"""JSON files to a star schema with one row per key: exact match, upserted dimensions, milliseconds, serial ids."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake.functions.casts import conform
from playlake.operators import dims, facts, quality
from playlake.operators.ids import serial_ids
from playlake.operators.upsert import ARTISTS_RULE, SONGS_RULE, USERS_RULE, upsert
from playlake.schemas import CORRUPT_COLUMN, EVENT_LOG, SONG_META, STAGING_EVENTS, STAR
from playlake.sinks.files import write_parquet
from playlake.sources.files import read_json_lines, read_json_objects, split_corrupt


def artist_rows(songs: DataFrame) -> DataFrame:
    """Artists as the song files give them, with the song id they arrive by; coordinates as decimals."""
    rows = songs.select("song_id", *dims.renamed(dims.ARTIST_COLUMNS))
    return rows.select("song_id", "artist_id", "name", "location", *decimals("latitude", "longitude"))


def decimals(*columns: str) -> list:
    return [F.col(c).try_cast("decimal(9,6)").alias(c) for c in columns]


def user_rows(plays: DataFrame) -> DataFrame:
    """Users as the plays give them, with the order they arrive in."""
    return plays.select(
        *dims.renamed(dims.USER_COLUMNS),
        "ts",
        F.col("sessionId").alias("session_id"),
        F.col("itemInSession").alias("item_in_session"),
    )


def songplay_facts(numbered: DataFrame, first_songs: DataFrame) -> DataFrame:
    """One fact row per numbered play, with the ids of the song it matches exactly, if any.

    ``first_songs`` has one row per match key, see :func:`playlake.operators.facts.first_song`, so that plays can be
    numbered before the lookup.
    """
    matched = facts.match_songs(numbered, first_songs, "exact", how="left")
    return facts.songplay_rows(matched, "milli", "songplay_id").select(*STAR["songplays"].names)


def build_star(
    spark: SparkSession, song_path: str, log_path: str, out: str, page: str = dims.PLAY_PAGE, object_files: bool = True
) -> dict[str, DataFrame]:
    """Write the five tables below ``out`` and return them as read back; dimensions are written before the fact.

    ``violations`` among the returned counts broken keys, references and row rules per table, when it is read;
    ``rejected_songs`` and ``rejected_events`` are the damaged rows that no table holds.
    """
    read_songs = read_json_objects if object_files else read_json_lines
    songs_raw, bad_songs = split_corrupt(
        read_songs(spark, song_path, SONG_META, CORRUPT_COLUMN), path=f"{out}/staging/songs"
    )
    log, bad_events = split_corrupt(
        read_json_lines(spark, log_path, EVENT_LOG, CORRUPT_COLUMN, recursive=True), path=f"{out}/staging/events"
    )
    plays = conform(dims.plays(log, page), STAGING_EVENTS)

    write_parquet(upsert(artist_rows(songs_raw), ARTISTS_RULE), f"{out}/artists")
    write_parquet(upsert(songs_raw.select(*dims.SONG_COLUMNS), SONGS_RULE), f"{out}/songs")
    write_parquet(dims.time_dimension(plays, page, "milli", "name"), f"{out}/time")
    write_parquet(upsert(user_rows(plays), USERS_RULE), f"{out}/users")
    tables = {t: spark.read.schema(STAR[t]).parquet(f"{out}/{t}") for t in ("artists", "songs", "time", "users")}

    catalog = facts.song_catalog(tables["songs"], tables["artists"])
    numbered = serial_ids(plays, ["ts", "sessionId", "itemInSession"], from_scan=True)
    write_parquet(songplay_facts(numbered, facts.first_song(catalog)), f"{out}/songplays")
    tables["songplays"] = spark.read.schema(STAR["songplays"]).parquet(f"{out}/songplays")
    rejected = {"rejected_songs": bad_songs, "rejected_events": bad_events}
    return tables | rejected | {"violations": violations(tables)}


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Table, constraint and number of rows that break it; empty if all hold."""
    parts = []
    for table, df in tables.items():
        keys = list(quality.STAR_KEYS[table])
        counts = quality.duplicate_keys(df, keys).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
        parts.append(counts.select(F.lit(table).alias("table_name"), F.lit("primary key").alias("rule"), "n_rows"))
        rules = quality.rule_counts(df, quality.STAR_RULES[table])
        parts.append(rules.select(F.lit(table).alias("table_name"), "rule", "n_rows"))
    for child, column, parent, key in quality.STAR_REFERENCES:
        lost = quality.orphan_keys(tables[child], column, tables[parent], key)
        counts = lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
        parts.append(
            counts.select(F.lit(child).alias("table_name"), F.lit(f"{column} not in {parent}").alias("rule"), "n_rows")
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found.filter("n_rows > 0")
