"""JSON files to staging tables to a star schema by insert-select: title and artist match, distinct rows."""

from pyspark.sql import DataFrame, SparkSession

from playlake.operators import dims, facts
from playlake.operators.ids import identity_ids
from playlake.schemas import EVENT_JSON_PATHS, STAGING_EVENTS, STAGING_SONGS, WAREHOUSE
from playlake.sinks.tables import arrange, create_tables, drop_tables, insert_select
from playlake.sources.copy import copy_by_name, copy_by_paths


def build_warehouse(
    spark: SparkSession,
    song_path: str,
    log_path: str,
    database: str,
    page: str = dims.PLAY_PAGE,
    json_paths: tuple[str, ...] = EVENT_JSON_PATHS,
    song_object_files: bool = False,
    fail: bool = True,
) -> dict[str, DataFrame]:
    """Replace the staging and star tables of an existing ``database`` and return them.

    Text that is no JSON fails the build; without ``fail`` it is staged as a row of nulls.
    """
    name = {table: f"{database}.{table}" for table in WAREHOUSE}
    drop_tables(spark, list(name.values()))
    create_tables(spark, database, WAREHOUSE)

    insert_select(copy_by_paths(spark, log_path, json_paths, STAGING_EVENTS, fail), name["staging_events"])
    insert_select(copy_by_name(spark, song_path, STAGING_SONGS, song_object_files, fail), name["staging_songs"])
    events, songs = spark.table(name["staging_events"]), spark.table(name["staging_songs"])

    matched = facts.match_songs(dims.plays(events, page), songs, "title_artist")
    # Numbered in the order of all columns, start_time first: the rows already lie by ranges of start_time.
    insert_select(identity_ids(facts.songplay_rows(matched)), name["songplays"])
    for table, rows in (
        ("users", dims.distinct_users(events, page, require_id=True)),
        ("songs", dims.distinct_songs(songs, require_id=True)),
        ("artists", dims.distinct_artists(songs)),
        ("time", dims.time_dimension(events, page=None, weekday="padded")),
    ):
        # Distinct rows differ in some column, and each table's first column is its sort key.
        insert_select(arrange(rows, rows.columns, unique=True), name[table])
    return {table: spark.table(full) for table, full in name.items()}
