"""The play-event fact: plays matched to songs.

No join is hinted to broadcast: the song side grows with the data, and Spark broadcasts it only after it has measured
it to be below ``spark.sql.autoBroadcastJoinThreshold``. Beyond that, adaptive execution splits the partition of a title
that holds much of the plays; see :func:`playlake.operators.joins.skew_join`.
"""

from pyspark.sql import DataFrame, functions as F

from playlake.functions.timeparts import start_time
from playlake.operators.joins import no_nulls, skew_join

# Which play column equals which song column, by match rule.
MATCH_RULES = {
    "title": {"song": "title"},
    "title_artist": {"song": "title", "artist": "artist_name"},
    "exact": {"song": "title", "artist": "artist_name", "length": "duration"},
}


def song_catalog(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Songs with the name of their artist, from the two dimensions; a song without an artist row is left out."""
    names = artists.select(F.col("artist_id").alias("_artist_id"), F.col("name").alias("artist_name"))
    joined = skew_join(
        songs.select("song_id", "artist_id", "title", "duration"), names, {"artist_id": "_artist_id"}, "inner"
    )
    return joined.select("song_id", "artist_id", "title", "artist_name", "duration")


def first_song(catalog: DataFrame, match: str = "exact") -> DataFrame:
    """One song per match key: the smallest song id, and the smallest artist id of that song."""
    keys = list(MATCH_RULES[match].values())
    return (
        no_nulls(catalog, keys)
        .groupBy(*keys)
        .agg(F.min(F.struct("song_id", "artist_id")).alias("first"))
        .select(*keys, "first.song_id", "first.artist_id")
    )


def match_songs(
    plays: DataFrame, catalog: DataFrame, match: str = "title", how: str = "inner", first_only: bool = False
) -> DataFrame:
    """Plays with ``song_id`` and ``artist_id`` of the songs they match.

    ``how='left'`` keeps plays without a match, with null ids. A play that matches several songs gives a row for each,
    or with ``first_only`` exactly one.
    """
    rule = MATCH_RULES[match]
    side = first_song(catalog, match) if first_only else catalog
    side = side.select(*[F.col(c).alias(f"_{c}") for c in (*rule.values(), "song_id", "artist_id")])
    return skew_join(plays, side, {play: f"_{song}" for play, song in rule.items()}, how).select(
        plays["*"], F.col("_song_id").alias("song_id"), F.col("_artist_id").alias("artist_id")
    )


def songplay_rows(matched: DataFrame, precision: str = "second", *extra: str) -> DataFrame:
    """The fact columns of matched plays, without an id. ``extra`` columns are kept at the end."""
    return matched.select(
        start_time(F.col("ts"), precision).alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *extra,
    )


def with_year_month(songplays: DataFrame) -> DataFrame:
    """Year and month of the start time, straight from it: no join with the time table is needed to get them."""
    return songplays.select(
        "*", F.year("start_time").alias("year"), F.month("start_time").alias("month")
    )


def join_time(songplays: DataFrame, times: DataFrame) -> DataFrame:
    """Year and month by joining a time table; plays whose start time it lacks are left out.

    A time table kept by millisecond has several rows per second. They are merged first, so no play is repeated.
    """
    moments = times.select("start_time", "year", "month").distinct()
    return songplays.join(moments, "start_time").select(songplays["*"], moments["year"], moments["month"])
