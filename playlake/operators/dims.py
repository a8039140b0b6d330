"""Dimensions by distinct projection: one row per distinct tuple, so a user with two levels has two rows.

For one row per key see :mod:`playlake.operators.upsert`.
"""

from pyspark.sql import Column, DataFrame, functions as F

from playlake.functions.timeparts import start_time, time_parts

# The page of a play, and old and new names of the dimension columns.
PLAY_PAGE = "NextSong"
USER_COLUMNS = {
    "userId": "user_id", "firstName": "first_name", "lastName": "last_name", "gender": "gender", "level": "level",
}
SONG_COLUMNS = ("song_id", "title", "artist_id", "year", "duration")
ARTIST_COLUMNS = {
    "artist_id": "artist_id", "artist_name": "name", "artist_location": "location", "artist_latitude": "latitude",
    "artist_longitude": "longitude",
}


def renamed(columns: dict[str, str]) -> list[Column]:
    return [F.col(old).alias(new) for old, new in columns.items()]


def plays(events: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """The events that are song plays."""
    return events.filter(F.col("page") == page)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """One of each set of identical rows. Copies are merged before the shuffle."""
    return df.dropDuplicates()


def distinct_users(
    events: DataFrame, page: str = PLAY_PAGE, raw_names: bool = False, require_id: bool = False
) -> DataFrame:
    """Distinct users among the plays; ``require_id`` leaves out rows without a user id."""
    rows = plays(events, page)
    if require_id:
        rows = rows.filter(F.col("userId").isNotNull())
    columns = [F.col(c) for c in USER_COLUMNS] if raw_names else renamed(USER_COLUMNS)
    return rows.select(*columns).distinct()


def distinct_songs(songs: DataFrame, require_id: bool = False) -> DataFrame:
    rows = songs.filter(F.col("song_id").isNotNull()) if require_id else songs
    return rows.select(*SONG_COLUMNS).distinct()


def distinct_artists(songs: DataFrame, raw_names: bool = False) -> DataFrame:
    columns = [F.col(c) for c in ARTIST_COLUMNS] if raw_names else renamed(ARTIST_COLUMNS)
    return songs.select(*columns).distinct()


def time_dimension(
    events: DataFrame,
    page: str | None = PLAY_PAGE,
    precision: str = "second",
    weekday: str = "number",
    keep_ts: bool = False,
) -> DataFrame:
    """Distinct start times with their parts. ``page=None`` takes all events; ``keep_ts`` keeps the raw milliseconds.

    The distinct runs over the one column the parts follow from, not over all seven.
    """
    rows = events if page is None else plays(events, page)
    if keep_ts:
        moments = rows.select("ts").distinct().select("ts", start_time(F.col("ts"), precision).alias("start_time"))
    else:
        moments = rows.select(start_time(F.col("ts"), precision).alias("start_time")).distinct()
    return moments.select("*", *time_parts(F.col("start_time"), weekday))
