"""The whole builds, from raw files written from the given tables to the tables they end in."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from playlake.plans import build_lake, build_serving, build_star, build_warehouse
from playlake.schemas import SONGPLAYS
from playlake.storage import fresh_path
from playlake.workload.analogues import PAGE, WITH
from playlake.workload.file_queries import (
    new_database,
    write_csvs,
    write_daily_logs,
    write_damaged_logs,
    write_multiline_csv,
    write_songs,
)
from playlake.workload.registry import ORACLES, query
from playlake.workload.star_queries import BOTH, LOOKUP, MATCHED, MILLI, SECOND, YEAR_MONTH


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts)


def counts_sql(tables: dict[str, str]) -> str:
    return WITH + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM ({rows})" for name, rows in tables.items()
    )


SONG_TUPLES = "SELECT DISTINCT song_id, title, artist_id, year, duration FROM songs"
ARTIST_TUPLES = (
    "SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude, artist_longitude FROM songs"
)
USER_TUPLES = 'SELECT DISTINCT "userId", "firstName", "lastName", gender, level FROM plays'
DISTINCT_BOTH = f"SELECT DISTINCT {SECOND}, {MATCHED} FROM {BOTH}"


def _lake(spark, sf_dir):
    songs, logs = write_songs(spark, sf_dir), write_damaged_logs(spark, sf_dir)
    return build_lake(spark, songs, logs, fresh_path(spark, "lake"), PAGE)


def _warehouse(spark, sf_dir):
    logs = write_daily_logs(spark, sf_dir)
    return build_warehouse(spark, write_songs(spark, sf_dir), f"{logs}/*/*/*.json", new_database(spark), PAGE)


def _star(spark, sf_dir):
    songs, logs = write_songs(spark, sf_dir), write_daily_logs(spark, sf_dir)
    return build_star(spark, songs, logs, fresh_path(spark, "star"), PAGE, object_files=False)


@query(
    "lake_build",
    counts_sql(
        {
            "songs": SONG_TUPLES,
            "artist": ARTIST_TUPLES,
            "users": USER_TUPLES,
            "time_table": "SELECT DISTINCT ts FROM plays",
            "songplays": "SELECT 1 FROM plays p JOIN songs s ON p.song = s.title",
            "rejected_songs": "SELECT 1 WHERE false",
            "rejected_events": "SELECT 1 FROM ev WHERE page IN ('error', 'signup')",
        }
    ),
)
def lake_build(spark, sf_dir):
    return row_counts(_lake(spark, sf_dir))


@query(
    "lake_songplays",
    WITH
    + f"SELECT * REPLACE (CAST(user_id AS VARCHAR) AS user_id), {YEAR_MONTH}"
    f" FROM (SELECT {SECOND}, {MATCHED} FROM plays p JOIN songs s ON p.song = s.title)",
)
def lake_songplays(spark, sf_dir):
    """The user id is text, as in the log."""
    return _lake(spark, sf_dir)["songplays"].drop("songplay_id")


@query(
    "warehouse_build",
    counts_sql(
        {
            "staging_events": "SELECT 1 FROM ev",
            "staging_songs": "SELECT 1 FROM songs",
            "songplays": DISTINCT_BOTH,
            "users": USER_TUPLES + ' WHERE "userId" IS NOT NULL',
            "songs": SONG_TUPLES,
            "artists": ARTIST_TUPLES,
            "time": f"SELECT DISTINCT {SECOND} FROM ev",
        }
    ),
)
def warehouse_build(spark, sf_dir):
    return row_counts(_warehouse(spark, sf_dir))


@query(
    "warehouse_songplays",
    WITH
    + "SELECT CAST(row_number() OVER (ORDER BY start_time, user_id, level, song_id, artist_id, session_id, location,"
    f" user_agent) AS BIGINT) AS songplay_id, * FROM ({DISTINCT_BOTH})",
)
def warehouse_songplays(spark, sf_dir):
    return _warehouse(spark, sf_dir)["songplays"]


@query(
    "star_build",
    counts_sql(
        {
            "users": 'SELECT DISTINCT "userId" FROM plays',
            "artists": "SELECT DISTINCT artist_id FROM songs",
            "songs": "SELECT DISTINCT song_id FROM songs",
            "time": "SELECT DISTINCT ts FROM plays",
            "songplays": "SELECT 1 FROM plays",
            "rejected_songs": "SELECT 1 WHERE false",
            "rejected_events": "SELECT 1 WHERE false",
            "violations": "SELECT 1 WHERE false",
        }
    ),
)
def star_build(spark, sf_dir):
    return row_counts(_star(spark, sf_dir))


@query(
    "star_rejected",
    counts_sql(
        {
            "songplays": "SELECT 1 FROM plays",
            "rejected_songs": "SELECT 1 WHERE false",
            "rejected_events": "SELECT 1 FROM ev WHERE page IN ('error', 'signup')",
        }
    ),
)
def star_rejected(spark, sf_dir):
    """Damaged lines of the log are in no table of the star, and returned beside them."""
    songs, logs = write_songs(spark, sf_dir), write_damaged_logs(spark, sf_dir)
    star = build_star(spark, songs, logs, fresh_path(spark, "star"), PAGE, object_files=False)
    return row_counts({name: star[name] for name in ("songplays", "rejected_songs", "rejected_events")})


@query(
    "star_songplays",
    WITH
    + 'SELECT CAST(row_number() OVER (ORDER BY ts, "sessionId", "itemInSession") AS BIGINT) AS songplay_id,'
    f" {MILLI}, {MATCHED} FROM {LOOKUP}",
)
def star_songplays(spark, sf_dir):
    return _star(spark, sf_dir)["songplays"].select(*SONGPLAYS.names)


@query(
    "serving_build",
    counts_sql(
        {
            "events_csv": "SELECT 1 FROM ev WHERE artist IS NOT NULL",
            "session_item": 'SELECT DISTINCT "sessionId", "itemInSession" FROM plays',
            "user_session": 'SELECT DISTINCT "userId", "sessionId", "itemInSession" FROM plays',
            "song_users": 'SELECT DISTINCT song, "userId" FROM plays',
        }
    ),
)
def serving_build(spark, sf_dir):
    tables = build_serving(spark, write_csvs(spark, sf_dir), fresh_path(spark, "serving"))
    return row_counts({name: df for name, df in tables.items() if name != "rejected"})


@query(
    "serving_multiline",
    WITH
    + "SELECT \"sessionId\", \"itemInSession\", replace(artist, ' (live)', ' ' || chr(10) || '\"live\", at home') AS artist, song, length FROM plays"
    " QUALIFY row_number() OVER (PARTITION BY \"sessionId\", \"itemInSession\" ORDER BY artist DESC, song DESC, length DESC) = 1",
)
def serving_multiline(spark, sf_dir):
    """The table by session and item, built of CSV files whose quoted fields hold line breaks."""
    return build_serving(spark, write_multiline_csv(spark, sf_dir), fresh_path(spark, "serving"))["session_item"]


def _serving(spark, sf_dir):
    return build_serving(spark, write_csvs(spark, sf_dir), fresh_path(spark, "serving"))


def _register_table(name: str, build, table_name: str, sql: str) -> None:
    """A query that returns the rows of one table of a build."""

    @query(name, sql)
    def rows(spark, sf_dir):
        return build(spark, sf_dir)[table_name]


for _table, _sql in {
    "songs": WITH + SONG_TUPLES,
    "artist": WITH + ARTIST_TUPLES,
    "users": WITH + USER_TUPLES.replace('"userId"', 'CAST("userId" AS VARCHAR) AS "userId"'),
    "time_table": ORACLES["time_lake"],
}.items():
    _register_table(f"lake_rows_{_table}", _lake, _table, _sql)

for _table, _like in {"users": "users_distinct", "songs": "songs_distinct", "artists": "artists_distinct", "time": "time_warehouse"}.items():
    _register_table(f"warehouse_rows_{_table}", _warehouse, _table, ORACLES[_like])

for _table, _like in {"users": "users_upsert", "songs": "songs_distinct", "artists": "artists_upsert", "time": "time_star"}.items():
    _register_table(f"star_rows_{_table}", _star, _table, ORACLES[_like])

#: The CSV files hold quotes and a comma in the names of some artists.
_QUOTED = "SELECT * REPLACE (replace(artist, '(live)', '\"live\", at home') AS artist) FROM ({})"

for _table, _form in {"session_item": _QUOTED, "user_session": _QUOTED, "song_users": "{}"}.items():
    _register_table(f"serving_rows_{_table}", _serving, _table, _form.format(ORACLES[f"serve_{_table}"]))
