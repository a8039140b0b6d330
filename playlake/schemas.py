"""Schemas of the raw inputs and of the tables built from them.

Ids that count up with the data (``sessionId``, ``userId``) are 64 bit, so that they do not overflow at scale.
"""

from pyspark.sql.types import (
    CharType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VarcharType,
)


def _schema(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


_S, _I, _L, _D, _TS = StringType(), IntegerType(), LongType(), DoubleType(), TimestampNTZType()

CORRUPT_COLUMN = "corrupt_record"

# Field names and order of the raw inputs.
EVENT_LOG = _schema(
    artist=_S, auth=_S, firstName=_S, gender=_S, itemInSession=_I, lastName=_S, length=_D, level=_S, location=_S,
    method=_S, page=_S, registration=_D, sessionId=_L, song=_S, status=_I, ts=_L, userAgent=_S, userId=_S,
)
SONG_META = _schema(
    num_songs=_I, artist_id=_S, artist_latitude=_D, artist_longitude=_D, artist_location=_S, artist_name=_S,
    song_id=_S, title=_S, duration=_D, year=_I,
)
EVENT_CSV = _schema(
    artist=_S, auth=_S, firstName=_S, gender=_S, itemInSession=_I, lastName=_S, length=_D, level=_S, location=_S,
    method=_S, page=_S, registration=_D, sessionId=_L, song=_S, status=_I, ts=_D, userId=_L,
)

# Positions kept, of the 17 CSV columns, in the consolidated file.
CONSOLIDATED_POSITIONS = (0, 2, 3, 4, 5, 6, 7, 8, 12, 13, 16)

# Staging tables: typed, every column nullable, no keys.
STAGING_EVENTS = StructType([StructField(f.name, _L if f.name == "userId" else f.dataType) for f in EVENT_LOG])
STAGING_SONGS = SONG_META

# One JSONPath per staging column, in column order.
EVENT_JSON_PATHS = tuple(f"$['{name}']" for name in STAGING_EVENTS.names)

# Star schema.
SONGPLAYS = _schema(
    songplay_id=_L, start_time=_TS, user_id=_L, level=_S, song_id=_S, artist_id=_S, session_id=_L, location=_S,
    user_agent=_S,
)
USERS = _schema(user_id=_L, first_name=_S, last_name=_S, gender=_S, level=_S)
SONGS = _schema(song_id=_S, title=_S, artist_id=_S, year=_I, duration=_D)
ARTISTS = _schema(artist_id=_S, name=_S, location=_S, latitude=_D, longitude=_D)
ARTISTS_DECIMAL = _schema(
    artist_id=_S, name=_S, location=_S, latitude=DecimalType(9, 6), longitude=DecimalType(9, 6)
)
TIME = _schema(start_time=_TS, hour=_I, day=_I, week=_I, month=_I, year=_I, weekday=_S)

STAR = {"users": USERS, "artists": ARTISTS_DECIMAL, "songs": SONGS, "time": TIME, "songplays": SONGPLAYS}

# The longest texts the warehouse tables take; 1 is a char column, the others varchar.
WAREHOUSE_LENGTHS = {
    "staging_events": {"firstName": 50, "gender": 1, "lastName": 50},
    "users": {"first_name": 50, "last_name": 50, "gender": 1},
    "time": {"weekday": 9},
}


def limited(schema: StructType, lengths: dict[str, int]) -> StructType:
    """``schema`` for a table definition, its texts limited to ``lengths``."""
    types = {name: CharType(n) if n == 1 else VarcharType(n) for name, n in lengths.items()}
    return StructType([StructField(f.name, types.get(f.name, f.dataType), f.nullable) for f in schema])


WAREHOUSE = {
    name: limited(schema, WAREHOUSE_LENGTHS.get(name, {}))
    for name, schema in {
        "staging_events": STAGING_EVENTS,
        "staging_songs": STAGING_SONGS,
        "songplays": SONGPLAYS,
        "users": USERS,
        "songs": SONGS,
        "artists": ARTISTS,
        "time": TIME,
    }.items()
}
