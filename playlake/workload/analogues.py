"""The given tables in the shape of the raw inputs: ``events`` as the event log, ``part`` as the songs.

Each analogue has its SQL next to it. A play is an event of type ``purchase``; its song is the part its ``props`` name.
Some plays carry another artist or length than the song has, so that the match rules differ. A title is shared by a few
songs only, however many parts there are, so a join on it grows with the plays.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake.functions.timeparts import epoch_millis
from playlake.schemas import SONG_META, STAGING_EVENTS

PAGE = "purchase"

TITLE = "concat(p_name, ' ', cast({quotient} as {text}))"

_SPARK = {"quotient": "p_partkey div 100", "text": "string"}
_DUCK = {"quotient": "p_partkey // 100", "text": "varchar"}

_PLAY = {
    "artist": "case when event_type = 'purchase' then"
    " case when value < 5 then concat(p_brand, ' (live)') else p_brand end end",
    "auth": "case when event_type = 'error' then 'Logged Out' else 'Logged In' end",
    "firstName": "concat('First', cast(event_id % 3 as {text}))",
    "gender": "case when user_id % 2 = 0 then 'F' else 'M' end",
    "itemInSession": "cast(event_id % 10 as int)",
    "lastName": "concat('Last', cast(user_id as {text}))",
    "length": "case when event_type = 'purchase' then"
    " case when value < 10 then p_retailprice + 1 else p_retailprice end end",
    "level": "case when value >= 20 then 'paid' else 'free' end",
    "location": "concat('City ', cast(user_id % 40 as {text}), ', ST')",
    "method": "case when event_type = 'purchase' then 'PUT' else 'GET' end",
    "page": "event_type",
    "registration": "cast(1500000000000 + user_id * 1000 as double)",
    "sessionId": "{session}",
    "song": "case when event_type = 'purchase' then " + TITLE + " end",
    "status": "cast(200 as int)",
    "ts": "{ts}",
    "userAgent": "concat('\"Agent/', cast(event_id % 5 as {text}), '\"')",
    "userId": "case when event_type = 'error' then null else user_id end",
}
_SONG = {
    "num_songs": "cast(1 as int)",
    "artist_id": "concat('A', substring(p_brand, 7))",
    "artist_latitude": "case when p_partkey % 3 = 0 then null else cast(p_partkey % 180 as double) / 2 + 0.1234567 end",
    "artist_longitude": "case when p_partkey % 3 = 0 then null else cast(p_partkey % 360 as double) / 2 - 90 end",
    "artist_location": "case when p_size % 4 = 0 then '' else concat('Region ', cast(p_size as {text})) end",
    "artist_name": "p_brand",
    "song_id": "concat('S', cast(p_partkey as {text}))",
    "title": TITLE,
    "duration": "p_retailprice",
    "year": "cast(case when p_size > 25 then 0 else 1970 + p_size end as int)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the columns of the typed event log."""
    events = table(spark, sf_dir, "events").withColumns(
        {"_ts": epoch_millis(F.col("ts")), "_k": F.get_json_object("props", "$.k").cast("bigint")}
    )
    part = table(spark, sf_dir, "part")
    played = (F.col("event_type") == PAGE) & (F.col("_k") == F.col("p_partkey"))
    words = _SPARK | {"ts": "_ts", "session": "event_id div 10"}
    return events.join(part, played, "left").selectExpr(
        *[f"{_PLAY[c].format(**words)} as {c}" for c in STAGING_EVENTS.names]
    )


def staged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the columns of the event log that need no look at ``part``."""
    events = table(spark, sf_dir, "events").withColumn("_ts", epoch_millis(F.col("ts")))
    words = _SPARK | {"ts": "_ts", "session": "event_id div 10"}
    names = [c for c in STAGING_EVENTS.names if c not in ("artist", "length", "song")]
    return events.selectExpr(*[f"{_PLAY[c].format(**words)} as {c}" for c in names])


def staged_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` in the columns of the song metadata."""
    part = table(spark, sf_dir, "part")
    return part.selectExpr(*[f"{_SONG[c].format(**_SPARK)} as {c}" for c in SONG_META.names])


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the JSON log has it: the user id is text, empty where nobody is logged in."""
    user = F.coalesce(F.col("userId").cast("string"), F.lit(""))
    return staged_events(spark, sf_dir).withColumn("userId", user)


_WORDS = _DUCK | {"ts": "epoch_us(ts) // 1000", "session": "event_id // 10"}

EVENTS_SQL = (
    "SELECT "
    + ", ".join(f'{_PLAY[c].format(**_WORDS)} AS "{c}"' for c in STAGING_EVENTS.names)
    + " FROM events LEFT JOIN part ON event_type = 'purchase'"
    + " AND p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)"
)
SONGS_SQL = "SELECT " + ", ".join(f'{_SONG[c].format(**_DUCK)} AS "{c}"' for c in SONG_META.names) + " FROM part"
WITH = f"WITH ev AS ({EVENTS_SQL}), plays AS (SELECT * FROM ev WHERE page = 'purchase'), songs AS ({SONGS_SQL}) "
