"""Query-first tables: one per access path, last write per key wins, laid out by key."""

from pyspark.sql import DataFrame

from playlake.operators.upsert import overwrite_rule, upsert
from playlake.schemas import CONSOLIDATED_POSITIONS
from playlake.sinks.tables import arrange

# Key and other columns of each table.
SESSION_ITEM = (("sessionId", "itemInSession"), ("artist", "song", "length"))
USER_SESSION = (("userId", "sessionId", "itemInSession"), ("artist", "firstName", "lastName", "song"))
SONG_USERS = (("song", "userId"), ("firstName", "lastName"))
TABLES = {"session_item": SESSION_ITEM, "user_session": USER_SESSION, "song_users": SONG_USERS}
ARRIVAL = ("sessionId", "itemInSession")


def with_artist(events: DataFrame) -> DataFrame:
    """The events that name an artist; the CSV scan reads an empty field as null."""
    return events.filter("artist IS NOT NULL AND artist <> ''")


def at_positions(df: DataFrame, positions: tuple[int, ...] = CONSOLIDATED_POSITIONS) -> DataFrame:
    """Columns by position."""
    return df.select(*[df.columns[i] for i in positions])


def serve(
    events: DataFrame, table: str, order_by: tuple[str, ...] = ARRIVAL, null_keys: str = "error", arranged: bool = True
) -> DataFrame:
    """The rows of one query-first table, by default range-partitioned and sorted by its key for writing."""
    keys, others = TABLES[table]
    rows = upsert(events, overwrite_rule(keys, others, order_by), null_keys)
    return arrange(rows, list(keys), unique=True) if arranged else rows
