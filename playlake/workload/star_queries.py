"""Fact, dimensions, upserts, ids, serving tables."""

from pyspark.sql import functions as F

from playlake.operators import dims, facts, ids, serving, upsert as up
from playlake.operators.profile import first_per_key
from playlake.plans.star import artist_rows, user_rows
from playlake.storage import materialize
from playlake.workload.analogues import PAGE, WITH, staged_events, staged_log, staged_songs, table
from playlake.workload.registry import query

FACT = (
    '"userId" AS user_id, level, {song_id} AS song_id, {artist_id} AS artist_id, "sessionId" AS session_id,'
    ' location, "userAgent" AS user_agent'
)
MATCHED = FACT.format(song_id="s.song_id", artist_id="s.artist_id")
SECOND = "date_trunc('second', epoch_ms(ts)) AS start_time"
MILLI = "epoch_ms(ts) AS start_time"
FIRST_SONG = (
    "(SELECT title, artist_name, duration, min(song_id) AS song_id, arg_min(artist_id, song_id) AS artist_id"
    " FROM songs GROUP BY ALL)"
)
LOOKUP = f"plays p LEFT JOIN {FIRST_SONG} s ON p.song = s.title AND p.artist = s.artist_name AND p.length = s.duration"
BOTH = "plays p JOIN songs s ON p.song = s.title AND p.artist = s.artist_name"
YEAR_MONTH = "CAST(year(start_time) AS INT) AS year, CAST(month(start_time) AS INT) AS month"


def parts_sql(weekday: str) -> str:
    return (
        "CAST(hour(start_time) AS INT) AS hour, CAST(day(start_time) AS INT) AS day,"
        " CAST(weekofyear(start_time) AS INT) AS week, CAST(month(start_time) AS INT) AS month,"
        f" CAST(year(start_time) AS INT) AS year, {weekday} AS weekday"
    )


def first_and_last(source: str, key: str, first: list[str], last: list[str], order: str) -> str:
    picks = [f"first_value({c}) OVER up AS {c}" for c in first] + [f"first_value({c}) OVER down AS {c}" for c in last]
    return (
        f"SELECT DISTINCT {key}, {', '.join(picks)} FROM {source} WINDOW"
        f" up AS (PARTITION BY {key} ORDER BY {order}),"
        f" down AS (PARTITION BY {key} ORDER BY {', '.join(f'{c} DESC' for c in order.split(', '))})"
    )


def _plays(spark, sf_dir):
    return dims.plays(staged_events(spark, sf_dir), PAGE)


def _log_plays(spark, sf_dir):
    return dims.plays(staged_log(spark, sf_dir), PAGE)


def _catalog(spark, sf_dir):
    """The song and artist tables, joined again for the lookup."""
    songs = staged_songs(spark, sf_dir)
    artists = up.upsert(artist_rows(songs), up.ARTISTS_RULE)
    return facts.song_catalog(up.upsert(songs.select(*dims.SONG_COLUMNS), up.SONGS_RULE), artists)


# Matches


@query("songplays_title", WITH + f"SELECT {SECOND}, {MATCHED} FROM plays p JOIN songs s ON p.song = s.title")
def songplays_title(spark, sf_dir):
    return facts.songplay_rows(facts.match_songs(_plays(spark, sf_dir), staged_songs(spark, sf_dir), "title"))


@query(
    "songplays_title_artist",
    WITH + f"SELECT *, {YEAR_MONTH} FROM (SELECT {SECOND}, {MATCHED} FROM {BOTH})",
)
def songplays_title_artist(spark, sf_dir):
    matched = facts.match_songs(_plays(spark, sf_dir), staged_songs(spark, sf_dir), "title_artist")
    return facts.with_year_month(facts.songplay_rows(matched))


@query(
    "large_lines_sql",
    """
    SELECT o_orderpriority, l_returnflag, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM orders, lineitem WHERE o_orderkey = l_orderkey AND l_quantity >= 30 GROUP BY ALL
    """,
)
def large_lines_sql(spark, sf_dir):
    """In SQL, the quantity tested within the join condition: the optimizer takes it to the scan."""
    return spark.sql(
        """
        SELECT o_orderpriority, l_returnflag, count(*) AS n_lines, sum(CAST(l_quantity AS BIGINT)) AS quantity
        FROM {orders} INNER JOIN {lines} ON l_quantity >= :least AND l_orderkey = o_orderkey
        GROUP BY o_orderpriority, l_returnflag
        """,
        args={"least": 30},
        orders=table(spark, sf_dir, "orders"),
        lines=table(spark, sf_dir, "lineitem"),
    )


@query("songplays_lookup", WITH + f"SELECT {MILLI}, {MATCHED} FROM {LOOKUP}")
def songplays_lookup(spark, sf_dir):
    matched = facts.match_songs(_plays(spark, sf_dir), _catalog(spark, sf_dir), "exact", "left", first_only=True)
    return facts.songplay_rows(matched, "milli")


@query("song_catalog", WITH + "SELECT song_id, artist_id, title, artist_name, duration FROM songs")
def song_catalog(spark, sf_dir):
    return _catalog(spark, sf_dir)


@query(
    "first_song_per_title",
    WITH + "SELECT title, min(song_id) AS song_id, arg_min(artist_id, song_id) AS artist_id FROM songs GROUP BY title",
)
def first_song_per_title(spark, sf_dir):
    return facts.first_song(staged_songs(spark, sf_dir), "title")


@query(
    "songplays_time_join",
    WITH + f"SELECT *, {YEAR_MONTH} FROM (SELECT {SECOND}, {MATCHED} FROM {BOTH})",
)
def songplays_time_join(spark, sf_dir):
    events = staged_events(spark, sf_dir)
    matched = facts.match_songs(dims.plays(events, PAGE), staged_songs(spark, sf_dir), "title_artist")
    return facts.join_time(facts.songplay_rows(matched), dims.time_dimension(events, PAGE, keep_ts=True))


# Ids


@query(
    "songplays_distinct_id",
    WITH
    + "SELECT CAST(row_number() OVER (ORDER BY start_time, user_id, level, song_id, artist_id, session_id, location,"
    f" user_agent) AS BIGINT) AS songplay_id, * FROM (SELECT DISTINCT {SECOND}, {MATCHED} FROM {BOTH})",
)
def songplays_distinct_id(spark, sf_dir):
    matched = facts.match_songs(_plays(spark, sf_dir), staged_songs(spark, sf_dir), "title_artist")
    return ids.identity_ids(facts.songplay_rows(matched))


@query(
    "songplays_serial",
    WITH
    + 'SELECT CAST(row_number() OVER (ORDER BY ts, "sessionId", "itemInSession") AS BIGINT) AS songplay_id, ts,'
    ' "userId", song FROM plays',
)
def songplays_serial(spark, sf_dir):
    rows = _plays(spark, sf_dir).select("ts", "sessionId", "itemInSession", "userId", "song")
    return ids.serial_ids(rows, ["ts", "sessionId", "itemInSession"], unique=True).drop("sessionId", "itemInSession")


@query(
    "lineitem_serial_ties",
    "SELECT CAST(row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity) AS BIGINT) AS line_id,"
    " l_shipdate, l_orderkey, l_linenumber, l_quantity FROM lineitem",
)
def lineitem_serial_ties(spark, sf_dir):
    """Rows with one date are numbered in the order of their other columns."""
    rows = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    return ids.serial_ids(rows, ["l_shipdate"], "line_id", from_scan=True)


@query("songplays_mono_id", WITH + "SELECT count(*) AS n_rows, count(*) AS n_ids FROM plays")
def songplays_mono_id(spark, sf_dir):
    numbered = ids.spread_ids(_log_plays(spark, sf_dir))
    return numbered.agg(F.count("*").alias("n_rows"), F.count_distinct("songplay_id").alias("n_ids"))


# Time


@query(
    "time_lake",
    WITH
    + f"SELECT ts, start_time, {parts_sql('CAST(dayofweek(start_time) + 1 AS INT)')}"
    f" FROM (SELECT DISTINCT ts, {SECOND} FROM plays)",
)
def time_lake(spark, sf_dir):
    return dims.time_dimension(staged_log(spark, sf_dir), PAGE, keep_ts=True)


@query(
    "time_warehouse",
    WITH
    + f"SELECT start_time, {parts_sql('''rpad(dayname(start_time), 9, ' ')''')}"
    f" FROM (SELECT DISTINCT {SECOND} FROM ev)",
)
def time_warehouse(spark, sf_dir):
    return dims.time_dimension(staged_log(spark, sf_dir), page=None, weekday="padded")


TIME_STAR = f"SELECT start_time, {parts_sql('dayname(start_time)')} FROM (SELECT DISTINCT {MILLI} FROM plays)"


@query("time_star", WITH + TIME_STAR)
def time_star(spark, sf_dir):
    return dims.time_dimension(staged_log(spark, sf_dir), PAGE, "milli", "name")


@query(
    "order_slots_sql",
    """
    SELECT o_orderkey, s AS opens, s + INTERVAL 90 MINUTE AS closes, CAST(hour(s + INTERVAL 90 MINUTE) AS INT) AS closing_hour
    FROM (SELECT o_orderkey, TIMESTAMP '1970-01-01' + to_seconds(o_orderkey * 1800) AS s FROM orders)
    """,
)
def order_slots_sql(spark, sf_dir):
    """In SQL: an epoch and intervals give times, and later columns of the list refer to earlier ones by name."""
    return spark.sql(
        """
        SELECT o_orderkey,
               timestamp_ntz'1970-01-01' + o_orderkey * INTERVAL '30' MINUTE AS opens,
               opens + INTERVAL '90' MINUTE AS closes,
               hour(closes) AS closing_hour
        FROM {orders}
        """,
        orders=table(spark, sf_dir, "orders"),
    )


@query(
    "users_distinct",
    WITH
    + 'SELECT DISTINCT "userId" AS user_id, "firstName" AS first_name, "lastName" AS last_name, gender, level'
    ' FROM plays WHERE "userId" IS NOT NULL',
)
def users_distinct(spark, sf_dir):
    return dims.distinct_users(staged_log(spark, sf_dir), PAGE, require_id=True)


@query(
    "songs_distinct",
    WITH + "SELECT DISTINCT song_id, title, artist_id, year, duration FROM songs WHERE song_id IS NOT NULL",
)
def songs_distinct(spark, sf_dir):
    return dims.distinct_songs(staged_songs(spark, sf_dir), require_id=True)


@query(
    "artists_distinct",
    WITH
    + "SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,"
    " artist_longitude AS longitude FROM songs",
)
def artists_distinct(spark, sf_dir):
    return dims.distinct_artists(staged_songs(spark, sf_dir))


@query(
    "dedupe_rows",
    "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
)
def dedupe_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return dims.dedupe_rows(lines.unionByName(lines))


# Upserts

USERS_SOURCE = (
    '(SELECT "userId" AS user_id, "firstName" AS first_name, "lastName" AS last_name, gender, level, ts,'
    ' "sessionId" AS session_id, "itemInSession" AS item_in_session FROM plays)'
)
USERS_SQL = WITH + first_and_last(
    USERS_SOURCE, "user_id", ["first_name", "last_name", "gender"], ["level"], "ts, session_id, item_in_session"
)
ARTISTS_SQL = WITH + first_and_last(
    "(SELECT song_id, artist_id, artist_name AS name, artist_location AS location,"
    " CAST(artist_latitude AS DECIMAL(9,6)) AS latitude, CAST(artist_longitude AS DECIMAL(9,6)) AS longitude"
    " FROM songs)",
    "artist_id",
    ["name"],
    ["location", "latitude", "longitude"],
    "song_id",
)


@query("users_upsert", USERS_SQL)
def users_upsert(spark, sf_dir):
    return up.upsert(user_rows(_log_plays(spark, sf_dir)), up.USERS_RULE)


@query("artists_upsert", ARTISTS_SQL)
def artists_upsert(spark, sf_dir):
    return up.upsert(artist_rows(staged_songs(spark, sf_dir)), up.ARTISTS_RULE)


@query(
    "supplier_coordinates_upsert",
    "SELECT DISTINCT n_nationkey AS artist_id, n_name AS name,"
    " first_value(s_name) OVER w AS location, CAST(first_value(s_acctbal) OVER w / 100 AS DECIMAL(9,6)) AS latitude,"
    " CAST(first_value(s_acctbal) OVER w / 50 AS DECIMAL(9,6)) AS longitude"
    " FROM supplier JOIN nation ON s_nationkey = n_nationkey"
    " WINDOW w AS (PARTITION BY n_nationkey ORDER BY s_suppkey DESC)",
)
def supplier_coordinates_upsert(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    artists = rows.select(
        F.col("s_suppkey").alias("song_id"),
        F.col("n_nationkey").alias("artist_id"),
        F.col("n_name").alias("name"),
        F.col("s_name").alias("location"),
        (F.col("s_acctbal") / 100).cast("decimal(9,6)").alias("latitude"),
        (F.col("s_acctbal") / 50).cast("decimal(9,6)").alias("longitude"),
    )
    return up.upsert(artists, up.ARTISTS_RULE)


@query("songs_insert_if_absent", WITH + "SELECT song_id, title, artist_id, year, duration FROM songs")
def songs_insert_if_absent(spark, sf_dir):
    """The paying half of the catalog is there already; inserting everything adds only the rest."""
    songs = staged_songs(spark, sf_dir).select(*dims.SONG_COLUMNS)
    existing = materialize(up.upsert(songs.filter("year > 0"), up.SONGS_RULE), "songs")
    return existing.unionByName(up.insert_absent(existing, songs, up.SONGS_RULE))


@query("time_insert_if_absent", WITH + TIME_STAR)
def time_insert_if_absent(spark, sf_dir):
    events = staged_log(spark, sf_dir)
    existing = materialize(dims.time_dimension(events.filter("level = 'paid'"), PAGE, "milli", "name"), "time")
    times = dims.time_dimension(events, PAGE, "milli", "name")
    return existing.unionByName(up.insert_absent(existing, times, up.TIME_RULE))


@query("upsert_incremental", USERS_SQL)
def upsert_incremental(spark, sf_dir):
    """The late batch first: the paid plays, then the free ones before, between and after them."""
    rows = user_rows(_log_plays(spark, sf_dir))
    state = materialize(up.to_state(rows.filter("level = 'paid'"), up.USERS_RULE), "users")
    return up.from_state(up.upsert_into(state, rows.filter("level = 'free'"), up.USERS_RULE), up.USERS_RULE)


LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice"


@query(
    "overwrite_by_key",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM (SELECT *, row_number()"
    " OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,"
    " l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1",
)
def overwrite_by_key(spark, sf_dir):
    others = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    rule = up.overwrite_rule(["l_orderkey", "l_linenumber"], others, LINE_ORDER.split(", "))
    return up.upsert(table(spark, sf_dir, "lineitem"), rule)


@query(
    "first_line_per_order",
    "SELECT l_orderkey, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION"
    f" BY l_orderkey ORDER BY {LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1",
)
def first_line_per_order(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER.split(", "))
    return first_per_key(lines, ["l_orderkey"], LINE_ORDER.split(", "))


# Serving tables


def serve_sql(name: str) -> str:
    keys, others = serving.TABLES[name]
    quoted = ", ".join(f'"{c}"' for c in (*keys, *others))
    partition = ", ".join(f'"{c}"' for c in keys)
    return (
        WITH
        + f"SELECT {quoted} FROM (SELECT *, row_number() OVER (PARTITION BY {partition}"
        ' ORDER BY "sessionId" DESC, "itemInSession" DESC) AS rn FROM ev WHERE artist IS NOT NULL) WHERE rn = 1'
    )


def _serve(name: str):
    def run(spark, sf_dir):
        return serving.serve(serving.with_artist(staged_events(spark, sf_dir)), name)

    return run


for _name in serving.TABLES:
    query(f"serve_{_name}", serve_sql(_name))(_serve(_name))


@query(
    "identity_repeated",
    "SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS BIGINT) AS line_id, l_orderkey, l_linenumber"
    " FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
)
def identity_repeated(spark, sf_dir):
    """Keys that the table holds several times get one id each."""
    return ids.identity_ids(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "line_id")
