"""Keyed messages and file-by-file loads."""

from pyspark.sql import functions as F

from playlake.functions.casts import conform
from playlake.operators import dims, upsert as up
from playlake.plans.star import build_star, user_rows
from playlake.schemas import EVENT_LOG, STAGING_EVENTS
from playlake.storage import fresh_path
from playlake.streaming import incremental, star_load, topics
from playlake.workload.analogues import PAGE, WITH, staged_log, table
from playlake.workload.file_queries import write_daily_logs, write_damaged_logs, write_songs
from playlake.workload.registry import query
from playlake.workload.star_queries import LOOKUP, MATCHED, MILLI, USERS_SQL

#: Daily logs in one batch.
FILES_PER_BATCH = 8

MESSAGES = "SELECT CAST(event_id AS VARCHAR) AS key, concat(event_type, ',', props) AS value FROM events"


def message_columns():
    return F.col("event_id").cast("string").alias("key"), F.concat_ws(",", "event_type", "props").alias("value")


def write_lines(spark, sf_dir: str) -> str:
    path = fresh_path(spark, "lines")
    messages = table(spark, sf_dir, "events").select(*message_columns())
    messages.select(topics.joined_keyed().alias("value")).write.text(path)
    return path


def consume(spark, source: str, path: str, checkpoint: str) -> None:
    """Read what is there from ``source`` and keep it at ``path``; the checkpoint says where to go on."""
    messages = topics.read_topic(spark, "text", {"path": source})
    topics.write_topic(messages, "parquet", {"path": path}, checkpoint).awaitTermination()


@query("stream_keyed", MESSAGES)
def stream_keyed(spark, sf_dir):
    path = fresh_path(spark, "messages")
    consume(spark, write_lines(spark, sf_dir), path, fresh_path(spark, "checkpoint"))
    return spark.read.schema("key string, value string").parquet(path)


@query("stream_write_keyed", MESSAGES)
def stream_write_keyed(spark, sf_dir):
    """``events`` as a stream, written as keyed text lines."""
    path = fresh_path(spark, "lines")
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    messages = events.select(*message_columns())
    topics.write_topic(messages, "text", {"path": path}, fresh_path(spark, "checkpoint")).awaitTermination()
    return topics.split_keyed(spark.read.text(path))


@query(
    "stream_replay",
    "SELECT reader, count(*) AS n_messages, count(DISTINCT event_id) AS n_keys FROM events,"
    " (VALUES ('group'), ('replay')) r(reader) GROUP BY reader",
)
def stream_replay(spark, sf_dir):
    """A group that comes back finds nothing new; a new checkpoint reads everything again."""
    source, group, replay = write_lines(spark, sf_dir), fresh_path(spark, "group"), fresh_path(spark, "replay")
    position = fresh_path(spark, "checkpoint")
    consume(spark, source, group, position)
    consume(spark, source, group, position)
    consume(spark, source, replay, fresh_path(spark, "checkpoint"))
    read = [
        spark.read.schema("key string, value string").parquet(path).select("key", F.lit(reader).alias("reader"))
        for path, reader in ((group, "group"), (replay, "replay"))
    ]
    counts = read[0].union(read[1]).groupBy("reader")
    return counts.agg(F.count("*").alias("n_messages"), F.count_distinct("key").alias("n_keys"))


def stream_daily_logs(spark, sf_dir: str):
    """The daily logs as a stream, some files per batch, in the order the files were written."""
    logs = write_daily_logs(spark, sf_dir)
    return incremental.read_files(spark, logs, EVENT_LOG, files_per_trigger=FILES_PER_BATCH)


@query("stream_file_upsert", USERS_SQL)
def stream_file_upsert(spark, sf_dir):
    """One table, upserted file by file."""
    path = fresh_path(spark, "users")
    load = incremental.upsert_batches(
        up.USERS_RULE, path, lambda batch: user_rows(conform(dims.plays(batch, PAGE), STAGING_EVENTS))
    )
    stream = stream_daily_logs(spark, sf_dir)
    incremental.run_batches(stream, load, fresh_path(spark, "checkpoint")).awaitTermination()
    return incremental.current_table(spark, path, up.USERS_RULE)


def song_lines(spark, sf_dir: str):
    """The songs as a stream of lines."""
    return star_load.read_lines(spark, write_songs(spark, sf_dir))


def log_lines(spark, path: str, files_per_batch: int = FILES_PER_BATCH):
    return star_load.read_lines(spark, path, files_per_batch)


def take_in(spark, stream, load) -> None:
    incremental.run_batches(stream, load, fresh_path(spark, "checkpoint")).awaitTermination()


@query("stream_file_songplays", WITH + f"SELECT {MILLI}, {MATCHED} FROM {LOOKUP}")
def stream_file_songplays(spark, sf_dir):
    """Songs, then users, times and plays, taken in file by file; here the plays."""
    star = star_load.StarLoad(spark, fresh_path(spark, "star"), PAGE)
    take_in(spark, song_lines(spark, sf_dir), star.load_songs)
    take_in(spark, log_lines(spark, write_daily_logs(spark, sf_dir)), star.load_events)
    return star.tables()["songplays"].drop("songplay_id")


@query("stream_song_files", WITH + f"SELECT {MILLI}, {MATCHED} FROM {LOOKUP}")
def stream_song_files(spark, sf_dir):
    """The songs come after all plays."""
    star = star_load.StarLoad(spark, fresh_path(spark, "star"), PAGE)
    take_in(spark, log_lines(spark, write_daily_logs(spark, sf_dir)), star.load_events)
    take_in(spark, song_lines(spark, sf_dir), star.load_songs)
    return star.tables()["songplays"].drop("songplay_id")


@query(
    "stream_replay_same_out",
    WITH + f"SELECT count(*) AS n_plays, count(*) AS n_ids, count(*) AS last_id, count(DISTINCT \"userId\") AS n_users FROM {LOOKUP}",
)
def stream_replay_same_out(spark, sf_dir):
    """The same files once more into the same star, from a new checkpoint and in other batches: nothing is added."""
    star = star_load.StarLoad(spark, fresh_path(spark, "star"), PAGE)
    take_in(spark, song_lines(spark, sf_dir), star.load_songs)
    logs = write_daily_logs(spark, sf_dir)
    for files_per_batch in (FILES_PER_BATCH, 3 * FILES_PER_BATCH):
        take_in(spark, log_lines(spark, logs, files_per_batch), star.load_events)
    tables = star.tables()
    users = tables["users"].agg(F.count("*").alias("n_users"))
    plays = tables["songplays"]
    counts = plays.agg(F.count("*").alias("n_plays"), F.count_distinct("songplay_id").alias("n_ids"), F.max("songplay_id").alias("last_id"))
    return counts.crossJoin(users)  # one row each


@query(
    "stream_continue_star",
    WITH + f"SELECT {MILLI}, {MATCHED} FROM {LOOKUP}",
)
def stream_continue_star(spark, sf_dir):
    """A star of the log's first half, built in one run, and a load of the second half on top of it. Ids that have a gap or repeat give no rows."""
    songs, logs = write_songs(spark, sf_dir), write_daily_logs(spark, sf_dir)
    log = spark.read.option("recursiveFileLookup", True).text(logs)
    halves = [fresh_path(spark, half) for half in ("first", "second")]
    for half, path in enumerate(halves):
        log.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == half).write.text(path)
    built = fresh_path(spark, "star")
    build_star(spark, songs, halves[0], built, PAGE, object_files=False)
    star = star_load.StarLoad(spark, fresh_path(spark, "star"), PAGE)
    star.seed(built, songs, halves[0])
    for path in halves:  # the first half counts as loaded
        take_in(spark, log_lines(spark, path), star.load_events)
    plays = star.tables()["songplays"]
    seen = plays.agg(F.count("*").alias("n"), F.count_distinct("songplay_id").alias("n_ids"), F.min("songplay_id").alias("a"), F.max("songplay_id").alias("b"))
    sound = seen.filter("n = n_ids and a = 1 and b = n").select("n")
    return plays.join(sound, how="cross").drop("songplay_id", "n")  # ``sound`` is one row or none


@query(
    "stream_rejected",
    WITH
    + "SELECT page, ts, \"sessionId\" AS session_id, CAST(NULL AS BIGINT) AS n_plays FROM ev WHERE page IN ('error', 'signup')"
    " UNION ALL SELECT NULL, NULL, NULL, count(*) FROM plays",
)
def stream_rejected(spark, sf_dir):
    """Damaged lines of a stream, with the number of plays beside them."""
    star = star_load.StarLoad(spark, fresh_path(spark, "star"), PAGE)
    take_in(spark, log_lines(spark, write_damaged_logs(spark, sf_dir)), star.load_events)
    tables = star.tables()
    bad = tables["rejected_events"]

    def number(name: str):
        return F.regexp_extract("corrupt_record", rf'"{name}":(\d+)', 1).cast("bigint")

    lines = bad.select(
        F.regexp_extract("corrupt_record", r'"page":"(\w+)"', 1).alias("page"), number("ts").alias("ts"), number("sessionId").alias("session_id")
    )
    n_plays = tables["songplays"].agg(F.count("*").alias("n_plays"))
    return lines.unionByName(n_plays, allowMissingColumns=True)


@query("stream_upsert_compacted", USERS_SQL)
def stream_upsert_compacted(spark, sf_dir):
    """The states of all batches folded into one, then read."""
    path, compacted = fresh_path(spark, "users"), fresh_path(spark, "users")
    rows = user_rows(dims.plays(staged_log(spark, sf_dir), PAGE))
    load = incremental.upsert_batches(up.USERS_RULE, path)
    for batch_id, level in enumerate(("paid", "free")):
        load(rows.filter(F.col("level") == level), batch_id)
    incremental.compact(spark, path, up.USERS_RULE, compacted)
    return incremental.current_table(spark, compacted, up.USERS_RULE)
