"""Scans, loads, sinks and tables: each query writes a given table in some format and reads it back."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from playlake import schemas, sinks, sources
from playlake.functions.timeparts import start_time
from playlake.operators import serving
from playlake.operators.profile import count_rows
from playlake.plans.serving import consolidate, read_consolidated
from playlake.storage import fresh_path
from playlake.workload.analogues import WITH, raw_events, staged_events, staged_songs, table
from playlake.workload.registry import query

EVENTS = WITH + "SELECT * FROM ev"
RAW = WITH + "SELECT * REPLACE (coalesce(CAST(\"userId\" AS VARCHAR), '') AS \"userId\") FROM ev"
SONGS = WITH + "SELECT * FROM songs"


def write_daily_logs(spark, sf_dir: str) -> str:
    """The event log as JSON lines below ``<year-month>/<day>/``."""
    path = fresh_path(spark, "logs")
    day = start_time(F.col("ts"))
    month = F.date_format(day, "yyyy-MM")
    logs = raw_events(spark, sf_dir).select("*", month.alias("month"), F.dayofmonth(day).alias("day"))
    logs.hint("rebalance", "month", "day").write.partitionBy("month", "day").json(path)
    return path


def write_songs(spark, sf_dir: str) -> str:
    path = fresh_path(spark, "songs")
    staged_songs(spark, sf_dir).write.json(path)
    return path


def write_csvs(spark, sf_dir: str) -> str:
    """The events as CSV files with a header each; text with commas and quotes is quoted, quotes are doubled."""
    path = fresh_path(spark, "csv")
    events = staged_events(spark, sf_dir).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.EVENT_CSV]
    )
    # One artist in every few is credited with a quote, to be doubled in the file.
    credited = events.withColumn("artist", F.replace("artist", F.lit(" (live)"), F.lit(' "live", at home')))
    credited.write.option("header", True).option("escape", '"').csv(path)
    return path


CSV = WITH + (
    "SELECT * EXCLUDE (\"userAgent\") REPLACE (replace(artist, ' (live)', ' \"live\", at home') AS artist,"
    " CAST(ts AS DOUBLE) AS ts) FROM ev"
)


@query("scan_json_lines", RAW)
def scan_json_lines(spark, sf_dir):
    path = write_daily_logs(spark, sf_dir)
    return sources.read_json_lines(spark, path, schemas.EVENT_LOG, recursive=True)


@query("scan_glob", RAW)
def scan_glob(spark, sf_dir):
    path = write_daily_logs(spark, sf_dir)
    return sources.read_json_lines(spark, f"{path}/*/*/*.json", schemas.EVENT_LOG)


@query(
    "scan_recursive",
    WITH
    + "SELECT CAST(day(epoch_ms(ts)) AS INT) AS day, count(*) AS n_rows FROM ev GROUP BY ALL",
)
def scan_recursive(spark, sf_dir):
    path = write_daily_logs(spark, sf_dir)
    logs = sources.read_json_lines(spark, path, schemas.EVENT_LOG, recursive=True, name_glob="*.json")
    day = F.regexp_extract("_metadata.file_path", r"day=(\d+)", 1).cast("int")
    return logs.groupBy(day.alias("day")).agg(F.count("ts").alias("n_rows"))


@query("count_files", WITH + "SELECT count(*) AS n_rows, true AS has_files FROM ev")
def count_files(spark, sf_dir):
    path = write_daily_logs(spark, sf_dir)
    logs = sources.read_json_lines(spark, path, schemas.EVENT_LOG, recursive=True, name_glob="*.json")
    return sources.count_files(logs).select("n_rows", (F.col("n_files") > 0).alias("has_files"))


@query("count_listed", "SELECT count(DISTINCT event_type) AS n_files FROM events")
def count_listed(spark, sf_dir):
    """One file for each type of event, counted without a look inside."""
    path = fresh_path(spark, "types")
    table(spark, sf_dir, "events").repartition("event_type").write.partitionBy("event_type").json(path)
    return sources.count_listed(spark, path, "*.json")


def write_song_objects(spark, sf_dir: str) -> str:
    """Songs as JSON that runs over several lines, at most a hundred to a file."""
    path = fresh_path(spark, "objects")
    shelf = F.call_function("div", F.substring("song_id", 2, 20).cast("bigint"), F.lit(100))
    files = staged_songs(spark, sf_dir).groupBy(shelf.alias("shelf")).agg(F.collect_list(F.struct("*")).alias("songs"))
    pretty = F.to_json("songs", {"pretty": "true"})
    files.select(pretty.alias("value"), "shelf").write.partitionBy("shelf").text(path)
    return path


@query("scan_json_object_files", SONGS)
def scan_json_object_files(spark, sf_dir):
    return sources.read_json_objects(spark, write_song_objects(spark, sf_dir), schemas.SONG_META, name_glob="*.txt")


def write_damaged_logs(spark, sf_dir: str) -> str:
    """The log with the lines of errors cut open and the item number of sign-ups spelled out."""
    path = fresh_path(spark, "damaged")
    events = raw_events(spark, sf_dir)
    line = F.to_json(F.struct(*events.columns))
    damaged = (
        F.when(F.col("page") == "error", F.replace(line, F.lit("}"), F.lit("")))
        .when(F.col("page") == "signup", F.replace(line, F.lit('"itemInSession":'), F.lit('"itemInSession":"no ')))
        .otherwise(line)
    )
    fixed = F.when(F.col("page") == "signup", F.regexp_replace(damaged, r'"no (\d+)', '"no $1"')).otherwise(damaged)
    events.select(fixed.alias("value")).write.text(path)
    return path


@query("scan_json_permissive", RAW + " WHERE page NOT IN ('error', 'signup')")
def scan_json_permissive(spark, sf_dir):
    path = write_damaged_logs(spark, sf_dir)
    logs = sources.read_json_lines(spark, path, schemas.EVENT_LOG, corrupt=schemas.CORRUPT_COLUMN)
    return sources.split_corrupt(logs)[0]


@query(
    "json_corrupt_rows",
    WITH + "SELECT page, ts, \"sessionId\" AS session_id FROM ev WHERE page IN ('error', 'signup')",
)
def json_corrupt_rows(spark, sf_dir):
    path = write_damaged_logs(spark, sf_dir)
    logs = sources.read_json_lines(spark, path, schemas.EVENT_LOG, corrupt=schemas.CORRUPT_COLUMN)
    bad = sources.split_corrupt(logs)[1]

    def number(name: str):
        return F.regexp_extract(schemas.CORRUPT_COLUMN, rf'"{name}":(\d+)', 1).cast("bigint")

    page = F.regexp_extract(schemas.CORRUPT_COLUMN, r'"page":"(\w+)"', 1)
    return bad.select(page.alias("page"), number("ts").alias("ts"), number("sessionId").alias("session_id"))


@query("scan_csv", CSV)
def scan_csv(spark, sf_dir):
    return sources.read_csv(spark, write_csvs(spark, sf_dir), schemas.EVENT_CSV)


def write_multiline_csv(spark, sf_dir: str) -> str:
    """The events as CSV files; some artists are credited in two lines, with a quote, and a few locations in three."""
    path = fresh_path(spark, "csv")
    events = staged_events(spark, sf_dir).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.EVENT_CSV])
    credited = events.withColumn("artist", F.replace("artist", F.lit(" (live)"), F.lit(' \n"live", at home')))
    spread = F.when(F.col("sessionId") % 7 == 0, F.replace("location", F.lit(", "), F.lit(",\n\n"))).otherwise(F.col("location"))
    credited.withColumn("location", spread).write.option("header", True).option("escape", '"').option("lineSep", "\n").csv(path)
    return path


MULTILINE = WITH + (
    "SELECT * EXCLUDE (\"userAgent\") REPLACE (replace(artist, ' (live)', ' ' || chr(10) || '\"live\", at home') AS artist, CAST(ts AS DOUBLE) AS ts,"
    " CASE WHEN \"sessionId\" % 7 = 0 THEN replace(location, ', ', ',' || chr(10) || chr(10)) ELSE location END AS location) FROM ev"
)


@query("scan_csv_multiline", MULTILINE)
def scan_csv_multiline(spark, sf_dir):
    """Files that are each read by many tasks where they are large, though their fields hold line breaks."""
    rows = sources.read_csv_records(spark, write_multiline_csv(spark, sf_dir), schemas.EVENT_CSV)
    return rows.filter(F.col(schemas.CORRUPT_COLUMN).isNull()).drop(schemas.CORRUPT_COLUMN)


def with_headers(lines, header: str):
    """``lines`` (one column, ``value``) with ``header`` before the first line of every task: each file that is written begins with one."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")  # the row's place in its task
    both = F.when(F.col("_place") == 0, F.array(F.lit(header), F.col("value"))).otherwise(F.array("value"))
    return lines.select("value", place).select(F.explode(both).alias("value"))


@query(
    "csv_rejected",
    WITH + "SELECT page, \"sessionId\" AS session_id FROM ev WHERE page IN ('error', 'signup') UNION ALL SELECT 'kept', count(*) FROM ev WHERE page NOT IN ('error', 'signup')",
)
def csv_rejected(spark, sf_dir):
    """Damaged CSV rows as text: errors lack their last columns, sign-ups have a word for the item number; and how many rows are kept."""
    path = fresh_path(spark, "csv")
    events = staged_events(spark, sf_dir).select(*[F.col(f.name).cast(f.dataType).cast("string").alias(f.name) for f in schemas.EVENT_CSV])
    spelled = events.withColumn("itemInSession", F.when(F.col("page") == "signup", F.concat(F.lit("no "), "itemInSession")).otherwise(F.col("itemInSession")))
    line = F.to_csv(F.struct(*spelled.columns), {"escape": '"'})
    cut = F.when(F.col("page") == "error", F.regexp_replace(line, ",[^,]*,[^,]*$", "")).otherwise(line)
    texts = spelled.select(cut.alias("value"))
    with_headers(texts, ",".join(spelled.columns)).write.text(path)
    rows = sources.read_csv_records(spark, path, schemas.EVENT_CSV)
    good, bad = sources.split_corrupt(rows)
    session = F.coalesce("sessionId", F.lit(-1)).cast("bigint").alias("session_id")
    return bad.select("page", session).union(good.agg(F.lit("kept"), F.count("*")))


@query("scan_csv_inferred", WITH + 'SELECT song, artist, "itemInSession", length FROM ev WHERE song IS NOT NULL')
def scan_csv_inferred(spark, sf_dir):
    path = fresh_path(spark, "csv")
    sinks.write_csv_quoted(
        staged_events(spark, sf_dir).select("song", "artist", "itemInSession", "length").dropna(subset=["song"]), path
    )
    return sources.read_csv_inferred(spark, path)


@query("copy_jsonpaths", EVENTS)
def copy_jsonpaths(spark, sf_dir):
    path = write_daily_logs(spark, sf_dir)
    return sources.copy_by_paths(spark, f"{path}/*/*/*.json", schemas.EVENT_JSON_PATHS, schemas.STAGING_EVENTS)


@query(
    "copy_jsonpaths_nested",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value AS first_value FROM events",
)
def copy_jsonpaths_nested(spark, sf_dir):
    path = fresh_path(spark, "nested")
    events = table(spark, sf_dir, "events")
    props = F.from_json("props", "k bigint")
    events.select("event_id", props.alias("props"), F.array("value", F.lit(0.0)).alias("values")).write.json(path)
    schema = StructType().add("event_id", LongType()).add("k", LongType()).add("first_value", DoubleType())
    return sources.copy_by_paths(spark, path, ("$['event_id']", "$.props.k", "$.values[0]"), schema)


@query("copy_auto", SONGS)
def copy_auto(spark, sf_dir):
    """Matched by name: an extra field is ignored, a missing one (here, where null) is null."""
    path = fresh_path(spark, "songs")
    staged_songs(spark, sf_dir).withColumn("extra", F.lit("x")).write.json(path)
    return sources.copy_by_name(spark, path, schemas.STAGING_SONGS)


@query(
    "copy_unfit_values",
    "SELECT CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END AS BIGINT) AS id,"
    " CAST(9007199254740993 + o_orderkey AS BIGINT) AS large FROM orders",
)
def copy_unfit_values(spark, sf_dir):
    """Numbers as text: whole ones load whatever their form and size, fractions are null in a whole-number column."""
    path = fresh_path(spark, "unfit")
    key = F.col("o_orderkey").cast("string")
    orders = table(spark, sf_dir, "orders")
    form = F.when(F.col("o_orderkey") % 3 == 0, F.concat(key, F.lit(".7"))).when(F.col("o_orderkey") % 3 == 1, F.concat(key, F.lit(".0")))
    large = F.concat((F.col("o_orderkey") + 9007199254740993).cast("string"), F.lit(".0"))
    orders.select(F.coalesce(form, key).alias("id"), large.alias("large")).write.json(path)
    return sources.copy_by_name(spark, path, StructType().add("id", LongType()).add("large", LongType()))


def write_song_table(spark, sf_dir: str) -> str:
    path = fresh_path(spark, "songs")
    songs = staged_songs(spark, sf_dir).select("song_id", "title", "artist_id", "year", "duration")
    sinks.write_parquet(songs, path, ("year", "artist_id"))
    return path


@query("scan_partitioned", WITH + "SELECT song_id, title, artist_id, year, duration FROM songs")
def scan_partitioned(spark, sf_dir):
    path = write_song_table(spark, sf_dir)
    return sources.read_partitioned(spark, path, schemas.SONGS, "*/*/").select(*schemas.SONGS.names)


@query("scan_leaf_glob", WITH + "SELECT song_id, title, duration FROM songs")
def scan_leaf_glob(spark, sf_dir):
    return sources.read_leaves(spark, write_song_table(spark, sf_dir))


@query(
    "union_sources",
    "SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation"
    " UNION ALL SELECT r_regionkey, r_name, NULL FROM region",
)
def union_sources(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").toDF("key", "name", "region")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    return sources.union_sources(nation, region)


# Tables

ORDER_SCHEMA = (
    StructType()
    .add("o_orderkey", LongType())
    .add("o_custkey", LongType())
    .add("o_orderstatus", StringType())
    .add("o_totalprice", DoubleType())
)


def new_database(spark) -> str:
    path = fresh_path(spark, "db")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    sinks.create_database(spark, name, path)
    return name


@query("scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_table(spark, sf_dir):
    """Create, drop, create again, append in two parts, scan."""
    name = f"{new_database(spark)}.orders"
    orders = table(spark, sf_dir, "orders").select(*ORDER_SCHEMA.names)
    sinks.create_table(spark, name, ORDER_SCHEMA)
    sinks.drop_tables(spark, [name])
    sinks.create_table(spark, name, ORDER_SCHEMA)
    sinks.append_rows(orders.filter("o_orderstatus = 'F'"), name)
    sinks.append_rows(orders.filter("o_orderstatus <> 'F'"), name)
    return sources.read_table(spark, name)


@query("scan_table_pruned", "SELECT o_orderkey, o_orderstatus FROM orders")
def scan_table_pruned(spark, sf_dir):
    name = f"{new_database(spark)}.orders"
    sinks.create_table(spark, name, ORDER_SCHEMA)
    sinks.insert_select(table(spark, sf_dir, "orders").select(*ORDER_SCHEMA.names), name)
    return sources.read_table(spark, name, ["o_orderkey", "o_orderstatus"])


@query(
    "insert_select_columns",
    "SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, o_totalprice FROM orders",
)
def insert_select_columns(spark, sf_dir):
    """Into some columns of the table, in an order of their own; the others are null."""
    name = f"{new_database(spark)}.orders"
    sinks.create_table(spark, name, ORDER_SCHEMA)
    rows = table(spark, sf_dir, "orders").selectExpr("o_totalprice AS a", "o_orderkey AS b", "o_custkey AS c")
    sinks.insert_select(rows, name, ["o_totalprice", "o_orderkey", "o_custkey"])
    return sources.read_table(spark, name)


@query("sink_parquet", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_parquet(spark, sf_dir):
    """Written twice: the second replaces the first."""
    path = fresh_path(spark, "supplier")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    sinks.write_parquet(suppliers.filter("s_acctbal < 0"), path)
    sinks.write_parquet(suppliers, path)
    return spark.read.schema(suppliers.schema).parquet(path)


@query(
    "sink_parquet_touched",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice, o_orderstatus"
    " FROM orders",
)
def sink_parquet_touched(spark, sf_dir):
    """Only the partition of finished orders is written anew; the others stay."""
    path = fresh_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.write_parquet(orders, path, ("o_orderstatus",))
    settled = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    sinks.write_parquet(settled, path, ("o_orderstatus",), only_touched=True)
    return sources.read_partitioned(spark, path, orders.schema)


CONSOLIDATED = (
    'SELECT artist, "firstName", gender, "itemInSession", "lastName", length, level, location, "sessionId", song,'
    ' "userId" FROM ev WHERE artist IS NOT NULL'
)


@query(
    "sink_csv_quoted",
    WITH + CONSOLIDATED.replace("artist,", "replace(artist, ' (live)', ' \"live\", at home') AS artist,", 1),
)
def sink_csv_quoted(spark, sf_dir):
    path = fresh_path(spark, "consolidated")
    consolidate(spark, write_csvs(spark, sf_dir), path)
    return read_consolidated(spark, path)


@query("count_csv_rows", WITH + "SELECT count(*) AS n_rows, true AS has_headers FROM ev WHERE artist IS NOT NULL")
def count_csv_rows(spark, sf_dir):
    """Data rows; the line count is higher by one header line per part file."""
    path = fresh_path(spark, "consolidated")
    kept = serving.at_positions(serving.with_artist(staged_events(spark, sf_dir)), (0, 2, 12, 16))
    sinks.write_csv_quoted(kept, path)
    counts = sources.union_sources(
        count_rows(sources.read_csv(spark, path, kept.schema)), sinks.count_lines(spark, path)
    ).agg(F.max("n_rows").alias("n_rows"), F.max("n_lines").alias("n_lines"))
    return counts.select("n_rows", (F.col("n_lines") > F.col("n_rows")).alias("has_headers"))


@query("sink_text_append", "SELECT c_name AS value FROM customer UNION ALL SELECT s_name FROM supplier")
def sink_text_append(spark, sf_dir):
    path = fresh_path(spark, "text")
    sinks.append_text(table(spark, sf_dir, "customer").select("c_name"), path)
    sinks.append_text(table(spark, sf_dir, "supplier").select("s_name"), path)
    return spark.read.schema(StructType([StructField("value", StringType())])).text(path)


@query("layout_sorted", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def layout_sorted(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return sinks.arrange(lines, ["l_shipdate"], from_scan=True)


@query("positional_columns", 'SELECT l_orderkey AS a, l_suppkey AS b, l_shipdate AS c FROM lineitem')
def positional_columns(spark, sf_dir):
    return serving.at_positions(table(spark, sf_dir, "lineitem"), (0, 2, 10)).toDF("a", "b", "c")
