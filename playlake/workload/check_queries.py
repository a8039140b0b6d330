"""Constraint checks, statements, lookups, profiles, samples."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from playlake import sinks
from playlake.operators import profile, quality, statements
from playlake.operators.key_log import KeyLog
from playlake.storage import fresh_path, materialize
from playlake.workload.analogues import WITH, staged_log, staged_songs, table
from playlake.workload.registry import query


@query(
    "check_pk",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def check_pk(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_pk_null",
    WITH + 'SELECT "userId", count(*) AS n_rows FROM ev GROUP BY ALL HAVING count(*) > 1 OR "userId" IS NULL',
)
def check_pk_null(spark, sf_dir):
    return quality.duplicate_keys(staged_log(spark, sf_dir), ["userId"])


@query(
    "check_pk_incremental",
    "WITH n AS (SELECT year(l_shipdate) AS load, l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL),"
    " b AS (SELECT *, CAST(coalesce(sum(n_rows) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY load"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS n_before FROM n)"
    " SELECT * FROM b WHERE n_rows + n_before > 1",
)
def check_pk_incremental(spark, sf_dir):
    """Line items loaded year by year, each year held against the bitmaps of those before."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("load"))
    lines = materialize(lines, "loads")
    keys = ["l_orderkey", "l_linenumber"]
    log = KeyLog(spark, fresh_path(spark, "keys"), lines.schema, keys, expected=lines.count())
    years = lines.agg(F.min("load"), F.max("load")).first()
    found = [log.take(lines.filter(F.col("load") == y), y).withColumn("load", F.lit(y)) for y in range(years[0], years[1] + 1)]
    return reduce(DataFrame.union, found)


@query(
    "check_fk_incremental",
    "SELECT r AS after_region, o_custkey, count(*) AS n_rows FROM (SELECT DISTINCT n_regionkey AS r FROM nation), orders"
    " WHERE NOT EXISTS (SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey"
    " WHERE n_regionkey <= r AND c_custkey = o_custkey) GROUP BY ALL",
)
def check_fk_incremental(spark, sf_dir):
    """Orders whose customer is not there yet, while customers are loaded region by region."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, sf_dir, "orders")
    log = KeyLog(spark, fresh_path(spark, "keys"), customer.schema, ["c_custkey"])
    found = []
    for region in sorted(r[0] for r in nation.select("n_regionkey").distinct().collect()):
        log.take(customer.filter(F.col("n_regionkey") == region), region)
        # Later loads must not change what was missing now.
        found.append(materialize(log.missing(orders, "o_custkey"), "missing").withColumn("after_region", F.lit(region)))
    return reduce(DataFrame.union, found)


@query("check_not_null", WITH + "SELECT ts, page, 'userId is null' AS broken FROM ev WHERE \"userId\" IS NULL")
def check_not_null(spark, sf_dir):
    rows = quality.broken_rows(staged_log(spark, sf_dir), quality.Rules(required=("userId", "page", "ts")))
    return rows.select("ts", "page", F.array_join("broken", "; ").alias("broken"))


@query("check_nonneg", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def check_nonneg(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return quality.broken_rows(customers, quality.Rules(non_negative=("c_custkey", "c_acctbal"))).drop("broken")


@query(
    "check_length",
    "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE length(s_name) > 9"
    " OR (s_acctbal IS NOT NULL AND TRY_CAST(s_acctbal AS DECIMAL(9,6)) IS NULL)",
)
def check_length(spark, sf_dir):
    rules = quality.Rules(max_length={"s_name": 9}, decimals={"s_acctbal": (9, 6)})
    return quality.broken_rows(table(spark, sf_dir, "supplier").drop("s_nationkey"), rules).drop("broken")


@query(
    "check_rule_counts",
    "SELECT 'c_acctbal < 0' AS rule, count(*) FILTER (c_acctbal < 0) AS n_rows FROM customer"
    " UNION ALL SELECT 'c_mktsegment longer than 9', count(*) FILTER (length(c_mktsegment) > 9) FROM customer"
    " UNION ALL SELECT 'c_name is null', count(*) FILTER (c_name IS NULL) FROM customer"
    " UNION ALL SELECT 'c_acctbal over decimal(9,6)',"
    " count(*) FILTER (TRY_CAST(c_acctbal AS DECIMAL(9,6)) IS NULL) FROM customer",
)
def check_rule_counts(spark, sf_dir):
    rules = quality.Rules(
        required=("c_name",),
        non_negative=("c_acctbal",),
        max_length={"c_mktsegment": 9},
        decimals={"c_acctbal": (9, 6)},
    )
    return quality.rule_counts(table(spark, sf_dir, "customer"), rules)


IN_CREDIT = "c_acctbal >= 0"


@query(
    "check_fk",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL"
    f" AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE {IN_CREDIT})",
)
def check_fk(spark, sf_dir):
    """Orders of customers that are missing from the list of those in credit."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return quality.orphan_rows(orders, "o_custkey", table(spark, sf_dir, "customer").filter(IN_CREDIT), "c_custkey")


@query(
    "check_fk_keys",
    "SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey IS NOT NULL"
    f" AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE {IN_CREDIT}) GROUP BY o_custkey",
)
def check_fk_keys(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter(IN_CREDIT)
    return quality.orphan_keys(table(spark, sf_dir, "orders"), "o_custkey", customers, "c_custkey")


@query(
    "check_fk_mixed_types",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL"
    f" AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE {IN_CREDIT})",
)
def check_fk_mixed_types(spark, sf_dir):
    """Decimals of one scale refer to decimals of another."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    child = orders.withColumn("o_custkey", F.col("o_custkey").cast("decimal(20,2)"))
    parent = table(spark, sf_dir, "customer").filter(IN_CREDIT).select(F.col("c_custkey").cast("decimal(24,4)").alias("c_custkey"))
    missing = quality.orphan_rows(child, "o_custkey", parent, "c_custkey")
    return missing.select("o_orderkey", F.col("o_custkey").cast("bigint").alias("o_custkey"))


DELETES = (
    "SELECT concat('DELETE FROM shop.orders WHERE o_orderkey=', o_orderkey, ' AND \"status\"=''', o_orderstatus, ''';')"
    " AS {name} FROM orders"
)


@query("delete_script", DELETES.format(name="value"))
def delete_script(spark, sf_dir):
    path = fresh_path(spark, "deletes")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    keys = {"o_orderkey": "o_orderkey", "o_orderstatus": '"status"'}
    statements.write_delete_script(orders, "shop.orders", keys, path)
    return spark.read.text(path)


@query(
    "delete_script_quoted",
    "SELECT concat('DELETE FROM t WHERE url=''', replace(url, '''', ''''''), ''';') AS statement FROM pages",
)
def delete_script_quoted(spark, sf_dir):
    return statements.delete_statements(table(spark, sf_dir, "pages"), "t", {"url": "url"})


@query(
    "delete_script_escaped",
    "SELECT concat('DELETE FROM t WHERE name=''', replace(replace(p_name, ' ', ''''), '''', ''''''), ''';') AS statement FROM part",
)
def delete_script_escaped(spark, sf_dir):
    """Names with a quote in place of each space: unescaped, the statements would end early."""
    parts = table(spark, sf_dir, "part").select(F.replace("p_name", F.lit(" "), F.lit("'")).alias("p_name"))
    return statements.delete_statements(parts, "t", {"p_name": "name"})


@query(
    "delete_by_keys",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem d WHERE"
    " d.l_returnflag = 'R' AND d.l_orderkey = l.l_orderkey AND d.l_linenumber = l.l_linenumber)",
)
def delete_by_keys(spark, sf_dir):
    """Written anew without the keys that were ever returned."""
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    left = statements.delete_by_keys(
        lines.select(*keys, "l_quantity"), lines.filter("l_returnflag = 'R'"), keys
    )
    path = fresh_path(spark, "kept")
    sinks.write_parquet(left, path)
    return spark.read.schema(left.schema).parquet(path)


@query(
    "delete_by_keys_mixed_types",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem d WHERE"
    " d.l_returnflag = 'R' AND d.l_orderkey = l.l_orderkey AND d.l_linenumber = l.l_linenumber)",
)
def delete_by_keys_mixed_types(spark, sf_dir):
    """Keys given as integers, and as numbers with a fraction, delete rows whose keys are wider."""
    lines = table(spark, sf_dir, "lineitem")
    returned = lines.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").cast("int").alias("l_orderkey"), F.col("l_linenumber").cast("double").alias("l_linenumber")
    )
    kept = lines.select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"), "l_linenumber", "l_quantity")
    return statements.delete_by_keys(kept, returned, ["l_orderkey", "l_linenumber"])


@query(
    "delete_touched_files",
    "SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem d WHERE"
    " d.l_returnflag = 'R' AND d.l_shipdate < (SELECT max(l_shipdate) - INTERVAL 4 YEAR FROM lineitem) AND d.l_shipdate = l.l_shipdate"
    " AND d.l_orderkey = l.l_orderkey AND d.l_linenumber = l.l_linenumber)",
)
def delete_touched_files(spark, sf_dir):
    """Lines in files by ship date, without the returned ones that were shipped over four years before the last: later files stay."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag")
    stored = sinks.FileTable.create(lines.drop("l_returnflag"), fresh_path(spark, "lines"), ["l_shipdate"], partitions=32)
    last = lines.agg(F.max("l_shipdate").alias("_last"))
    old = F.col("l_shipdate") < F.col("_last") - F.expr("INTERVAL 4 YEAR")
    gone = lines.filter("l_returnflag = 'R'").join(F.broadcast(last), old, "left_semi")
    stored.delete(gone, ["l_shipdate", "l_orderkey", "l_linenumber"])
    return stored.rows()


@query(
    "lookup_param",
    WITH + "SELECT song_id, artist_id FROM songs WHERE artist_name = 'Brand#7' AND year = 0 AND num_songs = 1",
)
def lookup_param(spark, sf_dir):
    songs = staged_songs(spark, sf_dir)
    return profile.lookup(songs, artist_name="Brand#7", year=0, num_songs=1).select("song_id", "artist_id")


PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


def profile_sql(table_name: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count,"
        f" round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,"
        f" CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,"
        f" round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,"
        f" round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {table_name}"
        for c in columns
    )


def rounded(df):
    digits = {"mean": 4, "std": 4, "q25": 6, "q50": 6, "q75": 6}
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


@query("profile_numeric", profile_sql("lineitem", PROFILED))
def profile_numeric(spark, sf_dir):
    return rounded(profile.profile_numeric(table(spark, sf_dir, "lineitem"), list(PROFILED)))


@query("profile_numeric_events", profile_sql("events", ["event_id", "user_id", "value"]))
def profile_numeric_events(spark, sf_dir):
    return rounded(profile.profile_numeric(table(spark, sf_dir, "events")))


PROFILE_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query(
    "profile_columns",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS position, '{c}' AS column_name, '{t}' AS column_type, count({c}) AS n_non_null"
        " FROM orders"
        for i, (c, t) in enumerate(PROFILE_TYPES.items())
    ),
)
def profile_columns(spark, sf_dir):
    return profile.profile_columns(table(spark, sf_dir, "orders"))


@query("count_rows", "SELECT count(*) AS n_rows FROM lineitem")
def count_rows(spark, sf_dir):
    return profile.count_rows(table(spark, sf_dir, "lineitem"))


@query(
    "count_distinct",
    WITH + 'SELECT count(DISTINCT "userId") + max(CASE WHEN "userId" IS NULL THEN 1 ELSE 0 END) AS n_distinct FROM ev',
)
def count_distinct(spark, sf_dir):
    return profile.count_distinct(staged_log(spark, sf_dir), "userId")


@query("limit_sample", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def limit_sample(spark, sf_dir):
    return profile.sample_rows(table(spark, sf_dir, "orders"), 5, ["o_orderkey"])


@query("head_rows", "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 1")
def head_rows(spark, sf_dir):
    return profile.sample_rows(table(spark, sf_dir, "part").select("p_partkey", "p_name"), 1, ["p_name", "p_partkey"])
