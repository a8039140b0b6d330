"""Sinks, tables, checks, statements."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, IntegerType, StructType, VarcharType

from playlake import sinks, sources
from playlake.operators import profile, quality, statements
from playlake.plans.star import violations
from playlake.schemas import STAR
from playlake.storage import fresh_path
from tests.rows import tuples


@pytest.fixture
def database(spark, out):
    sinks.create_database(spark, "checks", out + "/db", replace=True)
    yield "checks"
    spark.sql("DROP DATABASE checks CASCADE")


def test_tables(spark, database):
    name = f"{database}.t"
    schema = StructType().add("a", IntegerType()).add("b", VarcharType(3)).add("c", CharType(1))
    sinks.create_tables(spark, database, {"t": schema})
    sinks.create_tables(spark, database, {"t": schema})
    rows = spark.createDataFrame([(1, "abc", "F")], "a int, b string, c string")
    sinks.insert_select(rows, name)
    sinks.append_rows(rows.select("b", F.lit(2).alias("a")), name)
    sinks.insert_select(rows.select("c", "a"), name, ["c", "a"])
    assert tuples(sources.read_table(spark, name)) == [(1, "abc", "F"), (1, None, "F"), (2, "abc", None)]
    assert sources.read_table(spark, name, ["b"]).columns == ["b"]
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        sinks.insert_select(rows.withColumn("b", F.lit("long")), name)
    with pytest.raises(ValueError):
        sinks.insert_select(rows, name, ["a", "b", "z"])
    sinks.drop_tables(spark, [name, f"{database}.never"])
    assert not spark.catalog.tableExists(name)


def test_quoted_csv(spark, out):
    rows = spark.createDataFrame([('a "b", c', 1), (None, 2)], "x string, y int")
    sinks.write_csv_quoted(rows, out + "/csv", single_file=True)
    lines = [r[0] for r in spark.read.text(out + "/csv").collect()]
    assert lines == ['"x","y"', '"a ""b"", c","1"', '"","2"']
    assert tuples(sinks.count_lines(spark, out + "/csv")) == [(3,)]


def test_dynamic_overwrite_keeps_other_partitions(spark, out):
    df = spark.createDataFrame([(1, 1), (2, 2)], "p int, v int")
    sinks.write_parquet(df, out + "/t", ("p",))
    sinks.write_parquet(df.filter("p = 1").withColumn("v", F.lit(9)), out + "/t", ("p",), only_touched=True)
    assert tuples(spark.read.parquet(out + "/t"), "p", "v") == [(1, 9), (2, 2)]


def test_arrange_sorts_within_ranges(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    parts = sinks.arrange(df, ["k"], partitions=4).select("k", F.spark_partition_id().alias("p")).collect()
    assert [r["k"] for r in parts] == sorted(r["k"] for r in parts)


def test_row_rules(spark):
    rows = spark.createDataFrame(
        [(1, "ok", 10.0, 1), (2, None, 1234.5, -1), (3, "toolong", None, None)], "i int, s string, d double, n int"
    )
    rules = quality.Rules(required=("s",), non_negative=("n",), max_length={"s": 3}, decimals={"d": (9, 6)})
    assert tuples(quality.broken_rows(rows, rules), "i", "broken") == [
        (2, ["s is null", "n < 0", "d over decimal(9,6)"]),
        (3, ["s longer than 3"]),
    ]
    assert tuples(quality.rule_counts(rows, rules)) == [
        ("d over decimal(9,6)", 1), ("n < 0", 1), ("s is null", 1), ("s longer than 3", 1),
    ]


def test_keys_and_references(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (3, 3)], "a int, b int")
    assert tuples(quality.duplicate_keys(rows, ["a"])) == [(1, 2), (None, 1)]
    parents = spark.createDataFrame([(1,)], "k int")
    assert tuples(quality.orphan_rows(rows, "a", parents, "k")) == [(3, 3)]
    assert tuples(quality.orphan_keys(rows, "b", parents, "k")) == [(2, 1), (3, 1)]


def test_violations_name_the_broken_constraint(spark):
    empty = {t: spark.createDataFrame([], schema) for t, schema in STAR.items()}
    song = spark.createDataFrame([("S1", "T", "A9", -1, 1.0)], STAR["songs"])
    assert tuples(violations(empty | {"songs": song})) == [
        ("songs", "artist_id not in artists", 1), ("songs", "year < 0", 1),
    ]
    artist = spark.createDataFrame([("A9", "Ann", None, None, None)], STAR["artists"])
    assert violations(empty | {"artists": artist}).count() == 0


def test_delete_statements(spark, out):
    rows = spark.createDataFrame([(1, "it's"), (2, "b")], "id bigint, type string")
    keys = {"id": "id", "type": '"type"'}
    assert tuples(statements.delete_statements(rows, "k.t", keys)) == [
        ("DELETE FROM k.t WHERE id=1 AND \"type\"='it''s';",), ("DELETE FROM k.t WHERE id=2 AND \"type\"='b';",),
    ]
    raw = statements.delete_statements(rows, "k.t", keys, escape=False)
    assert "='it's';" in raw.first()[0]
    statements.write_delete_script(rows, "k.t", keys, out + "/script")
    statements.write_delete_script(rows, "k.t", keys, out + "/script")
    assert spark.read.text(out + "/script").count() == 4
    with pytest.raises(Exception, match="null in a key"):
        nothing = spark.createDataFrame([(1, None)], "id bigint, type string")
        statements.write_delete_script(nothing, "k.t", keys, out + "/bad")


def test_delete_by_keys(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "a", 3)], "id int, type string, v int")
    gone = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a")], "id int, type string")
    assert tuples(statements.delete_by_keys(rows, gone, ["id", "type"]), "v") == [(2,), (3,)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b")], "x int, y string")
    assert tuples(profile.profile_columns(df)) == [(0, "x", "int", 2), (1, "y", "string", 2)]
    assert tuples(profile.count_distinct(df, "y")) == [(3,)]
    assert tuples(profile.count_rows(df)) == [(3,)]
    assert tuples(profile.sample_rows(df, 1, ["y"])) == [(1, None)]
    assert tuples(profile.first_per_key(df, ["x"], ["y"])) == [(1, None), (None, "b")]
    assert tuples(profile.lookup(df, x=1, y="a")) == [(1, "a")]


def test_scratch_is_in_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = fresh_path(spark, "x")
    assert root is None or path.startswith(root)
    assert path != fresh_path(spark, "x")
