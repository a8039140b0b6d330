"""Deletes that write anew only the files that hold a key."""

import pytest
from pyspark.sql import functions as F

from playlake.operators import ids
from playlake.operators.profile import plan_text
from playlake.sinks import FileTable
from tests.rows import tuples


@pytest.fixture
def table(spark, out):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(0, 8000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("t"), F.lit("v").alias("v"))
    yield FileTable.create(rows, out + "/t", ["k"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def names(table):
    return {r["file"] for r in table.files().collect()}


def test_untouched_files_keep_their_names(spark, table):
    before = names(table)
    assert len(before) == 8
    gone = spark.createDataFrame([(1, 1), (2, 2), (2, 2), (3, 1), (None, 0), (9000, 0)], "k long, t long")
    assert table.delete(gone, ["k", "t"]) == 2  # 3 has another t
    after = names(table)
    assert len(before - after) == 1
    assert sorted(r["k"] for r in table.rows().collect()) == [0] + list(range(3, 8000))
    assert table.rows(version=1).count() == 8000
    assert table.files().agg(F.sum("n_rows")).first()[0] == 7998


def test_bounds_leave_out_files_no_key_falls_into(spark, table):
    wanted = spark.createDataFrame([(5,), (7990,)], "_0 long")
    assert table._near(wanted, ["k"]).count() == 2
    assert table._near(wanted.filter("false"), ["k"]).count() == 0
    assert table._near(wanted, ["t"]).count() == 8  # no bounds of this column are kept
    assert table._near(wanted.select(F.col("_0").cast("string")), ["k"]).count() == 8  # text has another order


def test_nothing_to_delete_makes_no_version(spark, table):
    assert table.delete(spark.createDataFrame([(-1,), (None,)], "k long"), ["k"]) == 0
    assert table.version() == 1


def test_keys_of_other_types(spark, table):
    assert table.delete(spark.createDataFrame([(5.0,), (6.5,)], "k double"), ["k"]) == 1
    assert table.delete(spark.createDataFrame([("7",)], "k string"), ["k"]) == 1
    assert table.delete(spark.createDataFrame([(8,), (5,)], "k int"), ["k"]) == 1
    assert table.rows().count() == 7997 and table.version() == 4


def test_all_rows_gone(spark, table):
    assert table.delete(table.rows().select("k"), ["k"]) == 8000
    assert table.rows().count() == 0 and table.rows().columns == ["k", "t", "v"]
    assert table.delete(spark.range(9).select(F.col("id").alias("k")), ["k"]) == 0


def test_a_failed_attempt_is_never_read(spark, table):
    table._write(table.rows().limit(10), "k")  # written, but not committed
    assert table.rows().count() == 8000


def test_nulls_copies_and_an_empty_table(spark, out):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, None)], "a long, c string")
    table = FileTable.create(rows, out + "/n", ["a"])
    assert table.delete(rows, ["a", "c"]) == 2
    assert tuples(table.rows()) == [(2, None), (None, "a")]
    empty = FileTable.create(rows.limit(0), out + "/e", ["a"])
    assert empty.delete(rows, ["a"]) == 0 and empty.rows().count() == 0


def test_sums_before_have_no_window_over_all_rows(spark):
    rows = spark.range(0, 5000, numPartitions=7).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id")
    summed = ids.sums_before(rows, "k", "id", "s")
    total, expected = 0, {}
    for row in sorted(rows.collect()):
        expected[row["k"]] = total
        total += row["id"]
    assert {r["k"]: r["s"] for r in summed.collect()} == expected
    assert "Exchange SinglePartition" not in plan_text(summed, "simple")
    assert ids.sums_before(rows.limit(0), "k", "id", "s").collect() == []
