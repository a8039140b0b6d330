"""Joins over keys of different types, casts of text, and loads that stop at unfit values."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from playlake.functions.casts import lenient
from playlake.operators import ids, quality, statements
from playlake.operators.joins import skew_join
from playlake.plans.star import build_star
from playlake.sources import copy_by_name, copy_by_paths
from tests.rows import song
from tests.test_streaming import log

PAIRS = [("int", "bigint"), ("decimal(10,2)", "decimal(20,4)"), ("float", "double"), ("int", "decimal(12,1)"), ("bigint", "double"), ("string", "bigint"), ("date", "timestamp_ntz")]


@pytest.mark.parametrize("types", PAIRS)
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_compares_as_equality_does(spark, types, how):
    base = spark.range(1, 7)
    value = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")) if types[0] == "date" else F.col("id")
    left = base.select(value.cast(types[0]).alias("a"), F.lit(1).alias("x"))
    right = base.filter("id > 3").select(value.cast(types[1]).alias("b"))
    want = left.join(right, left["a"] == right["b"], how)
    got = skew_join(left, right, {"a": "b"}, how)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_checks_and_deletes_over_mixed_types(spark):
    child, parent = spark.range(5).select(F.col("id").cast("int").alias("k")), spark.range(4)
    assert [r["k"] for r in quality.orphan_rows(child, "k", parent, "id").collect()] == [4]
    left = statements.delete_by_keys(spark.range(5).withColumnRenamed("id", "k"), child.filter("k < 3"), ["k"])
    assert sorted(r["k"] for r in left.collect()) == [3, 4]


def test_whole_numbers_in_text(spark):
    cases = {"1970.0": 1970, "3.7": None, "-2.9": None, "9007199254740993.0": 9007199254740993, "1.54111E+12": 1541110000000, "7": 7, "": None, "x": None, "1e40": None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = df.select("t", lenient(F.col("t"), df.schema["t"].dataType, LongType()).alias("n")).collect()
    assert {r["t"]: r["n"] for r in got} == cases


def test_unfit_values_stop_a_strict_load(spark, out):
    with open(f"{out}/x.json", "w") as file:
        file.write('{"ts": "soon"}\n')
    schema = StructType().add("ts", LongType())
    assert copy_by_name(spark, f"{out}/x.json", schema).first()["ts"] is None
    for load in (
        lambda: copy_by_name(spark, f"{out}/x.json", schema, unfit="fail"),
        lambda: copy_by_paths(spark, f"{out}/x.json", ["$['ts']"], schema, unfit="fail"),
    ):
        with pytest.raises(Exception, match="does not fit column ts"):
            load().collect()


def test_tied_ids_do_not_depend_on_the_split(spark, out):
    spark.range(4000).select((F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("v")).repartition(8).write.parquet(out + "/t")
    seen = []
    for size in ("16k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = ids.serial_ids(spark.read.parquet(out + "/t"), ["k"], "n", from_scan=True)
        seen.append(sorted(map(tuple, rows.collect())))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] and [r[0] for r in seen[0]] == list(range(1, 4001))


def test_star_returns_damaged_rows(spark, out):
    for name, rows in (("songs", [song()]), ("logs", [log(), log(itemInSession="x"), "cut"])):
        os.makedirs(f"{out}/{name}")
        with open(f"{out}/{name}/a.json", "w") as file:
            file.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)
    star = build_star(spark, out + "/songs", out + "/logs", out + "/star")
    assert star["rejected_events"].count() == 2 and star["rejected_songs"].count() == 0
    assert star["songplays"].count() == 1
