"""What must hold on a large cluster: hot keys, partition-wise ids, plans."""

import pytest
from pyspark.sql import functions as F

from playlake import sinks
from playlake.operators import facts, ids, joins, profile, quality, upsert as up
from playlake.operators.profile import plan_text
from playlake.workload.analogues import PAGE, staged_events, staged_songs
from playlake.operators import dims
from tests.conftest import SMALL
from tests.rows import tuples


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot(spark, out):
    """A third of the rows share one key and one time."""
    rows = spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 97).alias("t"),
        F.repeat(F.lit("x"), 50).alias("pad"),
    )
    rows.write.parquet(out + "/hot")
    return spark.read.parquet(out + "/hot")


def split_joins(settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__minPartitionSize="1KB",
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_hot_key_is_split_even_against_a_grouped_side(spark, settings, hot, how):
    split_joins(settings)
    grouped = hot.filter("k % 2 = 0").groupBy("k").agg(F.count("*").alias("n")).withColumnRenamed("k", "k2")
    joined = joins.skew_join(hot, grouped, {"k": "k2"}, how)
    n_rows = len(joined.collect())
    assert "skew=true" in plan_text(joined, "simple")
    hits = hot.filter("k % 2 = 0").count()
    assert n_rows == {"inner": hits, "left_semi": hits, "left": 60000, "left_anti": 60000 - hits}[how]


def test_lookup_of_a_hot_song_is_split(spark, settings, hot):
    split_joins(settings)
    plays = hot.select(
        F.concat(F.lit("T"), "k").alias("song"), F.lit("Ann").alias("artist"), F.lit(1.5).alias("length"), "t", "pad"
    )
    songs = spark.range(0, 60000).select(
        F.concat(F.lit("S"), "id").alias("song_id"), F.lit("A").alias("artist_id"),
        F.concat(F.lit("T"), "id").alias("title"), F.lit("Ann").alias("artist_name"), F.lit(1.5).alias("duration"),
    )
    found = facts.match_songs(plays, songs, "exact", "left", first_only=True)
    assert len(found.collect()) == 60000
    assert "skew=true" in plan_text(found, "simple")


@pytest.mark.parametrize("unique", [False, True])
def test_serial_ids_are_contiguous_and_spread(spark, hot, unique):
    rows = hot.withColumn("u", F.monotonically_increasing_id()) if unique else hot
    order = ["t", "u"] if unique else ["t"]
    numbered = ids.serial_ids(rows, order, "i", unique=unique)
    got = numbered.select("i", "t").orderBy("i").collect()
    assert [r["i"] for r in got] == list(range(1, 60001))
    assert [r["t"] for r in got] == sorted(r["t"] for r in got)


def test_arrival_ids_follow_the_files_however_they_are_split(spark, settings, out):
    spark.range(0, 50000, numPartitions=5).write.parquet(out + "/t")
    found = []
    for size in ("10KB", "128MB"):
        settings(files__maxPartitionBytes=size)
        numbered = ids.arrival_ids(spark.read.parquet(out + "/t"), "i", start=11)
        found.append(tuples(numbered))
        assert "Exchange hashpartitioning(_file" not in plan_text(numbered, "simple").split("Window")[0]
    assert found[0] == found[1]
    assert sorted(found[0]) == [(i + 11, i) for i in range(50000)]


def test_a_hot_value_spans_partitions(spark, settings, hot):
    settings(adaptive__coalescePartitions__enabled="false")
    arranged = sinks.arrange(hot, ["t"], partitions=8)
    sizes = arranged.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 60000 / 3
    ranges = arranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    bounds = [(r["lo"], r["hi"]) for r in ranges.orderBy("p").collect()]
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
    assert tuples(arranged.groupBy("t").count()) == tuples(hot.groupBy("t").count())


def test_partition_value_holding_much_is_split_on_write(spark, settings, hot, out):
    settings(adaptive__advisoryPartitionSizeInBytes="50KB")
    # Rows that do not compress, all of one partition value.
    rows = hot.select(F.lit(1).alias("p"), F.sha2(F.concat("k", "t", F.rand(1).cast("string")), 256).alias("h"))
    sinks.write_parquet(rows, out + "/parts", ("p",))
    files = spark.read.parquet(out + "/parts").select("_metadata.file_path").distinct().count()
    assert files > 1


def test_upsert_merges_before_the_shuffle(spark, hot):
    text = plan_text(up.upsert(hot, up.overwrite_rule(["k"], ["pad"], ["t"])), "simple")
    assert text.index("partial_max") > text.index("Exchange")  # below it in the printed tree


def test_filters_and_columns_reach_the_scan(spark):
    users = dims.distinct_users(staged_events(spark, SMALL), PAGE)
    text = plan_text(users)
    assert "EqualTo(event_type,purchase)" in text
    scan = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "ts" not in scan.split("<")[1].replace("event_type", "")
    # Nothing of the songs is needed, and the left join to them is still there only for repeated keys.
    assert "p_name" not in text


def test_no_window_over_all_rows_in_one_task(spark, hot):
    text = plan_text(ids.serial_ids(hot, ["t"], "i"), "simple")
    window = text[text.index("Window") :]
    assert "HashAggregate(keys=[_part" in window  # only over one row per partition
    assert "pad" not in window


def test_small_songs_are_broadcast_by_size_not_by_hint(spark):
    matched = facts.match_songs(dims.plays(staged_events(spark, SMALL), PAGE), staged_songs(spark, SMALL), "title")
    assert "ResolvedHint" not in plan_text(matched, "extended")


def test_exact_quantiles_of_skewed_values(spark, hot):
    got = profile.profile_numeric(hot, ["t"]).collect()[0]
    values = sorted(r["t"] for r in hot.select("t").collect())

    def at(q):
        rank = (len(values) - 1) * q
        low = values[int(rank)]
        return low + (values[min(int(rank) + 1, len(values) - 1)] - low) * (rank - int(rank))

    assert [got["q25"], got["q50"], got["q75"]] == [at(0.25), at(0.5), at(0.75)]
    assert (got["min"], got["max"], got["count"]) == (values[0], values[-1], len(values))


def test_quantiles_with_nulls_and_few_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (4, None)], "a int, b double")
    got = {r["column_name"]: r for r in profile.profile_numeric(df).collect()}
    assert (got["a"]["q25"], got["a"]["q50"], got["a"]["q75"]) == (1.5, 2.0, 3.0)
    assert (got["b"]["count"], got["b"]["q25"], got["b"]["std"]) == (1, 5.0, None)
    none = profile.profile_numeric(spark.createDataFrame([(None,)], "a double")).collect()[0]
    assert (none["count"], none["q50"], none["max"]) == (0, None, None)


def test_orphan_keys_are_counted_before_the_shuffle(spark, hot):
    parents = spark.range(1, 60000).withColumnRenamed("id", "k")
    lost = quality.orphan_keys(hot, "k", parents, "k")
    assert tuples(lost) == [(0, 20000)]
    assert "partial_count" in plan_text(lost, "simple")
