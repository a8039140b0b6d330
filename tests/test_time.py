import datetime

import pytest
from pyspark.sql import functions as F

from playlake.functions.timeparts import WEEKDAYS, epoch_millis, start_time, weekday
from playlake.operators import dims
from tests.rows import events, tuples

ROWS = (dict(ts=1541105830796), dict(ts=1541105830100), dict(ts=1546214400000, page="Home"))


def test_precision_and_page(spark):
    rows = events(spark, *ROWS)
    assert dims.time_dimension(rows).count() == 1
    assert dims.time_dimension(rows, precision="milli").count() == 2
    assert dims.time_dimension(rows, page=None).count() == 2
    assert dims.time_dimension(rows, keep_ts=True).count() == 2


def test_parts(spark):
    rows = events(spark, dict(ts=1546214400000))  # Monday 2018-12-31, in ISO week 1 of 2019
    when = datetime.datetime(2018, 12, 31)
    assert tuples(dims.time_dimension(rows)) == [(when, 0, 31, 1, 12, 2018, 2)]
    assert tuples(dims.time_dimension(rows, weekday="name"), "weekday") == [("Monday",)]
    assert tuples(dims.time_dimension(rows, weekday="padded"), "weekday") == [("Monday   ",)]
    with pytest.raises(ValueError):
        weekday(F.col("ts"), "roman")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_session_zone_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moments = spark.sql(
            "SELECT timestamp_ntz'2024-07-01 03:00:00.123456' AS t UNION ALL SELECT timestamp_ntz'2024-03-10 02:30:00'"
        ).select(epoch_millis(F.col("t")).alias("ms"))
        rows = moments.select("ms", start_time(F.col("ms"), "milli").cast("string").alias("t"))
        assert tuples(rows) == [
            (1710037800000, "2024-03-10 02:30:00"),
            (1719802800123, "2024-07-01 03:00:00.123"),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("style", ["number", "name", "padded"])
def test_no_time_has_no_weekday(spark, style):
    rows = events(spark, dict(ts=None))
    assert tuples(dims.time_dimension(rows, weekday=style)) == [(None,) * 7]


def test_weekday_names_follow_numbers(spark):
    days = spark.sql("SELECT explode(sequence(date'2023-01-01', date'2023-01-07')) AS d")
    named = days.orderBy("d").select(weekday(F.col("d"), "name").alias("w"), weekday(F.col("d")).alias("n"))
    assert [tuple(r) for r in named.collect()] == [(w, i + 1) for i, w in enumerate(WEEKDAYS)]
