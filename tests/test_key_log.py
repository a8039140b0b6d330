"""Key checks of loads, against counting all rows."""

import random
from collections import Counter

import pytest

from playlake.operators.key_log import KeyLog
from tests.rows import tuples


def broken_by_counting(loads, at):
    before, new = Counter(r for rows in loads[:at] for r in rows), Counter(loads[at])
    return sorted(
        ((*k, n, 0 if None in k else before[k]) for k, n in new.items() if None in k or n + before[k] > 1), key=repr
    )


@pytest.mark.parametrize("expected", [4, 100_000])  # few places: nearly every key shares its bit
@pytest.mark.parametrize("types", ["k long", "k int, t string"])
def test_broken_keys_of_each_load(spark, out, types, expected):
    rng = random.Random(3)
    width = types.count(",") + 1
    pick = [lambda: rng.choice([None, *range(-40, 400, 3)] * 3 + [-2**31, 2**31 - 1]), lambda: rng.choice(["a", "b", "", None])]
    loads = [[tuple(p() for p in pick[:width]) for _ in range(n)] for n in (150, 0, 90)]
    frames = [spark.createDataFrame(rows, types) for rows in loads]
    log = KeyLog(spark, out + "/log", frames[0].schema, frames[0].columns, expected)
    for at, frame in enumerate(frames):
        assert tuples(log.take(frame, at)) == broken_by_counting(loads, at)
    assert tuples(log.take(frames[2], 2)) == broken_by_counting(loads, 2)  # run again


def test_loads_without_common_keys_read_no_earlier_keys(spark, out):
    log = KeyLog(spark, out + "/log", spark.range(1).schema, ["id"])
    assert log.take(spark.range(0, 70000), 1).count() == 0
    clean = log.take(spark.range(70000, 90000), 2)
    assert clean.count() == 0
    assert "Join" not in clean._jdf.queryExecution().toString()
    assert tuples(log.take(spark.range(89999, 90001), 3)) == [(89999, 1, 1)]


def test_missing_references(spark, out):
    log = KeyLog(spark, out + "/log", spark.range(1).schema, ["id"])
    child = spark.createDataFrame([(5,), (5,), (32768,), (32769,), (-1,), (0,), (None,)], "c int")
    assert tuples(log.missing(child, "c")) == [(-1, 1), (0, 1), (32768, 1), (32769, 1), (5, 2)]
    log.take(spark.range(-1, 6), 1)
    log.take(spark.range(32769, 32770), 2)
    assert tuples(log.missing(child, "c")) == [(32768, 1)]
    with pytest.raises(ValueError, match="whole number"):
        log.missing(spark.createDataFrame([("5",)], "c string"), "c")
    pairs = KeyLog(spark, out + "/pairs", child.selectExpr("c", "c as d").schema, ["c", "d"])
    with pytest.raises(ValueError, match="orphan_keys"):
        pairs.missing(child, "c")
