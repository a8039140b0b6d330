"""Upserts: arrival order, late files, repeats, ties and null keys."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from playlake.operators import upsert as up
from tests.rows import tuples

RULE = up.UpsertRule(keys=("k",), first=("a",), last=("b",), order=("t", "u"))
SCHEMA = "k int, a string, b string, t int, u int"


def brute_force(rows):
    """Row by row: insert, or on conflict update ``b`` only."""
    table = {}
    for k, a, b, t, u in sorted(rows, key=lambda r: (r[3], r[4])):
        table[k] = (table[k][0], b) if k in table else (a, b)
    return sorted(((k, a, b) for k, (a, b) in table.items()), key=repr)


ROWS = st.lists(
    st.tuples(
        st.integers(0, 3), st.sampled_from(["x", "y", None]), st.sampled_from(["p", "q", None]), st.integers(0, 4)
    ),
    min_size=1,
    max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_upsert_equals_row_by_row(spark, rows):
    rows = [(*r, u) for u, r in enumerate(rows)]
    shuffled = random.Random(1).sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, SCHEMA)
    assert tuples(up.upsert(df, RULE)) == brute_force(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, st.integers(0, 25))
def test_batches_in_any_order_equal_one_run(spark, rows, cut):
    rows = [(*r, u) for u, r in enumerate(rows)]
    late, early = rows[:cut], rows[cut:]
    state = up.to_state(spark.createDataFrame(early, SCHEMA), RULE)
    state = up.upsert_into(state, spark.createDataFrame(late, SCHEMA), RULE)
    again = up.upsert_into(state, spark.createDataFrame(late, SCHEMA), RULE)
    assert tuples(up.from_state(state, RULE)) == tuples(up.from_state(again, RULE)) == brute_force(rows)


def test_order_columns_may_be_kept_too(spark):
    rule = up.overwrite_rule(["k"], ["a", "t"], ["t"])
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, None, 5)], "k int, a string, t int")
    assert tuples(up.upsert(df, rule)) == [(1, "y", 2), (2, None, 5)]


def test_insert_absent(spark):
    rule = up.UpsertRule(keys=("k",), first=("a",), order=("t",))
    existing = spark.createDataFrame([(1, "old")], "k int, a string")
    rows = spark.createDataFrame([(1, "new", 0), (2, "late", 9), (2, "early", 3)], "k int, a string, t int")
    assert tuples(up.insert_absent(existing, rows, rule)) == [(2, "early")]


def test_null_key(spark):
    df = spark.createDataFrame([(None, "x", "p", 0, 0), (1, "x", "p", 0, 0)], SCHEMA)
    with pytest.raises(Exception, match="null in key column k"):
        up.upsert(df, RULE).collect()
    assert tuples(up.upsert(df, RULE, null_keys="drop")) == [(1, "x", "p")]


def test_keys_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert tuples(up.upsert(df, up.UpsertRule(keys=("k",)))) == [(1,), (2,)]
