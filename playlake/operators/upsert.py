"""Upserts as aggregates.

An upsert keeps, per key, some columns from the first row that arrived and others from the last. Both are a minimum or
maximum over ``struct(order, columns)``. Minima and maxima of parts combine into those of the whole, so

* a hot key is reduced to one row per task before the shuffle,
* a batch gives a small *state*, and folding old and new states gives the same answer as one run over all rows, also
  when a late file arrives.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from playlake.operators.joins import no_nulls
from playlake.sources.files import union_sources


@dataclass(frozen=True)
class UpsertRule:
    """``first`` columns keep the first value per key, ``last`` columns take the newest."""

    keys: tuple[str, ...]
    first: tuple[str, ...] = ()
    last: tuple[str, ...] = ()
    order: tuple[str, ...] = ()


# What each table does when a key is there already, and the order rows arrive in.
USERS_RULE = UpsertRule(
    keys=("user_id",),
    first=("first_name", "last_name", "gender"),
    last=("level",),
    order=("ts", "session_id", "item_in_session"),
)
ARTISTS_RULE = UpsertRule(
    keys=("artist_id",), first=("name",), last=("location", "latitude", "longitude"), order=("song_id",)
)
SONGS_RULE = UpsertRule(keys=("song_id",), first=("title", "artist_id", "year", "duration"), order=())
TIME_RULE = UpsertRule(keys=("start_time",), first=("hour", "day", "week", "month", "year", "weekday"))


def overwrite_rule(keys: list[str], others: list[str], order: list[str]) -> UpsertRule:
    """A keyed store without conflict rules: the last write wins on all columns."""
    return UpsertRule(keys=tuple(keys), last=tuple(others), order=tuple(order))


def to_state(rows: DataFrame, rule: UpsertRule, null_keys: str = "error") -> DataFrame:
    """Rows as one state row per key: ``_first`` and ``_last`` with the order values they were taken at.

    A null key fails the job, as a primary key would; ``null_keys='drop'`` leaves such rows out.
    """
    if null_keys == "drop":
        rows = no_nulls(rows, rule.keys)
        keys = [F.col(k) for k in rule.keys]
    else:
        keys = [
            F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null in key column {k}"))).otherwise(F.col(k)).alias(k)
            for k in rule.keys
        ]
    order = [F.col(c).alias(f"_order{i}") for i, c in enumerate(rule.order)]
    sides = [F.struct(*order, *columns).alias(side) for side, columns in _sides(rule) if columns]
    return fold(rows.select(*keys, *sides), rule)


def fold(state: DataFrame, rule: UpsertRule) -> DataFrame:
    """One state row per key, out of any number of them. Equal order values: the smallest first, the greatest last."""
    pick = {"_first": F.min, "_last": F.max}
    sides = [pick[side](side).alias(side) for side, columns in _sides(rule) if columns]
    if not sides:
        return state.select(*rule.keys).distinct()
    return state.groupBy(*rule.keys).agg(*sides)


def from_state(state: DataFrame, rule: UpsertRule) -> DataFrame:
    """The table a state stands for."""
    return state.select(
        *rule.keys, *[F.col(f"{side}.{c}").alias(c) for side, columns in _sides(rule) for c in columns]
    )


def upsert(rows: DataFrame, rule: UpsertRule, null_keys: str = "error") -> DataFrame:
    """The table after upserting all ``rows`` in their order."""
    return from_state(to_state(rows, rule, null_keys), rule)


def upsert_into(state: DataFrame, rows: DataFrame, rule: UpsertRule, null_keys: str = "error") -> DataFrame:
    """The state after upserting a further batch of rows."""
    return fold(union_sources(state, to_state(rows, rule, null_keys)), rule)


def insert_absent(existing: DataFrame, rows: DataFrame, rule: UpsertRule, null_keys: str = "error") -> DataFrame:
    """The rows to append to ``existing``: one per key that is not there yet, the first in order."""
    return upsert(rows, rule, null_keys).join(existing.select(*rule.keys), list(rule.keys), "left_anti")


def _sides(rule: UpsertRule):
    return (("_first", rule.first), ("_last", rule.last))
