"""Constraint checks. Parquet tables enforce none, so violations are found by query, before the write.

Nulls pass a range, length or foreign-key check, as they do in SQL.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from playlake.operators.joins import skew_join
from playlake.schemas import WAREHOUSE_LENGTHS


@dataclass(frozen=True)
class Rules:
    """Row rules of a table: required columns, columns >= 0, longest texts, (precision, scale) of decimals."""

    required: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)

    def broken(self) -> dict[str, Column]:
        """Rule name to the condition under which a row breaks it."""
        tests = {f"{c} is null": F.col(c).isNull() for c in self.required}
        tests |= {f"{c} < 0": F.col(c) < 0 for c in self.non_negative}
        tests |= {f"{c} longer than {n}": F.length(c) > n for c, n in self.max_length.items()}
        tests |= {
            f"{c} over decimal({p},{s})": F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
            for c, (p, s) in self.decimals.items()
        }
        return tests


# The declared constraints of the star schema.
STAR_KEYS = {
    "users": ("user_id",), "artists": ("artist_id",), "songs": ("song_id",), "time": ("start_time",),
    "songplays": ("songplay_id",),
}
STAR_RULES = {
    "users": Rules(required=("user_id", "level"), max_length={"gender": 1}),
    "artists": Rules(required=("artist_id",), decimals={"latitude": (9, 6), "longitude": (9, 6)}),
    "songs": Rules(required=("song_id",), non_negative=("year",)),
    "time": Rules(
        required=("start_time", "hour", "day", "week", "month", "year", "weekday"),
        non_negative=("hour", "day", "week", "month", "year"),
    ),
    "songplays": Rules(required=("songplay_id", "level", "session_id")),
}
WAREHOUSE_RULES = {table: Rules(max_length=lengths) for table, lengths in WAREHOUSE_LENGTHS.items()}
STAR_REFERENCES = (
    ("songs", "artist_id", "artists", "artist_id"),
    ("songplays", "start_time", "time", "start_time"),
    ("songplays", "user_id", "users", "user_id"),
    ("songplays", "song_id", "songs", "song_id"),
    ("songplays", "artist_id", "artists", "artist_id"),
)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break a primary key, with their row count: more than one row, or a null in the key."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter((F.col("n_rows") > 1) | null)


def broken_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a rule, with the names of the rules, found in one scan without a shuffle."""
    names = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.broken().items()]))
    return df.select("*", names.alias("broken")).filter(F.size("broken") > 0)


def rule_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Rule name and number of rows that break it, for all rules in one pass."""
    tests = list(rules.broken().items())
    counts = df.agg(*[F.count_if(test).alias(f"r{i}") for i, (_, test) in enumerate(tests)])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n_rows")) for i, (name, _) in enumerate(tests)]
    return counts.select(F.inline(F.array(*pairs)))


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference has no parent row; null references pass."""
    side = parent.select(F.col(key).alias("_key"))
    return skew_join(child.filter(F.col(column).isNotNull()), side, {column: "_key"}, "left_anti")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Missing parent keys with the number of child rows: only distinct keys are shuffled, not the rows."""
    used = child.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return orphan_rows(used, column, parent, key)
