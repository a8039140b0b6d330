"""Equi-joins that stay balanced when one key holds much of the rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StringType


def no_nulls(df: DataFrame, columns) -> DataFrame:
    """Rows without a null in ``columns``. Unlike ``dropna`` it keeps NaN, which is a value."""
    return reduce(lambda rows, c: rows.filter(F.col(c).isNotNull()), columns, df)


def _compared_as(left: DataFrame, a: str, right: DataFrame, b: str) -> DataType | None:
    """The type in which ``=`` compares two columns; none where text meets another type, whose rules depend on the session."""
    types = [left.select(left[a]).schema[0].dataType, right.select(right[b]).schema[0].dataType]
    if types[0] == types[1]:
        return types[0]
    if any(isinstance(t, StringType) for t in types):
        return None
    either = F.coalesce(*[F.lit(None).cast(t) for t in types])
    return left.sparkSession.range(0).select(either).schema[0].dataType


def skew_join(left: DataFrame, right: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    """Join ``left`` and ``right`` where each left column of ``on`` equals its right column.

    Adaptive execution splits a hot key over several tasks only where a join reads its shuffles directly. A side that
    was just grouped by the join keys would be joined in the partitions of that grouping, hot key and all. A hash of the
    keys as a further, redundant join key makes Spark shuffle both sides for the join itself. A grouped side is small
    next to the other, and if Spark finds it below the broadcast threshold at run time, nothing changes.

    Equal values of different types have different hashes, so both sides are hashed in the type they are compared in. Keys for
    which there is no such type are left out of the hash.
    """
    condition = [left[a] == right[b] for a, b in on.items()]
    types = {(a, b): _compared_as(left, a, right, b) for a, b in on.items()}
    hashed = [(left[a].cast(t), right[b].cast(t)) for (a, b), t in types.items() if t is not None]
    if hashed:
        condition.insert(0, _hash([x for x, _ in hashed]) == _hash([y for _, y in hashed]))
    return left.join(right, condition, how)


def _hash(columns: list[Column]) -> Column:
    return F.xxhash64(*columns)
