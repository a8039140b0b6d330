"""Counts, column profiles and samples."""

import contextlib
import io

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from playlake.storage import materialize

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def count_distinct(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values; null counts as one."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))


def profile_columns(df: DataFrame) -> DataFrame:
    """Type and non-null count of each column, in column order, from one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(dtype).alias("column_type"),
            F.col(f"c{i}").alias("n_non_null"),
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def profile_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, exact quartiles and maximum of each column.

    Quartiles between two values are interpolated.
    """
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    values = _value_counts(df, columns)
    moments = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(f"m{i}")
            for i, c in enumerate(columns)
        ]
    ).select(F.inline(F.array(*[F.col(f"m{i}") for i in range(len(columns))])))
    quartiles = exact_quantiles(values, QUARTILES)
    return moments.join(F.broadcast(quartiles), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *QUARTILES, "max"
    )


def _value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n): copies of a value are counted before any shuffle."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(values: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Quantiles per ``column_name`` from (column_name, value, n), one column per quantile.

    ``percentile`` would gather all distinct values of a column in one task. Here the values are range-partitioned, the
    partition totals tell which partitions hold the wanted ranks, and only those are numbered.
    """
    ranged = values.repartitionByRange("column_name", "value").withColumn("_part", F.spark_partition_id())
    stored = materialize(ranged, "quantiles")

    # One row per range partition and column: bounded by the number of partitions.
    sizes = stored.groupBy("column_name", "_part").agg(F.sum("n").alias("size"))
    before = Window.partitionBy("column_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column_name")
    sizes = sizes.select(
        "column_name",
        "_part",
        "size",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("skipped"),
        F.sum("size").over(whole).alias("total"),
    )
    wanted = [
        F.struct(F.lit(name).alias("name"), ((F.col("total") - 1) * q).alias("rank")) for name, q in quantiles.items()
    ]
    ranks = sizes.select("*", F.inline(F.array(*wanted))).select(
        "column_name",
        "_part",
        "size",
        "skipped",
        "name",
        "rank",
        F.explode(F.array_distinct(F.array(F.floor("rank"), F.ceil("rank")))).alias("position"),
    )
    ranks = ranks.filter(
        (F.col("position") >= F.col("skipped")) & (F.col("position") < F.col("skipped") + F.col("size"))
    )

    # Running counts within the few partitions that hold a wanted position.
    running = Window.partitionBy("column_name", "_part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    hit_parts = ranks.select("column_name", "_part", "skipped").distinct()
    numbered = stored.join(F.broadcast(hit_parts), ["column_name", "_part"]).select(
        "column_name", "_part", "value", "n", (F.col("skipped") + F.sum("n").over(running)).alias("upto")
    )
    spots = ranks.select("column_name", "_part", "name", "rank", "position")
    found = numbered.join(F.broadcast(spots), ["column_name", "_part"]).filter(
        (F.col("position") < F.col("upto")) & (F.col("position") >= F.col("upto") - F.col("n"))
    )
    ends = found.groupBy("column_name", "name", "rank").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    at = F.col("low") + (F.col("high") - F.col("low")) * (F.col("rank") - F.floor("rank"))
    return (
        ends.select("column_name", "name", at.alias("quantile"))
        .groupBy("column_name")
        .pivot("name", list(quantiles))
        .agg(F.first("quantile"))
    )


def sample_rows(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """``n`` rows: any, or with ``order_by`` the first in that order (a top-n per task, then of those)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The first row per key. A minimum, so a hot key is reduced before the shuffle, unlike ``row_number``."""
    others = [c for c in df.columns if c not in keys]
    order = [F.col(c).alias(f"_order{i}") for i, c in enumerate(order_by)]
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *others)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns])


def lookup(df: DataFrame, **values) -> DataFrame:
    """Rows equal to the given values in all the given columns, which are passed as query parameters."""
    where = " AND ".join(f"`{name}` = :{name}" for name in values)
    return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE {where}", args=values, df=df)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``explain`` prints, as text."""
    with io.StringIO() as text, contextlib.redirect_stdout(text):
        df.explain(mode=mode)
        return text.getvalue()
