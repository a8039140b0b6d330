"""Row ids."""

from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from playlake.storage import materialize, with_place

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row position below


def spread_ids(df: DataFrame, name: str = "songplay_id") -> DataFrame:
    """Unique ids with gaps; costs nothing.

    Give them last, right before the write. They follow the order rows reach a task in, which differs when a lost task
    is run again: a shuffle after them could mix rows of both runs.
    """
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def serial_ids(
    df: DataFrame,
    order_by: list[str],
    name: str = "songplay_id",
    start: int = 1,
    unique: bool = False,
    from_scan: bool = False,
) -> DataFrame:
    """Ids ``start, start + 1, ...`` without gaps, in the order of ``order_by``.

    The rows are range-partitioned by the order and numbered within each partition; the sizes of the partitions before
    give each partition its offset. No task sees more than one range, and only one row per partition is broadcast.

    Say ``unique`` if no two rows are alike in ``order_by``. Otherwise ties are ordered by all other columns, so that ids do not
    depend on how a scan is split: rows that are still tied are copies of each other. These get a tie-breaker, so that a range
    boundary can fall within a large group of equal rows; see :func:`playlake.storage.with_place`.
    """
    columns = df.columns
    order = list(order_by)
    if not unique:
        named = {c.lower() for c in order}
        order += [f"`{f.name}`" for f in df.schema if f.name.lower() not in named and not isinstance(f.dataType, MapType)]
        df = with_place(df, "_tie", from_scan)
        order.append("_tie")
    slot = F.monotonically_increasing_id()
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*columns, slot.alias("_slot"))
        .select(
            *columns,
            F.shiftright("_slot", _POSITION_BITS).alias("_part"),
            F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
        )
    )
    # Range bounds are sampled anew by each run of the plan: keep one run's partitions.
    stored = materialize(ranged, "numbered")
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return stored.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_position") + start).cast("bigint").alias(name), *columns
    )


def arrival_ids(stored: DataFrame, name: str = "songplay_id", start: int = 1) -> DataFrame:
    """Ids ``start, start + 1, ...`` without gaps, in the order rows stand in the Parquet files ``stored`` scans.

    ``stored`` must be such a scan as it is, without a filter. A row's number in its file does not depend on how the
    scan is split, so there is nothing to shuffle; the row counts of the files before give each file its offset.
    """
    columns = stored.columns
    file = F.col("_metadata.file_path").alias("_file")
    sizes = stored.groupBy(file).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sums_before(sizes, "_file", "_size", "_offset").drop("_size")
    placed = stored.select(*columns, file, F.col("_metadata.row_index").alias("_row"))
    # One row per file: Spark broadcasts it unless the files are very many.
    return placed.join(offsets, "_file").select(
        (F.col("_offset") + F.col("_row") + start).cast("bigint").alias(name), *columns
    )


def sums_before(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Add to each row the sum of ``value`` over the rows with a smaller ``key``. Keys are unique, ``value`` is a whole number.

    Two levels: rows are range-partitioned by ``key`` and summed within each partition, in parallel; the totals of the partitions, one
    number for each, give every partition its start. No task sees all rows.
    """
    columns = rows.columns
    ranged = rows.repartitionByRange(key).sortWithinPartitions(key).select(*columns, F.monotonically_increasing_id().alias("_slot"))
    # Range bounds are sampled anew by each run of the plan: keep one run's partitions.
    stored = materialize(ranged.withColumn("_range", F.shiftright("_slot", _POSITION_BITS)), "sums")
    totals = {r["_range"]: r["_total"] for r in stored.groupBy("_range").agg(F.sum(value).alias("_total")).collect()}
    starts = list(accumulate((totals.get(i, 0) for i in range(max(totals, default=0))), initial=0))
    start = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")[F.col("_range").cast("int")]
    inside = Window.partitionBy("_range").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return stored.select(*columns, (start + F.coalesce(F.sum(value).over(inside), F.lit(0))).alias(name))


def identity_ids(df: DataFrame, name: str = "songplay_id") -> DataFrame:
    """Distinct rows, numbered from 1 in the order of all their columns."""
    return serial_ids(df.distinct(), df.columns, name, unique=True)
