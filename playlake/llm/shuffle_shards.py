"""Sharding by a two-pass external shuffle, with DataFrame functions only.

Pass one scatters the records uniformly over buckets: a seeded hash of a record's place picks its bucket, whatever its values, so
copies and hot keys spread like any other rows. There are as many buckets as it takes for each to fit in a task's memory. Pass
two reads each bucket, permutes it by a seeded Fisher-Yates shuffle (Spark's ``shuffle`` of an array) and writes it. The buckets in a
row are the shuffled table; ``n_shards`` equal stretches of it are the shards, whose row counts differ by one at most.

Ties and repeated rows are records of their own. Nulls in any column are carried along. An empty table gives empty shards.
Columns of any name are carried along.
"""

import math

from pyspark.sql import DataFrame, functions as F

from playlake.llm.common import quoted
from playlake.operators.ids import sums_before
from playlake.storage import fresh_path

#: Bytes of text that one bucket holds on average.
BUCKET_BYTES = 4 << 20


def shuffled_buckets(df: DataFrame, n_buckets: int, seed: int, path: str) -> DataFrame:
    """Both passes; written to ``path`` as (bucket, at, row) and read back. ``at`` counts from 0 in each bucket."""
    place = F.monotonically_increasing_id()
    row = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    scattered = df.select(row.alias("row"), place.alias("place"))
    key = F.xxhash64(F.lit(seed), F.col("place"))
    scattered = scattered.select(F.pmod(key, F.lit(n_buckets)).cast("int").alias("bucket"), key.alias("key"), "place", "row")
    # The order in which rows reach a task is not repeatable, so each bucket is put in order before it is shuffled.
    gathered = scattered.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("key", "place", "row"))).alias("rows"))
    ordered = gathered.sortWithinPartitions("bucket")
    shuffled = ordered.select("bucket", F.shuffle("rows", F.lit(seed)).alias("rows"))
    flat = shuffled.select("bucket", F.posexplode("rows").alias("at", "item")).select("bucket", "at", F.col("item.row").alias("row"))
    flat.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(flat.schema).parquet(path)


def shards(df: DataFrame, n_shards: int, seed: int = 42, size=None, bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """``row`` (a struct of the columns of ``df``, as c0, c1, ...), ``shard`` and ``slot``, which counts from 0 in each shard.

    ``size`` is the bytes of a record, as a column; it only sets the number of buckets.
    """
    spark = df.sparkSession
    total = df.agg(F.sum(size if size is not None else F.lit(1024))).first()[0] or 0
    n_buckets = max(1, math.ceil(total / bucket_bytes))
    stored = shuffled_buckets(df, n_buckets, seed, path or fresh_path(spark, "buckets"))
    counts = stored.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = sums_before(counts, "bucket", "n", "offset").select(F.col("bucket").alias("of"), "offset")
    rows = stored.agg(F.count(F.lit(1))).first()[0]
    n, total_rows = F.lit(n_shards).cast("long"), F.lit(rows).cast("long")
    position = F.col("offset") + F.col("at")
    # Shard s holds the positions p with floor(p * n / rows) = s; its first is ceil(s * rows / n).
    placed = stored.join(offsets, stored["bucket"] == offsets["of"]).select("row", position.alias("p"))
    shard = F.floor(F.col("p").cast("decimal(38,0)") * n / total_rows) if rows > 2**53 else F.floor(F.expr(f"p * {n_shards} div {max(rows, 1)}"))
    placed = placed.select("row", "p", shard.cast("int").alias("shard"))
    first = F.expr(f"(cast(shard as bigint) * {rows} + {n_shards - 1}) div {n_shards}")
    return placed.select("row", "shard", (F.col("p") - first).cast("long").alias("slot"))


def write_shards(placed: DataFrame, columns: list[str], path: str) -> None:
    """One folder of Parquet files for each shard, with the columns under their own names and ``slot`` as place in the shard."""
    named = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)]
    rows = placed.select("shard", "slot", F.struct(*named).alias("record"))
    rows.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode(
        "overwrite"
    ).parquet(path)
