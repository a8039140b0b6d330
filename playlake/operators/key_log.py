"""Key checks for tables that grow by loads: a new load is held against bitmaps of the earlier ones, not against their rows.

Each load keeps its distinct keys with their counts, and bitmaps of the keys, 32,768 places to a row. A single whole-number key has the place
of its value, so that a bit is the key; this suits ids that lie close together. Other keys have the place of a hash among some sixteen places
for each key to be expected: a bit that is not set proves that a key is new, and only keys whose bit is set are looked up in the earlier loads.

A load that is run again replaces what it has kept before. Loads are numbered, and one runs at a time.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType, LongType, StructField, StructType

from playlake.operators.joins import no_nulls, skew_join
from playlake.storage import materialize

_BITS = "bucket long, bits binary, load long"
_PLACES_PER_KEY = 16


class KeyLog:
    """The log in the folder ``path``, for the columns ``keys`` of tables like ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], expected: int = 1 << 30):
        """``expected`` keys in all loads together: with more, more keys are looked up. It must stay the same for one folder."""
        self.spark, self.keys, self.places = spark, keys, _PLACES_PER_KEY * max(expected, 1)
        self.exact = len(keys) == 1 and isinstance(schema[keys[0]].dataType, IntegralType)
        self._counts, self._bits = f"{path}/counts", f"{path}/bits"
        self._schema = StructType([schema[k] for k in keys] + [StructField("n_rows", LongType()), StructField("load", LongType())])
        for where, columns in ((self._counts, self._schema), (self._bits, _BITS)):
            spark.createDataFrame([], columns).write.mode("ignore").partitionBy("load").parquet(where)

    def counts(self) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(self._counts)

    def bits(self) -> DataFrame:
        return self.spark.read.schema(_BITS).parquet(self._bits)

    def take(self, rows: DataFrame, load: int) -> DataFrame:
        """Add a load. Returns its keys that break a primary key: (keys, n_rows, n_before), rows in this load and in loads with a smaller number.

        A key breaks it if it has more than one row in these loads, or holds a null; keys with a null are not counted before.
        """
        self._put(rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_rows")), self._counts, load)
        new = self.counts().filter(F.col("load") == load).drop("load")
        whole = no_nulls(new, self.keys).withColumn("_place", self._place(self.keys))
        marks = whole.groupBy(F.bitmap_bucket_number("_place").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("bits")
        )
        self._put(marks, self._bits, load)
        suspects = materialize(self._marked(whole, self.bits().filter(F.col("load") < load)).select(*self.keys), "suspects")
        broken = reduce(Column.__or__, [F.col(k).isNull() for k in self.keys], F.col("n_rows") > 1)
        if suspects.isEmpty():
            return new.filter(broken).withColumn("n_before", F.lit(0).cast("long"))
        named = suspects.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        earlier = skew_join(self.counts().filter(F.col("load") < load), named, {k: f"_{k}" for k in self.keys}, "left_semi")
        before = earlier.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys]).agg(F.sum("n_rows").alias("n_before"))
        met = skew_join(new, before, {k: f"_{k}" for k in self.keys}, "left")
        met = met.select(*self.keys, "n_rows", F.coalesce("n_before", F.lit(0)).alias("n_before"))
        return met.filter(broken | (F.col("n_before") > 0))

    def missing(self, child: DataFrame, column: str) -> DataFrame:
        """References of ``child`` that no load has a key for, with the number of rows; null references pass. Only for a whole-number key.

        The bitmaps say it all: no earlier key is read.
        """
        if not self.exact:
            raise ValueError("references can only be checked by the bitmaps of a single whole-number key; use quality.orphan_keys")
        if not isinstance(child.schema[column].dataType, IntegralType):
            raise ValueError(f"{column} is no whole number")
        used = no_nulls(child, [column]).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
        return self._marked(used.withColumn("_place", self._place([column])), self.bits(), there=False).select(column, "n_rows")

    def _place(self, columns: list[str]) -> Column:
        if self.exact:
            return F.col(columns[0]).cast("long")
        return F.pmod(F.xxhash64(*columns), F.lit(self.places)) + 1

    def _marked(self, rows: DataFrame, bits: DataFrame, there: bool = True) -> DataFrame:
        """The ``rows`` whose bit is set, or, with ``there=False``, is not."""
        merged = bits.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        met = rows.withColumn("_bucket", F.bitmap_bucket_number("_place")).join(merged, F.col("_bucket") == F.col("bucket"), "left")
        at = F.bitmap_bit_position("_place")
        byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        bit = F.coalesce(F.getbit(byte, (at % 8).cast("int")), F.lit(0))
        return met.filter(bit == F.lit(int(there)))

    def _put(self, rows: DataFrame, where: str, load: int) -> None:
        rows = rows.withColumn("load", F.lit(load).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(where)
