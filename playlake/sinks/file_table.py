"""A Parquet table whose current files a log names, so that a delete writes anew only the files that hold a key.

Each version is one file of the log that Spark moves into place by one rename, after the Parquet files it names are written: readers see a
delete as a whole or not at all, and what a failed attempt has left is never read. Replaced files stay, so earlier versions can be read.
One job changes a table at a time. The names of the current files pass through the driver, as in any Parquet scan.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, NumericType

from playlake.operators.joins import no_nulls, skew_join
from playlake.operators.statements import delete_by_keys
from playlake.sinks.tables import arrange

#: The most ranges that keys to delete are summed up in before they meet the bounds of files.
RANGES = 200


class FileTable:
    """The table in the folder ``path``, created by :meth:`create`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._log = spark, path, f"{path}/log"

    @classmethod
    def create(cls, df: DataFrame, path: str, layout: list[str], partitions: int | None = None) -> "FileTable":
        """Write ``df`` in files by ranges of the columns ``layout``, at most ``partitions`` of them if that is said.

        The bounds of the first of the columns are kept for each file.
        """
        table = cls(df.sparkSession, path)
        df.limit(0).write.parquet(f"{path}/columns")
        df.limit(0).select(*layout).write.parquet(f"{path}/layout")
        table._commit(1, table._write(arrange(df, layout, partitions=partitions), layout[0]), None)
        return table

    @property
    def schema(self):
        return self.spark.read.parquet(f"{self.path}/columns").schema

    @property
    def layout(self) -> list[str]:
        return self.spark.read.parquet(f"{self.path}/layout").columns

    def files(self, version: int | None = None) -> DataFrame:
        """(file, n_rows, low, high) of the files of a version, by default the last."""
        log = self.spark.read.parquet(self._log)
        if version is not None:
            log = log.filter(F.col("version") <= version)
        gone = log.filter("gone").select(F.col("file").alias("_file"))
        return log.filter("not gone").join(gone, F.col("file") == F.col("_file"), "left_anti").select("file", "n_rows", "low", "high")

    def version(self) -> int:
        return self.spark.read.parquet(self._log).agg(F.max("version")).first()[0]

    def rows(self, version: int | None = None) -> DataFrame:
        return self._scan(self.files(version))

    def delete(self, gone: DataFrame, keys: list[str]) -> int:
        """Delete the rows whose ``keys`` are those of a row of ``gone``, and say how many there were.

        Columns are compared as ``=`` does, so a null is equal to nothing. Files whose bounds no key falls into are not read; of the
        others only the keys are read, and only files with a row to delete are written anew. Without such rows there is no new version.
        """
        wanted = no_nulls(gone.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]), [f"_{i}" for i in range(len(keys))])
        here = self._scan(self._near(wanted, keys))
        places = here.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col("_metadata.file_path").alias("file"))
        hit = skew_join(places, wanted.distinct(), {f"k{i}": f"_{i}" for i in range(len(keys))}, "left_semi")
        touched = hit.groupBy("file").agg(F.count(F.lit(1)).alias("n_hit")).collect()
        if not touched:
            return 0
        names = [row["file"] for row in touched]
        layout = self.layout
        left = delete_by_keys(self.spark.read.schema(self.schema).parquet(*names), gone, keys)
        self._commit(self.version() + 1, self._write(arrange(left, layout), layout[0]), names)
        return sum(row["n_hit"] for row in touched)

    def _scan(self, files: DataFrame) -> DataFrame:
        names = [row["file"] for row in files.select("file").collect()]
        return self.spark.read.schema(self.schema).parquet(*(names or [f"{self.path}/columns"]))

    def _near(self, wanted: DataFrame, keys: list[str]) -> DataFrame:
        """The files that may hold one of the keys ``wanted``."""
        files, first = self.files(), self.layout[0]
        if first not in keys:
            return files
        at = keys.index(first)
        if not _same_order(files.schema["low"].dataType, wanted.schema[at].dataType):
            return files
        # Each range of a sorted sample of bounds is one row: at most RANGES of them, in one array.
        key = F.col(f"_{at}")
        part = wanted.select(key.alias("key")).repartitionByRange(RANGES, "key").groupBy(F.spark_partition_id().alias("part"))
        ranges = part.agg(F.min("key").alias("low"), F.max("key").alias("high")).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
        meet = F.exists("ranges", lambda r: (r["low"] <= F.col("high")) & (r["high"] >= F.col("low")))
        return files.join(F.broadcast(ranges), F.lit(True)).filter(meet).drop("ranges")

    def _write(self, df: DataFrame, first: str) -> DataFrame:
        """Write new files; their names, row counts and bounds."""
        folder = f"{self.path}/data-{uuid.uuid4().hex}"
        df.write.parquet(folder)
        written = self.spark.read.schema(df.schema).parquet(folder)
        return written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(first).alias("low"), F.max(first).alias("high")
        )

    def _commit(self, version: int, new: DataFrame, gone: list[str] | None) -> None:
        rows = new.select(F.lit(False).alias("gone"), "file", "n_rows", "low", "high")
        if gone:
            old = self.files().join(self.spark.createDataFrame([(f,) for f in gone], "name string"), F.col("file") == F.col("name"), "left_semi")
            rows = rows.union(old.select(F.lit(True), "file", "n_rows", "low", "high"))
        rows.select(F.lit(version).cast("long").alias("version"), "*").coalesce(1).write.mode("append").parquet(self._log)


def _same_order(a: DataType, b: DataType) -> bool:
    """Whether equal values of two types lie within bounds of the other type."""
    return a == b or (isinstance(a, NumericType) and isinstance(b, NumericType))
