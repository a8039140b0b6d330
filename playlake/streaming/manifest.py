"""Which files are loaded, and which folders hold the tables made of them.

The manifest is a log of commits. Each is one file that Spark moves into place by one rename, after everything it names is written: readers
see a batch as a whole or not at all, and what a failed attempt has left is never read. A load asks the manifest, not its checkpoint,
which files are new, so a replay from another checkpoint or with other batches adds nothing twice.

One load writes to a manifest at a time.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

FILE, TABLE = "file", "table"
_LOG = "version long, kind string, name string, path string, size long, modified timestamp, n_rows long"


class Manifest:
    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.path = spark, f"{out}/manifest"
        spark.createDataFrame([], _LOG).write.mode("ignore").parquet(self.path)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(self.path)

    def tables(self) -> dict[str, list[tuple[int, str, int | None]]]:
        """(version, folder, rows) of each commit that wrote a table, oldest first, by the table's name. One row for each folder."""
        rows = self.entries().filter(F.col("kind") == TABLE).select("version", "name", "path", "n_rows").collect()
        out: dict[str, list[tuple[int, str, int | None]]] = {}
        for row in sorted(rows, key=lambda r: r["version"]):
            out.setdefault(row["name"], []).append((row["version"], row["path"], row["n_rows"]))
        return out

    def version(self) -> int:
        """The number of the last commit; 0 before the first."""
        return max((version for commits in self.tables().values() for version, _, _ in commits), default=0)

    def files(self) -> DataFrame:
        """(name, size, modified) of the files loaded so far."""
        return self.entries().filter(F.col("kind") == FILE).select("name", "size", "modified")

    def new_rows(self, rows: DataFrame) -> DataFrame:
        """The ``rows`` (with file, size, modified) of files not loaded yet. A file that is not what it was when it was loaded stops the job."""
        known = self.files().select(F.col("name").alias("_name"), F.col("size").alias("_size"), F.col("modified").alias("_modified"))
        met = rows.join(known, F.col("file") == F.col("_name"), "left")
        same = (F.col("size") == F.col("_size")) & (F.col("modified") == F.col("_modified"))
        changed = F.raise_error(F.concat(F.lit("changed since it was loaded: "), F.col("file"))).cast("boolean")
        new = F.when(F.col("_name").isNull(), F.lit(True)).when(same, F.lit(False)).otherwise(changed)
        return met.filter(new).select(*rows.columns)

    def commit(self, version: int, files: DataFrame, tables: dict[str, tuple[str, int | None]]) -> None:
        """Make ``tables`` (name: folder, rows) and ``files`` (file, size, modified) known, all at once."""
        named = self.spark.createDataFrame([(name, path, n) for name, (path, n) in tables.items()], "name string, path string, n_rows long")
        nothing = F.lit(None)
        rows = named.select(
            F.lit(TABLE).alias("kind"), "name", "path", nothing.cast("long").alias("size"), nothing.cast("timestamp").alias("modified"), "n_rows"
        ).union(
            files.distinct().select(F.lit(FILE), "file", nothing.cast("string"), "size", "modified", nothing.cast("long"))
        )
        rows.select(F.lit(version).cast("long").alias("version"), "*").coalesce(1).write.mode("append").parquet(self.path)
