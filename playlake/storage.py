"""Where intermediate tables live: the shared folder the cluster names, never one machine's own disk."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def scratch_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, a local session gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="playlake-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path for one intermediate table; nothing is written to it yet."""
    return f"{scratch_root(spark)}/playlake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Cuts the lineage, outlives lost executors and makes row order within files repeatable for what reads it.
    """
    path = path or fresh_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_place(df: DataFrame, name: str, from_scan: bool = False) -> DataFrame:
    """Add each row's place in a file scan: unique, increasing in scan order, and the same when a task is run again.

    Rows that come out of a shuffle reach their task in an order that may differ from run to run, so they are written
    first and scanned. ``from_scan`` says that ``df`` is a scan already (filters and projections do no harm).
    """
    scan = df if from_scan else materialize(df, "placed")
    return scan.withColumn(name, F.monotonically_increasing_id())
