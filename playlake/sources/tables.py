"""Scans of Parquet trees and catalog tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_partitioned(
    spark: SparkSession, base: str, schema: StructType | None = None, leaves: str | None = None
) -> DataFrame:
    """Partitioned Parquet, partition columns kept. ``leaves`` is a glob below ``base``, such as ``*/*/``.

    Give the schema: without one Spark guesses the types of directory names and reads ``007`` as a number.
    """
    reader = spark.read.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{base.rstrip('/')}/{leaves}" if leaves else base)


def read_leaves(spark: SparkSession, base: str, leaves: str = "*/*/") -> DataFrame:
    """Partitioned Parquet read by its leaf directories: the partition columns are lost."""
    return spark.read.parquet(f"{base.rstrip('/')}/{leaves}")


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A catalog table, whole or some of its columns."""
    table = spark.table(name)
    return table.select(*columns) if columns else table
