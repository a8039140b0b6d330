"""Catalog tables: definitions, loads and layout."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from playlake.storage import with_place


def create_database(
    spark: SparkSession, name: str, location: str | None = None, replace: bool = False, use: bool = False
) -> None:
    """Create a database if absent; ``replace`` drops it with its tables first, ``use`` makes it the current one."""
    if replace:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    """Drop the tables that exist, in list order."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(spark: SparkSession, name: str, schema: StructType) -> None:
    """Create an empty Parquet table if absent. Char and varchar columns limit the length of inserted text."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet")


def create_tables(spark: SparkSession, database: str, schemas: dict[str, StructType]) -> None:
    for name, schema in schemas.items():
        create_table(spark, f"{database}.{name}", schema)


def append_rows(df: DataFrame, name: str) -> None:
    """Append to a table, matching its columns by name; a column ``df`` lacks is null."""
    insert_select(df, name, df.columns)


def insert_select(df: DataFrame, name: str, columns: list[str] | None = None) -> None:
    """Insert into a table by position, or into the given columns of it; other columns are null."""
    spark = df.sparkSession
    if columns is None:
        df.write.insertInto(name)
        return
    target = spark.table(name).schema
    given = dict(zip(columns, df.columns, strict=True))
    unknown = set(columns) - set(target.names)
    if unknown:
        raise ValueError(f"{name} has no columns {sorted(unknown)}")
    df.select(
        *[
            F.col(f"`{given[f.name]}`") if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target
        ]
    ).write.insertInto(name)


def arrange(
    df: DataFrame,
    keys: list[str],
    unique: bool = False,
    from_scan: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Distribute rows by ranges of ``keys`` and sort each partition by them.

    With ``unique`` keys (no two rows alike in them) one range shuffle does it. Otherwise many rows may share a key and
    would all go to one task, so each row gets a tie-breaker, see :func:`playlake.storage.with_place`. A hot key then
    spans several neighbouring partitions.
    """
    order = list(keys)
    if not unique:
        df = with_place(df, "_tie", from_scan)
        order.append("_tie")
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop("_tie")
