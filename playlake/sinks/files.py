"""File sinks."""

from pyspark.sql import DataFrame, SparkSession


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    mode: str = "overwrite",
    only_touched: bool = False,
    rebalance: bool = True,
) -> None:
    """Parquet, by default overwriting.

    With ``partition_by``, rows are first brought together by partition value, or each task would write a file into
    each partition. The rebalance lets Spark split a partition value that holds much of the data over several tasks
    and merge small ones. ``only_touched`` overwrites only the partitions that ``df`` has rows for.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        writer = writer.option("partitionOverwriteMode", "dynamic" if only_touched else "static")
    writer.parquet(path)


def write_csv_quoted(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV directory with every field quoted and a header line per file.

    Null and empty text look the same in it. ``single_file`` passes everything through one task: small results only.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("quoteAll", True).option("escape", '"').option("header", True).csv(path)


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the text files under ``path``, header lines included, as one row ``n_lines``."""
    return spark.read.text(path).groupBy().count().withColumnRenamed("count", "n_lines")


def append_text(df: DataFrame, path: str) -> None:
    """Append a single text column as lines."""
    df.write.mode("append").text(path)
