"""JSON and CSV file scans."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playlake.schemas import CORRUPT_COLUMN
from playlake.storage import materialize


def _with_corrupt(schema: StructType, column: str | None) -> StructType:
    if column is None or column in schema.names:
        return schema
    return StructType([*schema.fields, StructField(column, StringType(), True)])


def _discover(reader, recursive: bool, name_glob: str | None):
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", name_glob) if name_glob else reader


def read_json_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    corrupt: str | None = None,
    recursive: bool = False,
    name_glob: str | None = None,
) -> DataFrame:
    """One JSON object per line. ``path`` may hold globs.

    With ``corrupt``, a line that does not parse or does not fit the schema is kept as text in that column. See
    :func:`split_corrupt` before selecting from it.
    """
    reader = spark.read.schema(_with_corrupt(schema, corrupt)).option("mode", "PERMISSIVE")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return _discover(reader, recursive, name_glob).json(path)


def read_json_objects(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    corrupt: str | None = None,
    recursive: bool = True,
    name_glob: str | None = "*.json",
) -> DataFrame:
    """One JSON object per file, which may run over several lines."""
    reader = spark.read.schema(_with_corrupt(schema, corrupt)).option("multiLine", True).option("mode", "PERMISSIVE")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return _discover(reader, recursive, name_glob).json(path)


def split_corrupt(df: DataFrame, corrupt: str = CORRUPT_COLUMN, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows without the corrupt column, and the corrupt rows.

    Spark parses only the columns a query asks for, so whether a row counts as corrupt would depend on the query. The
    parsed rows are therefore written once; this also spares each later table a new pass over the raw text.
    """
    parsed = materialize(df, "parsed", path)
    good = parsed.filter(F.col(corrupt).isNull()).drop(corrupt)
    return good, parsed.filter(F.col(corrupt).isNotNull())


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    recursive: bool = False,
    name_glob: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV files with a header line each; a quote inside a quoted field is doubled.

    ``multi_line`` allows line breaks inside quoted fields, but then each file is read by one task.
    """
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", True)
    reader = reader.option("multiLine", multi_line)
    return _discover(reader, recursive, name_glob).csv(path)


def read_csv_inferred(spark: SparkSession, path: str | list[str], sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with types found from the data: one more pass over it, so prefer :func:`read_csv`."""
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("inferSchema", True)
        .option("samplingRatio", sampling_ratio)
        .csv(path)
    )


def count_files(df: DataFrame) -> DataFrame:
    """Number of non-empty files a file-based DataFrame reads, and its rows, as one row."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def count_listed(spark: SparkSession, path: str | list[str], name_glob: str = "*") -> DataFrame:
    """Number of files below ``path`` whose names fit, as one row; their content is not read. Spark's scans leave empty files out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name_glob)
    return files.load(path).select("path").agg(F.count(F.lit(1)).alias("n_files"))


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of several sources, copies kept; a column one of them lacks is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), sources)
