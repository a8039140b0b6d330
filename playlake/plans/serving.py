"""Event CSVs to one consolidated CSV data set, and one table per access path."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from playlake.operators import serving
from playlake.schemas import CONSOLIDATED_POSITIONS, CORRUPT_COLUMN, EVENT_CSV
from playlake.sinks.files import write_csv_quoted, write_parquet
from playlake.sources.files import read_csv, split_corrupt
from playlake.sources.records import read_csv_records
from playlake.storage import materialize

CONSOLIDATED = StructType([EVENT_CSV[i] for i in CONSOLIDATED_POSITIONS])


def consolidate(spark: SparkSession, csv_path: str, out: str, staging: str | None = None, parsed: str | None = None) -> DataFrame:
    """Write the kept rows and columns of all CSVs below ``csv_path`` as one data set to ``out`` and return the rows.

    The CSVs are parsed once, into Parquet at ``parsed``. The returned rows are read from Parquet at ``staging``. Damaged rows are left
    out; they stay in ``parsed``, see :func:`parse_events`.
    """
    good, _ = parse_events(spark, csv_path, parsed)
    kept = materialize(serving.at_positions(serving.with_artist(good)), "consolidated", staging)
    write_csv_quoted(kept, out)
    return kept


def parse_events(spark: SparkSession, csv_path: str, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of all CSVs below ``csv_path``, and the damaged ones as text. Quoted fields may hold line breaks."""
    return split_corrupt(read_csv_records(spark, csv_path, EVENT_CSV, recursive=True, name_glob="*.csv"), path=path)


def read_consolidated(spark: SparkSession, path: str) -> DataFrame:
    """A consolidated CSV data set. Empty text is null: every field is quoted, so the file does not tell them apart."""
    rows = read_csv(spark, path, CONSOLIDATED)
    return rows.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, StringType) else f.name
            for f in CONSOLIDATED
        ]
    )


def build_serving(spark: SparkSession, csv_path: str, out: str, null_keys: str = "error") -> dict[str, DataFrame]:
    """Write the consolidated CSV and the three query-first tables below ``out`` and return them as read back.

    ``rejected`` are the damaged rows, which no table holds. ``null_keys`` says what becomes of rows without a key: "error" stops the job,
    "drop" leaves them out of the table.
    """
    events = consolidate(spark, csv_path, f"{out}/events_csv", f"{out}/staging", f"{out}/parsed")
    tables = {"events_csv": read_consolidated(spark, f"{out}/events_csv")}
    for name in serving.TABLES:
        rows = serving.serve(events, name, null_keys=null_keys)
        write_parquet(rows, f"{out}/{name}")
        tables[name] = spark.read.schema(rows.schema).parquet(f"{out}/{name}")
    return tables | {"rejected": spark.read.parquet(f"{out}/parsed").filter(F.col(CORRUPT_COLUMN).isNotNull())}
