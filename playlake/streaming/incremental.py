"""File-by-file loads that can be run again at any point and end with the answer of one run over all files.

Each batch writes its own directory ``batch=<id>``, replacing what a failed attempt of the same batch left there, and
never changes what other batches wrote. Upserted tables are kept as states and folded when read, so a file that comes
late still lands in its place. For a whole star see :mod:`playlake.streaming.star_load`.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from playlake.operators.upsert import UpsertRule, fold, from_state, to_state


def read_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "json", files_per_trigger: int | None = 1, **options
) -> DataFrame:
    """A stream over the files below ``path``, also in its subdirectories, a number of files per batch."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def run_batches(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Call ``load`` on each batch of what is there now."""
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_path(table_path: str, batch_id: int) -> str:
    return f"{table_path}/batch={batch_id}"


def upsert_batches(rule: UpsertRule, table_path: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """A ``load`` function that adds each batch's state to the table at ``table_path``."""

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        to_state(rows, rule).write.mode("overwrite").parquet(batch_path(table_path, batch_id))

    return load


def current_table(spark: SparkSession, table_path: str, rule: UpsertRule) -> DataFrame:
    """The upserted table as of the batches written so far."""
    return from_state(fold(spark.read.parquet(table_path).drop("batch"), rule), rule)


def compact(spark: SparkSession, table_path: str, rule: UpsertRule, out: str) -> None:
    """Fold the states of all batches into one at ``out``, where further batches can go on."""
    state = spark.read.parquet(table_path)
    last = state.agg(F.max("batch")).first()[0]
    fold(state.drop("batch"), rule).write.mode("overwrite").parquet(batch_path(out, last))
