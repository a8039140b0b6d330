"""Keyed messages, as Kafka records or as text lines ``key,value``.

The position of a reader is its checkpoint: the same checkpoint goes on where it stopped, a new one starts from the
earliest message.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

SEPARATOR = ","


def split_keyed(lines: DataFrame, separator: str = SEPARATOR, column: str = "value") -> DataFrame:
    """``key`` and ``value`` of text lines, cut at the first separator; a line without one has a null key."""
    at = F.instr(F.col(column), separator)
    key = F.when(at > 0, F.substring(F.col(column), F.lit(1), at - 1))
    value = F.when(at > 0, F.substring(F.col(column), at + len(separator), F.length(column))).otherwise(F.col(column))
    return lines.select(key.alias("key"), value.alias("value"))


def joined_keyed(separator: str = SEPARATOR) -> Column:
    """``key``, separator and ``value`` as one text, as a console reader prints it."""
    return F.concat(F.coalesce(F.col("key").cast("string"), F.lit("null")), F.lit(separator), F.col("value"))


def read_topic(
    spark: SparkSession,
    source: str,
    options: dict[str, str],
    separator: str = SEPARATOR,
    starting: str = "earliest",
) -> DataFrame:
    """A stream of ``key`` and ``value``: ``source='kafka'`` with its options, or ``'text'`` with ``path``."""
    if source == "kafka":
        records = spark.readStream.format("kafka").option("startingOffsets", starting).options(**options).load()
        return records.select(F.col("key").cast("string"), F.col("value").cast("string"))
    return split_keyed(spark.readStream.format(source).options(**options).load(), separator)


def write_topic(
    messages: DataFrame, sink: str, options: dict[str, str], checkpoint: str, separator: str = SEPARATOR
) -> StreamingQuery:
    """Write all messages there are now: as Kafka records, as text lines, or as two columns of a file sink."""
    if sink == "kafka":
        out = messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
    elif sink == "text":
        out = messages.select(joined_keyed(separator).alias("value"))
    else:
        out = messages
    return (
        out.writeStream.format(sink)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
