"""CSV whose quoted fields hold line breaks, read by many tasks.

A line break is inside a field where the quotes before it in the file are odd in number. Each task counts the quotes of its split of a file; the
counts of the splits before, summed, tell whether a split begins inside a field. A split is taken in pieces of lines, so that no task has to sort a whole one. A second pass knows then where records begin. Lines
that are records of their own, mostly all, stay where they are; only the lines of longer records are shuffled to be joined.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from playlake.schemas import CORRUPT_COLUMN
from playlake.sources.judged import judged
from playlake.storage import materialize

#: A record of more lines than this comes from a quote that is never closed; its lines are rows of their own then.
MOST_LINES = 10_000
#: Lines of a piece, as a power of two.
PIECE_BITS = 16


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def csv_lines(spark: SparkSession, path: str | list[str], recursive: bool = False, name_glob: str | None = None) -> DataFrame:
    """Lines with their file, the split they are read in, their order there, and whether their quotes are odd in number."""
    reader = spark.read.option("lineSep", "\n")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    lines = reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
    )
    return materialize(lines.withColumn("odd", _quotes(F.col("value")) % 2 == 1), "csv-lines")


def records(lines: DataFrame, most_lines: int = MOST_LINES) -> DataFrame:
    """(file, value) of each record but the first of each file, its header."""
    piece = ["file", "split", "piece"]
    lines = lines.withColumn("piece", F.shiftright("at", PIECE_BITS))
    pieces = lines.groupBy(*piece).agg(F.sum(F.col("odd").cast("long")).alias("n_odd"), F.min("at").alias("first_at"))
    before = Window.partitionBy("file").orderBy("split", "piece").rowsBetween(Window.unboundedPreceding, -1)  # one row for each piece
    open_at = F.coalesce(F.sum("n_odd").over(before), F.lit(0)) % 2 == 1
    place = F.struct("split", "piece")
    header = place == F.min(place).over(Window.partitionBy("file"))
    states = pieces.select(*piece, open_at.alias("open"), F.when(header, F.col("first_at")).alias("header_at"))
    in_piece = Window.partitionBy(*piece).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each piece: hashed, so that the lines are sorted once, for the sums, and not for the join too.
    known = lines.join(states.hint("shuffle_hash"), piece)
    inside = (F.coalesce(F.sum(F.col("odd").cast("long")).over(in_piece), F.lit(0)) + F.col("open").cast("long")) % 2 == 1
    placed = materialize(known.withColumn("inside", inside).drop("open"), "csv-placed")
    alone = placed.filter("not inside and not odd and (header_at is null or at <> header_at)").select("file", "value")
    # Of longer records every line is inside or opens one; lines from one opening to the next are a record.
    longer = placed.filter("inside or odd")
    starts = ~F.col("inside")
    in_part = Window.partitionBy(*piece).orderBy("at")
    own = longer.withColumn("start", F.max(F.when(starts, F.col("at"))).over(in_part))
    ends = own.groupBy(*piece).agg(F.max(F.when(starts, F.col("at"))).alias("last_start"))
    # A record that began in an earlier piece goes on from the last opening there.
    carried = Window.partitionBy("file").orderBy("split", "piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*piece, F.last("last_start", ignorenulls=True).over(carried).alias("carried"))
    whole = own.join(carry.hint("shuffle_hash"), piece).withColumn("start", F.coalesce("start", "carried"))
    sizes = whole.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n_lines"))
    runaway = whole.join(sizes.filter(F.col("n_lines") > most_lines).select("file", "start"), ["file", "start"], "left_semi").select("file", "value")
    bounded = whole.join(sizes.filter(F.col("n_lines") <= most_lines).select("file", "start"), ["file", "start"], "left_semi")
    joined = bounded.groupBy("file", "start").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "at", "value"))), lambda line: line["value"]), "\n").alias("value"),
        F.max("header_at").alias("header_at"),
    )
    joined = joined.filter("header_at is null or start <> header_at").select("file", "value")
    return alone.unionByName(joined).unionByName(runaway).withColumn("value", F.regexp_replace("value", "\r$", ""))


def read_csv_records(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    recursive: bool = False,
    name_glob: str | None = None,
    corrupt: str = CORRUPT_COLUMN,
    most_lines: int = MOST_LINES,
) -> DataFrame:
    """CSV files with a header line each, line breaks in quoted fields allowed, with damaged rows as text in ``corrupt``.

    Where no line has an odd number of quotes, no field holds a line break, and lines are parsed as they are.
    """
    lines = csv_lines(spark, path, recursive, name_glob)
    if lines.filter("odd").isEmpty():
        header = lines.groupBy(F.col("file").alias("of")).agg(F.min(F.struct("split", "at")).alias("first"))
        kept = lines.join(header, (F.col("file") == F.col("of")) & (F.col("at") == F.col("first.at")), "left_anti")
        return judged(kept.select(F.regexp_replace("value", "\r$", "").alias("value")), schema, "csv", corrupt=corrupt)
    return judged(records(lines, most_lines).select("value"), schema, "csv", corrupt=corrupt)

