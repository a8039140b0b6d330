"""Rows and damaged rows from text, by one expression for batches and streams.

Spark's file readers parse only the columns a query asks for, so what counts as damaged may depend on the query. Here a row's text is parsed as a
whole: it is damaged if it does not parse, lacks or exceeds the columns (CSV), or holds a value that does not fit its type. A damaged
row has its text in the corrupt column; what could be read stands beside it.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playlake.schemas import CORRUPT_COLUMN


def judged(lines: DataFrame, schema: StructType, fmt: str = "json", column: str = "value", corrupt: str = CORRUPT_COLUMN) -> DataFrame:
    """``lines`` with the fields of ``schema`` and ``corrupt`` in place of the text in ``column``; blank text is no row."""
    text = F.col(column)
    whole = StructType([*schema.fields, StructField(corrupt, StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    if fmt == "json":
        parsed = F.from_json(text, whole, options)
    else:
        parsed = F.from_csv(text, whole.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options | {"escape": '"'})
    others = [c for c in lines.columns if c != column]
    rows = lines.filter(F.length(F.trim(text)) > 0).select(*others, parsed.alias("_row"))
    return rows.select(*others, *[F.col(f"_row.`{f.name}`").alias(f.name) for f in whole])
