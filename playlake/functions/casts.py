"""Lenient casts: a value that does not fit the target type becomes null."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType, StringType, StructType


def lenient(column: Column, source_type, target_type) -> Column:
    if source_type == target_type:
        return column
    if isinstance(target_type, IntegralType) and isinstance(source_type, StringType):
        # Text such as "1970.0" or "1.5E3" is a whole number too, "3.7" is none; decimals keep every digit.
        exact = column.try_cast("decimal(38,18)")
        return F.coalesce(column.try_cast(target_type), F.when(exact == F.floor(exact), exact.try_cast(target_type)))
    return column.try_cast(target_type)


def strict(column: Column, source_type, target_type, name: str) -> Column:
    """As :func:`lenient`, but a value that does not fit stops the job."""
    cast = lenient(column, source_type, target_type)
    unfit = F.raise_error(F.concat(F.lit(f"a value does not fit column {name}: "), column.cast("string")))
    return F.when(column.isNotNull() & cast.isNull(), unfit.cast(target_type)).otherwise(cast)


def conform(df: DataFrame, schema: StructType, unfit: str = "null") -> DataFrame:
    """Project ``df`` to ``schema`` by name, casting each column; a missing column is null. ``unfit`` says what becomes of a value
    that does not fit its type: "null", or "fail" to stop the job."""
    cast = strict if unfit == "fail" else lambda column, source, target, _: lenient(column, source, target)
    present = {field.name: field.dataType for field in df.schema}
    return df.select(
        *[
            cast(F.col(f"`{f.name}`"), present[f.name], f.dataType, f.name).alias(f.name)
            if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
