"""Delete statements from a table of keys, and the deletion itself as a set operation."""

from pyspark.sql import Column, DataFrame, functions as F

from playlake.operators.joins import skew_join
from playlake.sinks.files import append_text


def literal(column: str, dtype: str, escape: bool = True) -> Column:
    """A column as a literal in statement text: text in single quotes, anything else as it is."""
    text = F.col(column).cast("string")
    if dtype != "string":
        return text
    if escape:
        text = F.replace(text, F.lit("'"), F.lit("''"))
    return F.concat(F.lit("'"), text, F.lit("'"))


def delete_statements(rows: DataFrame, table: str, keys: dict[str, str], escape: bool = True) -> DataFrame:
    """One ``DELETE`` statement per row, in the column ``statement``.

    ``keys`` maps columns of ``rows`` to names as they should stand in the text. A row with a null key gives null:
    no statement can find it by equality.
    """
    dtypes = dict(rows.dtypes)
    parts = [F.lit(f"DELETE FROM {table} WHERE ")]
    for i, (column, shown) in enumerate(keys.items()):
        parts += [F.lit(f"{' AND ' if i else ''}{shown}="), literal(column, dtypes[column], escape)]
    return rows.select(F.concat(*parts, F.lit(";")).alias("statement"))


def write_delete_script(rows: DataFrame, table: str, keys: dict[str, str], path: str) -> None:
    """Append the statements for ``rows`` as lines to the text files under ``path``. A null key fails the job."""
    statements = delete_statements(rows, table, keys)
    checked = F.coalesce("statement", F.raise_error(F.lit("null in a key of a delete statement")))
    append_text(statements.select(checked.alias("value")), path)


def delete_by_keys(table: DataFrame, keys_to_delete: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``table`` that the statements for ``keys_to_delete`` would leave."""
    gone = keys_to_delete.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    return skew_join(table, gone, {k: f"_{k}" for k in keys}, "left_anti")
