"""Loads of JSON lines into typed staging columns, by a list of JSONPaths or by field name."""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playlake.functions.casts import conform, lenient, strict

_STEP = re.compile(r"\['([^']+)'\]|\.([A-Za-z_]\w*)")


def _keys(path: str) -> tuple[str, ...] | None:
    """Object keys of a JSONPath, or None if it has other steps such as array positions."""
    steps = path.removeprefix("$")
    if not steps or _STEP.sub("", steps):
        return None
    return tuple(quoted or plain for quoted, plain in _STEP.findall(steps))


def _text_schema(key_lists: list[tuple[str, ...]]) -> StructType | None:
    """Schema that reads each key list as text, or None if one list leads through another."""
    tree: dict = {}
    for keys in key_lists:
        node = tree
        for key in keys[:-1]:
            node = node.setdefault(key, {})
            if node is None:
                return None
        if isinstance(node.get(keys[-1]), dict):
            return None
        node[keys[-1]] = None

    def build(node: dict) -> StructType:
        return StructType(
            [StructField(key, StringType() if sub is None else build(sub)) for key, sub in node.items()]
        )

    return build(tree)


def copy_by_paths(
    spark: SparkSession, path: str | list[str], json_paths, schema: StructType, fail: bool = True, unfit: str = "null"
) -> DataFrame:
    """JSON lines loaded by position: the n-th JSONPath fills the n-th column, cast to its type.

    A value that does not fit the type, such as an empty user id, is null, or stops the load with ``unfit="fail"``. A line that is no JSON fails the load, or
    without ``fail`` gives nulls. Paths made of object keys are read in one pass by the JSON scan, which parses only
    those keys; other paths are taken from each line's text.
    """
    if len(json_paths) != len(schema):
        raise ValueError(f"{len(json_paths)} paths for {len(schema)} columns")
    key_lists = [_keys(p) for p in json_paths]
    text_schema = None if None in key_lists else _text_schema(key_lists)
    if text_schema is not None:
        lines = spark.read.schema(text_schema).option("mode", _mode(fail)).json(path)
        values = [F.col(".".join(f"`{key}`" for key in keys)) for keys in key_lists]
    else:
        lines = spark.read.text(path)
        line = F.col("value")
        if fail:
            damaged = line.isNotNull() & F.try_parse_json(line).isNull()
            line = F.when(damaged, F.raise_error(F.lit("a line is no JSON"))).otherwise(line)
        values = [F.get_json_object(line, p) for p in json_paths]
    if unfit == "fail":
        return lines.select(*[strict(v, StringType(), f.dataType, f.name).alias(f.name) for v, f in zip(values, schema.fields)])
    return lines.select(
        *[lenient(v, StringType(), f.dataType).alias(f.name) for v, f in zip(values, schema.fields)]
    )


def copy_by_name(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    object_files: bool = False,
    fail: bool = True,
    unfit: str = "null",
) -> DataFrame:
    """JSON lines, or one object per file, loaded by field name: missing fields are null, extra fields ignored.

    Text that is no JSON fails the load, or without ``fail`` gives nulls. A value that does not fit its column is null, or
    stops the load with ``unfit="fail"``.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema])
    reader = spark.read.schema(text).option("multiLine", object_files).option("mode", _mode(fail))
    return conform(reader.json(path), schema, unfit)


def _mode(fail: bool) -> str:
    return "FAILFAST" if fail else "PERMISSIVE"
