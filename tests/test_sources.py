"""Scans and loads: damaged lines, odd CSV fields, partition values, JSONPaths."""

import os

import pytest
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

from playlake import schemas, sinks, sources
from tests.rows import songs, tuples

SCHEMA = StructType().add("a", LongType()).add("b", StringType())


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as f:
        f.write(text)


def test_damaged_lines_are_set_aside_whatever_is_selected(spark, out):
    write(f"{out}/x.json", '{"a": 1, "b": "x"}\n{"a": "one", "b": "y"}\n{"a": 2, "b"\n{"b": "z", "c": 3}\n')
    good, bad = sources.split_corrupt(sources.read_json_lines(spark, out, SCHEMA, corrupt=schemas.CORRUPT_COLUMN))
    assert tuples(good) == [(1, "x"), (None, "z")]
    # The line with a wrongly typed "a" stays out even when only "b" is asked for.
    assert tuples(good, "b") == [("x",), ("z",)]
    assert tuples(bad, schemas.CORRUPT_COLUMN) == [('{"a": "one", "b": "y"}',), ('{"a": 2, "b"',)]


def test_object_files(spark, out):
    write(f"{out}/A/B/1.json", '{\n "a": 1,\n "b": "x"\n}')
    write(f"{out}/A/C/2.json", '{"a": 2}')
    write(f"{out}/A/C/notes.txt", "no json")
    found = sources.read_json_objects(spark, out, SCHEMA)
    assert tuples(found) == [(1, "x"), (2, None)]
    assert tuples(sources.count_files(found)) == [(2, 2)]


def test_glob_and_recursion_find_the_same(spark, out):
    write(f"{out}/2018/11/a.json", '{"a": 1}\n{"a": 2}\n')
    write(f"{out}/2018/12/b.json", '{"a": 3}\n')
    deep = sources.read_json_lines(spark, out, SCHEMA, recursive=True, name_glob="*.json")
    assert tuples(deep, "a") == tuples(sources.read_json_lines(spark, f"{out}/*/*/*.json", SCHEMA), "a")
    assert tuples(sources.count_files(deep)) == [(2, 3)]


def test_csv_quotes_commas_and_headers(spark, out):
    write(f"{out}/1.csv", 'a,b\n1,"Sioux ""Falls"", SD"\n2,\n')
    write(f"{out}/2.csv", "a,b\n3,\\plain\n")
    assert tuples(sources.read_csv(spark, out, SCHEMA)) == [(1, 'Sioux "Falls", SD'), (2, None), (3, "\\plain")]
    assert dict(sources.read_csv_inferred(spark, out).dtypes) == {"a": "int", "b": "string"}


def test_csv_line_break_in_field(spark, out):
    write(f"{out}/1.csv", 'a,b\n1,"two\nlines"\n')
    assert tuples(sources.read_csv(spark, out, SCHEMA, multi_line=True)) == [(1, "two\nlines")]


def test_copy_by_paths(spark, out):
    write(f"{out}/x.json", '{"u": "", "n": {"k": "5"}, "t": 1541105830796, "l": [7, 8]}\n{"u": "26", "n": {}}\n')
    schema = StructType().add("user", IntegerType()).add("k", LongType()).add("t", LongType())
    found = sources.copy_by_paths(spark, out, ("$['u']", "$.n.k", "$['t']"), schema)
    assert tuples(found) == [(26, None, None), (None, 5, 1541105830796)]
    listed = schema.add("last", DoubleType())
    found = sources.copy_by_paths(spark, out, ("$['u']", "$.n.k", "$['t']", "$.l[1]"), listed)
    assert tuples(found) == [(26, None, None, None), (None, 5, 1541105830796, 8.0)]
    overlapping = StructType().add("n", StringType()).add("k", LongType())
    assert tuples(sources.copy_by_paths(spark, out, ("$.n", "$.n.k"), overlapping)) == [('{"k":"5"}', 5), ("{}", None)]
    with pytest.raises(ValueError):
        sources.copy_by_paths(spark, out, ("$.n",), overlapping)


@pytest.mark.parametrize("json_path", ["$.u", "$.l[0]"])
def test_copy_of_damaged_lines(spark, out, json_path):
    write(f"{out}/x.json", '{"u": "1", "l": [1]}\n{"u": \n')
    schema = StructType().add("u", LongType())
    assert tuples(sources.copy_by_paths(spark, out, (json_path,), schema, fail=False)) == [(1,), (None,)]
    with pytest.raises(Exception, match="MALFORMED_RECORD|no JSON"):
        sources.copy_by_paths(spark, out, (json_path,), schema).collect()


def test_copy_by_name(spark, out):
    write(f"{out}/x.json", '{"song_id": "S1", "year": "1982.0", "duration": "n/a", "more": 1}\n')
    row = sources.copy_by_name(spark, out, schemas.STAGING_SONGS).first()
    assert (row["song_id"], row["year"], row["duration"], row["title"]) == ("S1", 1982, None, None)


def test_partition_values_keep_their_type(spark, out):
    rows = songs(spark, dict(artist_id="007"), dict(artist_id="", song_id="S2"), dict(artist_id=None, song_id="S3"))
    sinks.write_parquet(rows.select(*schemas.SONGS.names), out + "/t", ("year", "artist_id"))
    found = sources.read_partitioned(spark, out + "/t", schemas.SONGS, "*/*/")
    # An empty partition value comes back as null: nothing tells the two apart on disk.
    assert tuples(found, "song_id", "artist_id", "year") == [("S1", "007", 0), ("S2", None, 0), ("S3", None, 0)]
    assert set(sources.read_leaves(spark, out + "/t").columns) == {"song_id", "title", "duration"}


def test_partition_filter_prunes(spark, out):
    from playlake.operators.profile import plan_text

    sinks.write_parquet(songs(spark, {}, dict(year=1999)).select(*schemas.SONGS.names), out + "/t", ("year",))
    text = plan_text(sources.read_partitioned(spark, out + "/t", schemas.SONGS).filter("year = 1999"))
    assert "PartitionFilters: [isnotnull(year" in text


def test_listed_files(spark, out):
    os.makedirs(out + "/d/e")
    for name in ("d/a.json", "d/e/b.json", "d/e/c.txt"):
        write(f"{out}/{name}", "no json at all")
    assert tuples(sources.count_listed(spark, out + "/d", "*.json")) == [(2,)]
    assert tuples(sources.count_listed(spark, out + "/d")) == [(3,)]
