"""CSV records over several lines, read in splits."""

import csv
import os
import random

import pytest

from playlake import schemas
from playlake.plans import build_serving
from playlake.sources import read_csv_records
from playlake.sources.records import csv_lines, records
from tests.conftest import SMALL
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

SCHEMA = StructType([StructField("a", IntegerType()), StructField("b", StringType()), StructField("c", StringType())])


def write(path, rows, header=("a", "b", "c"), end="\n"):
    with open(path, "w", encoding="utf8", newline="") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)


def random_rows(seed, n):
    dice = random.Random(seed)
    texts = ["x", 'a "quoted" word', "two\nlines", '\n"\n"\n', "comma, comma", "é\n\nü", '"', "\n" * 5, "plain" * 30]
    return [(i, dice.choice(texts), dice.choice(texts)) for i in range(n)]


def test_records_across_splits(spark, out):
    """Files cut into splits of a few hundred bytes, so that splits begin within fields, and some have no beginning of a record."""
    rows = {f"{out}/{k}.csv": random_rows(k, 150) + [(999, "long\n" * 300, "end")] for k in range(3)}
    for path, own in rows.items():
        write(path, own)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = csv_lines(spark, out, name_glob="*.csv")
        assert lines.select("split").distinct().count() >= 12
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    texts = records(lines).collect()
    found = {path: sorted(next(csv.reader([r["value"]], strict=True)) if "\n" not in r["value"] else next(csv.reader(r["value"].splitlines(True))) for r in texts if r["file"].endswith(os.path.basename(path))) for path in rows}
    for path, own in rows.items():
        assert found[path] == sorted([str(a), b, c] for a, b, c in own)


@pytest.mark.parametrize("bits", [0, 2, 5])
def test_records_across_pieces(spark, out, monkeypatch, bits):
    """The lines of a split are taken in pieces of 1, 4 or 32, whose borders fall into fields."""
    monkeypatch.setattr("playlake.sources.records.PIECE_BITS", bits)
    rows = {f"{out}/{k}.csv": random_rows(k + 7, 60) + [(999, "long\n" * 50, "end")] for k in range(2)}
    for path, own in rows.items():
        write(path, own)
    texts = [r["value"] for r in records(csv_lines(spark, out, name_glob="*.csv")).collect()]
    found = sorted(next(csv.reader(text.splitlines(True))) for text in texts)
    assert found == sorted([str(a), b, c] for own in rows.values() for a, b, c in own)


def test_inputs_are_written_by_many_tasks(spark, out, monkeypatch):
    """No task holds all rows: events in eight parts give as many files, each with its header."""
    from pyspark.sql import functions as F

    from playlake.workload import file_queries

    parts = file_queries.staged_events(spark, SMALL).repartition(8).cache()
    monkeypatch.setattr(file_queries, "staged_events", lambda spark, sf_dir: parts)
    path = file_queries.write_multiline_csv(spark, SMALL)
    assert spark.read.text(path).select("_metadata.file_path").distinct().count() == 8
    header = ",".join(schemas.EVENT_CSV.names)
    lines = parts.select(F.col("page").alias("value"))
    file_queries.with_headers(lines, header).write.text(out + "/lines")
    by_file = spark.read.text(out + "/lines").groupBy("_metadata.file_path").agg(F.sum((F.col("value") == header).cast("int")).alias("n"))
    assert [r["n"] for r in by_file.collect()] == [1] * 8
    assert spark.read.text(out + "/lines").count() == parts.count() + 8
    read = file_queries.csv_rejected(spark, SMALL)
    assert read.filter("page = 'kept'").collect()[0]["session_id"] + read.count() - 1 == parts.count()
    parts.unpersist()


def test_values_and_damaged_rows(spark, out):
    write(f"{out}/a.csv", [(1, "two\nlines", "x"), ("no number", "y", "z"), (2, "q", 'a "b"\n c')], end="\r\n")
    with open(f"{out}/a.csv", "a", newline="") as f:
        f.write("3,short\r\n\r\n4,too,many,columns\r\n5,,last")
    rows = read_csv_records(spark, out, SCHEMA).collect()
    good = sorted(tuple(r)[:3] for r in rows if r[schemas.CORRUPT_COLUMN] is None)
    assert good == [(1, "two\nlines", "x"), (2, "q", 'a "b"\n c'), (5, None, "last")]
    assert sorted(r[schemas.CORRUPT_COLUMN] for r in rows if r[schemas.CORRUPT_COLUMN]) == ["3,short", "4,too,many,columns", "no number,y,z"]


def test_files_without_line_breaks_and_empty_files(spark, out):
    write(f"{out}/a.csv", [(1, "x", "y")])
    write(f"{out}/b.csv", [])
    open(f"{out}/c.csv", "w").close()
    assert [tuple(r) for r in read_csv_records(spark, out, SCHEMA).collect()] == [(1, "x", "y", None)]


def test_a_quote_that_is_never_closed(spark, out):
    with open(f"{out}/a.csv", "w") as f:
        f.write('a,b,c\n1,x,y\n2,"open,z\n' + "3,x,y\n" * 50)
    rows = records(csv_lines(spark, out), most_lines=20).collect()
    assert sorted(r["value"] for r in rows) == ["1,x,y", '2,"open,z'] + ["3,x,y"] * 50
    whole = records(csv_lines(spark, out)).collect()
    assert len(whole) == 2


def test_serving_tables_of_fields_with_line_breaks(spark, out):
    os.makedirs(out + "/csv")
    names = schemas.EVENT_CSV.names
    row = dict.fromkeys(names, "") | {"artist": "A\nB", "sessionId": 1, "itemInSession": 2, "userId": 3, "song": "S", "location": "x,\n\ny", "ts": "1E3", "page": "NextSong"}
    rows = [row, row | {"userId": "who?"}, row | {"itemInSession": 3, "userId": ""}]
    write(out + "/csv/1.csv", [[r[n] for n in names] for r in rows], names)
    with pytest.raises(Exception, match="null in key column userId"):
        build_serving(spark, out + "/csv", out + "/stop")
    tables = build_serving(spark, out + "/csv", out + "/t", null_keys="drop")
    assert [r["artist"] for r in tables["session_item"].collect()] == ["A\nB"] * 2
    assert tables["user_session"].count() == 1
    assert ["who?" in r[schemas.CORRUPT_COLUMN] for r in tables["rejected"].collect()] == [True]
