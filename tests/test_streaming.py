"""Topics and file-by-file loads: separators, replay, late files, repeated batches."""

import json
import os

from playlake import schemas
from playlake.operators import upsert as up
from playlake.streaming import incremental, topics
from tests.rows import event, tuples


def write_json(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def log(**fields):
    row = event(**fields)
    return row | {"userId": "" if row["userId"] is None else str(row["userId"])}


def test_split_and_join(spark):
    lines = spark.createDataFrame([("k,v,w",), ("alone",), (",v",)], "value string")
    pairs = topics.split_keyed(lines)
    assert tuples(pairs) == [("", "v"), ("k", "v,w"), (None, "alone")]
    assert tuples(pairs.select(topics.joined_keyed())) == [(",v",), ("k,v,w",), ("null,alone",)]
    wide = topics.split_keyed(spark.createDataFrame([("k::v:w",)], "value string"), "::")
    assert tuples(wide) == [("k", "v:w")]


def test_reader_goes_on_or_starts_over(spark, out):
    def consume(name, checkpoint):
        messages = topics.read_topic(spark, "text", {"path": out + "/in"})
        topics.write_topic(messages, "parquet", {"path": f"{out}/{name}"}, f"{out}/{checkpoint}").awaitTermination()
        return spark.read.schema("key string, value string").parquet(f"{out}/{name}").count()

    spark.createDataFrame([("a,1",), ("b,2",)], "value string").write.text(out + "/in")
    assert consume("group", "c1") == 2
    spark.createDataFrame([("c,3",)], "value string").write.mode("append").text(out + "/in")
    assert consume("group", "c1") == 3
    assert consume("again", "c2") == 3


def test_compaction_keeps_the_answer_and_later_batches(spark, out):
    rule = up.UpsertRule(keys=("k",), first=("a",), last=("b",), order=("t",))
    schema = "k int, a string, b string, t int"
    load = incremental.upsert_batches(rule, out + "/t")
    load(spark.createDataFrame([(1, "x", "p", 5)], schema), 0)
    load(spark.createDataFrame([(1, "y", "q", 9), (2, "z", "r", 1)], schema), 1)
    incremental.compact(spark, out + "/t", rule, out + "/c")
    load = incremental.upsert_batches(rule, out + "/c")
    load(spark.createDataFrame([(1, "first", "s", 0)], schema), 2)
    assert tuples(incremental.current_table(spark, out + "/c", rule)) == [(1, "first", "q"), (2, "z", "r")]


def test_files_per_batch(spark, out):
    for i in range(3):
        write_json(f"{out}/logs/{i}.json", [log()])
    seen = []
    stream = incremental.read_files(spark, out + "/logs", schemas.EVENT_LOG)
    run = incremental.run_batches(stream, lambda batch, i: seen.append((i, batch.count())), out + "/checkpoint")
    run.awaitTermination()
    assert seen == [(0, 1), (1, 1), (2, 1)]
