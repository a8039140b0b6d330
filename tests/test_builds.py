"""The builds from hand-made files, through the command line."""

import csv
import datetime
import json
import os

import pytest

from playlake.__main__ import main
from playlake.operators import quality
from playlake.plans import build_lake, build_warehouse
from playlake.plans.serving import read_consolidated
from playlake.schemas import SONGPLAYS
from playlake.sinks import create_database
from tests.rows import event, song, tuples
from tests.test_streaming import log

PLAYS = (
    {},
    {},
    dict(ts=1541105830100, userId=8, level="paid"),
    dict(ts=1541192230000, song="Other", artist="Bob"),
    dict(page="Home", song=None, artist=None, length=None, userId=None),
)


@pytest.fixture
def files(out):
    os.makedirs(out + "/logs/2018/11")
    with open(out + "/logs/2018/11/a.json", "w") as f:
        f.writelines(json.dumps(log(**row)) + "\n" for row in PLAYS)
        f.write('{"artist": "cut\n')
    os.makedirs(out + "/songs/A/B")
    for i, row in enumerate([song(), song(song_id="S2", artist_id="A2", artist_name="Bob")]):
        with open(f"{out}/songs/A/B/{i}.json", "w") as f:
            f.write(json.dumps(row))
    return out


def test_lake(spark, files, capsys):
    songs, logs = files + "/songs/*/*/*.json", files + "/logs/*/*/*.json"
    main(["lake", "--songs", songs, "--logs", logs, "--out", files + "/lake"])
    assert "rejected_events: 1 rows" in capsys.readouterr().out
    plays = spark.read.parquet(files + "/lake/songplays")
    # The copy among the log rows is merged; both songs have the title, so each play gives two rows.
    assert tuples(plays, "user_id", "song_id") == [("7", "S1"), ("7", "S2"), ("8", "S1"), ("8", "S2")]
    assert plays.select("songplay_id").distinct().count() == 4
    assert tuples(plays.select("start_time").distinct()) == [(datetime.datetime(2018, 11, 1, 20, 57, 10),)]
    assert os.path.isdir(files + "/lake/songplays/year=2018/month=11")
    assert os.path.isdir(files + "/lake/songs/year=0")
    assert spark.read.parquet(files + "/lake/time_table").count() == 3
    assert spark.read.parquet(files + "/lake/users").count() == 2


def test_lake_parted_by_artist(spark, files):
    paths = files + "/songs/*/*/*.json", files + "/logs/*/*/*.json"
    by_year = build_lake(spark, *paths, files + "/a")
    by_artist = build_lake(spark, *paths, files + "/b", song_partitions=("year", "artist_id"))
    assert os.path.isdir(files + "/b/songs/year=0/artist_id=A1")
    for table in ("songs", "songplays"):
        columns = sorted(set(by_year[table].columns) - {"songplay_id"})
        assert tuples(by_year[table], *columns) == tuples(by_artist[table], *columns)


def test_warehouse(spark, files):
    create_database(spark, "house", files + "/house", replace=True)
    try:
        paths = files + "/songs/*/*/*.json", files + "/logs/*/*/*.json"
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            build_warehouse(spark, *paths, "house")
        tables = build_warehouse(spark, *paths, "house", fail=False)
        assert tuples(tables["songplays"].select(*SONGPLAYS.names), "songplay_id", "user_id", "song_id") == [
            (1, 7, "S1"), (2, 8, "S1"),
        ]
        assert tuples(tables["time"], "weekday") == [("Friday   ",), ("Thursday ",), (None,)]
        # All events, also those that are no plays, and the cut line as a row of nulls.
        assert tables["staging_events"].count() == 6
        assert tuples(tables["users"], "user_id", "level") == [(7, "free"), (8, "paid")]
        assert "varchar(50)" in spark.sql("SHOW CREATE TABLE house.users").first()[0].lower()
        for table, rules in quality.WAREHOUSE_RULES.items():
            assert quality.broken_rows(tables[table], rules).count() == 0
    finally:
        spark.sql("DROP DATABASE house CASCADE")


def test_star_then_new_files(spark, files, capsys):
    main(["star", "--songs", files + "/songs", "--logs", files + "/logs", "--out", files + "/star"])
    assert "violations: 0 rows" in capsys.readouterr().out
    plays = spark.read.parquet(files + "/star/songplays")
    assert tuples(plays, "songplay_id", "user_id", "song_id") == [
        (1, 8, "S1"), (2, 7, "S1"), (3, 7, "S1"), (4, 7, None),
    ]
    load = ["load", "--star", files + "/star", "--logs", files + "/logs", "--out", files + "/live"]
    main([*load, "--checkpoint", files + "/checkpoint"])
    assert "songplays: 4 rows" in capsys.readouterr().out
    main([*load, "--checkpoint", files + "/checkpoint"])
    assert "songplays: 4 rows" in capsys.readouterr().out


def test_serving(spark, out, capsys):
    names = [n for n in event() if n != "userAgent"]
    rows = [
        event(itemInSession=1, artist='The "Q"', location="Rome, IT"),
        event(itemInSession=2, firstName="Flora"),
        event(itemInSession=3, artist="", song="", userId=""),
    ]
    os.makedirs(out + "/csv/sub")
    for i, row in enumerate(rows):
        with open(f"{out}/csv/sub/{i}.csv", "w", newline="") as f:
            writer = csv.writer(f)
            writer.writerow(names)
            writer.writerow([row[n] for n in names])
    main(["serving", "--csv", out + "/csv", "--out", out + "/serving"])
    printed = capsys.readouterr().out
    assert "events_csv: 2 rows" in printed and "song_users: 1 rows" in printed
    assert tuples(spark.read.parquet(out + "/serving/song_users")) == [("Hey", 7, "Flora", "Lee")]
    assert tuples(read_consolidated(spark, out + "/serving/events_csv")) == tuples(
        spark.read.parquet(out + "/serving/staging")
    )
    items = spark.read.parquet(out + "/serving/session_item")
    assert tuples(items, "itemInSession", "artist") == [(1, 'The "Q"'), (2, "Ann")]
