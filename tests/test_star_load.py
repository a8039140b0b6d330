"""A star that takes in files as they come: any order, replays, late songs, damaged lines, a built star below it."""

import json
import os

import pytest

from playlake.__main__ import main
from playlake.plans import build_star
from playlake.streaming import incremental
from playlake.streaming.manifest import Manifest
from playlake.streaming.star_load import StarLoad, read_lines, with_files
from tests.rows import event, song, tuples


def log(**fields):
    row = event(**fields)
    return row | {"userId": "" if row["userId"] is None else str(row["userId"])}


def write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as f:
        f.writelines((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines)


# Out of order: the file that comes first holds the newest rows.
FILES = (
    [dict(ts=3000, level="paid", firstName="New", itemInSession=3), dict(ts=3500, userId=8, itemInSession=4)],
    [dict(ts=1000, level="free", firstName="Old", itemInSession=1), dict(page="Home", userId=None, itemInSession=9)],
    [dict(ts=2000, level="free", song="Nope", itemInSession=2)] * 2,
)
DIMENSIONS = ("users", "time", "songs", "artists")


def run(spark, star, out, checkpoint="checkpoint", files=1):
    incremental.run_batches(read_lines(spark, out + "/logs", files), star.load_events, f"{out}/{checkpoint}").awaitTermination()
    return star.tables()


def take(spark, path, whole=False):
    return with_files(spark.read.option("recursiveFileLookup", True).option("wholetext", whole).text(path))


def same_star(got, whole):
    for table in DIMENSIONS:
        assert tuples(got[table]) == tuples(whole[table]), table
    assert tuples(got["songplays"].drop("songplay_id")) == tuples(whole["songplays"].drop("songplay_id"))
    n = whole["songplays"].count()
    assert tuples(got["songplays"], "songplay_id") == [(i + 1,) for i in range(n)]


def write_all(out, folder="logs"):
    for i, rows in enumerate(FILES):
        write_lines(f"{out}/{folder}/2018/{i}.json", [log(**r) for r in rows])


def test_file_by_file_equals_one_run(spark, out):
    write_lines(f"{out}/songs/1.json", [song()])
    star = StarLoad(spark, out + "/star")
    star.load_songs(take(spark, out + "/songs", whole=True))
    for i, rows in enumerate(FILES):
        write_lines(f"{out}/logs/2018/{i}.json", [log(**r) for r in rows])
        got = run(spark, star, out)
        assert got["songplays"].count() == sum(r.get("page") != "Home" for f in FILES[: i + 1] for r in f)
    whole = build_star(spark, out + "/songs", out + "/logs", out + "/whole")
    same_star(got, whole)
    assert tuples(got["users"], "user_id", "first_name", "level") == [(7, "Old", "paid"), (8, "Flo", "free")]
    assert whole["violations"].count() == 0

    # Another checkpoint, another number of files to a batch: nothing is new.
    version = star.manifest.version()
    same_star(run(spark, StarLoad(spark, out + "/star"), out, "other", files=3), whole)
    assert Manifest(spark, out + "/star").version() == version


def test_attempts_that_failed_are_not_read(spark, out):
    write_all(out)
    star = StarLoad(spark, out + "/star")

    def fail(*_):
        raise RuntimeError("lost")

    star.manifest.commit, commit = fail, star.manifest.commit
    with pytest.raises(RuntimeError):
        star.load_events(take(spark, out + "/logs"))
    assert star.tables()["songplays"].count() == 0 and star.manifest.version() == 0
    star.manifest.commit = commit
    star.load_events(take(spark, out + "/logs"))
    assert tuples(star.tables()["songplays"], "songplay_id") == [(i + 1,) for i in range(5)]


def test_a_file_that_changed_stops_the_load(spark, out):
    write_all(out)
    star = StarLoad(spark, out + "/star")
    star.load_events(take(spark, out + "/logs"))
    write_lines(f"{out}/logs/2018/1.json", [log(ts=1000), log(ts=1001), log(ts=1002)])
    with pytest.raises(Exception, match="changed since it was loaded"):
        star.load_events(take(spark, out + "/logs"))


def test_songs_after_their_plays(spark, out):
    """A later song with a smaller id, and an earlier one that renames its artist, change what plays match."""
    plays = [log(ts=1), log(ts=2, song="Other", artist="Band", length=9.0), log(ts=3, song="Third", artist="New name", length=5.0)]
    base = song()
    songs = [
        base | {"song_id": "S5"},
        base | {"song_id": "S2"},
        base | {"song_id": "S7", "title": "Third", "duration": 5.0, "artist_id": "AX", "artist_name": "Old name"},
        base | {"song_id": "S1", "title": "Fourth", "duration": 6.0, "artist_id": "AX", "artist_name": "New name"},
        base | {"song_id": "S9", "title": "Other", "duration": 9.0, "artist_id": "AB", "artist_name": "Band"},
    ]
    write_lines(f"{out}/logs/0.json", plays)
    star = StarLoad(spark, out + "/star")
    for i, row in enumerate(songs):
        write_lines(f"{out}/songs/{i}.json", [row])
        star.load_songs(take(spark, f"{out}/songs/{i}.json", whole=True))
        if i == 0:
            star.load_events(take(spark, out + "/logs"))
    whole = build_star(spark, out + "/songs", out + "/logs", out + "/whole")
    same_star(star.tables(), whole)
    assert tuples(star.tables()["songplays"], "song_id") == [("S2",), ("S7",), ("S9",)]


def test_damaged_lines_as_in_one_run(spark, out):
    bad = json.dumps(log(ts=4)).replace('"itemInSession": ', '"itemInSession": "no ').replace('"no 1', '"no 1"')
    write_lines(f"{out}/logs/0.json", [log(ts=1), json.dumps(log(ts=2))[:-1], bad, "", "[]", "null", log(ts=3)])
    write_lines(f"{out}/songs/1.json", [song()])
    whole = build_star(spark, out + "/songs", out + "/logs", out + "/whole")
    star = StarLoad(spark, out + "/star")
    star.load_songs(take(spark, out + "/songs", whole=True))
    star.load_events(take(spark, out + "/logs"))
    got = star.tables()
    same_star(got, whole)
    kept = set(tuples(whole["rejected_events"], "corrupt_record"))
    assert kept <= set(tuples(got["rejected_events"], "corrupt_record"))
    assert {os.path.basename(r["file"]) for r in got["rejected_events"].collect()} == {"0.json"}


def test_going_on_from_a_built_star(spark, out):
    write_lines(f"{out}/songs/1.json", [song()])
    write_all(out, "all")
    write_lines(f"{out}/logs/0.json", [log(**r) for r in FILES[0]])
    build_star(spark, out + "/songs", out + "/logs", out + "/built")
    star = StarLoad(spark, out + "/star")
    star.seed(out + "/built", out + "/songs", out + "/logs")
    for i in (1, 2):
        write_lines(f"{out}/logs/{i}.json", [log(**r) for r in FILES[i]])
        star.load_events(take(spark, out + "/logs"))  # the first file counts as loaded
    same_star(star.tables(), build_star(spark, out + "/songs", out + "/all", out + "/whole"))
    with pytest.raises(ValueError, match="already"):
        star.seed(out + "/built")


def test_null_keys(spark, out):
    write_lines(f"{out}/logs/0.json", [log(ts=1), log(ts=2, userId=None)])
    with pytest.raises(Exception, match="null in key column user_id"):
        StarLoad(spark, out + "/a").load_events(take(spark, out + "/logs"))
    star = StarLoad(spark, out + "/b", null_keys="drop")
    star.load_events(take(spark, out + "/logs"))
    assert star.tables()["users"].count() == 1 and star.tables()["songplays"].count() == 2


def test_command_line_goes_on_from_a_star(spark, out, capsys):
    write_lines(f"{out}/songs/1.json", [song()])
    write_lines(f"{out}/old/0.json", [log(**r) for r in FILES[0]])
    write_lines(f"{out}/logs/1.json", [log(**r) for r in FILES[2]])
    main(["--no-report", "star", "--songs", out + "/songs", "--logs", out + "/old", "--out", out + "/built"])
    load = ["load", "--star", out + "/built", "--go-on", "--logs", out + "/logs", "--out", out + "/live"]
    main([*load, "--checkpoint", out + "/c1"])
    main([*load, "--checkpoint", out + "/c2"])
    assert capsys.readouterr().out.count("songplays: 4 rows") == 2
