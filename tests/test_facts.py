"""Match rules, time precision, copies and the null side of the fact."""

import datetime

from pyspark.sql import functions as F

from playlake.operators import dims, facts, ids
from playlake.plans.star import songplay_facts
from tests.rows import events, songs, tuples


def catalog(spark):
    return songs(
        spark,
        dict(song_id="S2", duration=200.5),
        dict(song_id="S1", duration=200.5),
        dict(song_id="S3", duration=99.0),
        dict(song_id="S4", artist_id="A2", artist_name="Bob"),
        dict(song_id="S5", title="Other"),
        dict(song_id="S6", title=None),
    )


def test_match_rules_differ(spark):
    plays = events(spark, {})
    found = {m: facts.match_songs(plays, catalog(spark), m) for m in facts.MATCH_RULES}
    assert tuples(found["title"], "song_id") == [("S1",), ("S2",), ("S3",), ("S4",)]
    assert tuples(found["title_artist"], "song_id") == [("S1",), ("S2",), ("S3",)]
    assert tuples(found["exact"], "song_id") == [("S1",), ("S2",)]


def test_lookup_keeps_each_play_once(spark):
    plays = events(spark, {}, dict(song="Nope"), dict(song=None, artist=None, length=None), dict(length=1.0))
    found = facts.match_songs(plays, catalog(spark), "exact", "left", first_only=True)
    assert tuples(found, "song", "length", "song_id", "artist_id") == [
        ("Hey", 1.0, None, None),
        ("Hey", 200.5, "S1", "A1"),
        ("Nope", 200.5, None, None),
        (None, None, None, None),
    ]


def test_catalog_leaves_out_songs_without_artist(spark):
    artists = spark.createDataFrame([("A1", "Ann")], "artist_id string, name string")
    assert "S4" not in {r[0] for r in tuples(facts.song_catalog(catalog(spark), artists), "song_id")}


def test_time_join_does_not_repeat_plays(spark):
    rows = events(spark, dict(ts=1541105830100), dict(ts=1541105830900, userId=8))
    plays = facts.songplay_rows(facts.match_songs(rows, songs(spark, {}), "title"))
    joined = facts.join_time(plays, dims.time_dimension(rows, keep_ts=True))
    assert joined.count() == 2
    assert tuples(joined) == tuples(facts.with_year_month(plays))
    assert tuples(joined, "year", "month") == [(2018, 11), (2018, 11)]


def test_copies_are_kept_or_merged(spark):
    rows = events(spark, {}, {}, dict(ts=1541105830999))
    plays = facts.songplay_rows(rows.withColumns({"song_id": F.lit("S1"), "artist_id": F.lit("A1")}))
    assert ids.spread_ids(plays).select("songplay_id").distinct().count() == 3
    # Same second, all else equal: one row where rows are made distinct before they get an id.
    assert tuples(ids.identity_ids(plays), "songplay_id") == [(1,)]


def test_star_facts_keep_milliseconds_and_copies(spark, out):
    events(spark, {}, {}, dict(ts=1541105830795), dict(song="Nope", ts=1541105830797)).write.parquet(out + "/plays")
    plays = spark.read.parquet(out + "/plays")
    numbered = ids.serial_ids(plays, ["ts", "sessionId", "itemInSession"], from_scan=True)
    found = songplay_facts(numbered, facts.first_song(songs(spark, {})))
    got = tuples(found, "songplay_id", "start_time", "song_id")
    assert [r[0] for r in got] == [1, 2, 3, 4]
    assert got[0][1] == datetime.datetime(2018, 11, 1, 20, 57, 10, 795000)
    assert [r[2] for r in got] == ["S1", "S1", "S1", None]
