"""Hand-made edge rows in the shape of the raw inputs."""

from playlake import schemas


def event(**fields):
    base = dict(
        artist="Ann", auth="Logged In", firstName="Flo", gender="F", itemInSession=0, lastName="Lee", length=200.5,
        level="free", location="Rome, IT", method="PUT", page="NextSong", registration=1.5e12, sessionId=1, song="Hey",
        status=200, ts=1541105830796, userAgent="agent", userId=7,
    )
    return base | fields


def song(**fields):
    base = dict(
        num_songs=1, artist_id="A1", artist_latitude=None, artist_longitude=None, artist_location="", artist_name="Ann",
        song_id="S1", title="Hey", duration=200.5, year=0,
    )
    return base | fields


def events(spark, *rows):
    return spark.createDataFrame([event(**r) for r in rows], schemas.STAGING_EVENTS)


def songs(spark, *rows):
    return spark.createDataFrame([song(**r) for r in rows], schemas.SONG_META)


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
