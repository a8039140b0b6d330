"""A star that takes in log files and song files as they come and equals the star of one run over all of them.

Every batch writes folders of its own and is committed in the manifest by one rename, see :mod:`playlake.streaming.manifest`. Users, songs and artists
are kept as states that fold in any order. Plays are numbered on from the last id. Song files may come after the plays they
belong to: each batch of songs compares the first song of every match key before and after, and only for keys that changed looks for earlier plays; what
these find is kept as patches, the latest of which counts. Damaged lines go to a table of their own, judged as the whole builds judge them.

A load can go on from a star that :func:`playlake.plans.star.build_star` has built: its states and ids are made again from its staged rows.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake.functions.casts import conform
from playlake.operators import dims, facts
from playlake.operators.ids import arrival_ids, serial_ids
from playlake.operators.joins import skew_join
from playlake.operators.upsert import ARTISTS_RULE, SONGS_RULE, USERS_RULE, fold, from_state, to_state
from playlake.plans.star import artist_rows, user_rows
from playlake.schemas import CORRUPT_COLUMN, EVENT_LOG, SONG_META, STAGING_EVENTS, STAR
from playlake.sources.judged import judged
from playlake.storage import materialize
from playlake.streaming.manifest import Manifest

_RULES = {"users": USERS_RULE, "songs": SONGS_RULE, "artists": ARTISTS_RULE}
_KEYS = tuple(facts.MATCH_RULES["exact"])  # of a play; the catalog's are the values
_FIRST = "title string, artist_name string, duration double, song_id string, artist_id string"
_REJECTED = "file string, corrupt_record string"


def read_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None, whole: bool = False, name_glob: str | None = None) -> DataFrame:
    """A stream of lines, or of whole files as one text, below ``path``, each with its file and that file's size and time."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", True).option("wholetext", whole)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return with_files(reader.load(path))


def with_files(scan: DataFrame) -> DataFrame:
    about = {"file": "file_path", "size": "file_size", "modified": "file_modification_time"}
    return scan.select("value", *[F.col(f"_metadata.{old}").alias(new) for new, old in about.items()])


class StarLoad:
    """The star at ``out``. ``null_keys`` as in :func:`playlake.operators.upsert.to_state`."""

    def __init__(self, spark: SparkSession, out: str, page: str = dims.PLAY_PAGE, null_keys: str = "error"):
        self.spark, self.out, self.page, self.null_keys = spark, out, page, null_keys
        self.manifest = Manifest(spark, out)
        self.known: dict[str, list[tuple[int, str, int | None]]] = {}

    def _begin(self) -> tuple[str, int]:
        """A folder and the version of the next commit; reads what is committed."""
        self.known = self.manifest.tables()
        return f"{self.out}/batches/{uuid.uuid4().hex}", 1 + max((v for commits in self.known.values() for v, _, _ in commits), default=0)

    def _paths(self, table: str) -> list[str]:
        return [path for _, path, _ in self.known.get(table, [])]

    def _parsed(self, batch: DataFrame, schema, place: str) -> DataFrame | None:
        """The new lines of a batch, parsed and written; None if all its files are loaded already."""
        parsed = materialize(judged(self.manifest.new_rows(batch), schema), "parsed", f"{place}/parsed")
        return None if parsed.isEmpty() else parsed

    def _rejected(self, parsed: DataFrame, place: str) -> str:
        bad = parsed.filter(F.col(CORRUPT_COLUMN).isNotNull())
        bad.select("file", F.col(CORRUPT_COLUMN).alias("corrupt_record")).write.parquet(f"{place}/rejected")
        return f"{place}/rejected"

    def _state(self, rows: DataFrame, table: str, place: str) -> str:
        to_state(rows, _RULES[table], self.null_keys).write.parquet(f"{place}/{table}")
        return f"{place}/{table}"

    def _first_songs(self) -> DataFrame:
        paths = self._paths("catalog")
        return self.spark.read.schema(_FIRST).parquet(paths[-1]) if paths else self.spark.createDataFrame([], _FIRST)

    def _facts(self, numbered: DataFrame, first_songs: DataFrame, place: str) -> str:
        """Plays with their songs and, for songs still to come, their match keys."""
        matched = facts.match_songs(numbered, first_songs, "exact", how="left")
        facts.songplay_rows(matched, "milli", "songplay_id", *_KEYS).write.parquet(f"{place}/songplays")
        return f"{place}/songplays"

    def load_events(self, batch: DataFrame, batch_id: int = 0) -> None:
        """Take in log lines (value, file, size, modified), for ``foreachBatch`` or by itself."""
        place, version = self._begin()
        parsed = self._parsed(batch, EVENT_LOG, place)
        if parsed is None:
            return
        good = parsed.filter(F.col(CORRUPT_COLUMN).isNull())
        plays = materialize(conform(dims.plays(good, self.page), STAGING_EVENTS), "plays", f"{place}/plays")
        dims.time_dimension(plays, self.page, "milli", "name").write.parquet(f"{place}/time")
        numbered = arrival_ids(plays, start=sum(n for _, _, n in self.known.get("songplays", [])) + 1)
        tables = {
            "users": (self._state(user_rows(plays), "users", place), None),
            "time": (f"{place}/time", None),
            "songplays": (self._facts(numbered, self._first_songs(), place), plays.count()),
            "rejected_events": (self._rejected(parsed, place), None),
        }
        self.manifest.commit(version, parsed.select("file", "size", "modified"), tables)

    def load_songs(self, batch: DataFrame, batch_id: int = 0) -> None:
        """Take in song objects (value, file, size, modified), before or after the plays of these songs."""
        place, version = self._begin()
        parsed = self._parsed(batch, SONG_META, place)
        if parsed is None:
            return
        good = parsed.filter(F.col(CORRUPT_COLUMN).isNull())
        tables = self._song_tables(good, place)
        before = self._first_songs()
        catalog = facts.first_song(facts.song_catalog(self._folded("songs", tables["songs"][0]), self._folded("artists", tables["artists"][0])))
        after = materialize(catalog, "catalog", f"{place}/catalog")
        tables |= {"catalog": (f"{place}/catalog", None), "rejected_songs": (self._rejected(parsed, place), None)}
        if self._paths("songplays"):
            self._patch(before, after, version, place)
            tables["patches"] = (f"{place}/patches", None)
        self.manifest.commit(version, parsed.select("file", "size", "modified"), tables)

    def _song_tables(self, good: DataFrame, place: str) -> dict[str, tuple[str, int | None]]:
        return {
            "artists": (self._state(artist_rows(good), "artists", place), None),
            "songs": (self._state(good.select(*dims.SONG_COLUMNS), "songs", place), None),
        }

    def _patch(self, before: DataFrame, after: DataFrame, version: int, place: str) -> None:
        """Earlier plays whose match key has another first song now, or none any more."""
        keys = list(facts.MATCH_RULES["exact"].values())
        sides = [side.select(*keys, F.struct("song_id", "artist_id").alias(name)) for side, name in ((before, "old"), (after, "new"))]
        changed = sides[0].join(sides[1], keys, "full").filter(~F.col("old").eqNullSafe(F.col("new")))
        changed = changed.select(*[F.col(c).alias(f"_{c}") for c in keys], "new.song_id", "new.artist_id")
        plays = self.spark.read.parquet(*self._paths("songplays")).select("songplay_id", *_KEYS)
        met = skew_join(plays, changed, {play: f"_{song}" for play, song in facts.MATCH_RULES["exact"].items()}, "inner")
        met.select("songplay_id", F.lit(version).cast("long").alias("version"), "song_id", "artist_id").write.parquet(f"{place}/patches")

    def _folded(self, table: str, *more: str) -> DataFrame | None:
        """An upserted table from the states of all commits, and of folders not committed yet."""
        paths, rule = [*self._paths(table), *more], _RULES[table]
        return from_state(fold(self.spark.read.parquet(*paths), rule), rule) if paths else None

    def seed(self, star: str, songs: str | None = None, logs: str | None = None, plays: bool = True) -> None:
        """Go on from the star that was built at ``star`` of the files below ``songs`` and ``logs``: these count as loaded. Without
        ``plays`` only its songs and artists are taken."""
        place, version = self._begin()
        if version > 1:
            raise ValueError(f"{self.out} holds a load already; only an empty one can go on from a star")
        staged = {"rejected_songs": self.spark.read.parquet(f"{star}/staging/songs")}
        tables = self._song_tables(staged["rejected_songs"].filter(F.col(CORRUPT_COLUMN).isNull()), place)
        catalog = facts.first_song(facts.song_catalog(self._folded("songs", tables["songs"][0]), self._folded("artists", tables["artists"][0])))
        first_songs = materialize(catalog, "catalog", f"{place}/catalog")
        tables["catalog"] = (f"{place}/catalog", None)
        if plays:
            staged["rejected_events"] = self.spark.read.parquet(f"{star}/staging/events")
            tables |= self._built_plays(star, staged["rejected_events"].filter(F.col(CORRUPT_COLUMN).isNull()), first_songs, place)
        for name, rows in staged.items():
            bad = rows.filter(F.col(CORRUPT_COLUMN).isNotNull())
            bad.select(F.lit(None).cast("string").alias("file"), F.col(CORRUPT_COLUMN).alias("corrupt_record")).write.parquet(f"{place}/{name}")
            tables[name] = (f"{place}/{name}", None)
        self.manifest.commit(version, self._listed([path for path in (songs, logs) if path]), tables)

    def _built_plays(self, star: str, log: DataFrame, first_songs: DataFrame, place: str) -> dict[str, tuple[str, int | None]]:
        """Users, times and plays of a built star, made again from its staged log with the ids they have there."""
        plays = conform(dims.plays(log.drop(CORRUPT_COLUMN), self.page), STAGING_EVENTS)
        self.spark.read.schema(STAR["time"]).parquet(f"{star}/time").write.parquet(f"{place}/time")
        # The order that the build numbers plays by.
        numbered = serial_ids(plays, ["ts", "sessionId", "itemInSession"], from_scan=True)
        songplays = self._facts(numbered, first_songs, place)
        n_plays = self.spark.read.parquet(songplays).count()
        built = self.spark.read.schema(STAR["songplays"]).parquet(f"{star}/songplays").agg(F.max("songplay_id")).first()[0] or 0
        if built != n_plays:
            raise ValueError(f"{star} has plays up to {built}, but {n_plays} are staged")
        return {
            "users": (self._state(user_rows(plays), "users", place), None),
            "time": (f"{place}/time", None),
            "songplays": (songplays, n_plays),
        }

    def _listed(self, paths: list[str]) -> DataFrame:
        """(file, size, modified) of the files below ``paths``; their content is not read."""
        if not paths:
            return self.spark.createDataFrame([], "file string, size long, modified timestamp")
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
        return files.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))

    def tables(self) -> dict[str, DataFrame]:
        """The star as of the last commit, with the rejected lines."""
        self.known = self.manifest.tables()
        out = {name: self._folded(name) for name in _RULES}
        out = {name: self.spark.createDataFrame([], STAR[name]) if df is None else df.select(*STAR[name].names) for name, df in out.items()}
        out["time"] = self._union("time", STAR["time"]).distinct()
        plays, patches = self._union("songplays", STAR["songplays"]), self._paths("patches")
        if patches:
            latest = self.spark.read.parquet(*patches).groupBy(F.col("songplay_id").alias("_id"))
            latest = latest.agg(F.max_by(F.struct("song_id", "artist_id"), "version").alias("_now"))
            met = plays.join(latest, F.col("songplay_id") == F.col("_id"), "left")
            now = {c: F.when(F.col("_id").isNotNull(), F.col(f"_now.{c}")).otherwise(F.col(c)).alias(c) for c in ("song_id", "artist_id")}
            plays = met.select(*[now.get(c, F.col(c)) for c in STAR["songplays"].names])
        out["songplays"] = plays
        for name in ("rejected_songs", "rejected_events"):
            out[name] = self._union(name, _REJECTED)
        return out

    def _union(self, name: str, schema) -> DataFrame:
        paths = self._paths(name)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
