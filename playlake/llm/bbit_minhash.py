"""MinHash near-dedup on b-bit signatures.

A text's set of word shingles gives ``MINIMA`` minima under seeded multiplications of 64-bit hashes. Groups of ``ROWS`` minima are its
bands; texts that share a band are candidates. Of each minimum only the ``BITS`` lowest bits are kept, packed as planes of bits: two
signatures agree where the exclusive or of all planes is zero, so one count of bits gives the share of agreeing minima. Low bits also
agree by chance, one in ``2 ** BITS``, which is taken off: similarity = (share - chance) / (1 - chance). Candidates whose estimate a linked
pair reaches but once in 10^9 are dropped; all others are confirmed on their full sets of shingles.

Two texts at the least similarity share no band with a probability of (1 - 0.8 ** ROWS) ** bands, 2 in 10^9 here.

Texts with equal sets are one class. Classes in large groups are not compared in pairs: first each class is compared with one member of each of its
buckets (a star), and the confirmed links make components. Then only classes of different components are compared within a
bucket, those outside its largest component with all others, in blocks of ``BLOCK`` rows on either side. A first pass over the signatures finds the
classes that have a candidate at all, a second one brings the sets of these and confirms; it returns a link only where it joins what was apart. So no pass
returns more rows than it reads, whatever the size of a group, and no link between components is lost. The stars change the cost
only, not the result.

Null texts count as empty; a text without words has an empty set, no link and its own id as component. Rows with a null id take part;
the component of rows whose ids are all null is null. Repeated rows and ids are rows of their own. Sets are compared by 64-bit hashes of shingles
and known as equal by 128 bits. An empty table gives no rows. Texts of any length are read whole; further columns are not looked at.
"""

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from playlake.llm.common import quoted
from playlake.llm.components import components
from playlake.operators.joins import skew_join
from playlake.storage import materialize

MINIMA, ROWS, BITS = 256, 5, 4
BANDS = MINIMA // ROWS
#: 64-bit words of one plane of bits.
_WORDS = MINIMA // 64
#: Rows on either side of one comparison of blocks.
BLOCK = 4096
#: Rounds of stars before the comparison between components.
STARS = 2
#: Shingles that are multiplied at once, and hashes of words kept by a task.
_CHUNK, _MEMORY = 1024, 100_000

_dice = np.random.default_rng(13)
_FACTORS = _dice.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _dice.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_FACTORS = _dice.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """All bits of the input in all bits of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of shingles as sorted hashes; the hashes of words are remembered."""

    def __init__(self, words: int):
        self.words, self.memory = words, {}

    def of(self, text: str | None) -> np.ndarray:
        tokens = (text or "").encode().lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
        if len(self.memory) > _MEMORY:
            self.memory.clear()
        known, digest = self.memory, xxhash.xxh64_intdigest
        for token in set(tokens):
            if token not in known:
                known[token] = digest(token)
        hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        n = min(self.words, len(tokens))
        if not n:
            return hashes
        total = np.full(len(tokens) - n + 1, np.uint64(n))
        for k in range(n):
            total += hashes[k : len(tokens) - n + 1 + k] * _WORD_FACTORS[k]
        return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bands, and the planes of low bits, as signed 64-bit words."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        np.minimum(least, (_FACTORS[:, None] * shingles[None, at : at + _CHUNK]).min(axis=1), out=least)
    least >>= np.uint64(24)  # the low bits of a product are not well mixed
    grouped = least[: BANDS * ROWS].reshape(BANDS, ROWS)
    bands = _mixed((grouped * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _WORD_FACTORS[0])
    planes = [np.packbits((least >> np.uint64(b) & np.uint64(1)).astype(np.uint8)).view("<u8") for b in range(BITS)]
    return bands.view(np.int64), np.concatenate(planes).view(np.int64)


def least_agreement(percent: int, risk: float = 1e-9) -> int:
    """The most agreeing minima that a pair of the given similarity has fewer of with a probability of ``risk`` at most."""
    chance = 2.0**-BITS
    agree = chance + (1 - chance) * percent / 100
    below = 0.0
    for n in range(MINIMA + 1):
        below += comb(MINIMA, n) * agree**n * (1 - agree) ** (MINIMA - n)
        if below > risk:
            return n
    return MINIMA


def similarity(agreeing: Column) -> Column:
    """The estimate from agreeing minima, without the agreement by chance."""
    chance = 2.0**-BITS
    return (agreeing / MINIMA - chance) / (1 - chance)


def _agreeing(a: str, b: str) -> Column:
    """Agreeing minima of two packed signatures."""
    apart = F.lit(0)
    for w in range(_WORDS):
        differs = F.col(a)[w].bitwiseXOR(F.col(b)[w])
        for plane in range(1, BITS):
            differs = differs.bitwiseOR(F.col(a)[plane * _WORDS + w].bitwiseXOR(F.col(b)[plane * _WORDS + w]))
        apart = apart + F.bit_count(differs)
    return F.lit(MINIMA) - apart


def _measured(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(words)
        for batch in batches:
            sizes, firsts, seconds, bands, planes = [], [], [], [], []
            for text in batch["text"]:
                own = shingles.of(text)
                band, plane = signature(own) if len(own) else (np.empty(0, np.int64),) * 2
                sizes.append(len(own))
                firsts.append(xxhash.xxh64_intdigest(own.tobytes(), 1) - (1 << 63))
                seconds.append(xxhash.xxh64_intdigest(own.tobytes(), 2) - (1 << 63))
                bands.append(band)
                planes.append(plane)
            yield batch.drop(columns="text").assign(size=np.array(sizes, np.int64), h1=firsts, h2=seconds, bands=bands, planes=planes)

    return run


def _located(df: DataFrame, doc_id: str, text: str, from_scan: bool) -> DataFrame:
    """(id, text, file, row): a row's file and its number there find its text again, however a scan is split."""
    rows = df.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text"), *(["_metadata"] if from_scan else []))
    if not from_scan:
        rows = materialize(rows, "texts")
    return rows.select("id", "text", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


class _Search:
    def __init__(self, texts: DataFrame, classes: DataFrame, words: int, percent: int):
        self.spark, self.texts, self.classes, self.words, self.percent = texts.sparkSession, texts, classes, words, percent
        self.least = least_agreement(percent)

    def near(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b) with the agreeing minima, if these and the sizes of the sets allow a link."""
        sides = [self.classes.select(*[F.col(c).alias(f"{c}_{s}") for c in ("c", "size", "planes")]) for s in "ab"]
        joined = skew_join(skew_join(pairs, sides[0], {"a": "c_a"}, "inner"), sides[1], {"b": "c_b"}, "inner")
        sized = F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * self.percent
        agreeing = joined.filter(sized).select("a", "b", _agreeing("planes_a", "planes_b").alias("agreeing"))
        return agreeing.filter(F.col("agreeing") >= self.least)

    def texts_of(self, classes: DataFrame) -> DataFrame:
        """(c, text) of one column of classes, each once."""
        ends = classes.toDF("end").distinct()
        found = ends.join(self.classes, F.col("end") == F.col("c")).select("c", F.col("file").alias("f"), F.col("row").alias("r"))
        return materialize(self.texts.join(found, (F.col("file") == F.col("f")) & (F.col("row") == F.col("r"))).select("c", "text"), "sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The ``pairs`` (u, v) whose full sets are similar enough."""
        pairs = materialize(pairs, "candidates")
        if pairs.isEmpty():
            return pairs
        sets = self.texts_of(pairs.select("u").union(pairs.select("v")))
        with_u = skew_join(pairs, sets.select(F.col("c").alias("cu"), F.col("text").alias("text_u")), {"u": "cu"}, "inner")
        with_both = skew_join(with_u, sets.select(F.col("c").alias("cv"), F.col("text").alias("text_v")), {"v": "cv"}, "inner")
        words, percent = self.words, self.percent

        def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shingles, last, hub = Shingles(words), None, None
            for batch in batches:
                linked = []
                for v, text_u, text_v in zip(batch["v"].tolist(), batch["text_u"], batch["text_v"]):
                    if v != last:
                        last, hub = v, shingles.of(text_v)
                    own = shingles.of(text_u)
                    both = len(np.intersect1d(own, hub, assume_unique=True))
                    linked.append(100 * both >= percent * (len(own) + len(hub) - both))
                yield batch.loc[linked, ["u", "v"]]

        return materialize(with_both.select("u", "v", "text_u", "text_v").mapInPandas(check, "u long, v long"), "confirmed")

    def stars(self, members: DataFrame, seed: int) -> DataFrame:
        """Candidates (u, v): each class of ``members`` (bucket, c, root) with the nearest of the hubs of its buckets."""
        hub = F.min(F.struct(F.xxhash64(F.lit(seed), "c").alias("lot"), "c", "root")).alias("hub")
        hubs = members.groupBy(F.col("bucket").alias("of")).agg(hub, F.max("root").alias("most"), F.min("root").alias("least"))
        hubs = hubs.filter("least < most").select("of", F.col("hub.c").alias("b"), F.col("hub.root").alias("hub_root"))
        met = skew_join(members, hubs, {"bucket": "of"}, "inner").filter("root <> hub_root")
        near = self.near(met.select(F.col("c").alias("a"), "b").distinct())
        best = near.groupBy("a").agg(F.max(F.struct("agreeing", "b")).alias("best"))
        return best.select(F.col("a").alias("u"), F.col("best.b").alias("v"))

    def between(self, members: DataFrame, block: int) -> DataFrame:
        """Links (u, v) between components: enough to connect all that share a bucket and are similar."""
        parts = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
        major = parts.groupBy(F.col("bucket").alias("of")).agg(F.max(F.struct("n", "root")).alias("major"), F.sum("n").alias("n_all"))
        major = major.filter("n_all > major.n").select("of", F.col("major.root").alias("major"), "n_all", (F.col("n_all") - F.col("major.n")).alias("n_minor"))
        open_ = skew_join(members, major, {"bucket": "of"}, "inner")
        blocks, asked = (F.ceil(F.col(n) / block).cast("int") for n in ("n_all", "n_minor"))
        own = F.pmod(F.xxhash64("c"), blocks).cast("int")
        mine = F.pmod(F.xxhash64(F.lit(1), "c"), asked).cast("int")
        rows = open_.select("bucket", "c", "root", (F.col("root") == F.col("major")).alias("is_major"), blocks.alias("nb"), asked.alias("nq"), own.alias("b"), mine.alias("q"))
        # Every class stays in its block and is met by all blocks of queries; classes outside the largest component are queries.
        resident = rows.select("bucket", "c", "root", "is_major", "b", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("q"), F.lit(False).alias("asks"))
        queries = rows.filter("not is_major").select("bucket", "c", "root", "is_major", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"), "q", F.lit(True).alias("asks"))
        about = self.classes.select(F.col("c").alias("of_c"), "size", "planes", "bands")
        full = skew_join(resident.union(queries), about, {"c": "of_c"}, "inner").drop("of_c")
        least, percent, words = self.least, self.percent, self.words
        flagged = materialize(_in_groups(full, lambda group: _with_candidates(group, least, percent), full.schema), "near-rows")
        if flagged.isEmpty():
            return self.spark.createDataFrame([], "u long, v long")

        def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shingles = Shingles(words)
            for batch in batches:
                yield pd.DataFrame({"of_c": batch["c"], "shingles": [shingles.of(text).tobytes() for text in batch["text"]]})

        sets = self.texts_of(flagged.select("c")).mapInPandas(packed, "of_c long, shingles binary")
        whole = skew_join(flagged, sets, {"c": "of_c"}, "inner").drop("of_c")
        return materialize(_in_groups(whole, lambda group: _linked(group, least, percent), "u long, v long"), "links-between")


def _in_groups(rows: DataFrame, of_group, schema) -> DataFrame:
    """``of_group`` of the rows of each (bucket, b, q); a group holds two blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in _and_none(batches):
            if batch is not None:
                rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if rest is None or not len(rest):
                continue
            keys = rest[["bucket", "b", "q"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bounds = [0, *cuts.tolist()] + ([len(rest)] if batch is None else [])
            for start, end in zip(bounds, bounds[1:]):
                out = of_group(rest.iloc[start:end])
                if len(out):
                    yield out
            rest = rest.iloc[bounds[-1] :]

    return rows.repartition("bucket", "b", "q").sortWithinPartitions("bucket", "b", "q", "asks", "c").mapInPandas(run, schema)


def _candidates(group: pd.DataFrame, least: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query of a group its candidates, as places in the group, the most similar first. A pair with several common buckets is one
    of the bucket with the least number."""
    asks = group["asks"].to_numpy()
    here, asking = np.flatnonzero(~asks), np.flatnonzero(asks)
    if not len(here) or not len(asking):
        return
    c, root, size, major = (group[name].to_numpy() for name in ("c", "root", "size", "is_major"))
    planes, bands = (np.stack(group[name].to_numpy()) for name in ("planes", "bands"))
    bucket, far = group["bucket"].iloc[0], np.iinfo(np.int64).max
    for i in asking.tolist():
        fits = (root[here] != root[i]) & (np.minimum(size[here], size[i]) * 100 >= np.maximum(size[here], size[i]) * percent) & (major[here] | (c[here] < c[i]))
        others = here[fits]
        apart = (planes[others] ^ planes[i]).view(np.uint64).reshape(len(others), BITS, _WORDS)
        agreeing = MINIMA - np.bitwise_count(np.bitwise_or.reduce(apart, axis=1)).sum(axis=1, dtype=np.int64)
        others, agreeing = others[agreeing >= least], agreeing[agreeing >= least]
        if len(others):
            first = np.where(bands[others] == bands[i], bands[i], far).min(axis=1) == bucket
            others, agreeing = others[first], agreeing[first]
            if len(others):
                yield i, others[np.argsort(-agreeing, kind="stable")]


def _with_candidates(group: pd.DataFrame, least: int, percent: int) -> pd.DataFrame:
    """The rows of a group that have a candidate or are one."""
    kept = np.zeros(len(group), bool)
    for i, others in _candidates(group, least, percent):
        kept[i] = kept[others] = True
    return group[kept]


def _linked(group: pd.DataFrame, least: int, percent: int) -> pd.DataFrame:
    """Confirmed links of a group that join components not joined by earlier ones."""
    sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
    names, root = np.unique(group["root"].to_numpy(), return_inverse=True)
    c, up = group["c"].to_numpy(), np.arange(len(names))
    found = []
    for i, others in _candidates(group, least, percent):
        for j in others.tolist():
            a, b = root[i], root[j]
            while up[a] != a:
                a = up[a]
            while up[b] != b:
                b = up[b]
            if a != b:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    up[a] = b
                    found.append((int(c[i]), int(c[j])))
    return pd.DataFrame(found, columns=["u", "v"], dtype=np.int64)


def _and_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def near_copies(
    df: DataFrame, doc_id: str, text: str, words: int = 4, percent: int = 80, block: int = BLOCK, stars: int = STARS, from_scan: bool = False
) -> DataFrame:
    """(``doc_id``, n_shingles, component_id, kept) for every row.

    Texts are linked if their sets share ``percent`` of a hundred of their union at least. ``from_scan``: ``df`` is a scan of files as it is.
    """
    spark = df.sparkSession
    texts = _located(df, doc_id, text, from_scan)
    id_type = texts.schema["id"].dataType.simpleString()
    form = f"id {id_type}, file long, row long, size long, h1 long, h2 long, bands array<long>, planes array<long>"
    signed = materialize(texts.mapInPandas(_measured(words), form).withColumn("place", F.monotonically_increasing_id()), "signatures")
    same = signed.filter("size > 0").groupBy("h1", "h2").agg(F.min("place").alias("c"), F.min("id").alias("least_id"))
    same = materialize(same, "classes")
    one = signed.select("place", "file", "row", "size", "bands", "planes")
    classes = materialize(same.select("c").join(one, F.col("c") == F.col("place")).drop("place"), "representatives")
    placed = classes.select("c", F.explode("bands").alias("bucket"))
    sizes = placed.groupBy(F.col("bucket").alias("of")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("of")
    shared = materialize(skew_join(placed, sizes, {"bucket": "of"}, "inner").select("bucket", "c"), "shared")
    search = _Search(texts, classes, words, percent)
    roots, members = spark.createDataFrame([], "node long, root long"), shared.withColumn("root", F.col("c"))
    for step in range(stars + 1):
        found = search.confirmed(search.stars(members, step)) if step < stars else search.between(members, block)
        if found.isEmpty():
            continue
        # What is connected already goes on as links to the roots.
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(found))
        if step < stars:
            rooted = skew_join(shared, roots, {"c": "node"}, "left").select("bucket", "c", F.coalesce("root", "c").alias("root"))
            members = materialize(rooted, "members")
    known = skew_join(same, roots, {"c": "node"}, "left").select("h1", "h2", "least_id", F.coalesce("root", "c").alias("root"))
    named = known.groupBy(F.col("root").alias("r")).agg(F.min("least_id").alias("component"))
    mapped = skew_join(known, named, {"root": "r"}, "inner").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "component")
    joined = skew_join(signed.select("id", "size", "h1", "h2"), mapped, {"h1": "k1", "h2": "k2"}, "left")
    component = F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(doc_id), F.col("size").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept")
    )
