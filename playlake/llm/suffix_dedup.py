"""Removal of repeated byte strings, by prefix doubling.

The rank of a place at length 2L is the pair of its rank at L and the rank L bytes further on, and a place whose rank no other
shares is dropped from then on. Ranks are 64-bit identities instead of ordinals, so that a task can pair them by itself; Spark
shuffles and compares them at three lengths only, and only what may still be repeated:

1. Every string of ``n_bytes`` is represented by the least rank at length G (a power of two, at most a sixth of ``n_bytes``)
   inside it, its anchor. Equal strings have equal anchors, and neighbouring strings mostly share theirs: there is one row
   per run of strings with one anchor, some hundred bytes apart. Runs whose anchor rank is unique are dropped, and most of the corpus with them.
2. Runs that are equal as a whole are repeated, all their strings. One of them stands for all.
3. Where runs share an anchor rank but differ, their strings are compared at length ``n_bytes`` itself (two ranks of different
   seeds, 128 bits): the bytes of up to ``TOGETHER`` different runs of an anchor rank meet in a task; of larger groups every
   string is a row, and Spark counts equal ranks.

An anchor that half of the documents share is one row per run, counted before the shuffle; no task sees all rows of a rank. The rows of
a run that very many texts hold are not shuffled at all. Texts travel compressed. Null and empty texts have nothing removed. Rows with repeated or null ids are rows of their own, and repeated rows are
repeats of each other.

On request the same steps also tell which texts share a passage of so many words with another row, where a word's hash takes
the place of a byte. What is removed does not depend on it: passages of short words can have fewer bytes than removal asks for.
"""

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from playlake.operators.joins import skew_join
from playlake.storage import materialize, with_place

#: Strings of one document that are ranked at once.
SEGMENT = 1 << 19
#: Different runs of one anchor rank whose bytes are compared in one task; of words, with an eighth of the strings, ``WORDS_TOGETHER`` times as many.
TOGETHER, WORDS_TOGETHER = 1024, 8
#: Runs with more than one in so many of all rows are matched without a shuffle: their keys are fewer than this.
OFTEN = 4096
#: Bytes of runs that are ranked at once, besides what is left of the last group; texts whose runs leave a task at once.
COMPARED, HANDED_ON = 1 << 20, 500
_SPACE = re.compile(rb"[\x20\t-\r]")
_PLACE = np.uint64((1 << 20) - 1)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identity of the pair of ranks."""
    x = a * _K1 + b
    x ^= x >> np.uint64(32)
    x *= _K2
    x ^= x >> np.uint64(29)
    return x


def ranks(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Rank of each place at ``length``, of bytes or hashes of words: doubling up to the largest power of two below, then one pair that overlaps."""
    if data.dtype == np.uint8:
        rank = _pair(np.arange(256, dtype=np.uint64) + np.uint64(seed << 32), np.full(256, _K2))[data]
    else:
        rank = _pair(data + np.uint64(seed << 32), _K2)
    have = 1
    while have * 2 <= length:
        rank, have = _pair(rank[:-have], rank[have:]), have * 2
    return rank if have == length else _pair(rank[: len(rank) - (length - have)], rank[length - have :])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row."""
    have = 1
    while have * 2 <= width:
        values, have = np.minimum(values[:-have], values[have:]), have * 2
    return values if have == width else np.minimum(values[: len(values) - (width - have)], values[width - have :])


def anchor_length(n_bytes: int) -> int:
    return 1 << max((n_bytes // 6).bit_length() - 1, 0)


def runs(data: np.ndarray, n_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor ranks, first strings and numbers of strings of the runs of strings of ``data`` with one anchor."""
    gram = anchor_length(n_bytes)
    found = []
    for begin in range(0, len(data) - n_bytes + 1, SEGMENT):
        part = data[begin : begin + SEGMENT + n_bytes - 1]
        rank = ranks(part, gram, 0)
        # The leftmost of equal ones, and nothing but the string itself decides.
        ordered = (rank & ~_PLACE) | np.arange(len(rank), dtype=np.uint64)
        anchor = (_least(ordered, n_bytes - gram + 1) & _PLACE).astype(np.int64)
        starts = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
        counts = np.diff(np.concatenate((starts, [len(anchor)])))
        found.append((rank[anchor[starts]].view(np.int64), starts + begin, counts))
    return tuple(np.concatenate(x) for x in zip(*found))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode()


def words(raw: bytes) -> np.ndarray:
    """Hash of each word of a text; words end at ASCII white space. Long texts are cut in parts."""
    parts, begin = [np.zeros(0, dtype=np.uint64)], 0
    while begin < len(raw):
        space = _SPACE.search(raw, begin + SEGMENT)
        end = space.start() if space else len(raw)
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, raw[begin:end].split()), dtype=np.uint64))
        begin = end
    return np.concatenate(parts)


def _compressed(text: Column) -> Column:
    @F.pandas_udf(BinaryType())
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: zstandard.compress(_bytes(t), 1))

    return of(F.coalesce(text, F.lit("")))


def _find_runs(batches: Iterator[pd.DataFrame], n_bytes: int, n_words: int | None = None) -> Iterator[pd.DataFrame]:
    """Each run's anchor rank, the hash of all its bytes or words, (first string, strings) in one number, and which of the two it is of."""
    kinds = [(False, n_bytes, n_bytes)] + ([(True, n_words, 2 * n_words - 1)] if n_words else [])
    for batch in _slices(batches, HANDED_ON):
        whole, found = [], [(np.zeros(0, dtype=np.int64),) * 4]
        for number, text in zip(batch["row"].tolist(), batch["text"]):
            raw = _bytes(text)
            for of_words, n, least in kinds:
                if len(raw) < least:
                    continue
                data = words(raw) if of_words else np.frombuffer(raw, np.uint8)
                if len(data) >= n:
                    rank, first, count = runs(data, n)
                    buffer, width = (data.tobytes(), data.itemsize) if of_words else (raw, 1)
                    places = zip((first * width).tolist(), ((first + count + n - 1) * width).tolist())
                    whole += [xxhash.xxh3_64_intdigest(buffer[a:b]) for a, b in places]
                    found.append((rank, np.full(len(rank), number), first << 32 | count, np.full(len(rank), of_words)))
        rank, row, run, of_words = (np.concatenate(x) for x in zip(*found))
        whole = np.array(whole, dtype=np.uint64).view(np.int64)
        yield pd.DataFrame({"rank": rank, "whole": whole, "row": row, "run": run, "words": of_words.astype(bool)})


def _slices(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def _string_ranks(parts: list[bytes], n_bytes: int, kind: type = np.uint8) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every string in the parts, of bytes or of words' hashes: two ranks, the number of its part, and its place there."""
    data = np.frombuffer(b"".join(parts), kind)
    sizes = np.array([len(p) for p in parts]) // data.itemsize
    part = np.repeat(np.arange(len(parts)), sizes)[: len(data) - n_bytes + 1]
    at = np.arange(len(part)) - (np.cumsum(sizes) - sizes)[part]
    inside = at + n_bytes <= sizes[part]
    a, b = (ranks(data, n_bytes, seed).view(np.int64)[inside] for seed in (1, 2))
    return a, b, part[inside], at[inside]


def _open_runs(batches: Iterator[pd.DataFrame], n_bytes: int, n_words: int | None = None) -> Iterator[pd.DataFrame]:
    """The listed runs of each text: their bytes or hashes of words, or their strings' ranks where the list says that the group is large."""
    for batch in _slices(batches, HANDED_ON):
        whole, single = [], []
        for row, text, listed in zip(batch["row"].tolist(), batch["text"], batch["runs"]):
            raw = zstandard.decompress(text)
            hashes = words(raw).tobytes() if any(run["words"] for run in listed) else b""
            for run in listed:
                first, count, of_words = run["run"] >> 32, run["run"] & 0xFFFFFFFF, run["words"]
                if of_words:
                    part = hashes[8 * first : 8 * (first + count + n_words - 1)]
                else:
                    part = raw[first : first + count + n_bytes - 1]
                if run["large"]:
                    a, b, _, at = _string_ranks([part], *((n_words, np.uint64) if of_words else (n_bytes, np.uint8)))
                    ranked = {"rank": a, "h2": b, "row": row, "first": at + first, "copied": run["copied"], "words": of_words, "data": None}
                    single.append(pd.DataFrame(ranked))
                else:
                    whole.append((run["rank"], 0, row, first, run["copied"], of_words, part))
        if whole:
            single.append(pd.DataFrame(whole, columns=["rank", "h2", "row", "first", "copied", "words", "data"]))
        if single:
            yield pd.concat(single, ignore_index=True)


def _compare(batches: Iterator[pd.DataFrame], n_bytes: int, n_words: int | None = None) -> Iterator[pd.DataFrame]:
    """Strings that stand in two runs of a group, or in one that has copies, as (row, run). Partitions are sorted by rank.

    Of words, those that another row has: once a row, with -1 for the run.
    """
    rest = None
    for batch in chain(_slices(batches, 2 * TOGETHER), [None]):
        if batch is not None:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if rest is None or not len(rest):
            continue
        rank = rest["rank"].to_numpy()
        # The last group may go on in the next batch.
        until = len(rest) if batch is None else int(np.searchsorted(rank, rank[-1]))
        sizes, begin = np.cumsum(rest["data"].map(len).to_numpy()), 0
        while begin < until:
            most = np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + COMPARED, "right")
            end = int(np.searchsorted(rank[:until], rank[min(max(most, begin + 1), until) - 1], "right"))  # whole groups
            of_words = rest["words"].to_numpy(dtype=bool)[begin:end]
            if not of_words.all():
                yield _same_strings(rest.iloc[begin:end][~of_words], n_bytes)
            if of_words.any():
                yield _shared_words(rest.iloc[begin:end][of_words], n_words)
            begin = end
        rest = rest.iloc[until:]


def _same_strings(group: pd.DataFrame, n_bytes: int) -> pd.DataFrame:
    a, b, part, at = _string_ranks(group["data"].tolist(), n_bytes)
    copied = group["copied"].to_numpy()[part] > 0
    order = np.lexsort((b, a))
    change = np.flatnonzero((np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)) + 1
    begin = np.concatenate(([0], change))
    many = np.diff(np.concatenate((begin, [len(order)])))
    same = np.repeat((many > 1) | np.logical_or.reduceat(copied[order], begin), many)
    hit = order[same & ~copied[order]]
    row, place = group["row"].to_numpy()[part[hit]], group["first"].to_numpy()[part[hit]] + at[hit]
    order = np.lexsort((place, row))
    row, place = row[order], place[order]
    first = np.concatenate(([True], (np.diff(row) != 0) | (np.diff(place) != 1))) if len(row) else np.zeros(0, dtype=bool)
    starts = np.flatnonzero(first)
    lengths = np.diff(np.concatenate((starts, [len(row)])))
    return pd.DataFrame({"row": row[starts], "hit": place[starts] << 32 | lengths})


def _shared_words(group: pd.DataFrame, n_words: int) -> pd.DataFrame:
    a, b, part, _ = _string_ranks(group["data"].tolist(), n_words, np.uint64)
    order = np.lexsort((b, a))
    row, copied = (group[c].to_numpy()[part[order]] for c in ("row", "copied"))
    change = np.flatnonzero((np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)) + 1
    begin = np.concatenate(([0], change))
    apart = (np.minimum.reduceat(row, begin) < np.maximum.reduceat(row, begin)) | (np.maximum.reduceat(copied, begin) > 0)
    shared = np.repeat(apart, np.diff(np.concatenate((begin, [len(order)])))) & (copied == 0)
    return pd.DataFrame({"row": np.unique(row[shared]), "hit": -1})


def removed(listed, n: int, n_bytes: int) -> list[tuple[int, int]]:
    """Maximal covered stretches of ``n`` bytes, from packed (first string, strings)."""
    packed = np.sort(np.asarray(listed, dtype=np.int64))
    starts, ends = packed >> 32, (packed >> 32) + (packed & 0xFFFFFFFF) - 1 + n_bytes
    ends = np.minimum(np.maximum.accumulate(ends), n)
    cut = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    return list(zip(starts[np.concatenate(([0], cut))].tolist(), ends[np.concatenate((cut - 1, [len(ends) - 1]))].tolist()))


def _kept(packed: Column, listed: Column, n_bytes: int) -> Column:
    """(kept, n_removed, n_spans) of a compressed text and its repeated strings."""
    result = StructType([StructField("kept", BinaryType()), StructField("n_removed", LongType()), StructField("n_spans", LongType())])

    @F.pandas_udf(result)
    def of(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for value, strings in zip(texts, lists):
            raw = zstandard.decompress(value)
            spans = removed(strings, len(raw), n_bytes) if strings is not None and len(strings) else []
            edges = [0, *(x for span in spans for x in span), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((kept, len(raw) - len(kept), len(spans)))
        return pd.DataFrame(rows, columns=["kept", "n_removed", "n_spans"])

    return of(packed, listed)


def _with_copies(alive: DataFrame, whole: DataFrame) -> DataFrame:
    """The rows of ``alive`` whose run has copies, by the ``times`` of ``whole``.

    Adaptive execution splits a hot partition between the tasks that wrote it, and one of them may hold most rows of a run. So the
    runs with many of the rows (fewer than ``OFTEN``) go to the rows, and only the others are shuffled.
    """
    many = alive.count() // OFTEN
    copied = whole.filter("times > 1").select(F.col("rank").alias("r"), F.col("whole").alias("w"), "times")
    often = F.broadcast(copied.filter(F.col("times") > many))
    same = (alive["rank"] == often["r"]) & (alive["whole"] == often["w"])
    rest = alive.join(often, same, "left_anti")
    seldom = skew_join(rest, copied.filter(F.col("times") <= many), {"rank": "r", "whole": "w"}, "left_semi")
    return alive.join(often, same, "left_semi").union(seldom)


def without_repeats(
    df: DataFrame, doc_id: str, text: str, n_bytes: int = 400, from_scan: bool = False, together: int = TOGETHER, n_words: int | None = None
) -> DataFrame:
    """(``doc_id``, n_bytes, n_removed, n_spans, kept) for every row: ``kept`` are the bytes that no repeated string covers.

    With ``n_words``, shares_words says further whether so many words in a row stand in another row too; words end at ASCII
    white space, and a row's repeats of its own do not count.
    ``from_scan`` says that ``df`` is a scan of files; otherwise it is written first, so that rows keep their places.
    """
    docs = with_place(df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), "row", from_scan)
    long = docs.filter(F.octet_length("text") >= min(n_bytes, 2 * n_words - 1 if n_words else n_bytes))
    schema = "rank long, whole long, row long, run long, words boolean"
    every = materialize(long.select("row", "text").mapInPandas(lambda b: _find_runs(b, n_bytes, n_words), schema), "runs")

    # 1. Anchor ranks of more than one run.
    shared = every.groupBy(F.col("rank").alias("of")).agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("of")
    alive = materialize(skew_join(every, shared, {"rank": "of"}, "inner").select(*every.columns), "shared-runs")

    # 2. Runs that are equal as a whole. The anchor rank and the hash of all bytes are 128 bits together. Strings of bytes
    # repeat anywhere, those of words in another row.
    rows = [F.count(F.lit(1)).alias("times"), F.min("row").alias("least"), F.max("row").alias("most"), F.max("words").alias("apart")]
    again = F.when(F.col("apart"), F.col("least") < F.col("most")).otherwise(F.col("times") > 1)
    one = F.min(F.struct("row", "run")).alias("one")
    whole = alive.groupBy("rank", "whole").agg(*rows, one)
    times = F.when(again, F.col("times")).otherwise(1).alias("times")
    whole = materialize(whole.select("rank", "whole", times, "one", F.col("apart").alias("words")), "whole-runs")
    repeated = _with_copies(alive, whole).select("row", F.when(F.col("words"), -1).otherwise(F.col("run")).alias("hit"))

    # 3. Strings in runs that differ from others of their rank, unless all of these have copies.
    kinds = whole.groupBy(F.col("rank").alias("r")).agg(F.count(F.lit(1)).alias("kinds"), F.min("times").alias("fewest"))
    mixed = kinds.filter("kinds > 1 and fewest = 1")
    copied = (F.col("times") > 1).cast("int").alias("copied")
    large = F.col("kinds") > F.when(F.col("words"), WORDS_TOGETHER * together).otherwise(together)
    listed = F.struct("rank", "one.run", copied, large.alias("large"), "words")
    open_runs = skew_join(whole, mixed, {"rank": "r"}, "inner").select(F.col("one.row").alias("of"), listed.alias("run"))
    per_doc = open_runs.groupBy("of").agg(F.collect_list("run").alias("runs"))  # as many as the document's bytes at most
    texts = long.select("row", _compressed(F.col("text")).alias("text"))
    look = texts.join(per_doc, texts["row"] == per_doc["of"]).select("row", "text", "runs")
    schema = "rank long, h2 long, row long, first long, copied int, words boolean, data binary"
    strings = materialize(look.mapInPandas(lambda b: _open_runs(b, n_bytes, n_words), schema), "open-runs")
    groups = strings.filter("data is not null").repartition("rank").sortWithinPartitions("rank")
    met = groups.mapInPandas(lambda b: _compare(b, n_bytes, n_words), "row long, hit long")
    single = strings.filter("data is null")
    same = single.groupBy(F.col("rank").alias("g1"), F.col("h2").alias("g2")).agg(*rows, F.max("copied").alias("any"))
    same = same.filter(again | (F.col("any") == 1)).select("g1", "g2")
    single = skew_join(single.filter("copied = 0"), same, {"rank": "g1", "h2": "g2"}, "inner")
    single = single.select("row", F.when(F.col("words"), -1).otherwise(F.shiftleft("first", 32).bitwiseOR(F.lit(1))).alias("hit"))

    # A document's strings are as many as its bytes at most; those of words are noted, not listed.
    hits = repeated.union(met).union(single).groupBy(F.col("row").alias("of"))
    hits = hits.agg(F.collect_list(F.when(F.col("hit") >= 0, F.col("hit"))).alias("hits"), F.max(F.col("hit") < 0).alias("shares"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    packed = docs.select("id", "row", size, _compressed(F.col("text")).alias("packed"))
    shares = F.coalesce(F.col("shares"), F.lit(False)).alias("shares_words")
    found = packed.join(hits, packed["row"] == hits["of"], "left")
    found = found.select("id", "n_bytes", _kept(F.col("packed"), F.col("hits"), n_bytes).alias("out"), shares)
    columns = [F.col("id").alias(doc_id), "n_bytes", "out.n_removed", "out.n_spans", "out.kept"]
    return found.select(*columns, *(["shares_words"] if n_words else []))
