"""SimHash near-dedup: fingerprints of word shingles, linked where few bits differ.

Two fingerprints that differ in at most ``radius`` bits agree on at least two of ``radius + 2`` stretches of the 64 bits, so every link
lies within a bucket of fingerprints that share two stretches. Each bucket's fingerprints form BK-trees: children are keyed by
their distance to the parent, and a query follows only the edges within the radius of its own distance. A bucket of more
than ``BLOCK`` fingerprints is cut into shards of that size: each shard's tree is sent to the tasks that hold the other
shards of the bucket as queries, by a shuffle. A broadcast of all trees would grow with the corpus, a shard's tree does not.
A task returns only links that join what was apart, never all pairs, and the links make components.

Equal fingerprints are searched once. Null texts count as empty; texts without words have fingerprint zero and are linked like any
other. Rows with a null id get a fingerprint too; the component of rows whose ids are all null is null. Repeated rows and ids are
rows of their own in ``near_copies``; ``one_of_each`` keeps one row of a component, the one with the smallest id, then the first in the scan.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from playlake.llm.common import quoted, unused
from playlake.llm.components import components
from playlake.operators.joins import skew_join
from playlake.storage import materialize

SEED = 42
#: Fingerprints in one BK-tree at most, and in one block of queries.
BLOCK = 4096
#: Hashes whose bits are counted at once.
_CHUNK = 1 << 15


def fingerprint(text: str | None, words: int) -> int:
    """Signed 64 bits. A bit is set if it is set in over half of the shingles' hashes."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(tokens) - words, 0)
    spans = zip(starts[: last + 1].tolist(), ends[min(words, len(tokens)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype="<u8", count=last + 1)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, words: int) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: fingerprint(t, words)).astype("int64")

    return of(F.coalesce(text, F.lit("")))


class BKTree:
    """Nodes in arrays of their own; children of a node by their distance to it."""

    def __init__(self, values: np.ndarray, members: np.ndarray):
        self.values = values
        self.nodes: list[tuple[int, dict[int, int], np.ndarray]] = []  # member, child by distance, all members below
        waiting = [(members, None, 0)]
        while waiting:
            below, parent, distance = waiting.pop()
            if parent is not None:
                self.nodes[parent][1][distance] = len(self.nodes)
            self.nodes.append((int(below[0]), {}, below))
            apart = np.bitwise_count(values[below[1:]] ^ values[below[0]])
            waiting += [(below[1:][apart == d], len(self.nodes) - 1, int(d)) for d in np.unique(apart)]

    def links(self, queries: np.ndarray, radius: int) -> list[tuple[int, int]]:
        """Pairs (member, query) within ``radius``, as many as it takes to connect all that such pairs connect."""
        parent = np.arange(len(self.values))

        def roots(of: np.ndarray) -> np.ndarray:
            found = parent[of]
            while not np.array_equal(found, up := parent[found]):
                found = up
            return found

        out, waiting = [], [(0, queries)]
        while waiting:
            node, asking = waiting.pop()
            member, children, below = self.nodes[node]
            apart = np.bitwise_count(self.values[asking] ^ self.values[member]).astype(np.int64)
            near = asking[apart <= radius]
            if len(near):
                of_near, first = np.unique(roots(near), return_index=True)
                own = int(roots(np.array([member]))[0])
                for root, at in zip(of_near.tolist(), first.tolist()):
                    if root != own:
                        out.append((member, int(near[at])))
                        parent[root] = own
            for distance, child in children.items():
                rest = asking[np.abs(apart - distance) <= radius]
                if len(rest):
                    both = roots(np.concatenate((rest, self.nodes[child][2])))
                    if (both != both[0]).any():  # else all of them are connected already
                        waiting.append((child, rest))
        return out


def _search(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Links within each group (bucket, i, j) of a sorted partition; a group holds two blocks at most."""
    rest = None
    for batch in _and_none(batches):
        if batch is not None:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if rest is None or not len(rest):
            continue
        keys = rest[["bucket", "i", "j"]].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist()] + ([len(rest)] if batch is None else [])
        values, sides = rest["fp"].to_numpy().view(np.uint64), rest["side"].to_numpy()
        pairs = []
        for a, b in zip(bounds, bounds[1:]):
            if b - a > 1:
                part, side = values[a:b], sides[a:b]
                tree, asking = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
                if len(tree) and len(asking):
                    pairs += [(part[x], part[y]) for x, y in BKTree(part, tree).links(asking, radius)]
        if pairs:
            yield pd.DataFrame(np.array(pairs, dtype=np.uint64).view(np.int64), columns=["u", "v"])
        rest = rest.iloc[bounds[-1] :]


def _and_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def links(values: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """(u, v): enough links between the distinct fingerprints ``values.fp`` to connect all that are within ``radius``."""
    n = radius + 2
    cuts = [64 * k // n for k in range(n + 1)]

    def stretch(k: int) -> Column:
        width = cuts[k + 1] - cuts[k]
        return F.shiftrightunsigned("fp", cuts[k]).bitwiseAND(F.lit((1 << width) - 1))

    buckets = [
        F.xxhash64(F.lit(a * n + b), stretch(a), stretch(b))
        for a, b in combinations(range(n), 2)
    ]
    placed = values.select("fp", F.explode(F.array(*buckets)).alias("bucket"))
    sizes = placed.groupBy(F.col("bucket").alias("of")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = skew_join(placed, sizes, {"bucket": "of"}, "inner")
    blocks = F.ceil(F.col("n") / block).cast("int")
    shared = shared.select("bucket", "fp", blocks.alias("blocks"), F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("b"))
    # Block b is a tree for the blocks after it, and queries for the trees of the blocks before it.
    other = shared.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    side = F.when(F.col("o") == F.col("b"), 2).when(F.col("o") > F.col("b"), 0).otherwise(1)
    groups = other.select("bucket", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), side.alias("side"), "fp")
    ordered = groups.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "fp")
    return ordered.mapInPandas(lambda batches: _search(batches, radius), "u long, v long")


def _roots(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, root) for every distinct fingerprint; root is the least fingerprint of its component."""
    values = rows.select("fp").distinct()
    found = components(links(values, radius)).select(F.col("node").alias("of"), "root")
    return skew_join(values, found, {"fp": "of"}, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_copies(df: DataFrame, doc_id: str, text: str, words: int = 4, radius: int = 4) -> DataFrame:
    """(``doc_id``, fingerprint, component_id) for every row: 16 hex digits, and the smallest id that links can reach."""
    rows = materialize(df.select(F.col(doc_id).alias("id"), fingerprints(F.col(text), words).alias("fp")), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    known = materialize(_roots(rows, radius).join(least, "fp"), "roots")
    named = known.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    mapped = skew_join(known, named, {"root": "r"}, "inner").select(F.col("fp").alias("of"), "component_id")
    joined = skew_join(rows, mapped, {"fp": "of"}, "inner")
    return joined.select(F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, doc_id: str, text: str, words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``df``, one of each component, with the columns of ``df``."""
    fp, place = unused(df, "fp"), unused(df, "place")
    marked = df.withColumn(fp, fingerprints(F.col(quoted(text)), words)).withColumn(place, F.monotonically_increasing_id())
    stored = materialize(marked, "fingerprints")
    rows = stored.select(F.col(fp).alias("fp"), F.col(quoted(doc_id)).alias("id"), F.col(place).alias("place"))
    roots = _roots(rows, radius).select(F.col("fp").alias("of"), "root")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place")).alias("first")
    kept = skew_join(rows, roots, {"fp": "of"}, "inner").groupBy("root").agg(first).select(F.col("first.place").alias("kept"))
    return stored.join(kept, stored[place] == kept["kept"], "left_semi").select(*map(quoted, df.columns))
