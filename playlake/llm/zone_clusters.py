"""Centroid clustering on zone maps along a space-filling curve, in exact whole numbers.

Vectors are scaled and floored to integers, put in the order of a Hilbert curve over all their dimensions and cut into blocks; a block keeps
the least and the greatest value of each dimension, its box. For two centroids the difference of their squared distances is linear in
the vector, so its greatest value in a box is exact: a centroid that is farther than another one everywhere in the box is no
candidate of the block. The vectors of a block are compared with its candidates only, all at once and exactly.

Each round reads the blocks, one after the other, and returns one row for each centroid and task; only ``k`` centroids, a number that
is a parameter, pass through the driver. The curve's order breaks ties by a row's place in the scan, so that equal vectors, however many, spread
over blocks.

Vectors that are null, of another length, or that hold a null, NaN or infinite component are left out. Ids are not looked at but for the
choice of the first centroids: rows with a null or repeated id take part like any other, and ties in the choice go by the vector. With
fewer than ``k`` vectors there are as many centroids as vectors; an empty table gives no rows. A component whose integer has more
than 27 bits stops the job, as squared distances would not fit in 64 bits. Further columns of the input are not looked at.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from playlake.llm.common import quoted
from playlake.storage import materialize

#: Vectors in one block.
BLOCK = 256
#: Bits of a coordinate's cell on the curve.
CURVE_BITS = 2
_MOST = 1 << 27


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve, as rows of bytes, of the rows of ``cells`` (whole numbers below ``1 << bits``).

    A cell's bits are read from the highest down. At each level the bits of all dimensions say which part of the cube holds the
    cell; the part is turned and mirrored so that the curve runs through neighbouring parts in one piece (Skilling's transform).
    """
    axes = np.ascontiguousarray(cells.T).astype(np.uint32)
    for level in range(bits - 1, 0, -1):
        below = np.uint32((1 << level) - 1)
        for axis in axes:
            high = (axis >> np.uint32(level)) & np.uint32(1) == 1
            turned = np.where(high, 0, (axes[0] ^ axis) & below).astype(np.uint32)
            axes[0] ^= np.where(high, below, turned)
            axis ^= turned
    np.bitwise_xor.accumulate(axes, axis=0, out=axes)
    undo = np.zeros(axes.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        undo ^= ((axes[-1] >> np.uint32(level)) & np.uint32(1)) * np.uint32((1 << level) - 1)
    axes ^= undo
    planes = [(axes >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be the nearest one of some vector in the box."""
    apart = centroids[:, None, :] - centroids[None, :, :]  # [c, other]
    norms = (centroids * centroids).sum(axis=1)
    # The most that |x - other|^2 - |x - c|^2 reaches in the box; below 0 the other one is nearer everywhere.
    most = norms[None, :] - norms[:, None] + 2 * np.maximum(apart * low, apart * high).sum(axis=2)
    return np.flatnonzero(~(most < 0).any(axis=1))


def nearest(vectors: np.ndarray, numbers: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the nearest of the numbered centroids (ties: the smaller number) and the squared distance."""
    apart = np.stack([np.square(vectors - centroids[c]).sum(axis=1) for c in numbers])
    at = apart.argmin(axis=0)
    return numbers[at], apart[at, np.arange(len(vectors))]


def integers(vector: Column, dims: int, scale: int) -> Column:
    """The scaled and floored components; null for a vector that takes no part."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")), F.lit(False)))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("int"))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double") * float(scale)) < float(_MOST))
    kept = F.when(fits, scaled).otherwise(F.raise_error(F.lit("a component is too large for squared distances of 64 bits")))
    return F.when((F.size(vector) == dims) & finite, kept)


def _blocks(rows: DataFrame, dims: int, size: int) -> DataFrame:
    """Rows in the order of the curve, packed: ids, vectors and box of each block."""
    bounds = rows.agg(
        F.array(*[F.min(F.col("x")[i]) for i in range(dims)]).alias("low"), F.array(*[F.max(F.col("x")[i]) for i in range(dims)]).alias("high")
    ).first()
    low = np.array([v or 0 for v in bounds["low"]], float)
    width = np.array([v or 0 for v in bounds["high"]], float) - low + 1

    @F.pandas_udf("binary")
    def key(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        cells = ((np.stack(vectors.to_numpy()) - low) / width * (1 << CURVE_BITS)).astype(np.uint32)
        return pd.Series([k.tobytes() for k in hilbert_keys(cells, CURVE_BITS)])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in _and_none(batches):
            if batch is not None:
                rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if rest is None:
                continue
            whole = len(rest) if batch is None else len(rest) // size * size
            parts = [rest.iloc[at : min(at + size, whole)] for at in range(0, whole, size)]
            packed = [(part["id"].tolist(), np.stack(part["x"].to_numpy()).astype("<i4")) for part in parts]
            if packed:
                yield pd.DataFrame(
                    {
                        "ids": [[None if pd.isna(i) else i for i in ids] for ids, _ in packed],
                        "vectors": [x.tobytes() for _, x in packed],
                        "low": [x.min(axis=0).tolist() for _, x in packed],
                        "high": [x.max(axis=0).tolist() for _, x in packed],
                    }
                )
            rest = rest.iloc[whole:]

    keyed = rows.withColumn("key", key("x")).withColumn("place", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange("key", "place").sortWithinPartitions("key", "place").select("id", "x")
    id_type = rows.schema["id"].dataType.simpleString()
    return materialize(ordered.mapInPandas(pack, f"ids array<{id_type}>, vectors binary, low array<int>, high array<int>"), "zone-blocks")


def _and_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _assigned(blocks: pd.DataFrame, centroids: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors, numbers of the nearest centroids and squared distances, block by block."""
    for ids, packed, low, high in zip(blocks["ids"], blocks["vectors"], blocks["low"], blocks["high"]):
        vectors = np.frombuffer(packed, "<i4").reshape(len(ids), -1).astype(np.int64)
        numbers = candidates(np.asarray(low, np.int64), np.asarray(high, np.int64), centroids)
        yield ids, vectors, *nearest(vectors, numbers, centroids)


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of exact means; one without vectors stays."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, vectors, cluster, _ in _assigned(batch, centroids):
                for c in np.unique(cluster):
                    own = vectors[cluster == c]
                    count[c] += len(own)
                    total[c] += own.sum(axis=0)
        used = np.flatnonzero(count)
        yield pd.DataFrame({"c": used.astype(np.int32), "n": count[used], "total": total[used].tolist()})

    parts = blocks.mapInPandas(sums, "c int, n long, total array<long>")
    whole = parts.groupBy("c").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i].cast("decimal(38,0)")) for i in range(dims)]).alias("total"))
    moved = centroids.copy()
    for row in whole.collect():  # k rows at most
        moved[row["c"]] = [int(t) // row["n"] for t in row["total"]]
    return moved


def clusters(
    df: DataFrame, vec_id: str, vector: str, dims: int = 64, k: int = 16, rounds: int = 3, scale: int = 64, seed: int = 1, block: int = BLOCK
) -> DataFrame:
    """(``vec_id``, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every vector that takes part.

    The first centroids are the ``k`` vectors with the least sha256 of ``seed:id``; a null id reads ``null``.
    """
    spark = df.sparkSession
    rows = df.select(F.col(quoted(vec_id)).alias("id"), integers(F.col(quoted(vector)), dims, scale).alias("x")).filter("x is not null")
    lot = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    chosen = rows.select(lot.alias("lot"), "x").orderBy("lot", "x").limit(k).collect()
    id_type = df.select(quoted(vec_id)).schema[0].dataType.simpleString()
    if not chosen:
        nothing = f"id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], nothing).withColumnRenamed("id", vec_id)
    centroids = np.array([row["x"] for row in chosen], np.int64)
    blocks = _blocks(rows, dims, block)
    for _ in range(rounds):
        centroids = _moved(blocks, centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, _, cluster, distance in _assigned(batch, centroids):
                yield pd.DataFrame({"id": pd.Series(list(ids), dtype=object), "cluster": cluster.astype(np.int32), "distance": distance})

    assigned = materialize(blocks.mapInPandas(assign, f"id {id_type}, cluster int, distance long"), "assigned")
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # k rows at most
    total = sum(row["s"] for row in inertia)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame(
        [(r["cluster"], r["s"], total, digests[r["cluster"]]) for r in inertia], "c int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    joined = assigned.join(F.broadcast(about), F.col("cluster") == F.col("c"))
    return joined.select(F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
