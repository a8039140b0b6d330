"""Centroid clustering in whole numbers, against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from playlake.llm import zone_clusters as zc
from playlake.llm.oracles import ORACLES
from playlake.llm.queries import QUERIES
from tests.compare import difference
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>"


def expected(rows, dims, k, rounds, scale=64, seed=1):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    lot = sorted((hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)
    centroids = [x for _, x in lot[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = {}
        for _, x in kept:
            own.setdefault(near(x)[1], []).append(x)
        centroids = [[sum(c) // len(own[n]) for c in zip(*own[n])] if n in own else old for n, old in enumerate(centroids)]
    found = [(i, *near(x)) for i, x in kept]
    total = sum(d for _, d, _ in found)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, sum(e for _, e, m in found if m == n), total, digests[n]) for i, d, n in found), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_vectors(spark):
    assert difference(spark, SMALL, QUERIES["op12_zone_clusters"], ORACLES["op12_zone_clusters"]) is None


def test_odd_vectors_ties_and_blocks(spark):
    dice = random.Random(6)
    rows = [(i, [dice.choice([-1.0, -0.25, 0.0, 0.5]) + c for _ in range(4)]) for i, c in enumerate(dice.choice([0, 5, -9]) for _ in range(120))]
    rows += [(7, rows[3][1]), (None, rows[5][1]), (None, [0.1] * 4)] + [rows[0]] * 40
    odd = [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0, None, 1.0, 1.0]), (904, [math.nan] * 4), (905, [math.inf, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    want = expected(rows + odd, 4, 5, 3)
    for block in (1, 8, 256):
        assert got(zc.clusters(df, "vec_id", "embedding", dims=4, k=5, block=block)) == want


def test_few_vectors_empty_table_and_clashing_names(spark):
    few = [(1, [0.0, 1.0]), (2, [3.0, 1.0])]
    df = spark.createDataFrame(few, SCHEMA)
    assert got(zc.clusters(df, "vec_id", "embedding", dims=2, k=16)) == expected(few, 2, 16, 3)
    assert zc.clusters(df.limit(0), "vec_id", "embedding", dims=2).columns[0] == "vec_id"
    assert zc.clusters(df.limit(0), "vec_id", "embedding", dims=2).count() == 0
    clash = spark.createDataFrame([("a", [0.0, 1.0], 1, "x"), ("b", [9.0, 1.0], 2, "y")], "x string, key array<double>, cluster int, place string")
    assert [r["x"] for r in zc.clusters(clash, "x", "key", dims=2).orderBy("x").collect()] == ["a", "b"]
    huge = spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        zc.clusters(huge, "vec_id", "embedding", dims=2)


def test_the_curve_steps_to_neighbours_and_boxes_prune():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = [k.tobytes() for k in zc.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
    centroids = np.array([[0, 0], [100, 0], [0, 100]])
    assert zc.candidates(np.array([-5, -5]), np.array([5, 5]), centroids).tolist() == [0]
    assert zc.candidates(np.array([40, -5]), np.array([60, 5]), centroids).tolist() == [0, 1]
    assert zc.candidates(np.array([50, 0]), np.array([50, 0]), centroids).tolist() == [0, 1]  # a tie stays
