"""Approximate nearest neighbours by inner product, with a robust-pruned directed graph for each shard.

The distinct vectors are dealt to shards of about ``SHARD`` by a hash. In each shard a greedy search from the middle
proposes neighbours for every vector, and a relaxed distance rule prunes them: a candidate goes if a kept neighbour is, by the factor
``alpha``, closer to it than the vector itself. What stays points in different directions, so that greedy search gets
anywhere. A beam search then asks every shard for every query, in blocks of queries, and the best of all shards are
ranked by their exact score.

Inner products become distances by one more coordinate that brings all vectors to one length; queries have zero there.

Copies of a vector are one node and are expanded after the search, so a group of copies costs nothing and no copy is lost.
Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows with a null id. Vectors of different lengths have no inner
product: each length has shards of its own, and only vectors of the query's length are its candidates. Rows with one id are rows of their own, as queries
and as candidates. With fewer candidates than asked for, all of them are returned. Ties go to the smaller id. Further columns do not
matter, whatever their names; an empty table gives no rows.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from playlake.llm.common import quoted
from playlake.operators.joins import skew_join
from playlake.storage import materialize, with_place

#: Vectors in a shard, on average, and queries in a block.
SHARD, QUERIES = 8192, 4096
#: Edges of a node, further ones it may gather while building before it is pruned again, beam widths while building and searching, and the factors of the two building passes.
EDGES, SLACK, BUILD_BEAM, SEARCH_BEAM = 40, 8, 64, 128
ALPHAS = (1.0, 1.2)
_BATCH = 512
#: Queries and nodes that are searched for and pruned at once: few enough for a processor's cache.
_CACHED = 128


class Graph:
    """A directed graph over the rows of ``points``, all of one length; -1 fills up the lists of neighbours."""

    def __init__(self, points: np.ndarray, out: np.ndarray | None = None, seed: int = 42):
        self.points = points
        self.length2 = float((points[0].astype(np.float64) ** 2).sum()) if len(points) else 0.0
        self.middle = int(np.argmax(points @ points.mean(axis=0))) if len(points) else 0
        if out is not None:
            self.out = out
            return
        random = np.random.default_rng(seed)
        n = len(points)
        self.out = np.full((n, EDGES + SLACK), -1, dtype=np.int32)
        if n > 1:
            first = random.integers(0, n - 1, size=(n, min(EDGES, n - 1)))
            self.out[:, : first.shape[1]] = first + (first >= np.arange(n)[:, None])  # never the node itself
        for alpha in ALPHAS:
            order = random.permutation(n)
            for at in range(0, n, _BATCH):
                self._insert(order[at : at + _BATCH], alpha)
        for at in range(0, n, _BATCH):
            part = np.arange(at, min(at + _BATCH, n))
            part = part[(self.out[part, EDGES:] >= 0).any(axis=1)]
            self._link(part, self.out[part], ALPHAS[-1])
        self.out = np.ascontiguousarray(self.out[:, :EDGES])

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes that a beam search finds for each query, and their inner products; -1 where there are fewer."""
        parts = [self._search(queries[at : at + _CACHED], width) for at in range(0, max(1, len(queries)), _CACHED)]
        return np.concatenate([beam for beam, _ in parts]), np.concatenate([score for _, score in parts])

    def _search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.points)
        beam = np.full((len(queries), width), -1, dtype=np.int64)
        score = np.full((len(queries), width), -np.inf, dtype=np.float32)
        done = np.ones((len(queries), width), dtype=bool)
        seen = np.zeros((len(queries), n + 1), dtype=bool)  # the last column takes the fillers
        seen[:, n] = True
        beam[:, 0], done[:, 0] = self.middle, False
        seen[:, self.middle] = True
        score[:, 0] = queries @ self.points[self.middle]
        active = np.arange(len(queries))
        while len(active):
            at = np.argmin(done[active], axis=1)  # the best that is still to be expanded, as beams are sorted
            done[active, at] = True
            near = self.out[beam[active, at]].astype(np.int64)
            near[near < 0] = n
            near[seen[active[:, None], near]] = n
            seen[active[:, None], near] = True
            fresh = np.einsum("qed,qd->qe", self.points[np.minimum(near, n - 1)], queries[active])
            fresh[near == n] = -np.inf
            # A node may stand twice among the neighbours of the one: keep the first.
            order = np.argsort(near, axis=1, kind="stable")
            ranked = np.take_along_axis(near, order, axis=1)
            twice = np.zeros_like(near, dtype=bool)
            np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], axis=1)
            fresh[twice] = -np.inf
            ids = np.concatenate((beam[active], np.where(np.isneginf(fresh), -1, near)), axis=1)
            scores = np.concatenate((score[active], fresh), axis=1)
            flags = np.concatenate((done[active], np.isneginf(fresh)), axis=1)
            best = np.argsort(-scores, axis=1, kind="stable")[:, :width]
            beam[active], score[active], done[active] = (np.take_along_axis(x, best, axis=1) for x in (ids, scores, flags))
            active = active[~done[active].all(axis=1)]
        return beam, score

    def _distance(self, product: np.ndarray) -> np.ndarray:
        return np.maximum(2 * (self.length2 - product), 0)

    def _prune(self, nodes: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
        """Up to ``EDGES`` diverse neighbours for each node out of its row of candidates (-1: none)."""
        candidates = np.where(candidates == nodes[:, None], -1, candidates)
        order = np.argsort(candidates, axis=1, kind="stable")
        candidates = np.take_along_axis(candidates, order, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        vectors = self.points[np.maximum(candidates, 0)]
        apart = self._distance(np.einsum("ncd,nd->nc", vectors, self.points[nodes]))
        apart[candidates < 0] = np.inf
        kept = np.full((len(nodes), EDGES), -1, dtype=np.int32)
        row = np.arange(len(nodes))
        for k in range(EDGES):
            best = np.argmin(apart, axis=1)
            alive = np.isfinite(apart[row, best])
            if not alive.any():
                break
            kept[alive, k] = candidates[row, best][alive]
            between = self._distance(np.einsum("ncd,nd->nc", vectors, vectors[row, best]))
            apart[alpha * alpha * between <= apart] = np.inf  # distances are squared
            apart[row, best] = np.inf
        return kept

    def _link(self, nodes: np.ndarray, candidates: np.ndarray, alpha: float) -> None:
        """Give each node the diverse ones of its candidates as neighbours, and room for ``SLACK`` more."""
        for at in range(0, len(nodes), _CACHED):
            part = nodes[at : at + _CACHED]
            self.out[part, :EDGES] = self._prune(part, candidates[at : at + _CACHED], alpha)
            self.out[part, EDGES:] = -1

    def _insert(self, nodes: np.ndarray, alpha: float) -> None:
        found, _ = self.search(self.points[nodes], BUILD_BEAM)
        self._link(nodes, np.concatenate((found, self.out[nodes]), axis=1), alpha)
        targets = self.out[nodes, :EDGES]
        source, target = np.repeat(nodes, EDGES), targets.ravel()
        source, target = source[target >= 0], target[target >= 0]
        fresh = ~(self.out[target] == source[:, None]).any(axis=1)
        source, target = source[fresh], target[fresh]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        back, start, count = np.unique(target, return_index=True, return_counts=True)
        # Lists with room take the edges back as they are, and only those that overflow are pruned: a few times for each node, however
        # many nodes there are. Room is behind the neighbours.
        have = (self.out[back] >= 0).sum(axis=1)
        room = have + count <= EDGES + SLACK
        of = np.repeat(np.arange(len(back)), count)
        column = have[of] + np.arange(len(of)) - start[of]
        self.out[target[room[of]], column[room[of]]] = source[room[of]]
        back, start, count = back[~room], start[~room], count[~room]
        for at in range(0, len(back), _BATCH):
            part, begin, many = back[at : at + _BATCH], start[at : at + _BATCH], count[at : at + _BATCH]
            into = np.full((len(part), int(many.max())), -1, dtype=np.int64)
            line = np.repeat(np.arange(len(part)), many)
            column = np.arange(len(line)) - np.repeat(np.cumsum(many) - many, many)
            into[line, column] = source[begin[line] + column]
            self._link(part, np.concatenate((self.out[part], into), axis=1), alpha)


def _graph_of_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("rep")
    longest2 = pdf["longest2"].iloc[0]
    points = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
    rest = np.sqrt(np.maximum(longest2 - (points**2).sum(axis=1), 0))
    lifted = np.concatenate((points, rest[:, None]), axis=1).astype(np.float32)
    out = Graph(lifted).out
    return pd.DataFrame(
        {
            "n": [int(pdf["n"].iloc[0])],
            "shard": [int(pdf["shard"].iloc[0])],
            "reps": [pdf["rep"].to_numpy(dtype="<i8").tobytes()],
            "ids": [pdf["vec_id"].to_numpy(dtype="<i8").tobytes()],
            "points": [points.astype("<f8").tobytes()],
            "rest": [rest.astype("<f8").tobytes()],
            "edges": [out.astype("<i4").tobytes()],
        }
    )


def _ask(index: pd.DataFrame, queries: pd.DataFrame, k: int, width: int) -> pd.DataFrame:
    columns = ["query", "query_id", "rep", "first", "score"]
    if not len(index) or not len(queries):
        return pd.DataFrame(columns=columns)
    shard = index.iloc[0]
    reps, ids = np.frombuffer(shard["reps"], "<i8"), np.frombuffer(shard["ids"], "<i8")
    points = np.frombuffer(shard["points"], "<f8").reshape(len(reps), -1)
    lifted = np.concatenate((points, np.frombuffer(shard["rest"], "<f8")[:, None]), axis=1).astype(np.float32)
    graph = Graph(lifted, np.frombuffer(shard["edges"], "<i4").reshape(len(reps), EDGES))
    parts = []
    for at in range(0, len(queries), _BATCH):
        part = queries.iloc[at : at + _BATCH]
        asked = np.stack(part["vector"].to_numpy()).astype(np.float64)
        found, _ = graph.search(np.concatenate((asked, np.zeros((len(asked), 1))), axis=1).astype(np.float32), max(width, k))
        line, column = np.nonzero(found >= 0)
        nodes = found[line, column]
        score = (asked[line] * points[nodes]).sum(axis=1)
        query, query_id = part["row"].to_numpy()[line], part["vec_id"].to_numpy()[line]
        result = pd.DataFrame({"query": query, "query_id": query_id, "rep": reps[nodes], "first": ids[nodes], "score": score})
        order = {"query": True, "score": False, "first": True, "rep": True}
        parts.append(result.sort_values(list(order), ascending=list(order.values())).groupby("query").head(k))
    return pd.concat(parts, ignore_index=True)[columns]


def _first(df: DataFrame, by: str, order: list, k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; Spark drops the others before it shuffles."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col(name) <= k)


def usable(df: DataFrame, vec_id: str, embedding: str, from_scan: bool = False) -> DataFrame:
    """(row, vec_id, vector, n) of the rows that take part: a number for each row, and the length of its vector."""
    named = df.select(F.col(quoted(vec_id)).cast("long").alias("vec_id"), F.col(quoted(embedding)).alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0)
    return with_place(named, "row", from_scan).filter(good).withColumn("n", F.size("vector"))


def build(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """The index: one row for each shard of each length, with its vectors and edges packed. ``vectors`` has (rep, vec_id, vector, n), all
    vectors different."""
    length2 = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    per = vectors.groupBy(F.col("n").alias("of")).agg(F.ceil(F.count(F.lit(1)) / shard).alias("shards"), F.max(length2).alias("longest2"))
    per = materialize(per, "lengths")
    shards = per.agg(F.sum("shards")).first()[0] or 1
    known = skew_join(vectors, per, {"n": "of"}, "inner")
    dealt = known.select("rep", "vec_id", "vector", "n", "longest2", F.pmod(F.xxhash64("rep"), "shards").cast("int").alias("shard"))
    schema = "n int, shard int, reps binary, ids binary, points binary, rest binary, edges binary"
    # A given number of partitions is not merged to fewer for being small: a graph takes long to build, however few its bytes.
    graphs = dealt.repartition(shards, "n", "shard").groupBy("n", "shard").applyInPandas(_graph_of_shard, schema)
    return materialize(graphs, "graphs")


def nearest(
    df: DataFrame,
    queries: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 20,
    width: int = SEARCH_BEAM,
    from_scan: bool = False,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row that ``queries`` (a condition on ``vec_id``) selects.
    ``from_scan`` says that ``df`` is a scan of files."""
    rows = materialize(usable(df, vec_id, embedding, from_scan), "vectors")
    ranked = _first(rows, "vector", [F.col("vec_id"), F.col("row")], k + 1)  # one of them may be the query itself
    first = F.min(F.struct("vec_id", "row")).over(Window.partitionBy("vector"))["row"]
    members = materialize(ranked.select("row", "vec_id", "vector", "n", first.alias("rep")), "copies")
    index = build(members.filter("row = rep").select("rep", "vec_id", "vector", "n"))

    asked = rows.filter(queries)
    blocks = asked.groupBy("n").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("blocks"))
    per = materialize(index.groupBy(F.col("n").alias("of")).agg(F.count(F.lit(1)).alias("shards")).join(blocks, F.col("of") == F.col("n")).drop("n"), "plan")
    tasks = per.agg(F.sum(F.col("shards") * F.col("blocks"))).first()[0] or 1
    dealt = skew_join(asked, per, {"n": "of"}, "inner").select("row", "vec_id", "vector", "n", "shards", F.pmod(F.xxhash64("row"), "blocks").cast("int").alias("block"))
    dealt = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards").cast("int") - 1)))
    copies = index.join(per, F.col("n") == F.col("of")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    copies = copies.drop("of", "shards", "blocks")
    keys = ("n", "shard", "block")
    found = (
        copies.repartition(tasks, *keys)
        .groupBy(*keys)
        .cogroup(dealt.repartition(tasks, *keys).groupBy(*keys))
        .applyInPandas(lambda a, b: _ask(a, b, k + 1, width), "query long, query_id long, rep long, first long, score double")
    )
    best = _first(found, "query", [F.desc("score"), F.col("first"), F.col("rep")], k + 1).select("query", "query_id", "score", "rep")
    names = members.select(F.col("rep").alias("of"), "vec_id", "row")
    expanded = skew_join(best, names, {"rep": "of"}, "inner").filter("row <> query")
    return _first(expanded, "query", [F.desc("score"), F.col("vec_id"), F.col("row")], k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the rows of ``exact`` (query_id, vec_id) that ``found`` has too."""
    hits = exact.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hits / max(1, exact.count())
