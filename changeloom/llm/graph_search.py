"""Approximate nearest neighbours by inner product: robust-pruned directed graphs, one a shard.

Vectors are dealt by a hash of their id to shards of about SHARD rows. Each shard's graph is grown from random edges: a greedy beam search for each vector
proposes neighbours, relaxed distance pruning keeps diverse ones (a candidate goes when one kept already is nearer to it by the factor ALPHA), and edges back
are added and pruned alike. Distances are those of vectors lifted to equal norm by one more coordinate, where the nearest is the one with the largest inner
product. A query walks every shard's graph with a beam; scores are inner products of the original components in double precision, and a window takes the best of all shards.

The index is a table with one row per distinct vector of a shard (its ids, components and neighbours), stored in the shared folder. Queries go to
each shard in blocks of QUERY_BLOCK, so a task holds one shard and one block. A vector with very many copies is spread over all shards, where equal vectors are one node.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do null ids; vectors of different lengths never meet; ties in
score go to the smaller id; with fewer candidates than k all that are found are returned; an empty table gives an empty result; extra columns don't take part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.llm.common import stored, table

SHARD, QUERY_BLOCK = 1 << 14, 4096
DEGREE, BEAM, ALPHA = 32, 64, 1.4
SEARCH_BEAM, K = 192, 20
#: Nodes that a step of the lock-step search expands, and vectors that are inserted together.
AT_ONCE, BATCH = 4, 256
STARTS = 16


class Graph:
    """A directed graph over the rows of x (float32), at most DEGREE edges out of each."""

    def __init__(self, x: np.ndarray, neighbours: np.ndarray | None = None):
        n = len(x)
        norms = (x.astype(np.float64) ** 2).sum(1)
        self.x = np.hstack([x, np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))[:, None]]).astype(np.float32)
        self.square = (self.x**2).sum(1)
        # walks start at the middle and at the longest vectors, where large inner products lie
        middle = ((self.x - self.x.mean(0)) ** 2).sum(1).argmin()
        self.starts = np.unique(np.append(np.argsort(-norms, kind="stable")[: STARTS - 1], middle))
        if neighbours is not None:
            self.out = neighbours
            return
        rng = np.random.default_rng(11)
        width = min(DEGREE, max(n - 1, 1))
        self.out = np.full((n, DEGREE), -1, np.int32)
        if n > 1:
            near = rng.integers(0, n - 1, (n, min(width, DEGREE // 2)))
            self.out[:, : near.shape[1]] = near + (near >= np.arange(n)[:, None])
            for batch in np.array_split(rng.permutation(n), -(-n // BATCH)):
                self._insert(batch)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes that end up in each query's beam, nearest first (-1 where it isn't full), and their distances."""
        b, n = len(q), len(self.x)
        rows = np.arange(b)[:, None]
        ids = np.full((b, beam), -1, np.int32)
        dist = np.full((b, beam), np.inf, np.float32)
        done = np.ones((b, beam), bool)
        seen = np.zeros((b, n + 1), bool)  # the last column stands for no node
        seen[:, -1] = True
        first = self.starts[:beam]
        ids[:, : len(first)], done[:, : len(first)] = first, False
        dist[:, : len(first)] = self.square[first] - 2 * q @ self.x[first].T
        seen[:, first] = True
        while True:
            order = np.argsort(np.where(done, np.inf, dist), axis=1)[:, :AT_ONCE]
            chosen = np.where(done[rows, order], -1, ids[rows, order])
            live = np.flatnonzero((chosen >= 0).any(1))
            if not len(live):
                return ids, dist
            done[rows, order] = True
            at = live[:, None]
            near = np.where(chosen[live][:, :, None] >= 0, self.out[chosen[live]], -1).reshape(len(live), -1)
            near = np.where(seen[at, near], -1, near)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            seen[at, near] = True
            d = self.square[near] - 2 * np.einsum("brd,bd->br", self.x[near], q[live])
            d[near < 0] = np.inf
            all_ids, all_dist = np.hstack([ids[live], near]), np.hstack([dist[live], d])
            all_done = np.hstack([done[live], near < 0])
            best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            pick = np.arange(len(live))[:, None]
            ids[live], dist[live], done[live] = all_ids[pick, best], all_dist[pick, best], all_done[pick, best]

    def _prune(self, points: np.ndarray, pool: np.ndarray) -> np.ndarray:
        """For each point DEGREE diverse ones of its pool (-1: none)."""
        rows = np.arange(len(points))
        gone = (pool < 0) | (pool == points[:, None])
        x = self.x[pool]
        d = self.square[pool] + self.square[points][:, None] - 2 * np.einsum("bld,bd->bl", x, self.x[points])
        kept = np.full((len(points), DEGREE), -1, np.int32)
        for k in range(DEGREE):
            pick = np.where(gone, np.inf, d).argmin(1)
            ok = ~gone[rows, pick]
            if not ok.any():
                break
            kept[:, k] = np.where(ok, pool[rows, pick], -1)
            between = self.square[pool] + self.square[pool[rows, pick]][:, None] - 2 * np.einsum("bld,bd->bl", x, x[rows, pick])
            gone |= (ALPHA**2 * between <= d) & ok[:, None]
            gone[rows, pick] = True
        return kept

    def _insert(self, points: np.ndarray) -> None:
        found, _ = self.search(self.x[points], BEAM)
        self.out[points] = self._prune(points, np.hstack([found, self.out[points]]))
        source = np.repeat(points, DEGREE)
        target = self.out[points].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        to, first, n = np.unique(target, return_index=True, return_counts=True)
        more = np.full((len(to), int(n.max(initial=0))), -1, np.int32)
        more[np.repeat(np.arange(len(to)), n), np.arange(len(target)) - np.repeat(first, n)] = source
        pool = np.hstack([self.out[to], more])
        pool.sort(axis=1)
        pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1
        pool = -np.sort(-pool, axis=1)
        fits = (pool >= 0).sum(1) <= DEGREE
        self.out[to[fits]] = pool[fits, :DEGREE] if pool.shape[1] >= DEGREE else np.pad(pool[fits], ((0, 0), (0, DEGREE - pool.shape[1])), constant_values=-1)
        if not fits.all():
            self.out[to[~fits]] = self._prune(to[~fits], pool[~fits])


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id, x, dim of the rows that take part."""
    x = F.col("x")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.select(F.col(key).alias("id"), F.col(vector).alias("x")).where(F.col("id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0)).withColumn("dim", F.size(x))


def dealt(rows: DataFrame, shard: int) -> tuple[DataFrame, DataFrame]:
    """rows with their shard, and the number of shards for each dim."""
    shards = rows.groupBy("dim").agg(F.ceil(F.count("*") / shard).alias("shards"))
    return rows.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards"))).drop("shards"), shards


def index(rows: DataFrame) -> DataFrame:
    """dim, shard, ids, x, neighbours: the graph of each shard, a row for each distinct vector."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        x, first, which = np.unique(np.array(group["x"].tolist(), np.float64), axis=0, return_index=True, return_inverse=True)
        ids = group["id"].to_numpy()
        order = np.argsort(which.ravel(), kind="stable")
        members = np.split(ids[order], np.cumsum(np.bincount(which.ravel()))[:-1])
        graph = Graph(x.astype(np.float32))
        return pd.DataFrame({"dim": group["dim"].iloc[0], "shard": group["shard"].iloc[0], "node": np.arange(len(x)), "ids": [m.tolist() for m in members], "x": x.tolist(), "neighbours": graph.out.tolist()})

    return rows.groupBy("dim", "shard").applyInPandas(build, "dim int, shard long, node int, ids array<long>, x array<double>, neighbours array<int>")


def search(graphs: DataFrame, shards: DataFrame, queries: DataFrame, k: int = K, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, vec_id, score: each query's k best of each shard."""
    blocks = queries.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("blocks"))
    to_all = queries.join(shards, "dim").join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).select("id", "x", "dim", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    for_all = graphs.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")

    def walk(nodes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if nodes.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        nodes = nodes.sort_values("node")
        x = np.array(nodes["x"].tolist())
        members = nodes["ids"].tolist()
        graph = Graph(x.astype(np.float32), np.array(nodes["neighbours"].tolist(), np.int32))
        q = np.array(asked["x"].tolist(), np.float64)
        rows = []
        for at in range(0, len(q), BATCH):
            part, own = q[at : at + BATCH], asked["id"].to_numpy()[at : at + BATCH]
            lifted = np.hstack([part, np.zeros((len(part), 1))]).astype(np.float32)
            found, _ = graph.search(lifted, max(beam, k + 1))
            scores = np.einsum("bld,bd->bl", x[found], part)
            scores[found < 0] = -np.inf
            order = np.argsort(-scores, axis=1, kind="stable")
            for i, me in enumerate(own):
                taken, last = [], None
                for j in order[i]:
                    if found[i, j] < 0 or len(taken) >= k and scores[i, j] != last:
                        break
                    last = scores[i, j]
                    taken += [(me, int(v), last) for v in members[found[i, j]][: k + 1] if v != me]
                rows += sorted(taken, key=lambda t: (-t[2], t[1]))[:k]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return for_all.groupBy("dim", "shard", "block").cogroup(to_all.groupBy("dim", "shard", "block")).applyInPandas(walk, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = K, shard: int = SHARD, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score for all rows where is_query (a condition on id) holds, against all rows.

    shard: vectors of a graph, as many as a task's memory holds (a vector takes about 12 * dim + 1,000 bytes there): work is queries x shards.
    """
    rows, shards = dealt(usable(vectors, key, vector), shard)
    rows, shards = stored(rows, "vectors"), stored(shards, "shards")
    graphs = stored(index(rows), "graphs")
    found = search(graphs, shards, rows.where(is_query).select("id", "x", "dim"), k, beam)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 20 == 0)
