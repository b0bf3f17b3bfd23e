"""Approximate nearest neighbours by a robust-pruned directed graph in each shard.

Nearness is the largest inner product, in double precision on the original vectors. Distinct vectors are dealt out into shards by
bands of their length (norm) and a hash: in a shard the lengths are alike, so that few long vectors do not hide the rest. There
are SHARDS shards, and more only where one would exceed SHARD vectors. A shard's graph is built on directions: it starts at random
and is refined in blocks, where a greedy search proposes neighbours, relaxed pruning (a candidate falls out if ALPHA times its
distance to a kept neighbour is at most its own distance) keeps up to DEGREE diverse edges, and reverse edges are pruned the same
way; a node that no edge leads to is hung on its nearest one. Each query searches each shard's graph with a beam ordered by inner
product, from the middle and the longest vectors; the shards' best are scored exactly and merged.

Equal vectors are one node with its least ids, as many as an answer can need, gathered in salted groups. Vectors that are
null, zero, or hold null or non-finite components take no part, neither as queries nor as candidates. Vectors of another number
of components have no inner product with a query: each number of components is searched by itself. A row's own id is never its
answer. Rows that repeat an id and a vector count once; where an id has several vectors, the least by its components asks, and
each is a candidate. With fewer candidates than k all found are returned; shards of up to `beam` nodes are searched whole. Ties
go to the lesser id. Empty tables give empty results. The result has columns of its own only; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._runtime import release, stored

SHARDS, SHARD, DEGREE, BEAM, BUILD, ALPHA, BLOCK = 8, 16_384, 32, 128, 64, 1.2, 256
#: Vectors that a shard should have before there are several, and longest vectors that a search starts from.
FEW, STARTS = 1024, 32
#: Rows of a group of equal vectors that are gathered in one step, about, and queries of one task.
COPIES, ASKED = 2000, 2048


class Graph:
    """A shard's vectors, their edges (-1: none; the last column holds nodes that nothing else leads to) and start nodes."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None, degree: int = DEGREE, beam: int = BUILD, alpha: float = ALPHA, seed: int = 7):
        self.x = vectors.astype(np.float32)
        length = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        n, self.degree = len(self.x), degree
        unit = (vectors / length[:, None]).astype(np.float32)
        middle = np.argsort(-(unit @ unit.mean(0)), kind="stable")[:1] if n else np.zeros(0, np.int64)
        self.starts = np.unique(np.concatenate([middle, np.argsort(-length, kind="stable")[:STARTS]]))
        if edges is not None:
            self.edges = edges
            return
        rng = np.random.default_rng(seed)
        self.edges = np.full((n, degree + 1), -1, np.int64)
        if n > 1:
            some = rng.integers(0, n - 1, (n, min(degree // 2, n - 1)))
            own = np.arange(n)[:, None]
            self.edges[:, : some.shape[1]] = np.where(some >= own, some + 1, some)
        if n > beam:
            real, self.x = self.x, unit  # neighbours by direction
            ends, self.starts = self.starts, middle
            for _ in range(2):
                order = rng.permutation(n)
                for a in range(0, n, BLOCK):
                    self._insert(order[a : a + BLOCK], beam, alpha)
            self._connect()
            self.x, self.starts = real, ends

    def _connect(self) -> None:
        """An edge to each node that has none, from its nearest neighbour or from the last one hung there."""
        into = np.bincount(self.edges[self.edges >= 0], minlength=len(self.x))
        for p in np.flatnonzero(into == 0).tolist():
            j = int(self.edges[p, 0])
            while j >= 0 and self.edges[j, -1] >= 0:
                j = int(self.edges[j, -1])
            if j >= 0:
                self.edges[j, -1] = p

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Nodes (-1: none) of a beam of each query, the largest inner product first."""
        n, q = len(self.x), len(queries)
        if n <= beam:
            return np.argsort(-(queries @ self.x.T), 1, kind="stable")
        s = self.starts[:beam]
        near = -(queries @ self.x[s].T)
        first = np.argsort(near, 1, kind="stable")
        nodes = np.full((q, beam), -1, np.int64)
        far = np.full((q, beam), np.inf, np.float32)
        done = np.ones((q, beam), bool)
        seen = np.zeros((q, n), bool)
        nodes[:, : len(s)], far[:, : len(s)], done[:, : len(s)] = s[first], np.take_along_axis(near, first, 1), False
        seen[:, s] = True
        live = np.arange(q)
        while len(live):
            open_at = np.argmin(done[live], 1)  # the beam is sorted: its first open node
            active = ~done[live, open_at]
            live, open_at = live[active], open_at[active]
            if not len(live):
                break
            done[live, open_at] = True
            to = self.edges[nodes[live, open_at]]
            ok = to >= 0
            ok &= ~seen[live[:, None], np.where(ok, to, 0)]
            seen[np.repeat(live, ok.sum(1)), to[ok]] = True
            d = np.where(ok, -np.einsum("qrd,qd->qr", self.x[np.where(ok, to, 0)], queries[live]), np.inf).astype(np.float32)
            all_far = np.concatenate([far[live], d], 1)
            best = np.argsort(all_far, 1, kind="stable")[:, :beam]
            far[live] = np.take_along_axis(all_far, best, 1)
            nodes[live] = np.take_along_axis(np.concatenate([nodes[live], np.where(ok, to, -1)], 1), best, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], ~ok], 1), best, 1)
        return nodes

    def _prune(self, node: int, candidates: np.ndarray, alpha: float) -> np.ndarray:
        """Up to degree diverse neighbours of a node."""
        c = np.unique(candidates)
        c = c[(c >= 0) & (c != node)]
        if not len(c):
            return c
        d = ((self.x[c] - self.x[node]) ** 2).sum(1)
        order = np.argsort(d, kind="stable")
        c, d = c[order], d[order]
        v = self.x[c]
        length = (v**2).sum(1)
        between = np.maximum(0, length[:, None] + length[None] - 2 * (v @ v.T))
        alive, kept = np.ones(len(c), bool), []
        for i in range(len(c)):
            if alive[i]:
                kept.append(i)
                if len(kept) == self.degree:
                    break
                alive &= alpha * alpha * between[i] > d  # distances are squared
        return c[kept]

    def _insert(self, block: np.ndarray, beam: int, alpha: float) -> None:
        nodes = self.search(self.x[block], beam)
        back: dict[int, list[int]] = {}
        for p, found in zip(block.tolist(), nodes, strict=True):
            kept = self._prune(p, np.concatenate([found, self.edges[p]]), alpha)
            self.edges[p] = -1
            self.edges[p, : len(kept)] = kept
            for j in kept.tolist():
                back.setdefault(j, []).append(p)
        for j, new in back.items():
            old = self.edges[j][self.edges[j] >= 0]
            both = np.union1d(old, new)
            if len(both) > self.degree:
                both = self._prune(j, both, alpha)
            self.edges[j] = -1
            self.edges[j, : len(both)] = both


def _usable(vec: str):
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def dealt(nodes: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """nodes with their shard, and (size, shard) of all shards. What is gathered is some numbers a shard, not a vector."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    nodes = nodes.select("v", "ids", F.size("v").alias("size"), length.alias("length"))
    cuts = [i / shards for i in range(1, shards)]
    bounds = {r["size"]: sorted(set(r["cuts"] or [])) for r in nodes.groupBy("size").agg(F.percentile_approx("length", cuts, 10_000).alias("cuts") if cuts else F.lit(None).alias("cuts")).collect()}
    table = F.create_map(*(c for s, b in bounds.items() for c in (F.lit(s), F.array(*(F.lit(float(x)) for x in b)).cast("array<double>"))))
    band = F.size(F.filter(table[F.col("size")], lambda x: x < F.col("length")))
    nodes = nodes.withColumn("band", band)
    share = max(1, nodes.count() // shards)
    first, out = 0, []
    for r in nodes.groupBy("size", "band").count().orderBy("size", "band").collect():
        parts = max(1, round(r["count"] / share))
        out.append((r["size"], r["band"], first, parts))
        first += parts
    spark = nodes.sparkSession
    found = spark.createDataFrame(out, "size int, band int, first int, parts int")  # a row a band
    nodes = nodes.join(F.broadcast(found), ["size", "band"])
    nodes = nodes.select("v", "ids", (F.col("first") + F.pmod(F.xxhash64("v"), F.col("parts"))).cast("int").alias("shard"))
    return nodes, found.select("size", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)).alias("shard"))


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 20, vec_id: str = "vec_id", vec: str = "embedding", shards: int = SHARDS, shard: int = SHARD, beam: int = BEAM) -> DataFrame:
    """The k nearest of each query's vector among vectors: query_id, rank (from 1), vec_id, score. queries has the same columns."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & _usable("v"))
    count = rows.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    # equal vectors: the k + 1 least ids, first in salted groups
    salts = count // COPIES + 1
    least = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    some = rows.groupBy("v", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")).agg(least(F.collect_list("id")).alias("ids"))
    some = some.groupBy("v", F.pmod("salt", F.lit(int(salts**0.5) + 1)).alias("salt")).agg(least(F.flatten(F.collect_list("ids"))).alias("ids"))
    nodes = stored(some.groupBy("v").agg(least(F.flatten(F.collect_list("ids"))).alias("ids")), "vectors")
    distinct = nodes.count()
    nodes, all_shards = dealt(nodes, max(-(-distinct // shard), min(shards, distinct // FEW), 1))
    number = all_shards.count()

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids = rows["ids"].combine_chunks()
        rows = rows.take(pa.array(np.argsort(ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()], kind="stable")))
        g = Graph(matrix(rows["v"].combine_chunks()))
        n, width = g.edges.shape
        edges = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(g.edges.ravel().astype(np.int32)))
        release()
        return pa.table({"shard": rows["shard"], "node": pa.array(np.arange(n), pa.int32()), "ids": rows["ids"], "v": rows["v"], "edges": edges})

    graphs = nodes.repartitionByRange(number, "shard").groupBy("shard").applyInArrow(build, "shard int, node int, ids array<long>, v array<double>, edges array<int>")
    graphs = stored(graphs, "graphs")

    asked = queries.select(F.col(vec_id).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & _usable("v"))
    asked = asked.groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, asked.count() // ASKED)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("size", F.size("v"))
    each = asked.join(F.broadcast(all_shards), "size").select("shard", "block", "id", "v")
    copies = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def ask(key: tuple, graph: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        scores = [np.zeros(0)]
        if len(graph) and len(asked):
            graph = graph.sort_by("node").combine_chunks()
            v, edges = matrix(graph["v"].combine_chunks()), matrix(graph["edges"].combine_chunks())
            g = Graph(v, edges.astype(np.int64))
            lists = graph["ids"].combine_chunks()
            at, ids = np.append(0, np.cumsum(lists.value_lengths().to_numpy())), lists.flatten().to_numpy()
            q, own = matrix(asked["v"].combine_chunks()), asked["id"].to_numpy()
            for a in range(0, len(q), BLOCK):
                part = q[a : a + BLOCK]
                for i, row in enumerate(g.search(part.astype(np.float32), beam)):
                    row = row[row >= 0]
                    s = (v[row] * part[i]).sum(1)
                    order = np.argsort(-s, kind="stable")[: k + 1 + beam]
                    out_ids = np.concatenate([ids[at[j] : at[j + 1]] for j in row[order]])
                    out_s = np.repeat(s[order], at[row[order] + 1] - at[row[order]])
                    ok = out_ids != own[a + i]
                    out_ids, out_s = out_ids[ok], out_s[ok]
                    top = np.lexsort((out_ids, -out_s))[:k]
                    found.append(np.stack([np.full(len(top), own[a + i]), out_ids[top]], 1))
                    scores.append(out_s[top])
        pairs, s = np.concatenate(found), np.concatenate(scores)
        release()
        return pa.table({"query_id": pairs[:, 0], "vec_id": pairs[:, 1], "score": s})

    tasks = number * blocks
    dealt_graphs, dealt_queries = (x.repartition(tasks, "shard", "block").groupBy("shard", "block") for x in (copies, each))
    near = dealt_graphs.cogroup(dealt_queries).applyInArrow(ask, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
