"""Approximate nearest neighbours by sharded HNSW graphs (operator 3).

Equal vectors are one point, which keeps the few least ids that a query can
need. Points are dealt to shards of bounded size by a hash of the vector; each
shard builds one hierarchical navigable small-world graph, kept as flat arrays
of neighbours, one row a shard. A stated query set is dealt to every shard in
blocks; each (shard, block) row is searched on its own, and the nearest of all
shards are merged by a window. Every vector is indexed.

Distances are in double precision, of differences taken first, and each shard is
scaled by a power of two, so neither an offset nor the scale of the vectors blurs
their order. A graph is built by insertion: a new node is searched for in the graph so far, and
linked to well-spread ones of the nodes found. Nodes are inserted, and queries are
answered, a block at a time, so that each step of their searches is one operation
on arrays; nodes of one block are also candidates for each other. Nodes are
numbered by falling level, so a level's nodes are the first ones.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

#: Points of a shard, about; its graph is built in one task. Work a point grows with the logarithm of this.
SHARD_POINTS = 16_384
#: Queries that meet a shard in one row.
BLOCK_QUERIES = 8192
#: Neighbours a node keeps (twice as many on the lowest level), and widths of the searches that build and that answer.
M, EF_BUILD, EF_SEARCH = 16, 128, 256
#: Scaled entries of queries are no larger, so that squares don't overflow.
FAR = 1e140
#: Nodes or queries searched together, at most, and nodes that each of them expands in one step.
TOGETHER, AHEAD = 512, 4


@dataclass
class Graph:
    """vectors of the nodes, links: neighbours of each level's nodes, lowest level first; -1 is none."""

    vectors: np.ndarray
    links: list[np.ndarray]

    def __post_init__(self) -> None:
        self.power = -exponent(self.vectors)
        self.points = np.ldexp(self.vectors, self.power)

    def distances(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distance of each (scaled) query to its own row of nodes; for the order of a search."""
        apart = self.points[nodes] - queries[:, None]
        return np.einsum("qkd,qkd->qk", apart, apart)

    def beam(self, level: int, queries: np.ndarray, entries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ef nearest nodes found for each query on one level, nearest first, and their distances; -1 and infinity fill up."""
        links, count = self.links[level], len(queries)
        ids, far = np.full((count, ef), -1, np.int64), np.full((count, ef), np.inf)
        ids[:, 0], far[:, 0] = entries, self.distances(queries, entries[:, None])[:, 0]
        todo = np.zeros((count, ef), bool)
        todo[:, 0] = True
        seen = np.zeros((count, len(links)), bool)
        seen[np.arange(count), entries] = True
        live = np.arange(count)
        while len(live):
            # the nearest few that were not expanded yet; lists are in order, so these are the first ones
            place = np.cumsum(todo[live], 1)
            turn = todo[live] & (place <= min(AHEAD, ef))
            nodes = np.full((len(live), min(AHEAD, ef)), -1, np.int64)
            row, column = np.nonzero(turn)
            nodes[row, place[row, column] - 1] = ids[live[row], column]
            todo[live] &= ~turn
            near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(live), -1).astype(np.int64)
            near.sort(1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            fresh &= ~seen[live[:, None], near]
            row, column = np.nonzero(fresh)
            seen[live[row], near[row, column]] = True
            d = np.full(near.shape, np.inf)
            rows, columns = np.nonzero(fresh)
            apart = self.points[near[rows, columns]] - queries[live[rows]]
            d[rows, columns] = np.einsum("id,id->i", apart, apart)
            both, far_both = np.concatenate((ids[live], near), 1), np.concatenate((far[live], d), 1)
            open_both = np.concatenate((todo[live], fresh), 1)
            order = np.argsort(far_both, axis=1, kind="stable")[:, :ef]
            ids[live], far[live] = np.take_along_axis(both, order, 1), np.take_along_axis(far_both, order, 1)
            todo[live] = np.take_along_axis(open_both, order, 1) & np.isfinite(far[live])
            live = live[todo[live].any(1)]
        ids[~np.isfinite(far)] = -1
        return ids, far

    def search(self, queries: np.ndarray, ef: int) -> np.ndarray:
        """The nodes found near each query."""
        queries, out = np.clip(np.ldexp(queries, self.power), -FAR, FAR), []
        step = together(len(self.vectors))
        for at in range(0, len(queries), step):
            part = queries[at : at + step]
            entries = np.zeros(len(part), np.int64)
            for level in range(len(self.links) - 1, 0, -1):
                entries = self.beam(level, part, entries, 1)[0][:, 0]
            out.append(self.beam(0, part, entries, ef)[0])
        return np.concatenate(out) if out else np.zeros((0, ef), np.int64)

    def choose(self, nodes: np.ndarray, near: np.ndarray, far: np.ndarray, m: int) -> np.ndarray:
        """m of each node's candidates (in order): nearest first, each if nearer to the node than to any taken; then the nearest of the rest."""
        points = self.points[near] - self.points[nodes][:, None]  # seen from the node, so that those near it are small
        square = np.einsum("qkd,qkd->qk", points, points)
        between = square[:, :, None] + square[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        real = np.isfinite(far) & (near >= 0)
        taken = np.zeros(near.shape, bool)
        for i in range(near.shape[1]):
            close = (taken[:, :i] & (between[:, i, :i] <= far[:, i, None])).any(1)
            taken[:, i] = real[:, i] & ~close & (taken[:, :i].sum(1) < m)
        order = np.argsort(np.where(taken, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :m]
        chosen = np.where(np.take_along_axis(real, order, 1), np.take_along_axis(near, order, 1), -1)
        return np.pad(chosen, ((0, 0), (0, m - chosen.shape[1])), constant_values=-1)

    def link(self, level: int, nodes: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        """Links the nodes to chosen candidates, and these back to them."""
        links = self.links[level]
        room = links.shape[1]
        chosen = self.choose(nodes, near, far, M)
        links[nodes, : chosen.shape[1]] = chosen
        row, column = np.nonzero(chosen >= 0)
        other, new = chosen[row, column], nodes[row]
        order = np.argsort(other, kind="stable")
        other, new = other[order], new[order]
        ends = np.append(np.flatnonzero(np.append(True, other[1:] != other[:-1])), len(other)) if len(other) else np.zeros(1, np.int64)
        most = int(np.diff(ends).max()) if len(other) else 0
        added = np.full((len(ends) - 1, most), -1, np.int64)
        group = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        added[group, np.arange(len(other)) - ends[group]] = new
        hosts = other[ends[:-1]] if len(other) else other
        for at in range(0, len(hosts), TOGETHER):
            host = hosts[at : at + TOGETHER]
            lists = np.concatenate((links[host].astype(np.int64), added[at : at + TOGETHER]), 1)
            d = np.where(lists >= 0, self.distances(self.points[host], lists), np.inf)
            order = np.argsort(d, axis=1, kind="stable")[:, : 2 * room]
            lists, d = np.take_along_axis(lists, order, 1), np.take_along_axis(d, order, 1)
            full = np.isfinite(d).sum(1) > room
            links[host[~full]] = lists[~full, :room]
            if full.any():
                links[host[full]] = self.choose(host[full], lists[full], d[full], room)


def exponent(vectors: np.ndarray) -> int:
    """The power of two just above all entries."""
    return int(np.frexp(np.abs(vectors).max(initial=0))[1])


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; a power of two keeps squares from overflow, and changes no digit."""
    half = np.ldexp(vectors, -1) - np.ldexp(query, -1)
    power = np.frexp(np.abs(half).max(1, initial=0))[1]
    return np.ldexp(np.sqrt((np.ldexp(half, -power[:, None]) ** 2).sum(1)), power + 1)


def together(points: int) -> int:
    """Searches of one block, so that what they have seen stays in some megabytes."""
    return max(8, min(TOGETHER, (1 << 24) // max(points, 1)))


def levels_of(n: int, seed: int = 11) -> np.ndarray:
    """Levels of n nodes, falling."""
    return np.sort(np.minimum((-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(M)).astype(np.int64), 6))[::-1]


def build(vectors: np.ndarray) -> Graph:
    """The graph of vectors (one at least), inserted in their order; the first ones have the higher levels."""
    n, levels = len(vectors), levels_of(len(vectors))
    sizes = [int((levels >= level).sum()) for level in range(int(levels[0]) + 1)]
    graph = Graph(vectors, [np.full((size, 2 * M if level == 0 else M), -1, np.int32) for level, size in enumerate(sizes)])
    begin = 0
    while begin < n:
        end = min(n, begin + min(together(n), max(begin, 64)))
        block = np.arange(begin, end)
        queries = graph.points[block]
        inner = np.stack([((queries - q) ** 2).sum(1) for q in queries])
        inner[np.arange(len(block))[:, None] <= np.arange(len(block))] = np.inf  # those before it in the block
        entries = np.zeros(len(block), np.int64)
        for level in range(len(sizes) - 1, -1, -1):
            mine = block < sizes[level]
            near, far = np.zeros((len(block), 0), np.int64), np.zeros((len(block), 0))
            if begin:
                wide = graph.beam(level, queries[mine], entries[mine], EF_BUILD)
                if not mine.all():
                    entries[~mine] = graph.beam(level, queries[~mine], entries[~mine], 1)[0][:, 0]
                entries[mine] = wide[0][:, 0]
                near, far = wide
            members = np.flatnonzero(mine)
            if not len(members):
                continue
            if not begin:
                near, far = near[mine], far[mine]
            far = np.concatenate((far, inner[np.ix_(mine, mine)]), 1)
            near = np.concatenate((near, np.broadcast_to(block[members], (len(members), len(members)))), 1)
            order = np.argsort(far, axis=1, kind="stable")[:, :EF_BUILD]
            graph.link(level, block[members], np.take_along_axis(near, order, 1), np.take_along_axis(far, order, 1))
        begin = end
    return graph


def _usable(table: DataFrame, vector: str, key: str) -> DataFrame:
    """Rows with an id and a vector that is not null, not zero and wholly finite, as doubles."""
    v = F.col("vector")
    rows = table.select(table[key].cast("long").alias("vec_id"), table[vector].cast("array<double>").alias("vector"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(F.forall(v, fine) & F.exists(v, lambda x: x != 0))


def nearest(table: DataFrame, queries: DataFrame, k: int = 10, vector: str = "embedding", key: str = "vec_id", ef: int = EF_SEARCH) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the k nearest found of each row of queries.

    Both tables hold key and vector. A row is no neighbour of the query of its own
    id. Vectors that are null, empty, zero, or hold null or non-finite parts take
    no part, nor do rows without id; vectors of a length other than a query's are
    never its neighbours. Ties go to the smaller id; of repeated rows of one id the
    least usable vector counts. Fewer candidates than k give fewer rows, an empty table none.
    """
    spark = table.sparkSession
    once = lambda df: _usable(df, vector, key).groupBy("vec_id").agg(F.min("vector").alias("vector")).select("vec_id", "vector", F.size("vector").alias("dims"))
    rows = once(table)
    # A point that many rows share keeps the ids that can matter; the limit already holds in each task before the shuffle.
    of_point = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("turn", F.row_number().over(of_point)).where(F.col("turn") <= k + 1)
    points = few.groupBy("vector", "dims").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    points = written(points)
    shards = max(1, -(-points.count() // SHARD_POINTS))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)))
    index = written(dealt.groupBy("dims", "shard").applyInArrow(_build_table, "dims int, shard long, points int, vectors binary, links binary, sizes array<int>, ids array<array<bigint>>"))
    asked = once(queries)
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    packed = (
        asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
        .groupBy("dims", "block")
        .agg(F.collect_list(F.struct("vec_id", "vector")).alias("asked"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n, raw, links, sizes, ids, asked = (batch.column(i)[row] for i in range(6))
                n = n.as_py()
                graph = Graph(np.frombuffer(raw.as_buffer(), np.float64).reshape(n, -1), [])
                flat, at = np.frombuffer(links.as_buffer(), np.int32), 0
                for level, size in enumerate(sizes.as_py()):
                    width = 2 * M if level == 0 else M
                    graph.links.append(flat[at : at + size * width].reshape(size, width))
                    at += size * width
                names = asked.values.field("vec_id").to_numpy()
                wanted = asked.values.field("vector").flatten().to_numpy().reshape(len(names), -1)
                members, out = ids.as_py(), []
                for one, query, nodes in zip(names.tolist(), wanted, graph.search(wanted, max(ef, k + 1))):
                    nodes = nodes[nodes >= 0]
                    distance = exact(graph.vectors[nodes], query)
                    got = [(d, i, one) for d, node in zip(distance.tolist(), nodes.tolist()) for i in members[node] if i != one]
                    out += heapq.nsmallest(k, got)
                if out:
                    score, vec, query_id = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(query_id, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())], ["query_id", "vec_id", "score"])

    pairs = index.join(packed, ["dims", "shard"]).select("points", "vectors", "links", "sizes", "ids", "asked").repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
    found = pairs.mapInArrow(answer, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _build_table(group: pa.Table) -> pa.Table:
    group = group.combine_chunks()
    vectors = group.column("vector").combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
    ids = group.column("ids").to_pylist()
    order = np.random.default_rng(13).permutation(sorted(range(len(ids)), key=lambda i: ids[i][0]))
    vectors, ids = vectors[order], [ids[i] for i in order]
    graph = build(vectors)
    links = b"".join(x.tobytes() for x in graph.links)
    return pa.table(
        {
            "dims": pa.array([vectors.shape[1]], pa.int32()), "shard": group.column("shard").slice(0, 1), "points": pa.array([len(ids)], pa.int32()), "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "links": pa.array([links], pa.binary()), "sizes": pa.array([[len(x) for x in graph.links]], pa.list_(pa.int32())), "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))),
        }
    )
