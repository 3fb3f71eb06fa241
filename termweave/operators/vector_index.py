"""An inverted index of product-quantised vectors, for approximate cosine search (G6).

Unit vectors are dealt to cells, around centroids fitted by k-means on a bounded
sample; every row is indexed. A row is held beside its vector as one byte for each
slice of its difference from the centroid: the nearest of 256 slices learned on the
same sample. Rows stand in shards of bounded bytes, in order of their cells. A query
visits the shards of its nearest cells; there the rows of these cells are rated by
table lookups of their bytes, and the best of them are measured exactly. All of that
happens in the task that holds the shard, so only the k nearest of a query and shard
leave it. How many cells are visited is found on the sample, for a wanted recall:
few where vectors lie in clusters, many where they don't.

Index and model are tables: an index is built once, written, and searched by many
queries, with filters on the columns that were kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import written
from ._rank import top

#: Rows that centroids and slices are fitted on, at most: those of least hash. Rows of these that cells to visit are counted for.
SAMPLE_ROWS, TRIAL_QUERIES = 65_536, 256
#: Cells at most, and centroids of a slice.
MAX_CELLS, SLICE_CENTROIDS = 4096, 256
#: Dimensions of a slice, at most.
SLICE_DIMS = 4
#: Share of the ten nearest rows that the visited cells should hold.
RECALL = 0.96
#: Bytes of vectors in a shard; queries that meet it in one row, about.
SHARD_BYTES, QUERY_BLOCK = 8 << 20, 1024
#: Rows of a shard measured exactly, for each neighbour wanted.
REFINE = 16
#: Entries of a matrix in memory, about: rows are taken in slices that keep to it, however many cells, rows and queries there are.
MATRIX = 1 << 21
ROUNDS, SEED = 12, 7


@dataclass
class Model:
    """centroids [cells, dims], slices [slices, 256, dims of a slice], and cells that a query should visit; dims are padded with zeros to whole slices."""

    dims: int
    centroids: np.ndarray
    slices: np.ndarray
    probes: int

    def padded(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.slices.shape[0] * self.slices.shape[2] - x.shape[1])))

    def cells(self, x: np.ndarray, count: int) -> np.ndarray:
        """The nearest cells of each row, nearest first."""
        count = min(count, len(self.centroids))
        out = np.empty((len(x), count), np.int32)
        for own in slices_of(len(x), len(self.centroids)):
            far = (self.centroids**2).sum(1) - 2 * x[own] @ self.centroids.T
            near = np.argpartition(far, count - 1, axis=1)[:, :count]
            out[own] = np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable"), 1)
        return out

    def codes(self, rest: np.ndarray) -> np.ndarray:
        """A byte for each slice of the rows' differences from their centroids."""
        parts = self.padded(rest).reshape(len(rest), len(self.slices), -1)
        return np.stack([nearest(parts[:, s], self.slices[s]) for s in range(len(self.slices))], 1).astype(np.uint8)

    def ratings(self, rest: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """[query, row]: squared distance, about, of queries' and rows' differences from one centroid."""
        parts = self.padded(rest).reshape(len(rest), len(self.slices), -1)
        out = np.zeros((len(rest), len(codes)), np.float32)
        for s, own in enumerate(self.slices):
            table = (own**2).sum(1) - 2 * parts[:, s] @ own.T
            out += table.astype(np.float32)[:, codes[:, s]]
        return out


def slices_of(rows: int, width: int) -> list[slice]:
    """Slices of so many rows that a matrix of this width stays within MATRIX entries."""
    step = max(1, MATRIX // max(1, width))
    return [slice(at, min(at + step, rows)) for at in range(0, rows, step)]


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    own = np.empty(len(x), np.int64)
    for part in slices_of(len(x), len(centroids)):
        own[part] = ((centroids**2).sum(1) - 2 * x[part] @ centroids.T).argmin(1)
    return own


def nearest_rows(near: np.ndarray, keys: np.ndarray, real: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """[query, place]: columns of the k greatest similarities of 6 places, equal ones by key, and these similarities; -inf where a query has fewer that are real.

    near and real are [query, column]; keys are of the columns, or [query, column].
    """
    steps = np.floor(near * 1e6 + 0.5)
    real = real & np.isfinite(steps)
    turn = np.empty(keys.shape, np.int64)  # the place of each key
    np.put_along_axis(turn, np.argsort(keys, axis=-1, kind="stable"), np.broadcast_to(np.arange(keys.shape[-1]), keys.shape), -1)
    order = np.where(real, -steps, 2e6).astype(np.int64) * near.shape[1] + turn
    k = min(k, near.shape[1])
    at = np.argpartition(order, k - 1, axis=1)[:, :k]
    at = np.take_along_axis(at, np.argsort(np.take_along_axis(order, at, 1), axis=1), 1)
    return at, np.where(np.take_along_axis(real, at, 1), np.take_along_axis(steps, at, 1) / 1e6, -np.inf)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k centroids of x (k at most the rows), by Lloyd's rounds from distinct rows; an empty cell takes the row that is farthest from its own."""
    centroids = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centroids)
        counts = np.bincount(own, minlength=k)
        held, empty = np.flatnonzero(counts), np.flatnonzero(counts == 0)
        sums = np.add.reduceat(x[np.argsort(own, kind="stable")], np.cumsum(counts[held]) - counts[held])
        centroids[held] = sums / counts[held, None]
        if len(empty):
            far = ((x - centroids[own]) ** 2).sum(1)
            centroids[empty] = x[np.argsort(-far, kind="stable")[: len(empty)]]
    return centroids


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _usable(df: DataFrame, key: str, *more: str) -> DataFrame:
    """key, embedding (as doubles) and further columns of rows with a key and a vector wholly finite."""
    v = F.col("embedding")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col("embedding").cast("array<double>").alias("embedding"), *more)
    return rows.where(F.col("key").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(index: DataFrame, key: str = "concept_id", cells: int | None = None) -> Model | None:
    """The model of a table of vectors; None where none is usable.

    The sample holds SAMPLE_ROWS rows at most, those of least hash of key and
    vector; its commonest length (of several, the longest) is the index's. Cells
    are four times the root of the rows, as far as the sample has two rows for each.
    """
    rows = _usable(index, key)
    n = rows.count()
    sample = rows.select("embedding", F.xxhash64("key", "embedding").alias("turn")).orderBy("turn").limit(SAMPLE_ROWS).toArrow()
    if not sample.num_rows:
        return None
    lists = sample.column("embedding").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    kinds, counts = np.unique(sizes, return_counts=True)
    dims = int(kinds[counts == counts.max()].max())
    x = unit(np.stack([v.values.to_numpy(zero_copy_only=False) for v, size in zip(lists, sizes) if size == dims]))
    rng = np.random.default_rng(SEED)
    k = cells or min(MAX_CELLS, int(4 * np.sqrt(n)), -(-len(x) // 2))
    centroids = k_means(x, max(1, min(k, len(x))), rng)
    slices = -(-dims // SLICE_DIMS)
    model = Model(dims, centroids, np.zeros((slices, 1, SLICE_DIMS)), len(centroids))
    own = nearest(x, centroids)
    parts = model.padded(x - centroids[own]).reshape(len(x), slices, SLICE_DIMS)
    model.slices = np.stack([k_means(parts[:, s], min(SLICE_CENTROIDS, len(x)), rng) for s in range(slices)])
    model.probes = _probes(model, x, own)
    return model


def _probes(model: Model, x: np.ndarray, own: np.ndarray) -> int:
    """The fewest cells that hold RECALL of the ten nearest rows of the sample, over its first rows as queries; own: the rows' cells."""
    asked = x[:TRIAL_QUERIES]
    wanted = np.empty((len(asked), min(10, len(x) - 1)), np.int64)
    for part in slices_of(len(asked), len(x)):
        near = asked[part] @ x.T
        near[np.arange(len(near)), np.arange(part.start, part.stop)] = -np.inf
        wanted[part] = np.argsort(-near, axis=1, kind="stable")[:, : wanted.shape[1]]
    if not wanted.size:
        return 1
    turn = np.argsort(model.cells(asked, len(model.centroids)), axis=1)  # of each cell, for each query
    needed = np.sort(np.take_along_axis(turn, own[wanted], 1).reshape(-1))
    return int(needed[int(np.ceil(RECALL * len(needed))) - 1]) + 1


@dataclass
class VectorIndex:
    """The model, and shards(shard, n, held, cells, keys, vectors, codes, kept columns as arrays of text); held: its distinct cells, cells: the cell of each row."""

    model: Model
    shards: DataFrame
    kept: list[str]

    def write(self, path: str) -> None:
        """Stores shards and model below a folder, as tables."""
        m, spark = self.model, self.shards.sparkSession
        self.shards.write.parquet(f"{path}/shards")
        row = [(m.dims, m.probes, list(self.kept), list(m.slices.shape), bytearray(m.centroids.tobytes()), bytearray(m.slices.tobytes()))]
        spark.createDataFrame(row, "dims int, probes int, kept array<string>, shape array<int>, centroids binary, slices binary").coalesce(1).write.parquet(f"{path}/model")

    @staticmethod
    def read(spark: SparkSession, path: str) -> VectorIndex:
        row = spark.read.parquet(f"{path}/model").first()
        model = Model(row.dims, np.frombuffer(row.centroids).reshape(-1, row.dims), np.frombuffer(row.slices).reshape(row["shape"]), row.probes)
        return VectorIndex(model, spark.read.parquet(f"{path}/shards"), list(row.kept))


def build_index(index: DataFrame, key: str = "concept_id", keep: tuple[str, ...] = (), model: Model | None = None) -> VectorIndex | None:
    """The written index of every usable row of index(key, embedding, ...), with the columns of `keep` as text for filters; None where no row is usable.

    Rows are dealt by ranges of cell and key, so a cell that holds much of the
    table is spread over tasks and shards. Rows of another length than the model's
    are left out.
    """
    model = model or fit(index, key)
    if model is None:
        return None
    kept = list(keep)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(_matrix(batch.column(1)))
            cell = model.cells(x, 1)[:, 0]
            codes = model.codes(x - model.centroids[cell])
            arrays = [pa.array(cell.astype(np.int32)), batch.column(0), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "key", "vector", "code", *kept])

    rows = _usable(index, key, *(F.col(c).cast("string").alias(c) for c in kept)).where(F.size("embedding") == model.dims)
    dealt = rows.mapInArrow(deal, "cell int, key long, vector binary, code binary" + "".join(f", `{c}` string" for c in kept)).repartitionByRange("cell", "key").sortWithinPartitions("cell", "key")
    most = max(1, SHARD_BYTES // (8 * model.dims))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                cells = part.column(0).to_numpy()
                binary = [cells.tobytes(), part.column(1).to_numpy().tobytes(), *(b"".join(part.column(c).to_pylist()) for c in (2, 3))]
                lists = [pa.array([part.column(4 + i).to_pylist()], pa.list_(pa.string())) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([part.num_rows], pa.int32()), pa.array([np.unique(cells)], pa.list_(pa.int32())), *(pa.array([b], pa.binary()) for b in binary), *lists], ["shard", "n", "held", "cells", "keys", "vectors", "codes", *kept])
                number += 1

    shards = dealt.mapInArrow(pack, "shard long, n int, held array<int>, cells binary, keys binary, vectors binary, codes binary" + "".join(f", `{c}` array<string>" for c in kept))
    return VectorIndex(model, written(shards), kept)


def _asked(queries: DataFrame, index: VectorIndex, probes: int) -> DataFrame:
    """shard, asked, wanted: the ids and unit vectors of queries, for each shard that holds a cell they visit, in blocks."""
    model = index.model

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for part in slices_of(len(x), len(model.centroids)):
                cells = model.cells(unit(x[part]), probes)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[part], cells.shape[1])), pa.array(cells.reshape(-1))], ["query_id", "cell"])

    rows = _usable(queries, "query_id").where(F.size("embedding") == model.dims).withColumnRenamed("key", "query_id")
    if probes < len(model.centroids):
        visits = rows.mapInArrow(visit, "query_id long, cell int").join(index.shards.select("shard", F.explode("held").alias("cell")), "cell").select("query_id", "shard").distinct()
    else:  # every cell is visited, so every shard
        visits = rows.select("query_id").distinct().crossJoin(F.broadcast(index.shards.select("shard")))
    met = visits.join(rows, "query_id")
    counts = visits.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("blocks"))  # a row holds so many queries, about
    dealt = met.join(counts, "shard").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")))
    return dealt.groupBy("shard", "block").agg(F.collect_list(F.struct("query_id", "embedding")).alias("asked")).drop("block")


def search(queries: DataFrame, index: VectorIndex, k: int = 10, key: str = "concept_id", own: bool = True, probes: int | None = None, refine: int | None = REFINE, counted: bool = False, **equal: str | None) -> DataFrame:
    """query_id, rank, key, similarity (6 places) of the k nearest rows found for each row of queries(query_id, embedding).

    Filters such as domain_id="Product", on kept columns, hold before rows are
    rated; with own=False a row is no neighbour of the query of its id. probes:
    cells visited, those that the model found if not given; refine: rows of a shard
    measured exactly for each neighbour wanted, None for all. With every cell and
    all rows the search is exact. Order: similarity, then key. counted=True gives
    query_id, n_rated and n_measured, the rows that it took, instead.
    """
    model = index.model
    wanted = {c: str(v) for c, v in equal.items() if v is not None}
    if not set(wanted) <= set(index.kept):
        raise ValueError(f"the index keeps {index.kept}")
    probes = min(probes or model.probes, len(model.centroids))
    pairs = index.shards.join(_asked(queries, index, probes), "shard").select("cells", "keys", "vectors", "codes", "asked", *wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                raw = [batch.column(c)[row].as_buffer() for c in range(4)]
                cells, keys = np.frombuffer(raw[0], np.int32), np.frombuffer(raw[1], np.int64)
                vectors, codes = np.frombuffer(raw[2]).reshape(len(keys), -1), np.frombuffer(raw[3], np.uint8).reshape(len(keys), -1)
                take = np.ones(len(keys), bool)
                for i, value in enumerate(wanted.values()):
                    take &= np.array([x == value for x in batch.column(5 + i)[row].as_py()], bool)
                if not take.all():
                    cells, keys, vectors, codes = cells[take], keys[take], vectors[take], codes[take]
                asked = batch.column(4)[row].values
                ids, x = asked.field("query_id").to_numpy(), unit(_matrix(asked.field("embedding")))
                width = max(len(keys), len(model.centroids), model.dims * (0 if refine is None else refine * (k + 1)))
                for part in slices_of(len(ids) if len(keys) else 0, width):
                    yield _nearest(model, probes, ids[part], x[part], cells, keys, vectors, codes, k, own, refine, counted)

    if counted:
        return pairs.mapInArrow(run, "query_id long, rated long, measured long").groupBy("query_id").agg(F.sum("rated").alias("n_rated"), F.sum("measured").alias("n_measured"))
    found = pairs.mapInArrow(run, "query_id long, key long, similarity double")
    return top(found, ["query_id"], [F.col("similarity").desc(), "key"], k).select("query_id", "rank", F.col("key").alias(key), "similarity")


def _nearest(model: Model, probes: int, ids: np.ndarray, x: np.ndarray, cells: np.ndarray, keys: np.ndarray, vectors: np.ndarray, codes: np.ndarray, k: int, own: bool, refine: int | None, counted: bool) -> pa.RecordBatch:
    """The k nearest rows of a shard for each query, of the cells that it visits: rated by their codes, the best of them measured. Rows are in order of their cells."""
    visited = np.zeros((len(ids), len(model.centroids)), bool)
    np.put_along_axis(visited, model.cells(x, probes), True, 1)
    n, some = len(keys), len(keys) if refine is None else min(len(keys), refine * (k + 1))
    if some < n:
        rated = np.full((len(ids), n), np.inf, np.float32)
        ends = np.append(np.flatnonzero(np.append(True, cells[1:] != cells[:-1])), n)
        for begin, end in zip(ends[:-1], ends[1:]):
            mine = np.flatnonzero(visited[:, cells[begin]])
            if len(mine):
                rest = x[mine] - model.centroids[cells[begin]]
                rated[mine, begin:end] = model.ratings(rest, codes[begin:end]) + (rest**2).sum(1, keepdims=True)
        # as whole numbers with the row's place, so that of equal ratings the first rows are taken
        order = np.maximum(rated, 0).view(np.int32).astype(np.int64) << 32 | np.arange(n)
        at = np.argpartition(order, some - 1, axis=1)[:, :some]
        near, real = np.einsum("qd,qnd->qn", x, vectors[at]), np.isfinite(np.take_along_axis(rated, at, 1))
    else:
        at, near, real = np.broadcast_to(np.arange(n), (len(ids), n)), x @ vectors.T, visited[:, cells]
    if counted:
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(visited[:, cells].sum(1)), pa.array(real.sum(1))], ["query_id", "rated", "measured"])
    names = keys[at]
    if not own:
        real = real & (names != ids[:, None])
    place, best = nearest_rows(near, names if some < n else keys, real, k)
    best, real = best.reshape(-1), best.reshape(-1) > -np.inf
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, place.shape[1])[real]), pa.array(np.take_along_axis(names, place, 1).reshape(-1)[real]), pa.array(best[real])], ["query_id", "key", "similarity"])
