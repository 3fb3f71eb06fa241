"""Vector retrieval, scoring and fusion (G)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from . import vector_index
from ._rank import top
from .hierarchy import ancestry_check
from .mapping import valid_maps
from .search import search_concepts

#: Query and index vectors of a block.
QUERY_BLOCK, INDEX_BLOCK = 1024, 4096
#: Queries up to which their blocks are broadcast; more are dealt by a shuffle.
BROADCAST_QUERIES = 32_768


def hashing_encoder(names: list[str], dims: int = 64) -> np.ndarray:
    """Unit vectors of character trigram counts; the encoder used where no model is given."""
    out = np.zeros((len(names), dims))
    for i, name in enumerate(names):
        padded = f"  {name.lower()} "
        for j in range(len(padded) - 2):
            h = int.from_bytes(hashlib.blake2b(padded[j : j + 3].encode(), digest_size=4).digest(), "little")
            out[i, h % dims] += 1.0 if h >> 31 else -1.0
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def embed_texts(df: DataFrame, key: str, text: str, encoder: Callable[[list[str]], np.ndarray] = hashing_encoder) -> DataFrame:
    """key and embedding of every row; the encoder runs in the tasks, a batch at a time."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = encoder([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(vectors), pa.list_(pa.float64()))], ["key", "embedding"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, embedding array<double>").withColumnRenamed("key", key)


def enriched_text(concepts: DataFrame, synonyms: DataFrame, closure: DataFrame, n_synonyms: int = 5, n_parents: int = 3, size: int = 1500) -> DataFrame:
    """name | synonyms | level-1 parents | domain | vocabulary of every concept, cut at `size` characters."""
    joined = lambda df, c: df.groupBy("concept_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", c))), lambda x: x[c]), ", ").alias(c))
    named = joined(top(synonyms, ["concept_id"], ["concept_synonym_name"], n_synonyms, "turn"), "concept_synonym_name")
    up = closure.where("min_levels_of_separation = 1").select(F.col("descendant_concept_id").alias("concept_id"), F.col("ancestor_concept_id").alias("parent_id")).join(concepts.select(F.col("concept_id").alias("parent_id"), F.col("concept_name").alias("parent")), "parent_id")
    above = joined(top(up, ["concept_id"], ["parent", "parent_id"], n_parents, "turn"), "parent")
    rows = concepts.join(named, "concept_id", "left").join(above, "concept_id", "left")
    return rows.select("concept_id", F.substring(F.concat_ws(" | ", "concept_name", "concept_synonym_name", "parent", "domain_id", "vocabulary_id"), 1, size).alias("text"))


def cosine_similarity(a, b):
    """Cosine of two arrays as a column expression, in double."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _packed(df: DataFrame, key: str, rows: int) -> DataFrame:
    """df(key, embedding) as blocks of at most `rows` rows: keys, unit vectors as bytes, their length. Null vectors are left out."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                x = np.stack([v.values.to_numpy(zero_copy_only=False) for v in part.column(1)])
                x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_numpy().tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), pa.array([x.shape[1]], pa.int32())], ["keys", "vectors", "dims"])

    return df.select(F.col(key).cast("long").alias("key"), F.col("embedding").cast("array<double>").alias("embedding")).where("key is not null and embedding is not null").mapInArrow(pack, "keys binary, vectors binary, dims int")


def cosine_topk(queries: DataFrame, index: DataFrame, k: int = 10, key: str = "concept_id", own: bool = True, **equal: str | None) -> DataFrame:
    """query_id, rank, key, similarity (6 places) of the k nearest index rows of each query, exactly.

    queries(query_id, embedding), index(key, embedding, ...). Filters such as
    domain_id="Product" hold before scoring; with own=False a row is no neighbour
    of the query of its id. Both sides are packed in blocks of rows, and each pair
    of blocks is scored in a task by matrix products of bounded size, of which only k a
    query go on; neither side passes through the driver, but for query blocks that are few
    enough to be broadcast. Order: similarity, then key.
    """
    for column, value in equal.items():
        if value is not None:
            index = index.where(F.col(column) == value)
    n = queries.count()
    blocks = max(1, -(-n // QUERY_BLOCK))
    asked = _packed(queries.repartition(blocks), "query_id", QUERY_BLOCK).select(F.col("keys").alias("asked"), F.col("vectors").alias("wanted"), F.col("dims").alias("wanted_dims"))
    # A stated set of queries meets all rows, block by block.
    pairs = _packed(index, key, INDEX_BLOCK).crossJoin(F.broadcast(asked) if n <= BROADCAST_QUERIES else asked).select("keys", "vectors", "asked", "wanted", "dims", "wanted_dims")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dims = batch.column(4)[row].as_py()
                if dims != batch.column(5)[row].as_py():
                    continue
                keys, ids = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int64) for c in (0, 2))
                x, q = (np.frombuffer(batch.column(c)[row].as_buffer(), np.float64).reshape(-1, dims) for c in (1, 3))
                for part in vector_index.slices_of(len(q), len(x)):
                    order, best = vector_index.nearest_rows(q[part] @ x.T, keys, np.True_ if own else keys != ids[part, None], k)
                    best, real = best.reshape(-1), best.reshape(-1) > -np.inf
                    columns = np.repeat(ids[part], order.shape[1])[real], keys[order.reshape(-1)][real], best[real]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "key", "similarity"])

    found = pairs.mapInArrow(run, "query_id long, key long, similarity double")
    return top(found, ["query_id"], [F.col("similarity").desc(), "key"], k).select("query_id", "rank", F.col("key").alias(key), "similarity")


def resolve_via_nonstandard(hits: DataFrame, concepts: DataFrame, maps: DataFrame, k_std: int = 10, target_domain: str | None = None, target_vocabulary: str | None = None) -> DataFrame:
    """Standard targets of each query's non-standard hits(query_id, concept_id, similarity): best similarity, number of sources, provenance.

    maps(concept_id, target). The filters hold after the hits were cut.
    """
    fine = concepts.where("standard_concept = 'S' and invalid_reason is null").select(F.col("concept_id").alias("target"), F.col("concept_name").alias("target_name"), "domain_id", "vocabulary_id")
    if target_domain is not None:
        fine = fine.where(F.col("domain_id") == target_domain)
    if target_vocabulary is not None:
        fine = fine.where(F.col("vocabulary_id") == target_vocabulary)
    rows = hits.join(maps, "concept_id").join(fine, "target")
    source = F.struct((-F.col("similarity")).alias("order"), "concept_id", "similarity")
    grouped = rows.groupBy("query_id", F.col("target").alias("concept_id"), "target_name").agg(F.max("similarity").alias("similarity"), F.countDistinct("concept_id").alias("n_sources"), F.array_sort(F.collect_set(source)).alias("provenance"))
    return top(grouped, ["query_id"], [F.col("similarity").desc(), "concept_id"], k_std)


def provenance_top3(resolved: DataFrame) -> DataFrame:
    return resolved.select("query_id", "concept_id", F.posexplode(F.slice("provenance", 1, 3)).alias("place", "source")).select("query_id", "concept_id", (F.col("place") + 1).cast("long").alias("place"), F.col("source.concept_id").alias("source_id"), F.col("source.similarity").alias("similarity"))


def approx_topk(queries: DataFrame, index: DataFrame, k: int = 10, key: str = "concept_id", own: bool = True, **equal: str | None) -> DataFrame:
    """cosine_topk by an inverted index of product-quantised vectors, built here; build_index() and search() of vector_index keep one for many uses."""
    built = vector_index.build_index(index, key, tuple(c for c, value in equal.items() if value is not None))
    if built is None:
        return cosine_topk(queries.where("false"), index.where("false"), k, key)
    return vector_index.search(queries, built, k, key, own, **equal)


def rerank_cosine(hits: DataFrame, k: int = 10) -> DataFrame:
    """hits(query_id, keyword, concept_id, concept_name, similarity) by 0.4 cosine + 0.3 Levenshtein + 0.3 word overlap."""
    score = 0.4 * F.col("similarity") + 0.3 * tx.levenshtein_ratio(F.col("keyword"), F.col("concept_name")) + 0.3 * tx.jaccard_tokens(F.col("keyword"), F.col("concept_name"))
    return top(hits.withColumn("score", F.round(score, 6)), ["query_id"], [F.col("score").desc(), "concept_id"], k)


def ground_terms(concepts: DataFrame, synonyms: DataFrame, queries: DataFrame, closure: DataFrame | None = None, vectors: tuple[DataFrame, DataFrame] | None = None, require_standard: bool = True, max_results: int = 5, ratio=tx.gestalt, **filters) -> DataFrame:
    """query_id, rank, concept_id, concept_name, match_tier, score[, separation] of queries(query_id, keyword[, parent_concept_id]).

    Names are searched first; queries with fewer than three candidates also search
    synonyms, and those still short the vectors (queries, index) if given. A
    concept keeps the first tier that found it. With a parent, only it and its
    descendants stay, taken in cascade order up to max_results before sorting.
    """
    limit = min(max(4 * max_results, 20), 50)
    asked = queries.select("query_id", "keyword")
    key = ["query_id", "concept_id"]

    def short(found: DataFrame) -> DataFrame:
        counts = found.groupBy("query_id").agg(F.countDistinct("concept_id").alias("n"))
        return asked.join(counts, "query_id", "left").where(F.coalesce("n", F.lit(0)) < 3).select("query_id", "keyword")

    tier = lambda df, n: df.select(*key, F.lit(n).cast("long").alias("match_tier"), F.col("rank").alias("place"))
    found = tier(search_concepts(concepts, asked, limit=limit, standard_only=require_standard, valid_only=True, **filters), 1)
    found = found.union(tier(search_concepts(concepts, short(found), synonyms, limit=limit, standard_only=require_standard, valid_only=True, **filters), 2))
    if vectors is not None:
        asked_vectors = vectors[0].join(short(found).select("query_id"), "query_id", "left_semi")
        found = found.union(tier(cosine_topk(asked_vectors, vectors[1], min(limit, 20)), 3))
    first = found.groupBy(*key).agg(F.min(F.struct("match_tier", "place")).alias("at")).select(*key, "at.*")
    rows = first.join(concepts.select("concept_id", "concept_name"), "concept_id").join(asked, "query_id")
    score = F.round(tx.hybrid_score(F.col("keyword"), F.col("concept_name"), ratio), 6)
    if closure is None or "parent_concept_id" not in queries.columns:
        rows = (promising(rows, max_results) if ratio is tx.gestalt else rows).withColumn("score", score)
        return top(rows, ["query_id"], [F.col("score").desc(), "concept_id"], max_results).select("query_id", "rank", "concept_id", "concept_name", "match_tier", "score")
    rows = rows.join(queries.select("query_id", "parent_concept_id"), "query_id")
    checked = ancestry_check(closure, rows.select(F.col("query_id").alias("pair_id"), F.col("parent_concept_id").alias("ancestor"), F.col("concept_id").alias("descendant")).distinct()).select(F.col("pair_id").alias("query_id"), F.col("descendant").alias("concept_id"), F.col("separation").alias("below"))
    rows = rows.join(checked, key).withColumn("separation", F.when(F.col("concept_id") == F.col("parent_concept_id"), F.lit(0).cast("long")).otherwise(F.col("below"))).where("separation is not null")
    kept = top(rows, ["query_id"], ["match_tier", "place", "concept_id"], max_results, "turn").withColumn("score", score)
    return top(kept, ["query_id"], ["separation", F.col("score").desc(), "concept_id"], None).select("query_id", "rank", "concept_id", "concept_name", "match_tier", "score", "separation")


def promising(rows: DataFrame, k: int) -> DataFrame:
    """Rows(query_id, keyword, concept_name, ...) that can still be among the k of best hybrid score of their query.

    A row is left out if the most that its text ratio can be leaves it below k rows
    at the least that theirs can be; both are column functions.
    """
    keyword, name = F.col("keyword"), F.col("concept_name")
    known = tx.gestalt_known(keyword, name)
    least, most = (tx.hybrid_score(keyword, name, lambda a, b, other=other: F.coalesce(known, other)) for other in (F.lit(0.0), tx.gestalt_bound(keyword, name)))
    ranked = top(rows.withColumn("_least", least), ["query_id"], [F.col("_least").desc()], None, "_turn")
    reached = F.max(F.when(F.col("_turn") == k, F.col("_least"))).over(Window.partitionBy("query_id"))
    return ranked.withColumn("_reached", reached).where(F.col("_reached").isNull() | (most >= F.col("_reached") - 2e-6)).drop("_least", "_turn", "_reached")


def rrf_fuse(rankings: DataFrame, k: int = 60, limit: int | None = None) -> DataFrame:
    """Sum of 1 / (k + rank) over the lists of rankings(query_id, source, concept_id, rank)."""
    fused = rankings.groupBy("query_id", "concept_id").agg(F.round(F.sum(1.0 / (k + F.col("rank"))), 9).alias("score"))
    return top(fused, ["query_id"], [F.col("score").desc(), "concept_id"], limit)


def round_robin_union(rankings: DataFrame, limit: int | None = None) -> DataFrame:
    """Lists interleaved by rank, then source; a concept counts at its first place."""
    first = rankings.groupBy("query_id", "concept_id").agg(F.min(F.struct("rank", "source")).alias("at"))
    return top(first, ["query_id"], ["at", "concept_id"], limit, "position").select("query_id", "position", "concept_id")


def mapped_targets(edges: DataFrame) -> DataFrame:
    return valid_maps(edges)
