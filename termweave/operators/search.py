"""Concept filters, lookups and keyword search (B)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._pieces import contained
from ._rank import top

COLUMNS = ["concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id", "concept_code", "standard_concept", "invalid_reason"]
MAX_RESULTS = 50


def concept_filter(df: DataFrame, domain: str | None = None, vocabulary_id: str | None = None, concept_class: str | None = None, standard_only: bool = False, valid_only: bool = False) -> DataFrame:
    """Conjunction of the filters given; text filters ignore case and take the caller's % and _ as wildcards."""
    for column, pattern in (("domain_id", domain), ("vocabulary_id", vocabulary_id), ("concept_class_id", concept_class)):
        if pattern is not None:
            df = df.where(F.col(column).ilike(pattern))
    if standard_only:
        df = df.where("standard_concept = 'S'")
    return df.where("invalid_reason is null") if valid_only else df


def lookup_concepts(concepts: DataFrame, ids: DataFrame) -> DataFrame:
    """Eight columns of each known id, once."""
    return concepts.select(*COLUMNS).join(ids.select("concept_id").distinct(), "concept_id", "left_semi")


def missing_ids(concepts: DataFrame, ids: DataFrame) -> DataFrame:
    return ids.select("concept_id").distinct().join(concepts.select("concept_id"), "concept_id", "left_anti")


def _unknown(key: str = "concept_id"):
    return F.concat(F.lit("Unknown ("), F.col(key).cast("string"), F.lit(")"))


def concept_names(concepts: DataFrame, ids: DataFrame) -> DataFrame:
    """concept_id and its name, or Unknown (id)."""
    return ids.join(concepts.select("concept_id", "concept_name"), "concept_id", "left").select("concept_id", F.coalesce("concept_name", _unknown()).alias("concept_name"))


def source_header(concepts: DataFrame, ids: DataFrame) -> DataFrame:
    return ids.join(concepts.select("concept_id", "concept_name", "vocabulary_id"), "concept_id", "left").select("concept_id", F.coalesce("concept_name", _unknown()).alias("concept_name"), F.coalesce("vocabulary_id", F.lit("?")).alias("vocabulary_id"))


def concept_batch(concepts: DataFrame, frontier: DataFrame) -> DataFrame:
    """Node metadata of a frontier(set_id, concept_id)."""
    return frontier.join(concepts.select(*COLUMNS), "concept_id").select("set_id", *COLUMNS)


def _name_hits(names: DataFrame, queries: DataFrame) -> DataFrame:
    """Rows of names(text, ...) that contain a query's keyword, whatever the case."""
    holds = F.ilike(F.col("text"), F.concat(F.lit("%"), F.col("keyword"), F.lit("%")))
    return contained(names, F.col("text"), queries, holds, special=r"%_\\")


def search_concepts(concepts: DataFrame, queries: DataFrame, synonyms: DataFrame | None = None, limit: int = 25, max_limit: int = MAX_RESULTS, **filters) -> DataFrame:
    """query_id, rank and the columns of the best concepts of each query(query_id, keyword[, domain]).

    Exact names come first, then shorter ones, then by name and id. With synonyms,
    hits of names come before hits of synonyms, each shown by its concept's name.
    """
    limit = min(max(limit, 1), max_limit)
    pool = concept_filter(concepts, **filters)
    hits = _name_hits(pool.select(*COLUMNS, F.col("concept_name").alias("text")), queries).withColumn("source", F.lit(0))
    if synonyms is not None:
        named = pool.select(*COLUMNS).join(synonyms.select("concept_id", F.col("concept_synonym_name").alias("text")), "concept_id")
        hits = hits.unionByName(_name_hits(named, queries).withColumn("source", F.lit(1)))
    if "domain" in queries.columns:
        hits = hits.where("domain is null or domain_id ilike domain")
    if synonyms is not None:
        hits = top(hits, ["query_id", "concept_id"], ["source", F.length("text"), "text"], 1, "turn")
    exact = F.when(F.ilike(F.col("concept_name"), F.col("keyword")), 0).otherwise(1)
    found = top(hits, ["query_id"], ["source", exact, F.length("concept_name"), "concept_name", "concept_id"], limit)
    return found.select("query_id", "rank", *COLUMNS)
