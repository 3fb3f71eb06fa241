"""Relationships and mappings (D)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from ._rank import dealt, top

RELATED = ["concept_name", "domain_id", "vocabulary_id", "concept_class_id", "concept_code", "standard_concept"]
KINDS = ("ontological", "mapping", "versioning", "attribute", "metadata")


def relationships(concepts: DataFrame, edges: DataFrame, ids: DataFrame, relationship_id: str | None = None, valid_only: bool = True, limit: int | None = 50) -> DataFrame:
    """Outgoing edges of each id with the target's metadata, by relationship and name."""
    rows = edges.join(ids.select(F.col("concept_id").alias("concept_id_1")).distinct(), "concept_id_1")
    if relationship_id is not None:
        rows = rows.where(F.col("relationship_id").ilike(relationship_id))
    if valid_only:
        rows = rows.where("invalid_reason is null")
    target = concepts.select(F.col("concept_id").alias("concept_id_2"), *(F.col(c).alias("related_concept_name" if c == "concept_name" else c) for c in RELATED))
    found = rows.drop("invalid_reason").join(target, "concept_id_2").withColumnsRenamed({"concept_id_1": "source_id", "concept_id_2": "related_concept_id"})
    return top(found, ["source_id"], ["relationship_id", "related_concept_name", "related_concept_id"], limit)


def relationships_as_concepts(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({"related_concept_id": "concept_id", "related_concept_name": "concept_name"})


def valid_maps(edges: DataFrame) -> DataFrame:
    """(concept_id, target) of valid mappings to another concept."""
    return edges.where("relationship_id = 'Maps to' and invalid_reason is null and concept_id_1 <> concept_id_2").select(F.col("concept_id_1").alias("concept_id"), F.col("concept_id_2").alias("target"))


def one_hop_maps_to(concepts: DataFrame, edges: DataFrame, ids: DataFrame) -> DataFrame:
    """The least valid mapping target of each id, with its metadata."""
    first = valid_maps(edges).join(ids.select("concept_id").distinct(), "concept_id", "left_semi").groupBy("concept_id").agg(F.min("target").alias("target_id"))
    target = concepts.select(F.col("concept_id").alias("target_id"), F.col("concept_name").alias("target_name"), F.col("vocabulary_id").alias("target_vocabulary"), F.col("standard_concept").alias("target_standard"))
    return first.join(target, "target_id").select("concept_id", "target_id", "target_name", "target_vocabulary", "target_standard")


def trace_standard_mapping(concepts: DataFrame, edges: DataFrame, ids: DataFrame, max_hops: int = 3) -> DataFrame:
    """concept_id, target_id, hops, chain (visited ids) and error of each id.

    A mapping is followed, least id first, until a standard concept; a concept met
    before ends the chain. hops is clamped to 1..5.
    """
    hops = min(max(max_hops, 1), 5)
    n = max(df.count() for df in (concepts, edges, ids))  # so many rows has a side of a join at most
    standard = concepts.select(F.col("concept_id").alias("at"), (F.col("standard_concept").eqNullSafe(F.lit("S"))).alias("standard"))
    maps = dealt(valid_maps(edges), n, "target").join(dealt(standard, n, "at"), F.col("target") == F.col("at")).select(F.col("concept_id").alias("at"), F.struct("target", "standard").alias("to"))
    step = written(dealt(maps, n, "at").groupBy("at").agg(F.min("to").alias("to")).select("at", F.col("to.target").alias("next"), F.col("to.standard").alias("fine")))
    live = ids.select("concept_id").distinct().withColumns({"at": F.col("concept_id"), "hops": F.lit(0).cast("long"), "chain": F.array("concept_id")})
    live = dealt(live, n, "at").join(dealt(standard, n, "at"), "at", "left").withColumn("done", F.when(F.col("standard").isNull(), F.lit("not found")).when(F.col("standard"), F.lit("ok"))).drop("standard")
    ended = []
    for _ in range(hops):
        live = written(live)  # read twice: what has ended is not carried through the joins
        ended.append(live.where("done is not null"))
        moved = dealt(live.where("done is null"), n, "at").join(dealt(step, n, "at"), "at", "left")
        go = F.col("next").isNotNull() & ~F.array_contains("chain", F.col("next"))
        stop = F.when(F.col("next").isNull(), F.lit("no mapping")).when(~go, F.lit("loop")).when(F.col("fine"), F.lit("ok"))
        live = moved.select("concept_id", F.when(go, F.col("next")).otherwise(F.col("at")).alias("at"), (F.col("hops") + go.cast("long")).alias("hops"), F.when(go, F.concat("chain", F.array("next"))).otherwise(F.col("chain")).alias("chain"), stop.alias("done"))
    live = reduce(DataFrame.unionByName, ended, live)
    ok = F.coalesce(F.col("done") == "ok", F.lit(False))
    return live.select("concept_id", F.when(ok, F.col("at")).alias("target_id"), "hops", "chain", F.when(~ok, F.coalesce("done", F.lit("too many hops"))).alias("error"))


def classify_predicates(relationship: DataFrame) -> DataFrame:
    """relationship_id and kind; the first rule that holds decides."""
    back = relationship.select(F.col("relationship_id").alias("reverse_relationship_id"), F.lower("relationship_name").alias("back"))
    name = F.lower("relationship_name")
    has = lambda *words: F.greatest(*(name.contains(w) for w in words), F.lit(False))
    kind = (
        F.when(F.col("defines_ancestry") == "1", "ontological")
        .when(has("maps to", "mapped from", "equivalent"), "mapping")
        .when(has("replaced", "replaces"), "versioning")
        .when(name.startswith("has ") | F.coalesce(F.col("back").startswith("has "), F.lit(False)), "attribute")
        .otherwise("metadata")
    )
    return relationship.join(back, "reverse_relationship_id", "left").select("relationship_id", kind.alias("kind"))


def relationship_ids_for_kinds(relationship: DataFrame, kinds: list[str] | None, empty_is_all: bool = True) -> DataFrame:
    """Ids of the kinds; unknown kinds are dropped, and none left means all ids unless told otherwise."""
    wanted = [k for k in kinds or [] if k in KINDS]
    found = classify_predicates(relationship)
    return found.select("relationship_id") if not wanted and empty_is_all else found.where(F.col("kind").isin(wanted)).select("relationship_id")


def outgoing_edges(edges: DataFrame, frontier: DataFrame, relationship_ids: DataFrame | None = None, cap: int | None = 200, incoming: bool = False) -> DataFrame:
    """Valid edges from (or to) a frontier(concept_id), at most `cap` a node, by relationship and other end."""
    own, other = ("concept_id_2", "concept_id_1") if incoming else ("concept_id_1", "concept_id_2")
    rows = edges.where("invalid_reason is null").join(frontier.select(F.col("concept_id").alias(own)).distinct(), own, "left_semi")
    if relationship_ids is not None:
        rows = rows.join(relationship_ids, "relationship_id", "left_semi")
    return top(rows, [own], ["relationship_id", other], cap, "turn").select("concept_id_1", "relationship_id", "concept_id_2")


def standardise(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct mapping targets, an unmapped id standing for itself."""
    maps = edges.where("relationship_id = 'Maps to' and invalid_reason is null").select(F.col("concept_id_1").alias("concept_id"), F.col("concept_id_2").alias("target"))
    return ids.select("concept_id").distinct().join(maps, "concept_id", "left").select(F.coalesce("target", "concept_id").alias("concept_id")).distinct()
