"""Neighbourhoods and ranked shortest paths (E)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from ._rank import top
from .mapping import classify_predicates, outgoing_edges, relationship_ids_for_kinds


def explore_subgraph(concepts: DataFrame, edges: DataFrame, seeds: DataFrame, relationship: DataFrame | None = None, kinds: list[str] | None = None, max_depth: int = 2, max_nodes: int | None = 50, edge_cap: int | None = 200) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, flags) around the seeds(set_id, concept_id) of each set.

    Outgoing edges are followed level by level. New nodes are admitted by depth and
    id up to max_nodes a set; an edge to a refused node stays, and the set's flag
    `truncated` tells of it.
    """
    wanted = relationship_ids_for_kinds(relationship, kinds) if relationship is not None and kinds else None
    seen = written(seeds.select("set_id", "concept_id").distinct().withColumn("depth", F.lit(0).cast("long")))
    found, refused = [], []
    for depth in range(1, max(max_depth, 1) + 1):
        frontier = seen.where(F.col("depth") == depth - 1)
        out = outgoing_edges(edges, frontier, wanted, edge_cap)
        walked = written(frontier.select("set_id", F.col("concept_id").alias("concept_id_1")).join(out, "concept_id_1").select("set_id", "concept_id_1", "relationship_id", "concept_id_2"))
        found.append(walked)
        new = walked.select("set_id", F.col("concept_id_2").alias("concept_id")).distinct().join(seen.select("set_id", "concept_id"), ["set_id", "concept_id"], "left_anti")
        if max_nodes is not None:
            held = seen.groupBy("set_id").agg(F.count("*").alias("held"))
            ranked = top(new, ["set_id"], ["concept_id"], None).join(held, "set_id").withColumn("fits", F.col("rank") + F.col("held") <= max_nodes)
            refused.append(ranked.where(~F.col("fits")).select("set_id"))
            new = ranked.where("fits")
        new = written(new.select("set_id", "concept_id").withColumn("depth", F.lit(depth).cast("long")))
        seen = seen.unionByName(new)
        if new.isEmpty():
            break
    nodes = seen.join(concepts.select("concept_id", "concept_name", "vocabulary_id"), "concept_id", "left").select("set_id", "concept_id", "depth", F.coalesce("concept_name", F.concat(F.lit("Unknown ("), F.col("concept_id").cast("string"), F.lit(")"))).alias("concept_name"), "vocabulary_id")
    sets = seeds.select("set_id").distinct()
    cut = reduce(DataFrame.union, refused).distinct().withColumn("truncated", F.lit(True)) if refused else None
    flags = sets.withColumn("truncated", F.lit(False)) if cut is None else sets.join(cut, "set_id", "left").select("set_id", F.coalesce("truncated", F.lit(False)).alias("truncated"))
    return nodes, reduce(DataFrame.union, found).distinct(), flags


def shortest_paths(edges: DataFrame, pairs: DataFrame, relationship_ids: DataFrame | None = None, max_depth: int = 6, max_hops: int | None = None, edge_cap: int | None = None) -> DataFrame:
    """pair_id, steps (array of subject, predicate, object) of all shortest paths of pairs(pair_id, source, target).

    Both ends are searched level by level, in turn; each side goes max_depth levels
    at most, so a path may be twice as long unless max_hops bounds it. Layers and the
    edges between them are kept for each end, whatever the number of its pairs; paths
    are built once the meeting level of a pair is known. Source and target alike give one path without steps.
    """
    step_type = "array<struct<subject_id:bigint,predicate_id:string,object_id:bigint>>"
    same = pairs.where("source = target").select("pair_id", F.array().cast(step_type).alias("steps"))
    live = written(pairs.where("source <> target").select("pair_id", "source", "target"))
    layers = {side: [live.select(F.col(side).alias("root"), F.col(side).alias("node")).distinct()] for side in ("source", "target")}
    between: dict[str, list[DataFrame]] = {"source": [], "target": []}
    paths = [same]
    for turn in range(min(2 * max_depth, max_hops or 2 * max_depth)):
        side = ("source", "target")[turn % 2]
        forward = side == "source"
        own, other = ("concept_id_1", "concept_id_2") if forward else ("concept_id_2", "concept_id_1")
        last = layers[side][-1].join(live.select(F.col(side).alias("root")).distinct(), "root", "left_semi")
        out = outgoing_edges(edges, last.select(F.col("node").alias("concept_id")), relationship_ids, edge_cap, incoming=not forward)
        seen = reduce(DataFrame.union, layers[side])
        walked = last.withColumnRenamed("node", own).join(out, own).join(seen.select("root", F.col("node").alias(other)), ["root", other], "left_anti")
        walked = written(walked.select("root", "concept_id_1", "relationship_id", "concept_id_2"))
        between[side].append(walked)
        layers[side].append(written(walked.select("root", F.col(other).alias("node")).distinct()))
        ends = {end: layers[end][-1].withColumnRenamed("root", end) for end in layers}
        meets = written(live.join(ends["source"], "source").join(ends["target"], ["target", "node"]))
        if not meets.isEmpty():
            paths.append(written(_paths(meets, between["source"], between["target"], step_type)))
            live = written(live.join(meets.select("pair_id").distinct(), "pair_id", "left_anti"))
            if live.isEmpty():
                break
    return reduce(DataFrame.union, paths)


def _paths(meets: DataFrame, left: list[DataFrame], right: list[DataFrame], step_type: str) -> DataFrame:
    """Paths from the nodes where the searches of a pair meet back to both its ends."""
    ends = ["pair_id", "source", "target"]
    rows = meets.select(*ends, F.col("node").alias("first"), F.col("node").alias("last"), F.array().cast(step_type).alias("steps"))
    step = F.struct(F.col("concept_id_1").alias("subject_id"), F.col("relationship_id").alias("predicate_id"), F.col("concept_id_2").alias("object_id"))
    for edges in reversed(left):
        back = edges.withColumnRenamed("root", "source").withColumn("first", F.col("concept_id_2"))
        rows = rows.join(back, ["source", "first"]).select(*ends, F.col("concept_id_1").alias("first"), "last", F.concat(F.array(step), "steps").alias("steps"))
    for edges in reversed(right):
        ahead = edges.withColumnRenamed("root", "target").withColumn("last", F.col("concept_id_1"))
        rows = rows.join(ahead, ["target", "last"]).select(*ends, "first", F.col("concept_id_2").alias("last"), F.concat("steps", F.array(step)).alias("steps"))
    return rows.select("pair_id", "steps")


def _walk() -> Column:
    """The concepts of a path, in order; none for a path without steps."""
    return F.concat(F.transform(F.slice("steps", 1, 1), lambda s: s["subject_id"]), F.col("steps.object_id"))


def path_profile(concepts: DataFrame, relationship: DataFrame, paths: DataFrame) -> DataFrame:
    """paths(pair_id, path_id, steps) with hops, invalid, non_standard, vocab_switches, ontological, mapping, metadata."""
    nodes = paths.select("pair_id", "path_id", F.posexplode(_walk()).alias("at", "concept_id"))
    known = nodes.join(concepts.select("concept_id", "vocabulary_id", "standard_concept", F.col("invalid_reason").alias("gone"), F.lit(True).alias("known")), "concept_id", "left")
    order = Window.partitionBy("pair_id", "path_id").orderBy("at")
    known = known.withColumn("before", F.lag("vocabulary_id").over(order))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    of_nodes = known.groupBy("pair_id", "path_id").agg(
        count(F.col("known").isNull() | F.col("gone").isNotNull()).alias("invalid"),
        count(~F.col("standard_concept").eqNullSafe(F.lit("S"))).alias("non_standard"),
        count(F.col("vocabulary_id") != F.col("before")).alias("vocab_switches"),
    )
    walked = paths.select("pair_id", "path_id", F.explode("steps.predicate_id").alias("relationship_id")).join(classify_predicates(relationship), "relationship_id", "left")
    of_edges = walked.groupBy("pair_id", "path_id").agg(*(count(F.col("kind") == k).alias(k) for k in ("ontological", "mapping", "metadata")))
    zero = lambda *names: [F.coalesce(n, F.lit(0)).alias(n) for n in names]
    rows = paths.join(of_nodes, ["pair_id", "path_id"], "left").join(of_edges, ["pair_id", "path_id"], "left")
    return rows.select("pair_id", "path_id", "steps", F.size("steps").cast("long").alias("hops"), *zero("invalid", "non_standard", "vocab_switches", "ontological", "mapping", "metadata"))


def rank_paths(profiles: DataFrame, max_paths: int | None = 10) -> DataFrame:
    """Profiles in order: fewer invalid, non-standard, metadata, mapping, vocabulary switches, hops; then by step text."""
    return top(profiles, ["pair_id"], ["invalid", "non_standard", "metadata", "mapping", "vocab_switches", "hops", F.to_json("steps")], max_paths)


def find_ranked_paths(concepts: DataFrame, edges: DataFrame, relationship: DataFrame, pairs: DataFrame, kinds: list[str] | None = None, max_depth: int = 6, max_paths: int = 10, max_hops: int | None = None) -> DataFrame:
    """All shortest paths of each pair, profiled and ranked, and of these the first max_paths."""
    wanted = relationship_ids_for_kinds(relationship, kinds) if kinds else None
    found = shortest_paths(edges, pairs, wanted, max(max_depth, 1), max_hops)
    numbered = written(top(found, ["pair_id"], [F.to_json("steps")], None, "path_id"))
    return rank_paths(path_profile(concepts, relationship, numbered), max(max_paths, 1))


def explain_paths(concepts: DataFrame, relationship: DataFrame, paths: DataFrame) -> DataFrame:
    """One row a step: ids, names and vocabularies of both ends, the predicate's name and kind."""
    rows = paths.select("pair_id", "path_id", F.posexplode("steps").alias("at", "step")).select("pair_id", "path_id", F.col("at").cast("long").alias("step_no"), "step.*")
    for end in ("subject", "object"):
        named = concepts.select(F.col("concept_id").alias(f"{end}_id"), F.col("concept_name").alias("n"), F.col("vocabulary_id").alias("v"))
        rows = rows.join(named, f"{end}_id", "left").withColumns({f"{end}_name": F.coalesce("n", F.concat(F.lit("Unknown ("), F.col(f"{end}_id").cast("string"), F.lit(")"))), f"{end}_vocabulary": F.coalesce("v", F.lit("?"))}).drop("n", "v")
    kinds = classify_predicates(relationship).join(relationship.select("relationship_id", "relationship_name"), "relationship_id").withColumnRenamed("relationship_id", "predicate_id")
    return rows.join(kinds, "predicate_id", "left")


def path_concepts(pairs: DataFrame, ranked: DataFrame) -> DataFrame:
    """Distinct concepts of each pair's paths: source, target, then by path rank and place."""
    ends = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit(0).alias("r"), F.lit(0).alias("p"), F.col("source").alias("c")), F.struct(F.lit(0).alias("r"), F.lit(1).alias("p"), F.col("target").alias("c")))).alias("x"))
    nodes = ranked.select("pair_id", "rank", F.posexplode(_walk()).alias("p", "c"))
    rows = ends.select("pair_id", F.col("x.r").cast("long").alias("r"), F.col("x.p").cast("long").alias("p"), F.col("x.c").alias("concept_id")).union(nodes.select("pair_id", "rank", F.col("p").cast("long"), "c"))
    first = rows.groupBy("pair_id", "concept_id").agg(F.min(F.struct("r", "p")).alias("place"))
    return top(first, ["pair_id"], ["place", "concept_id"], None, "position").select("pair_id", "position", "concept_id")
