"""Operators on the closure table (C)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import clear, mark, written
from ._rank import top

_SHOWN = ["concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id", "concept_code", "standard_concept"]


def build_closure(is_a: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """The closure table of is_a(child, parent): every ancestor and descendant with the least and the greatest number of levels between, however deep.

    A round joins the paths known so far end to end, so their length doubles; it
    takes a logarithm of the depth. own(concept_id) has the concepts that stand above
    themselves at level 0. Null ends are left out; a cycle is an error, as it has no
    greatest number of levels.
    """
    spark, since = is_a.sparkSession, mark()
    edges = is_a.where("child is not null and parent is not null").select(F.col("parent").alias("ancestor"), F.col("child").alias("descendant")).distinct()
    known = written(edges.withColumns({"least": F.lit(1).cast("long"), "most": F.lit(1).cast("long")}))
    size = None
    while True:
        n = known.agg(F.count("*"), F.sum("least"), F.sum("most"), F.count_if(F.col("ancestor") == F.col("descendant"))).first()
        if n[3]:
            raise ValueError("the hierarchy has a cycle")
        if n == size:
            break
        size = n
        above = known.select("ancestor", F.col("descendant").alias("middle"), "least", "most")
        below = known.select(F.col("ancestor").alias("middle"), "descendant", F.col("least").alias("l"), F.col("most").alias("m"))
        longer = above.join(below, "middle").select("ancestor", "descendant", F.col("least") + F.col("l"), F.col("most") + F.col("m"))
        known = written(known.union(longer).groupBy("ancestor", "descendant").agg(F.min("least").alias("least"), F.max("most").alias("most")))
    clear(spark, since, keep=known)
    rows = known.select(F.col("ancestor").alias("ancestor_concept_id"), F.col("descendant").alias("descendant_concept_id"), F.col("least").alias("min_levels_of_separation"), F.col("most").alias("max_levels_of_separation"))
    if own is None:
        return rows
    zero = F.lit(0).cast("long")
    return rows.union(own.where("concept_id is not null").select("concept_id", "concept_id", zero, zero).distinct())


def _relatives(concepts, closure, ids, own: str, other: str, levels: int | None, limit: int | None, order: list[str]) -> DataFrame:
    rows = closure.where("min_levels_of_separation > 0")
    if levels is not None:
        rows = rows.where(F.col("min_levels_of_separation") <= levels)
    rows = rows.join(ids.select(F.col("concept_id").alias(own)).distinct(), own).select(F.col(own).alias("source_id"), F.col(other).alias("concept_id"), F.col("min_levels_of_separation").alias("min_separation"), F.col("max_levels_of_separation").alias("max_separation"))
    found = rows.join(concepts.select(*_SHOWN), "concept_id")
    return top(found, ["source_id"], [*order, "concept_id"], limit).select("source_id", "rank", *_SHOWN, "min_separation", "max_separation")


def ancestors(concepts: DataFrame, closure: DataFrame, ids: DataFrame, max_separation: int | None = None, limit: int | None = 50) -> DataFrame:
    """Ancestors of each id, nearest first."""
    return _relatives(concepts, closure, ids, "descendant_concept_id", "ancestor_concept_id", max_separation, limit, ["min_separation"])


def descendants(concepts: DataFrame, closure: DataFrame, ids: DataFrame, max_separation: int | None = None, limit: int | None = 50) -> DataFrame:
    """Descendants of each id, nearest first, then by name."""
    return _relatives(concepts, closure, ids, "ancestor_concept_id", "descendant_concept_id", max_separation, limit, ["min_separation", "concept_name"])


def ancestry_check(closure: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs(pair_id, ancestor, descendant) with separation: least level above 0, else null."""
    rows = closure.where("min_levels_of_separation > 0").select(F.col("ancestor_concept_id").alias("ancestor"), F.col("descendant_concept_id").alias("descendant"), F.col("min_levels_of_separation").alias("separation"))
    return pairs.join(rows, ["ancestor", "descendant"], "left").select("pair_id", "ancestor", "descendant", "separation")


def direct_parents(concepts: DataFrame, closure: DataFrame, ids: DataFrame) -> DataFrame:
    """child, parent, parent_name over valid parents at level 1."""
    rows = closure.where("min_levels_of_separation = 1").join(ids.select(F.col("concept_id").alias("descendant_concept_id")).distinct(), "descendant_concept_id")
    valid = concepts.where("invalid_reason is null").select(F.col("concept_id").alias("parent"), F.col("concept_name").alias("parent_name"))
    return rows.select(F.col("descendant_concept_id").alias("child"), F.col("ancestor_concept_id").alias("parent")).join(valid, "parent").select("child", "parent", "parent_name")


def standard_descendant_count(concepts: DataFrame, closure: DataFrame, parents: DataFrame) -> DataFrame:
    """parent and its number of distinct standard valid descendants above level 0."""
    fine = concepts.where("standard_concept = 'S' and invalid_reason is null").select(F.col("concept_id").alias("descendant_concept_id"))
    rows = closure.where("min_levels_of_separation > 0").join(parents.select(F.col("concept_id").alias("ancestor_concept_id")).distinct(), "ancestor_concept_id").join(fine, "descendant_concept_id", "left_semi")
    counted = rows.groupBy("ancestor_concept_id").agg(F.countDistinct("descendant_concept_id").alias("n_descendants"))
    return parents.select(F.col("concept_id").alias("parent")).distinct().join(counted.withColumnRenamed("ancestor_concept_id", "parent"), "parent", "left").select("parent", F.coalesce("n_descendants", F.lit(0)).alias("n_descendants"))


def within_levels(closure: DataFrame, pairs: DataFrame, levels: int = 3) -> DataFrame:
    """pairs(pair_id, left_id, right_id) with near: in one chain, either way, at most `levels` apart; null ids are not."""
    rows = closure.where(F.col("min_levels_of_separation") <= levels)
    one = rows.select(F.col("ancestor_concept_id").alias("left_id"), F.col("descendant_concept_id").alias("right_id"))
    either = one.union(one.select("right_id", "left_id")).distinct().withColumn("near", F.lit(True))
    return pairs.join(either, ["left_id", "right_id"], "left").select("pair_id", "left_id", "right_id", F.coalesce("near", F.lit(False)).alias("near"))
