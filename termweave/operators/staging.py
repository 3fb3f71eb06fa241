"""Immutable staged results, curation and lineage (H).

A result is a header row (result_id, parent_result_id, tool_name, parameters,
created_at, concept_count) and ordered concept rows. Nothing is changed in place:
a curation gives a child, a status is a row of a log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from ._rank import top
from .hierarchy import descendants

FLAGS = ["include_descendants", "include_mapped", "is_excluded", "is_descendant"]


def _index(df: DataFrame, order: list) -> DataFrame:
    return df.withColumn("row_index", (F.row_number().over(Window.partitionBy("result_id").orderBy(*order)) - 1).cast("long"))


def stage(results: DataFrame, concepts: DataFrame, order: list) -> tuple[DataFrame, DataFrame]:
    """(headers, rows) of results(result_id, tool_name, created_at, ...parameters) and their concepts(result_id, concept_id, ...).

    Rows are indexed from 0 in the given order, missing flags are false, other
    columns of results go into `parameters` as JSON, and a result without
    concepts is not staged.
    """
    rows = concepts
    for flag in FLAGS:
        rows = rows.withColumn(flag, F.coalesce(F.col(flag).cast("boolean"), F.lit(False)) if flag in concepts.columns else F.lit(False))
    if "source_concept_id" not in rows.columns:
        rows = rows.withColumn("source_concept_id", F.lit(None).cast("long"))
    rows = _index(rows, order)
    counts = rows.groupBy("result_id").agg(F.count("*").alias("concept_count"))
    fixed = ["result_id", "parent_result_id", "tool_name", "created_at"]
    headers = results if "parent_result_id" in results.columns else results.withColumn("parent_result_id", F.lit(None).cast("long"))
    extra = [c for c in results.columns if c not in fixed]
    headers = headers.withColumn("parameters", F.to_json(F.struct(*extra)) if extra else F.lit("{}")).select(*fixed, "parameters")
    return headers.join(counts, "result_id"), rows


def result_concepts(rows: DataFrame, ids: DataFrame | None = None, include_ids: bool = False) -> DataFrame:
    """Rows of the results, without concept_id unless asked for."""
    found = rows if ids is None else rows.join(ids.select("result_id").distinct(), "result_id", "left_semi")
    return found if include_ids else found.drop("concept_id")


def cherry_pick(rows: DataFrame, picks: DataFrame) -> DataFrame:
    """Children of picks(result_id, child_id, row_index): the chosen rows in parent order, indexed anew; unknown indices do nothing."""
    chosen = rows.join(picks.select("result_id", "child_id", "row_index").distinct(), ["result_id", "row_index"])
    return _index(chosen.drop("result_id").withColumnRenamed("child_id", "result_id").withColumnRenamed("row_index", "parent_index"), ["parent_index"]).drop("parent_index")


def exclude(rows: DataFrame, keywords: DataFrame) -> DataFrame:
    """Children of keywords(result_id, child_id, keyword): all rows, those whose name holds the keyword excluded."""
    hit = F.lower("concept_name").contains(F.lower("keyword"))
    return rows.join(keywords, "result_id").withColumn("is_excluded", F.col("is_excluded") | hit).drop("result_id", "keyword").withColumnRenamed("child_id", "result_id")


def expand_descendants(rows: DataFrame, concepts: DataFrame, closure: DataFrame, limit: int | None = 500) -> DataFrame:
    """Every result's rows, then descendants not among them, once each, with the first row that brought them as source."""
    below = descendants(concepts, closure, rows.select("concept_id"), limit=limit).select(F.col("source_id").alias("source_concept_id"), F.col("concept_id").alias("below"), "concept_name", F.col("rank").alias("place"))
    first = rows.groupBy("result_id", F.col("concept_id").alias("source_concept_id")).agg(F.min("row_index").alias("from_row"))
    new = top(first.join(below, "source_concept_id"), ["result_id", "below"], ["from_row", "place"], 1, "turn")
    new = new.join(rows.select("result_id", F.col("concept_id").alias("below")), ["result_id", "below"], "left_anti")
    added = new.select("result_id", F.col("below").alias("concept_id"), "concept_name", "source_concept_id", F.lit(True).alias("is_descendant"), "from_row", "place", F.lit(1).alias("part"))
    old = rows.select("result_id", "concept_id", "concept_name", "source_concept_id", "is_descendant", F.col("row_index").alias("from_row"), F.lit(0).cast("long").alias("place"), F.lit(0).alias("part"))
    return _index(old.unionByName(added), ["part", "from_row", "place", "concept_id"]).drop("part", "from_row", "place")


def modify_flags(rows: DataFrame, indices: DataFrame, **flags: bool | None) -> DataFrame:
    """Rows with the given flags set on indices(result_id, row_index); None leaves a flag."""
    hit = indices.select("result_id", "row_index").distinct().withColumn("hit", F.lit(True))
    out = rows.join(hit, ["result_id", "row_index"], "left")
    for flag, value in flags.items():
        if value is not None:
            out = out.withColumn(flag, F.when(F.col("hit"), F.lit(value)).otherwise(F.col(flag)))
    return out.drop("hit")


def promote(ids: DataFrame, at: Column, status: str = "kept") -> DataFrame:
    """Rows for the status log, of ids(result_id, draft_name)."""
    return ids.select("result_id", F.lit(status).alias("status"), "draft_name", at.alias("changed_at"))


def list_results(headers: DataFrame, log: DataFrame, status: list[str] | None = None) -> DataFrame:
    """Headers with their latest status (ephemeral where none is logged)."""
    latest = top(log, ["result_id"], [F.col("changed_at").desc(), F.col("status").desc()], 1, "turn").select("result_id", "status", "draft_name")
    found = headers.join(latest, "result_id", "left").withColumn("status", F.coalesce("status", F.lit("ephemeral")))
    return found if status is None else found.where(F.col("status").isin(status))


def draft_concepts(headers: DataFrame, rows: DataFrame, log: DataFrame) -> DataFrame:
    """draft_name, row_index, concept_id and flags of all drafts."""
    drafts = list_results(headers, log, ["kept", "finalized"]).select("result_id", "draft_name")
    return rows.join(drafts, "result_id").select("draft_name", "row_index", "concept_id", "is_excluded", "include_descendants", "include_mapped")


def lineage(headers: DataFrame, ids: DataFrame) -> DataFrame:
    """result_id, ancestor_id, generation from each result up to its root, however far; a loop of parents is an error.

    Steps double: parents, then parents of parents, so the rounds are the logarithm of the depth.
    """
    jump = headers.where("parent_result_id is not null").select("result_id", F.col("parent_result_id").alias("up"))
    n, length = headers.count(), 1
    found = ids.select("result_id").distinct().select("result_id", F.col("result_id").alias("ancestor_id"), F.lit(0).cast("long").alias("generation"))
    while not jump.isEmpty():
        if length > n:
            raise ValueError("a result is among its own ancestors")
        step = jump.select(F.col("result_id").alias("ancestor_id"), "up")
        above = found.join(step, "ancestor_id").select("result_id", F.col("up").alias("ancestor_id"), (F.col("generation") + length).alias("generation"))
        found = written(found.union(above))
        jump = written(jump.join(jump.select(F.col("result_id").alias("up"), F.col("up").alias("next")), "up").select("result_id", F.col("next").alias("up")))
        length *= 2
    return found


def expire(headers: DataFrame, rows: DataFrame, log: DataFrame, as_of: Column, minutes: int = 60) -> tuple[DataFrame, DataFrame]:
    """Headers and rows without ephemeral results older than the cut-off that are nobody's parent."""
    parents = headers.where("parent_result_id is not null").select(F.col("parent_result_id").alias("result_id")).distinct()
    old = list_results(headers, log, ["ephemeral"]).where(F.col("created_at") < as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    gone = old.join(parents, "result_id", "left_anti").select("result_id")
    return headers.join(gone, "result_id", "left_anti"), rows.join(gone, "result_id", "left_anti")
