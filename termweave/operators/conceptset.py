"""Concept sets and common ancestors (F)."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from ._rank import top
from .mapping import one_hop_maps_to
from .search import COLUMNS, search_concepts

_KEYS = ["set_id", "concept_id"]


def preview_concept_set(concepts: DataFrame, closure: DataFrame, sets: DataFrame, include_descendants: bool = True, limit: int | None = 50) -> DataFrame:
    """Valid members (flag 0) and their valid standard descendants (flag 1) of sets(set_id, concept_id), once each, by flag and name."""
    valid = concepts.where("invalid_reason is null").select(*COLUMNS)
    rows = sets.select(*_KEYS).distinct().withColumn("is_descendant", F.lit(0).cast("long"))
    rows = rows.join(valid.select("concept_id"), "concept_id", "left_semi").select(*_KEYS, "is_descendant")
    if include_descendants:
        below = closure.where("min_levels_of_separation > 0").select(F.col("ancestor_concept_id").alias("concept_id"), F.col("descendant_concept_id").alias("below"))
        more = sets.select(*_KEYS).distinct().join(below, "concept_id").select("set_id", F.col("below").alias("concept_id"), F.lit(1).cast("long").alias("is_descendant"))
        rows = rows.union(more.join(valid.where("standard_concept = 'S'").select("concept_id"), "concept_id", "left_semi").select(*_KEYS, "is_descendant"))
    once = rows.groupBy(*_KEYS).agg(F.min("is_descendant").alias("is_descendant")).join(valid, "concept_id")
    return top(once, ["set_id"], ["is_descendant", "concept_name", "concept_id"], limit)


def concept_set_size(concepts: DataFrame, closure: DataFrame, sets: DataFrame) -> DataFrame:
    """Number of distinct standard valid descendants of each set, level 0 included."""
    fine = concepts.where("standard_concept = 'S' and invalid_reason is null").select(F.col("concept_id").alias("descendant_concept_id"))
    rows = sets.select("set_id", F.col("concept_id").alias("ancestor_concept_id")).distinct().join(closure, "ancestor_concept_id").join(fine, "descendant_concept_id", "left_semi")
    counted = rows.groupBy("set_id").agg(F.countDistinct("descendant_concept_id").alias("n_concepts"))
    return sets.select("set_id").distinct().join(counted, "set_id", "left").select("set_id", F.coalesce("n_concepts", F.lit(0)).alias("n_concepts"))


def resolve_concept_set(concepts: DataFrame, synonyms: DataFrame, closure: DataFrame, queries: DataFrame, max_input: int = 5, limit: int | None = 50, **filters) -> DataFrame:
    """The preview of each keyword's best concepts; a keyword without any gives one row with an error."""
    seeds = search_concepts(concepts, queries, synonyms, limit=max_input, **filters).select(F.col("query_id").alias("set_id"), "concept_id")
    shown = preview_concept_set(concepts, closure, seeds, True, limit).withColumn("error", F.lit(None).cast("string"))
    none = queries.select(F.col("query_id").alias("set_id")).join(seeds.select("set_id"), "set_id", "left_anti").withColumn("error", F.lit("no concept found"))
    return shown.unionByName(none, allowMissingColumns=True)


def validate_seeds(concepts: DataFrame, edges: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, warnings): each seed's status (standard, mapped, unmapped, unknown) with its mapping; warning codes of each set."""
    target = one_hop_maps_to(concepts, edges, sets).select("concept_id", "target_id", "target_name")
    rows = sets.select(*_KEYS).distinct().join(concepts.select("concept_id", "concept_name", "domain_id", "standard_concept"), "concept_id", "left").join(target, "concept_id", "left")
    status = F.when(F.col("concept_name").isNull(), "unknown").when(F.col("standard_concept").eqNullSafe(F.lit("S")), "standard").when(F.col("target_id").isNotNull(), "mapped").otherwise("unmapped")
    rows = rows.withColumn("status", status)
    held = lambda s: F.max(F.col("status") == s)
    sums = rows.groupBy("set_id").agg(
        held("unknown").alias("unknown"), held("mapped").alias("mapped"), held("unmapped").alias("unmapped"), F.size(F.collect_set("domain_id")).alias("domains"),
        F.collect_set(F.when(F.col("status") == "standard", F.col("concept_name"))).alias("names"), F.collect_set(F.when(F.col("status") == "mapped", F.col("target_name"))).alias("targets"),
    )
    code = lambda c, name: F.when(c, F.lit(name))
    apart = (F.size("names") > 0) & (F.size("targets") > 0) & ~F.arrays_overlap("names", "targets")
    codes = F.array_compact(F.array(code(F.col("unknown"), "not_found"), code(F.col("mapped"), "non_standard_mapped"), code(F.col("unmapped"), "non_standard_unmapped"), code(F.col("domains") > 1, "several_domains"), code(apart, "names_disjoint")))
    return rows, sums.select("set_id", F.array_join(codes, ",").alias("warnings"))


def common_parents(concepts: DataFrame, closure: DataFrame, sets: DataFrame, max_up_depth: int = 5, min_coverage: int = 2, compute_pollution: bool = True) -> DataFrame:
    """Parents that several seeds of a set share: coverage, completeness, pollution, purity, max_depth, by coverage and purity.

    Each seed climbs valid level-1 parents; a node is entered once a seed. Sets of
    fewer than two seeds have no result.
    """
    valid = concepts.where("invalid_reason is null").select(F.col("concept_id").alias("parent"))
    up = closure.where("min_levels_of_separation = 1").select(F.col("descendant_concept_id").alias("node"), F.col("ancestor_concept_id").alias("parent")).join(valid, "parent", "left_semi")
    seeds = sets.select(*_KEYS).distinct()
    counts = seeds.groupBy("set_id").agg(F.count("*").alias("n_seeds")).where("n_seeds >= 2")
    frontier = written(seeds.join(counts, "set_id").select("set_id", F.col("concept_id").alias("origin"), F.col("concept_id").alias("node")))
    seen, climbed = frontier, None
    for depth in range(1, max_up_depth + 1):
        step = written(frontier.join(up, "node").select("set_id", "origin", "parent").distinct().withColumn("depth", F.lit(depth).cast("long")))
        if step.isEmpty():
            break
        climbed = step if climbed is None else climbed.union(step)
        frontier = written(step.select("set_id", "origin", F.col("parent").alias("node")).join(seen, ["set_id", "origin", "node"], "left_anti"))
        seen = seen.union(frontier)
    if climbed is None:
        climbed = frontier.select("set_id", "origin", F.col("node").alias("parent"), F.lit(1).cast("long").alias("depth")).where("false")
    found = climbed.groupBy("set_id", "parent").agg(F.countDistinct("origin").alias("coverage"), F.max("depth").alias("max_depth")).where(F.col("coverage") >= min_coverage).join(counts, "set_id")
    if compute_pollution:
        from .hierarchy import standard_descendant_count

        below = standard_descendant_count(concepts, closure, found.select(F.col("parent").alias("concept_id")))
        found = found.join(below, "parent").withColumn("pollution", F.greatest(F.col("n_descendants") - F.col("n_seeds"), F.lit(0).cast("long")))
        purity = F.col("coverage") / (F.col("coverage") + F.col("pollution"))
    else:
        found, purity = found.withColumn("pollution", F.lit(0).cast("long")), F.lit(1.0)
    found = found.withColumns({"completeness": F.round(F.col("coverage") / F.col("n_seeds"), 3), "purity": F.round(purity, 3)})
    named = found.join(concepts.select(F.col("concept_id").alias("parent"), F.col("concept_name").alias("parent_name")), "parent")
    return top(named, ["set_id"], [F.col("coverage").desc(), F.col("purity").desc(), "parent"], None).select("set_id", "rank", "parent", "parent_name", "coverage", "completeness", "pollution", "purity", "max_depth")


def covered_seeds(closure: DataFrame, sets: DataFrame, candidates: DataFrame) -> DataFrame:
    """set_id, parent, seed for each seed below (or equal to) a candidate(set_id, parent)."""
    below = closure.select(F.col("ancestor_concept_id").alias("parent"), F.col("descendant_concept_id").alias("seed"))
    return candidates.select("set_id", "parent").distinct().join(below, "parent").join(sets.select("set_id", F.col("concept_id").alias("seed")).distinct(), ["set_id", "seed"], "left_semi").select("set_id", "parent", "seed")


#: Rows (candidate and seed) of a set up to which one task picks its cover; larger sets take rounds over many tasks.
GROUP_ROWS = 100_000
_PICKS = "set_id long, pick_no long, parent long, newly_covered long"


def greedy_cover(closure: DataFrame, sets: DataFrame, candidates: DataFrame, target_coverage: float = 1.0) -> DataFrame:
    """set_id, pick_no, parent, newly_covered: repeated picks of most new seeds times purity, candidate order breaking ties.

    candidates(set_id, rank, parent, purity) come from common_parents. Sets are
    independent: one of few rows is a group of a grouped map, and large ones are
    covered in rounds, with the same picks.
    """
    rows = written(covered_seeds(closure, sets, candidates).join(candidates.select("set_id", "parent", "rank", "purity"), ["set_id", "parent"]).join(sets.select(*_KEYS).distinct().groupBy("set_id").agg(F.count("*").alias("n_seeds")), "set_id"))
    large = written(rows.groupBy("set_id").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_ROWS).select("set_id"))
    if large.isEmpty():
        return _cover_in_groups(rows, target_coverage)
    return _cover_in_groups(rows.join(large, "set_id", "left_anti"), target_coverage).union(_cover_in_rounds(rows.join(large, "set_id", "left_semi"), target_coverage))


def _cover_in_groups(rows: DataFrame, target_coverage: float) -> DataFrame:
    def pick(table: pa.Table) -> pa.Table:
        covers: dict[tuple, set] = {}
        for rank, parent, purity, seed in zip(*(table.column(c).to_pylist() for c in ("rank", "parent", "purity", "seed"))):
            covers.setdefault((rank, parent, purity), set()).add(seed)
        total, done, out = table.column("n_seeds")[0].as_py(), set(), []
        while len(done) < target_coverage * total:
            gain, _, parent, new = max(((len(s - done) * purity, -rank, parent, s - done) for (rank, parent, purity), s in covers.items()), key=lambda x: x[:2], default=(0, 0, 0, set()))
            if gain <= 0:
                break
            done |= new
            out.append((parent, len(new)))
        key = table.column("set_id")[0].as_py()
        return pa.table({"set_id": pa.array([key] * len(out), pa.int64()), "pick_no": pa.array(range(1, len(out) + 1), pa.int64()), "parent": pa.array([p for p, _ in out], pa.int64()), "newly_covered": pa.array([n for _, n in out], pa.int64())})

    return rows.groupBy("set_id").applyInArrow(pick, _PICKS)


def _cover_in_rounds(rows: DataFrame, target_coverage: float) -> DataFrame:
    """The same picks, a run of them a round: the candidates in order of their gain, up to the first that shares a new seed with one before it.

    Until there, no pick changes the gain of the next, and none behind can overtake.
    Only candidates of half the best gain or more are looked at in a round. No task
    holds the seeds of a set; what is left of them is written after each round.
    """
    left, picked = rows, []
    done = written(rows.select("set_id", "n_seeds").distinct().withColumns({"done": F.lit(0).cast("long"), "n_picks": F.lit(0).cast("long")}))
    by_set = Window.partitionBy("set_id")
    order = by_set.orderBy(F.col("gain").desc(), "rank")
    while True:
        live = done.where(F.col("done") < target_coverage * F.col("n_seeds"))
        counts = left.groupBy("set_id", "parent", "rank", "purity").agg(F.count("*").alias("new")).withColumn("gain", F.col("new") * F.col("purity")).where("gain > 0").join(live, "set_id")
        best = counts.withColumn("best", F.max("gain").over(by_set)).where("gain * 2 >= best")
        turns = written(best.withColumn("turn", F.row_number().over(order)).drop("best"))
        if turns.isEmpty():
            break
        held = left.join(turns.select("set_id", "parent", "turn"), ["set_id", "parent"]).select("set_id", "parent", "seed", "turn")
        shared = held.groupBy("set_id", "seed").agg(F.get(F.sort_array(F.collect_set("turn")), F.lit(1)).alias("again")).where("again is not null")
        stop = shared.groupBy("set_id").agg(F.min("again").alias("stop"))
        run = turns.join(stop, "set_id", "left").where(F.col("stop").isNull() | (F.col("turn") < F.col("stop")))
        before = F.coalesce(F.sum("new").over(by_set.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        run = written(run.withColumn("before", before).where(F.col("done") + F.col("before") < target_coverage * F.col("n_seeds")))
        picked.append(run.select("set_id", (F.col("n_picks") + F.col("turn")).cast("long").alias("pick_no"), "parent", F.col("new").alias("newly_covered")))
        gone = held.join(run.select("set_id", "parent"), ["set_id", "parent"], "left_semi").select("set_id", "seed").distinct()
        more = run.groupBy("set_id").agg(F.sum("new").alias("more"), F.count("*").alias("picks"))
        # a set that picked nothing in this round has no gain left and is over
        done = written(done.join(more, "set_id").select("set_id", "n_seeds", (F.col("done") + F.col("more")).alias("done"), (F.col("n_picks") + F.col("picks")).alias("n_picks")))
        left = written(left.join(gone, ["set_id", "seed"], "left_anti").join(done.select("set_id"), "set_id", "left_semi"))
    empty = rows.sparkSession.createDataFrame([], _PICKS)
    return reduce(DataFrame.union, picked, empty)


def uncovered_seeds(closure: DataFrame, sets: DataFrame, picks: DataFrame) -> DataFrame:
    """Seeds below none of the picks(set_id, parent)."""
    done = covered_seeds(closure, sets, picks).select("set_id", F.col("seed").alias("concept_id"))
    return sets.select(*_KEYS).distinct().join(done, _KEYS, "left_anti")
