"""Concept sets and common ancestors (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import conceptset
from ..plans.derive import with_vocabulary as v
from . import query
from .vocabulary import _BELOW, _SHOWN, KEYWORDS_SQL, keywords, seed_sets

_SETS = "sets AS (SELECT DISTINCT bn AS set_id, branded AS concept_id FROM parts UNION SELECT DISTINCT bn, 100 + nr FROM parts UNION SELECT DISTINCT bn, srcid FROM parts)"


def mixed_sets(g):
    """Each brand's items, their nouns and their source items."""
    p = g.parts
    return p.select(F.col("bn").alias("set_id"), F.col("branded").alias("concept_id")).union(p.select("bn", 100 + F.col("nr"))).union(p.select("bn", "srcid")).distinct()


@query("f1_preview_set", v(f"""
    , {_SETS}, m AS (SELECT set_id, concept_id, 0 AS f FROM sets JOIN concept USING (concept_id) WHERE invalid_reason IS NULL
      UNION ALL SELECT set_id, descendant_concept_id, 1 FROM sets s JOIN closure ON ancestor_concept_id = s.concept_id JOIN concept c ON c.concept_id = descendant_concept_id WHERE min_levels_of_separation > 0 AND standard_concept = 'S' AND invalid_reason IS NULL),
    o AS (SELECT set_id, concept_id, CAST(min(f) AS BIGINT) AS is_descendant FROM m GROUP BY ALL)
    SELECT set_id, rank, is_descendant, {_SHOWN} FROM (SELECT o.*, c.* EXCLUDE (concept_id), row_number() OVER (PARTITION BY set_id ORDER BY is_descendant, concept_name, concept_id) AS rank FROM o JOIN concept c USING (concept_id)) WHERE rank <= 50"""))
def _(g):
    return conceptset.preview_concept_set(g.concept, g.closure, mixed_sets(g)).select("set_id", "rank", "is_descendant", *_SHOWN.split(", "))


@query("f2_set_size", v(f", {_SETS} SELECT set_id, count(DISTINCT c.concept_id) AS n_concepts FROM sets s LEFT JOIN closure ON ancestor_concept_id = s.concept_id LEFT JOIN concept c ON c.concept_id = descendant_concept_id AND standard_concept = 'S' AND invalid_reason IS NULL GROUP BY 1"))
def _(g):
    return conceptset.concept_set_size(g.concept, g.closure, mixed_sets(g))


@query("f3_resolve_set", v(f"""
    , {KEYWORDS_SQL}, asked AS (SELECT * FROM keywords UNION ALL SELECT DISTINCT 1000 + bn, 'no such ' || p_brand FROM parts),
    hits AS (SELECT query_id, keyword, concept_id, concept_name, 0 AS source, concept_name AS t FROM asked JOIN concept ON concept_name ILIKE '%' || keyword || '%' WHERE standard_concept = 'S' AND invalid_reason IS NULL
      UNION ALL SELECT query_id, keyword, concept_id, concept_name, 1, concept_synonym_name FROM asked JOIN synonym ON concept_synonym_name ILIKE '%' || keyword || '%' JOIN concept USING (concept_id) WHERE standard_concept = 'S' AND invalid_reason IS NULL),
    once AS (SELECT *, row_number() OVER (PARTITION BY query_id, concept_id ORDER BY source, length(t), t) AS turn FROM hits),
    seeds AS (SELECT query_id AS set_id, concept_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY source, CASE WHEN concept_name ILIKE keyword THEN 0 ELSE 1 END, length(concept_name), concept_name, concept_id) AS rank FROM once WHERE turn = 1) WHERE rank <= 5),
    m AS (SELECT set_id, concept_id, 0 AS f FROM seeds UNION ALL SELECT set_id, descendant_concept_id, 1 FROM seeds s JOIN closure ON ancestor_concept_id = s.concept_id JOIN concept c ON c.concept_id = descendant_concept_id WHERE min_levels_of_separation > 0 AND standard_concept = 'S' AND invalid_reason IS NULL),
    o AS (SELECT set_id, concept_id, CAST(min(f) AS BIGINT) AS is_descendant FROM m GROUP BY ALL),
    r AS (SELECT o.*, concept_name, row_number() OVER (PARTITION BY set_id ORDER BY is_descendant, concept_name, concept_id) AS rank FROM o JOIN concept USING (concept_id))
    SELECT set_id, rank, concept_id, is_descendant, concept_name, CAST(NULL AS VARCHAR) AS error FROM r WHERE rank <= 50
    UNION ALL SELECT query_id, NULL, NULL, NULL, NULL, 'no concept found' FROM asked WHERE query_id NOT IN (SELECT set_id FROM seeds)"""))
def _(g):
    asked = keywords(g).union(g.parts.select(1000 + F.col("bn"), F.concat(F.lit("no such "), "p_brand")).distinct())
    return conceptset.resolve_concept_set(g.concept, g.synonym, g.closure, asked, standard_only=True, valid_only=True).select("set_id", "rank", "concept_id", "is_descendant", "concept_name", "error")


_SEEDS = "seeds AS (SELECT bn AS set_id, branded AS concept_id FROM parts UNION SELECT bn, srcid FROM parts UNION SELECT bn, 500 + bn FROM parts WHERE bn % 2 = 0 UNION SELECT bn, srcid + 50000000 FROM parts WHERE partkey % 50 = 0)"


def checked_seeds(g):
    p = g.parts
    rows = [p.select(F.col("bn").alias("set_id"), F.col("branded").alias("concept_id")), p.select("bn", "srcid"), p.where("bn % 2 = 0").select("bn", 500 + F.col("bn")), p.where("partkey % 50 = 0").select("bn", F.col("srcid") + 50000000)]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3]).distinct()


_STATUS = f"""
    , {_SEEDS}, hop AS (SELECT a AS concept_id, t AS target_id, concept_name AS target_name FROM (SELECT a, min(b) AS t FROM maps WHERE a <> b GROUP BY a) JOIN concept ON concept_id = t),
    rows_ AS (SELECT s.set_id, s.concept_id, concept_name, domain_id, target_id, target_name, CASE WHEN concept_name IS NULL THEN 'unknown' WHEN standard_concept = 'S' THEN 'standard' WHEN target_id IS NOT NULL THEN 'mapped' ELSE 'unmapped' END AS status
      FROM seeds s LEFT JOIN concept c USING (concept_id) LEFT JOIN hop USING (concept_id))"""


@query("f4_validate_seeds", v(f"{_STATUS} SELECT set_id, concept_id, status, target_id, target_name FROM rows_"))
def _(g):
    return conceptset.validate_seeds(g.concept, g.edges, checked_seeds(g))[0].select("set_id", "concept_id", "status", "target_id", "target_name")


@query("f4_seed_warnings", v(f"""{_STATUS}
    SELECT set_id, concat_ws(',', CASE WHEN bool_or(status = 'unknown') THEN 'not_found' END, CASE WHEN bool_or(status = 'mapped') THEN 'non_standard_mapped' END, CASE WHEN bool_or(status = 'unmapped') THEN 'non_standard_unmapped' END, CASE WHEN count(DISTINCT domain_id) > 1 THEN 'several_domains' END,
      CASE WHEN bool_or(status = 'standard') AND bool_or(status = 'mapped') AND NOT list_has_any(coalesce(list(concept_name) FILTER (status = 'standard'), []), coalesce(list(target_name) FILTER (status = 'mapped'), [])) THEN 'names_disjoint' END) AS warnings FROM rows_ GROUP BY set_id"""))
def _(g):
    return conceptset.validate_seeds(g.concept, g.edges, checked_seeds(g))[1]


_PARENTS = f"""
    , {_BELOW}, seeds AS (SELECT DISTINCT bn AS set_id, branded AS seed FROM parts), cnt AS (SELECT set_id, count(*) AS n_seeds FROM seeds GROUP BY 1 HAVING count(*) >= 2),
    up AS (SELECT descendant_concept_id AS node, ancestor_concept_id AS parent FROM closure JOIN concept ON concept_id = ancestor_concept_id WHERE min_levels_of_separation = 1 AND invalid_reason IS NULL),
    l1 AS (SELECT DISTINCT set_id, seed, parent FROM seeds JOIN cnt USING (set_id) JOIN up ON node = seed),
    l2 AS (SELECT DISTINCT set_id, seed, up.parent FROM l1 JOIN up ON up.node = l1.parent), n2 AS (SELECT * FROM l2 EXCEPT SELECT * FROM l1),
    l3 AS (SELECT DISTINCT set_id, seed, up.parent FROM n2 JOIN up ON up.node = n2.parent), n3 AS (SELECT * FROM l3 EXCEPT SELECT * FROM l1 EXCEPT SELECT * FROM l2),
    l4 AS (SELECT DISTINCT set_id, seed, up.parent FROM n3 JOIN up ON up.node = n3.parent),
    walked AS (SELECT *, 1 AS d FROM l1 UNION ALL SELECT *, 2 FROM l2 UNION ALL SELECT *, 3 FROM l3 UNION ALL SELECT *, 4 FROM l4),
    agg AS (SELECT set_id, parent, count(DISTINCT seed) AS coverage, CAST(max(d) AS BIGINT) AS max_depth FROM walked GROUP BY ALL HAVING count(DISTINCT seed) >= 2),
    scored AS (SELECT set_id, parent, coverage, max_depth, round(coverage / n_seeds, 3) AS completeness, greatest(coalesce(n_descendants, 0) - n_seeds, 0) AS pollution, round(coverage / (coverage + greatest(coalesce(n_descendants, 0) - n_seeds, 0)), 3) AS purity FROM agg JOIN cnt USING (set_id) LEFT JOIN below USING (parent)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY set_id ORDER BY coverage DESC, purity DESC, parent) AS rank FROM scored)"""


@query("f5_common_parents", v(f"{_PARENTS} SELECT set_id, rank, parent, concept_name AS parent_name, coverage, completeness, pollution, purity, max_depth FROM ranked JOIN concept ON concept_id = parent"))
def _(g):
    return conceptset.common_parents(g.concept, g.closure, seed_sets(g))


@query("ag4_distinct_coverage", v(f"{_PARENTS} SELECT parent, count(*) AS n_sets, CAST(sum(coverage) AS BIGINT) AS coverage FROM ranked GROUP BY parent"))
def _(g):
    return conceptset.common_parents(g.concept, g.closure, seed_sets(g), compute_pollution=False).groupBy("parent").agg(F.count("*").alias("n_sets"), F.sum("coverage").alias("coverage"))


# Recursive rows carry the seeds covered so far; each step takes the candidate of most new seeds times purity.
@query("f6_greedy_cover", v(f"""{_PARENTS},
    covers AS MATERIALIZED (SELECT r.set_id, r.parent, r.rank, r.purity, n_seeds, list(DISTINCT seed) AS held FROM ranked r JOIN cnt USING (set_id) JOIN seeds USING (set_id) JOIN closure ON ancestor_concept_id = r.parent AND descendant_concept_id = seed GROUP BY ALL),
    cover AS (SELECT set_id, 0 AS pick_no, CAST(NULL AS BIGINT) AS parent, CAST(0 AS BIGINT) AS newly_covered, CAST([] AS BIGINT[]) AS done FROM cnt
      UNION ALL SELECT set_id, pick_no, parent, newly_covered, done FROM (
        SELECT set_id, pick_no + 1 AS pick_no, parent, len(fresh) AS newly_covered, list_concat(done, fresh) AS done, row_number() OVER (PARTITION BY set_id ORDER BY len(fresh) * purity DESC, rank) AS turn
        FROM (SELECT x.set_id, pick_no, y.parent, rank, purity, done, list_filter(held, lambda s: NOT list_contains(done, s)) AS fresh FROM cover x JOIN covers y ON x.set_id = y.set_id AND len(done) < n_seeds) WHERE len(fresh) * purity > 0) WHERE turn = 1)
    SELECT set_id, CAST(pick_no AS BIGINT) AS pick_no, parent, newly_covered FROM cover WHERE pick_no > 0"""))
def _(g):
    return conceptset.greedy_cover(g.closure, seed_sets(g), conceptset.common_parents(g.concept, g.closure, seed_sets(g)))


@query("f7_uncovered_seeds", v(f"{_PARENTS} SELECT s.set_id, s.seed AS concept_id FROM seeds s JOIN cnt USING (set_id) WHERE NOT EXISTS (SELECT 1 FROM ranked r JOIN closure ON ancestor_concept_id = r.parent WHERE r.set_id = s.set_id AND rank > 1 AND purity >= 0.3 AND descendant_concept_id = s.seed)"))
def _(g):
    found = conceptset.common_parents(g.concept, g.closure, seed_sets(g)).where("rank > 1 and purity >= 0.3")
    several = seed_sets(g).groupBy("set_id").count().where("count >= 2").select("set_id")
    return conceptset.uncovered_seeds(g.closure, seed_sets(g).join(several, "set_id", "left_semi"), found)
