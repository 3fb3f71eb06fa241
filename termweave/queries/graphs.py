"""Neighbourhoods and paths (E)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import graph, mapping
from ..plans.derive import with_vocabulary as v
from . import query
from .vocabulary import _KINDS, seed_sets

_AROUND = """, seeds AS (SELECT DISTINCT bn AS set_id, branded AS node FROM parts),
    e1 AS (SELECT DISTINCT set_id, concept_id_1, relationship_id, concept_id_2 FROM seeds JOIN edges ON concept_id_1 = node),
    n1 AS (SELECT set_id, concept_id_2 AS node FROM e1 EXCEPT SELECT * FROM seeds),
    e2 AS (SELECT DISTINCT set_id, concept_id_1, relationship_id, concept_id_2 FROM n1 JOIN edges ON concept_id_1 = node),
    n2 AS (SELECT set_id, concept_id_2 AS node FROM e2 EXCEPT SELECT * FROM seeds EXCEPT SELECT * FROM n1)"""


@query("e1_subgraph_nodes", v(f"{_AROUND} SELECT set_id, node AS concept_id, CAST(depth AS BIGINT) AS depth, concept_name, vocabulary_id FROM (SELECT *, 0 AS depth FROM seeds UNION ALL SELECT *, 1 FROM n1 UNION ALL SELECT *, 2 FROM n2) LEFT JOIN concept ON concept_id = node"))
def _(g):
    return graph.explore_subgraph(g.concept, g.edges, seed_sets(g), max_nodes=None, edge_cap=None)[0]


@query("e1_subgraph_edges", v(f"{_AROUND} SELECT * FROM e1 UNION SELECT * FROM e2"))
def _(g):
    return graph.explore_subgraph(g.concept, g.edges, seed_sets(g), max_nodes=None, edge_cap=None)[1]


@query("e1_subgraph_capped", v(f""", {_KINDS}, outgoing AS (SELECT concept_id_1, concept_id_2 FROM (SELECT *, row_number() OVER (PARTITION BY concept_id_1 ORDER BY relationship_id, concept_id_2) AS turn
      FROM edges JOIN kinds USING (relationship_id) WHERE invalid_reason IS NULL AND kind IN ('ontological', 'attribute')) WHERE turn <= 200),
    seeds AS (SELECT DISTINCT bn AS set_id, branded AS node FROM parts),
    new1 AS (SELECT set_id, concept_id_2 AS node FROM seeds JOIN outgoing ON concept_id_1 = node EXCEPT SELECT * FROM seeds),
    placed1 AS (SELECT set_id, node, held + row_number() OVER (PARTITION BY set_id ORDER BY node) AS place FROM new1 JOIN (SELECT set_id, count(*) AS held FROM seeds GROUP BY 1) USING (set_id)),
    n1 AS (SELECT set_id, node FROM placed1 WHERE place <= 50), seen AS (SELECT * FROM seeds UNION ALL SELECT * FROM n1),
    new2 AS (SELECT set_id, concept_id_2 AS node FROM n1 JOIN outgoing ON concept_id_1 = node EXCEPT SELECT * FROM seen),
    placed2 AS (SELECT set_id, node, held + row_number() OVER (PARTITION BY set_id ORDER BY node) AS place FROM new2 JOIN (SELECT set_id, count(*) AS held FROM seen GROUP BY 1) USING (set_id)),
    cut AS (SELECT set_id FROM placed1 WHERE place > 50 UNION SELECT set_id FROM placed2 WHERE place > 50)
    SELECT set_id, count(*) AS n_nodes, set_id IN (SELECT set_id FROM cut) AS truncated FROM (SELECT * FROM seen UNION ALL SELECT set_id, node FROM placed2 WHERE place <= 50) GROUP BY set_id"""))
def _(g):
    nodes, _, flags = graph.explore_subgraph(g.concept, g.edges, seed_sets(g), g.relationship, ["ontological", "attribute"])
    return nodes.groupBy("set_id").agg(F.count("*").alias("n_nodes")).join(flags, "set_id")


def path_pairs(g):
    """Every branded item with the first one of the next brand, and with itself."""
    items = g.parts.select("branded", "bn").distinct()
    firsts = items.groupBy((F.col("bn") - 1).alias("bn")).agg(F.min("branded").alias("target"))
    far = items.join(firsts, "bn").select(F.col("branded").alias("pair_id"), F.col("branded").alias("source"), "target")
    return far.union(items.select(F.col("branded") + 100000000, "branded", "branded"))


# Any two items are four hops apart at most: by their adjectives and the product. So four hops are all there are.
_PATHS = """, items AS (SELECT DISTINCT branded, bn FROM parts), firsts AS (SELECT bn - 1 AS bn, min(branded) AS target FROM items GROUP BY bn),
    pairs AS (SELECT branded AS pair_id, branded AS source, target FROM items JOIN firsts USING (bn)),
    e AS (SELECT concept_id_1 AS a, relationship_id AS r, concept_id_2 AS b FROM edges),
    one AS (SELECT pair_id, [{'s': source, 'r': e.r, 'o': target}] AS st FROM pairs JOIN e ON e.a = source AND e.b = target),
    rest1 AS (SELECT * FROM pairs WHERE pair_id NOT IN (SELECT pair_id FROM one)),
    two AS (SELECT pair_id, [{'s': source, 'r': e.r, 'o': e.b}, {'s': f.a, 'r': f.r, 'o': target}] AS st FROM rest1 JOIN e ON e.a = source JOIN e f ON f.a = e.b AND f.b = target),
    rest2 AS (SELECT * FROM rest1 WHERE pair_id NOT IN (SELECT pair_id FROM two)),
    ahead AS (SELECT pair_id, target, [{'s': source, 'r': e.r, 'o': e.b}, {'s': f.a, 'r': f.r, 'o': f.b}] AS st, f.b AS m FROM rest2 JOIN e ON e.a = source JOIN e f ON f.a = e.b),
    three AS (SELECT pair_id, list_append(st, {'s': e.a, 'r': e.r, 'o': e.b}) AS st FROM ahead JOIN e ON e.a = m AND e.b = target),
    rest3 AS (SELECT * FROM ahead WHERE pair_id NOT IN (SELECT pair_id FROM three)),
    behind AS (SELECT f.b AS target, e.a AS m, [{'s': e.a, 'r': e.r, 'o': e.b}, {'s': f.a, 'r': f.r, 'o': f.b}] AS st FROM (SELECT DISTINCT target FROM rest3) t JOIN e f ON f.b = t.target JOIN e ON e.b = f.a),
    four AS (SELECT pair_id, list_concat(x.st, y.st) AS st FROM rest3 x JOIN behind y USING (target, m)),
    found AS (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three UNION ALL SELECT * FROM four UNION ALL SELECT branded + 100000000, [] FROM items),
    paths AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY json) AS path_id FROM (SELECT *, len(st) AS hops, coalesce(array_to_string(list_transform(st, lambda x: concat_ws('|', x.s, x.r, x.o)), ' '), '') AS steps,
      '[' || coalesce(array_to_string(list_transform(st, lambda x: '{"subject_id":' || x.s || ',"predicate_id":"' || x.r || '","object_id":' || x.o || '}'), ','), '') || ']' AS json FROM found)),
    walked AS (SELECT pair_id, path_id, generate_subscripts(st, 1) AS place, unnest(st) AS x FROM paths),
    nodes AS (SELECT pair_id, path_id, 0 AS place, x.s AS concept_id FROM walked WHERE place = 1 UNION ALL SELECT pair_id, path_id, place, x.o FROM walked)"""
_PROFILES = f"""{_PATHS}, {_KINDS},
    of_nodes AS (SELECT pair_id, path_id, count(*) FILTER (found IS NULL OR gone IS NOT NULL) AS invalid, count(*) FILTER (standard_concept IS DISTINCT FROM 'S') AS non_standard, count(*) FILTER (vocabulary_id <> before) AS vocab_switches
      FROM (SELECT n.*, c.concept_id AS found, c.invalid_reason AS gone, standard_concept, vocabulary_id, lag(vocabulary_id) OVER (PARTITION BY pair_id, path_id ORDER BY place) AS before FROM nodes n LEFT JOIN concept c USING (concept_id)) GROUP BY ALL),
    of_edges AS (SELECT pair_id, path_id, count(*) FILTER (kind = 'ontological') AS ontological, count(*) FILTER (kind = 'mapping') AS mapping, count(*) FILTER (kind = 'metadata') AS metadata FROM walked JOIN kinds ON relationship_id = x.r GROUP BY ALL),
    profiles AS (SELECT p.pair_id, p.path_id, p.steps, p.json, p.hops, coalesce(invalid, 0) AS invalid, coalesce(non_standard, 0) AS non_standard, coalesce(vocab_switches, 0) AS vocab_switches, coalesce(ontological, 0) AS ontological, coalesce(mapping, 0) AS mapping, coalesce(metadata, 0) AS metadata
      FROM paths p LEFT JOIN of_nodes USING (pair_id, path_id) LEFT JOIN of_edges USING (pair_id, path_id)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY invalid, non_standard, metadata, mapping, vocab_switches, hops, json) AS rank FROM profiles)"""
_RANKED = f"{_PROFILES} SELECT * EXCLUDE (json) FROM ranked WHERE rank <= 10"


def paths(g):
    """All shortest paths of the pairs, numbered by their steps."""
    found = graph.shortest_paths(g.edges, path_pairs(g))
    return found.withColumn("path_id", F.row_number().over(Window.partitionBy("pair_id").orderBy(F.to_json("steps"))).cast("long"))


def text(steps="steps"):
    return F.array_join(F.transform(steps, lambda s: F.concat_ws("|", s["subject_id"].cast("string"), s["predicate_id"], s["object_id"].cast("string"))), " ")


@query("e4_shortest_paths", v(f"{_PATHS} SELECT pair_id, steps FROM paths"))
def _(g):
    return graph.shortest_paths(g.edges, path_pairs(g)).select("pair_id", text().alias("steps"))


@query("e5_path_profile", v(f"{_PROFILES} SELECT * EXCLUDE (json, path_id) FROM profiles"))
def _(g):
    return graph.path_profile(g.concept, g.relationship, paths(g)).drop("path_id").withColumn("steps", text())


@query("e3_ranked_paths", v(_RANKED))
def _(g):
    return graph.find_ranked_paths(g.concept, g.edges, g.relationship, path_pairs(g)).withColumn("steps", text())


@query("e6_rank_paths", v(_RANKED))
def _(g):
    return graph.rank_paths(graph.path_profile(g.concept, g.relationship, paths(g))).withColumn("steps", text())


@query("e7_explain_paths", v(f"""{_PATHS}, {_KINDS}
    SELECT pair_id, place - 1 AS step_no, x.s AS subject_id, x.r AS predicate_id, x.o AS object_id, a.concept_name AS subject_name, b.concept_name AS object_name, a.vocabulary_id AS subject_vocabulary, b.vocabulary_id AS object_vocabulary, relationship_name, kind
    FROM walked JOIN concept a ON a.concept_id = x.s JOIN concept b ON b.concept_id = x.o JOIN kinds k ON k.relationship_id = x.r JOIN relationship q ON q.relationship_id = x.r"""))
def _(g):
    return graph.explain_paths(g.concept, g.relationship, paths(g)).drop("path_id")


@query("e8_path_concepts", v(f"""{_PROFILES}, ends AS (SELECT * FROM pairs UNION ALL SELECT branded + 100000000, branded, branded FROM items),
    places AS (SELECT pair_id, 0 AS r, 0 AS p, source AS concept_id FROM ends UNION ALL SELECT pair_id, 0, 1, target FROM ends UNION ALL SELECT pair_id, rank, place, concept_id FROM ranked JOIN nodes USING (pair_id, path_id) WHERE rank <= 10)
    SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY first, concept_id) AS position, concept_id FROM (SELECT pair_id, concept_id, min(r * 1000 + p) AS first FROM places GROUP BY ALL)"""))
def _(g):
    pairs = path_pairs(g)
    ranked = graph.rank_paths(graph.path_profile(g.concept, g.relationship, paths(g)))
    return graph.path_concepts(pairs, ranked)


@query("d3_kinds", v(f", {_KINDS} SELECT * FROM kinds WHERE relationship_id IN (SELECT relationship_id FROM edges)"))
def _(g):
    return mapping.classify_predicates(g.relationship).join(g.edges, "relationship_id", "left_semi")
