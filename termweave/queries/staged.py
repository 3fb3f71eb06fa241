"""Staging, curation and lineage (H), recursive union (SO6), age cut-off (SC11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import staging
from ..plans.derive import with_vocabulary as v
from . import query
from .vocabulary import seed_sets

#: One result a brand, of its branded items; brand n is the parent of brand n + 1 but for each fifth; a minute apart.
_ROWS = """, res AS (SELECT DISTINCT bn AS result_id, CASE WHEN bn % 5 = 0 OR bn - 1 NOT IN (SELECT bn FROM parts) THEN NULL ELSE bn - 1 END AS parent_result_id, 'tool' || (bn % 3) AS tool_name, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(bn AS INTEGER)) AS created_at FROM parts),
    rws AS (SELECT bn AS result_id, concept_id, concept_name, row_number() OVER (PARTITION BY bn ORDER BY concept_name, concept_id) - 1 AS row_index FROM (SELECT DISTINCT bn, branded FROM parts) JOIN concept ON concept_id = branded),
    log AS (SELECT result_id, CASE WHEN result_id % 3 = 0 THEN 'kept' ELSE 'finalized' END AS status, 'draft ' || result_id AS draft_name FROM res WHERE result_id % 3 <> 1)"""


def staged(g):
    ids = g.parts.select(F.col("bn").alias("result_id")).distinct()
    before = ids.select((F.col("result_id") + 1).alias("result_id"), F.col("result_id").alias("parent"))
    results = ids.join(before, "result_id", "left").select("result_id", F.when(F.col("result_id") % 5 != 0, F.col("parent")).alias("parent_result_id"), F.concat(F.lit("tool"), (F.col("result_id") % 3).cast("string")).alias("tool_name"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(result_id as int), 0)").alias("created_at"), (F.col("result_id") * 2).alias("limit"))
    concepts = seed_sets(g).withColumnRenamed("set_id", "result_id").join(g.concept.select("concept_id", "concept_name"), "concept_id")
    return staging.stage(results, concepts, ["concept_name", "concept_id"])


def log(g):
    """A draft status a minute before a later one, for two brands of three."""
    ids = g.parts.select(F.col("bn").alias("result_id")).distinct().where("result_id % 3 <> 1").withColumn("draft_name", F.concat(F.lit("draft "), F.col("result_id").cast("string")))
    early = staging.promote(ids, F.expr("timestamp_ntz'2024-01-02 00:00:00'"), "ephemeral")
    late = ids.withColumn("changed_at", F.expr("timestamp_ntz'2024-01-02 00:01:00'")).select("result_id", F.when(F.col("result_id") % 3 == 0, "kept").otherwise("finalized").alias("status"), "draft_name", "changed_at")
    return early.union(late)


@query("h1_stage_headers", v(f"{_ROWS} SELECT result_id, parent_result_id, tool_name, '{{\"limit\":' || (result_id * 2) || '}}' AS parameters, count(*) AS concept_count FROM res JOIN rws USING (result_id) GROUP BY ALL"))
def _(g):
    return staged(g)[0].select("result_id", "parent_result_id", "tool_name", "parameters", "concept_count")


@query("h1_stage_rows", v(f"{_ROWS} SELECT *, false AS is_excluded FROM rws"))
def _(g):
    return staged(g)[1].select("result_id", "concept_id", "concept_name", "row_index", "is_excluded")


@query("h2_result_concepts", v(f"{_ROWS} SELECT result_id, row_index, concept_name FROM rws WHERE result_id % 2 = 0"))
def _(g):
    headers, rows = staged(g)
    return staging.result_concepts(rows, headers.where("result_id % 2 = 0")).select("result_id", "row_index", "concept_name")


@query("h3_cherry_pick", v(f"{_ROWS} SELECT result_id + 1000 AS result_id, concept_id, row_number() OVER (PARTITION BY result_id ORDER BY row_index) - 1 AS row_index FROM rws WHERE row_index % 3 = 1"))
def _(g):
    rows = staged(g)[1]
    picks = rows.where("row_index % 3 = 1").select("result_id", (F.col("result_id") + 1000).alias("child_id"), "row_index").union(rows.select("result_id", F.col("result_id") + 1000, F.lit(999999).cast("long")))
    return staging.cherry_pick(rows, picks).select("result_id", "concept_id", "row_index")


@query("h4_exclude", v(f"{_ROWS} SELECT result_id + 1000 AS result_id, row_index, concept_id, lower(concept_name) LIKE '%ring%' AS is_excluded FROM rws"))
def _(g):
    headers, rows = staged(g)
    words = headers.select("result_id", (F.col("result_id") + 1000).alias("child_id"), F.lit("RING").alias("keyword"))
    return staging.exclude(rows, words).select("result_id", "row_index", "concept_id", "is_excluded")


_ITEM_ROWS = ", irws AS (SELECT nr AS result_id, item AS concept_id, concept_name, row_number() OVER (PARTITION BY nr ORDER BY concept_name, concept_id) - 1 AS row_index FROM (SELECT DISTINCT nr, item FROM parts) JOIN concept ON concept_id = item)"


@query("h5_expand_descendants", v(f"""{_ITEM_ROWS}, d AS (SELECT ancestor_concept_id AS src, descendant_concept_id AS below, concept_name, row_number() OVER (PARTITION BY ancestor_concept_id ORDER BY min_levels_of_separation, concept_name, concept_id) AS place FROM closure JOIN concept ON concept_id = descendant_concept_id WHERE min_levels_of_separation > 0),
    new AS (SELECT result_id, below, d.concept_name, src, row_index, place, row_number() OVER (PARTITION BY result_id, below ORDER BY row_index, place) AS turn FROM irws r JOIN d ON src = r.concept_id WHERE place <= 500),
    u AS (SELECT result_id, concept_id, concept_name, CAST(NULL AS BIGINT) AS source_concept_id, false AS is_descendant, row_index AS o, 0 AS p, 0 AS part FROM irws UNION ALL SELECT result_id, below, concept_name, src, true, row_index, place, 1 FROM new n WHERE turn = 1 AND NOT EXISTS (SELECT 1 FROM irws i WHERE i.result_id = n.result_id AND i.concept_id = below))
    SELECT result_id, concept_id, concept_name, source_concept_id, is_descendant, row_number() OVER (PARTITION BY result_id ORDER BY part, o, p, concept_id) - 1 AS row_index FROM u"""))
def _(g):
    items = g.parts.select(F.col("nr").alias("result_id"), F.col("item").alias("concept_id")).distinct().join(g.concept.select("concept_id", "concept_name"), "concept_id")
    results = items.select("result_id").distinct().select("result_id", F.lit("t").alias("tool_name"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("created_at"))
    return staging.expand_descendants(staging.stage(results, items, ["concept_name", "concept_id"])[1], g.concept, g.closure)


@query("h6_modify_flags", v(f"{_ROWS} SELECT result_id, row_index, row_index < 2 AS is_excluded, row_index < 2 AS include_mapped, false AS include_descendants FROM rws"))
def _(g):
    rows = staged(g)[1]
    return staging.modify_flags(rows, rows.where("row_index < 2"), is_excluded=True, include_mapped=True, include_descendants=None).select("result_id", "row_index", "is_excluded", "include_mapped", "include_descendants")


@query("h7_promote", v(f"{_ROWS} SELECT result_id, 'kept' AS status, 'mine ' || result_id AS draft_name FROM res"))
def _(g):
    ids = staged(g)[0].select("result_id", F.concat(F.lit("mine "), F.col("result_id").cast("string")).alias("draft_name"))
    return staging.promote(ids, F.expr("timestamp_ntz'2024-01-03 00:00:00'")).select("result_id", "status", "draft_name")


@query("h8_list_results", v(f"{_ROWS} SELECT result_id, tool_name, coalesce(status, 'ephemeral') AS status, draft_name FROM res LEFT JOIN log USING (result_id)"))
def _(g):
    return staging.list_results(staged(g)[0], log(g)).select("result_id", "tool_name", "status", "draft_name")


@query("h9_draft_concepts", v(f"{_ROWS} SELECT draft_name, row_index, concept_id, false AS is_excluded, false AS include_descendants, false AS include_mapped FROM rws JOIN log USING (result_id)"))
def _(g):
    headers, rows = staged(g)
    return staging.draft_concepts(headers, rows, log(g))


_UP = f"{_ROWS}, up AS (SELECT result_id, result_id AS ancestor_id, CAST(0 AS BIGINT) AS generation FROM res UNION ALL SELECT u.result_id, h.parent_result_id, u.generation + 1 FROM up u JOIN res h ON h.result_id = u.ancestor_id WHERE h.parent_result_id IS NOT NULL) SELECT * FROM up"


@query("h10_lineage", v(_UP))
def _(g):
    headers = staged(g)[0]
    return staging.lineage(headers, headers)


@query("so6_recursive_union", v(_UP))
def _(g):
    headers = staged(g)[0]
    return staging.lineage(headers, headers)


_GONE = "result_id NOT IN (SELECT result_id FROM log) AND created_at < TIMESTAMP '2024-01-01 01:15:00' - INTERVAL 60 MINUTE AND result_id NOT IN (SELECT parent_result_id FROM res WHERE parent_result_id IS NOT NULL)"


@query("h11_expire", v(f"{_ROWS} SELECT r.result_id, count(*) AS n FROM res r JOIN rws USING (result_id) WHERE NOT ({_GONE.replace('result_id NOT', 'r.result_id NOT')}) GROUP BY 1"))
def _(g):
    headers, rows = staged(g)
    kept, left = staging.expire(headers, rows, log(g), F.expr("timestamp_ntz'2024-01-01 01:15:00'"))
    return kept.select("result_id").join(left, "result_id").groupBy("result_id").agg(F.count("*").alias("n"))


@query("jn4_not_a_parent", v(f"{_ROWS} SELECT result_id FROM res WHERE result_id NOT IN (SELECT parent_result_id FROM res WHERE parent_result_id IS NOT NULL)"))
def _(g):
    headers = staged(g)[0]
    return headers.select("result_id").join(headers.where("parent_result_id is not null").select(F.col("parent_result_id").alias("result_id")), "result_id", "left_anti")


@query("sc11_age_cutoff", "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 90 MINUTE")
def _(g):
    return g.read("events").where(F.col("ts") < F.expr("timestamp_ntz'2024-01-15 00:00:00' - interval 90 minutes")).select("event_id")
