"""Vector retrieval, scoring and fusion (G), retrieval metrics (I13-I15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import picks, semantic, vector_index
from ..operators._rank import top
from ..plans.derive import with_vocabulary as v
from ..sources.scratch import written
from . import query
from .vocabulary import KEYWORDS_SQL, keywords

_VECTORS = """, q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id % 20 = 0), idx AS (SELECT vec_id AS concept_id, label, CAST(embedding AS DOUBLE[]) AS y FROM embeddings),
    sims AS (SELECT query_id, concept_id, label, floor(list_dot_product(x, y) / (sqrt(list_dot_product(x, x)) * sqrt(list_dot_product(y, y))) * 1e6 + 0.5) / 1e6 AS similarity FROM q, idx WHERE query_id <> concept_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, concept_id) AS rank FROM sims)"""
_MAPS = """, vmaps AS (SELECT vec_id AS concept_id, 101 + label % (SELECT max(nr) FROM parts) AS target FROM embeddings WHERE vec_id % 7 <> 0)"""


def vectors(g):
    """The stated queries (ids divisible by 20) and the index (all rows)."""
    e = g.read("embeddings")
    asked = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return asked, e.select(F.col("vec_id").alias("concept_id"), "embedding", "label")


def nearest(g, k=10, **more):
    """The k nearest rows of each query, but for itself."""
    return semantic.cosine_topk(*vectors(g), k=k, own=False, **more)


def vector_maps(g):
    return g.read("embeddings").where("vec_id % 7 <> 0").join(F.broadcast(g.nouns())).select(F.col("vec_id").alias("concept_id"), (101 + F.col("label") % F.col("n_nouns")).alias("target"))


@query("sc12_cosine", "SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), list_reverse(CAST(embedding AS DOUBLE[]))) / list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 6) + 0.0 AS similarity FROM embeddings")
def _(g):
    return g.read("embeddings").select("vec_id", (F.round(semantic.cosine_similarity(F.col("embedding"), F.reverse("embedding")), 6) + 0.0).alias("similarity"))


@query("g1_embed_texts", v("SELECT concept_id, CAST(64 AS BIGINT) AS dims, CAST(1 AS DOUBLE) AS norm FROM concept"))
def _(g):
    return semantic.embed_texts(g.concept, "concept_id", "concept_name").select("concept_id", F.size("embedding").cast("long").alias("dims"), F.round(semantic.cosine_similarity(F.col("embedding"), F.col("embedding")), 6).alias("norm"))


@query("g2_enriched_text", v("""
    , s AS (SELECT concept_id, string_agg(concept_synonym_name, ', ' ORDER BY concept_synonym_name) AS t FROM (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY concept_synonym_name) AS n FROM synonym) WHERE n <= 5 GROUP BY 1),
    p AS (SELECT concept_id, string_agg(parent, ', ' ORDER BY parent, pid) AS t FROM (SELECT descendant_concept_id AS concept_id, c.concept_id AS pid, concept_name AS parent, row_number() OVER (PARTITION BY descendant_concept_id ORDER BY concept_name, c.concept_id) AS n FROM closure JOIN concept c ON c.concept_id = ancestor_concept_id WHERE min_levels_of_separation = 1) WHERE n <= 3 GROUP BY 1)
    SELECT concept_id, substring(concat_ws(' | ', concept_name, s.t, p.t, domain_id, vocabulary_id), 1, 1500) AS text FROM concept LEFT JOIN s USING (concept_id) LEFT JOIN p USING (concept_id)"""))
def _(g):
    return semantic.enriched_text(g.concept, g.synonym, g.closure)


@query("g3_cosine_topk", v(f"{_VECTORS} SELECT query_id, rank, concept_id, similarity FROM ranked WHERE rank <= 10"))
def _(g):
    return nearest(g)


@query("g3_cosine_filtered", v(f"{_VECTORS}, f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, concept_id) AS r2 FROM sims WHERE label = 3) SELECT query_id, r2 AS rank, concept_id, similarity FROM f WHERE r2 <= 5"))
def _(g):
    return nearest(g, 5, label=3)


_RESOLVED = f"""{_VECTORS}{_MAPS}, res AS (SELECT query_id, m.target AS concept_id, c.concept_name AS target_name, max(similarity) AS similarity, count(DISTINCT r.concept_id) AS n_sources,
      list(r.concept_id ORDER BY similarity DESC, r.concept_id) AS ids, list(similarity ORDER BY similarity DESC, r.concept_id) AS sims_
      FROM ranked r JOIN vmaps m ON m.concept_id = r.concept_id JOIN concept c ON c.concept_id = m.target WHERE rank <= 20 AND standard_concept = 'S' AND invalid_reason IS NULL GROUP BY 1, 2, 3),
    resr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, concept_id) AS rank FROM res)"""


def resolved(g):
    return semantic.resolve_via_nonstandard(nearest(g, 20), g.concept, vector_maps(g))


@query("g4_resolve_nonstandard", v(f"{_RESOLVED} SELECT query_id, rank, concept_id, target_name, similarity, n_sources, array_to_string(ids, ',') AS sources FROM resr WHERE rank <= 10"))
def _(g):
    return resolved(g).select("query_id", "rank", "concept_id", "target_name", "similarity", "n_sources", F.array_join(F.transform("provenance", lambda p: p["concept_id"].cast("string")), ",").alias("sources"))


@query("ag3_best_count_list", v(f"{_RESOLVED} SELECT concept_id, max(similarity) AS best, CAST(sum(n_sources) AS BIGINT) AS n_sources FROM resr GROUP BY 1"))
def _(g):
    return resolved(g).groupBy("concept_id").agg(F.max("similarity").alias("best"), F.sum("n_sources").alias("n_sources"))


@query("g5_provenance", v(f"{_RESOLVED} SELECT query_id, concept_id, CAST(k AS BIGINT) AS place, ids[k] AS source_id, sims_[k] AS similarity FROM resr, (VALUES (1), (2), (3)) t(k) WHERE rank <= 10 AND k <= len(ids)"))
def _(g):
    return semantic.provenance_top3(resolved(g))


@query("g6_approx_topk")
def _(g):
    return semantic.approx_topk(*vectors(g), 10, own=False)


@query("g6_every_cell_topk", v(f"{_VECTORS} SELECT query_id, rank, concept_id, similarity FROM ranked WHERE rank <= 10"))
def _(g):
    asked, index = vectors(g)
    built = vector_index.build_index(index)
    return vector_index.search(asked, built, 10, own=False, probes=len(built.model.centroids), refine=None)


@query("g6_every_cell_filtered", v(f"{_VECTORS}, f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, concept_id) AS r2 FROM sims WHERE label = 3) SELECT query_id, r2 AS rank, concept_id, similarity FROM f WHERE r2 <= 5"))
def _(g):
    asked, index = vectors(g)
    built = vector_index.build_index(index, keep=("label",))
    return vector_index.search(asked, built, 5, own=False, probes=len(built.model.centroids), refine=None, label=3)


_NAMED = f"""{KEYWORDS_SQL}, m AS (SELECT query_id, keyword, concept_id, concept_name FROM keywords JOIN concept ON concept_name ILIKE '%' || keyword || '%')"""
_LEV = "CASE WHEN greatest(length(keyword), length(concept_name)) = 0 THEN 1.0 ELSE 1 - levenshtein(lower(keyword), lower(concept_name)) / CAST(greatest(length(keyword), length(concept_name)) AS DOUBLE) END"
_TOK = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '\\s+'), lambda x: x <> ''))"
_JAC = "len(list_intersect({a}, {b})) / CAST(len(list_distinct(list_concat({a}, {b}))) AS DOUBLE)".format(a=_TOK.format("keyword"), b=_TOK.format("concept_name"))


def _gestalt(rows):
    """CTEs whose last, gest, has the Ratcliff-Obershelp ratio of each row's keyword and name: the longest common piece, then those on both its sides."""
    return f"""gm AS (SELECT DISTINCT query_id, concept_id, '' AS part, lower(keyword) AS a, lower(concept_name) AS b, 0 AS n FROM {rows}
      UNION ALL SELECT query_id, concept_id, part || side, CASE side WHEN 'l' THEN substring(a, 1, i - 1) ELSE substring(a, i + size) END, CASE side WHEN 'l' THEN substring(b, 1, j - 1) ELSE substring(b, j + size) END, CASE side WHEN 'l' THEN size ELSE 0 END
      FROM (SELECT *, strpos(b, substring(a, i, size)) AS j FROM (SELECT *, (best + 999) // 1000 AS size, (best + 999) // 1000 * 1000 - best AS i FROM (
        SELECT query_id, concept_id, part, a, b, max(z * 1000 - y) AS best FROM (SELECT *, unnest(range(1, length(a) - y + 2)) AS z FROM (SELECT *, unnest(range(1, length(a) + 1)) AS y FROM gm WHERE a <> '' AND b <> '')) WHERE contains(b, substring(a, y, z)) GROUP BY ALL))), (VALUES ('l'), ('r')) t(side)),
    gest AS (SELECT g.query_id, g.concept_id, CASE WHEN max(length(keyword) + length(concept_name)) = 0 THEN 1.0 ELSE 2.0 * sum(n) / max(length(keyword) + length(concept_name)) END AS gestalt FROM gm g JOIN (SELECT DISTINCT query_id, concept_id, keyword, concept_name FROM {rows}) USING (query_id, concept_id) GROUP BY ALL)"""


def name_pairs(g):
    """Each keyword with every concept whose name holds it."""
    from ..operators.search import _name_hits

    return _name_hits(g.concept.select("concept_id", "concept_name", F.col("concept_name").alias("text")), keywords(g))


@query("g7_gestalt_ratio", v(f", {_NAMED}, {_gestalt('m')} SELECT query_id, concept_id, round(gestalt, 6) AS ratio FROM gest"))
def _(g):
    return name_pairs(g).select("query_id", "concept_id", F.round(tx.gestalt(F.col("keyword"), F.col("concept_name")), 6).alias("ratio"))


@query("g8_levenshtein_ratio", v(f", {_NAMED} SELECT query_id, concept_id, round({_LEV}, 6) AS ratio FROM m"))
def _(g):
    return name_pairs(g).select("query_id", "concept_id", F.round(tx.levenshtein_ratio(F.col("keyword"), F.col("concept_name")), 6).alias("ratio"))


@query("g9_jaccard_tokens", v(f", {_NAMED} SELECT query_id, concept_id, round({_JAC}, 6) AS overlap FROM m"))
def _(g):
    return name_pairs(g).select("query_id", "concept_id", F.round(tx.jaccard_tokens(F.col("keyword"), F.col("concept_name")), 6).alias("overlap"))


_HYBRID = f"0.4 * {_LEV} + 0.4 * {_JAC} + 0.2 / (1 + length(concept_name) / 100.0)"
_HYBRID_G = f"0.4 * gestalt + 0.4 * {_JAC} + 0.2 / (1 + length(concept_name) / 100.0)"


@query("g10_hybrid_score", v(f", {_NAMED}, {_gestalt('m')} SELECT query_id, concept_id, round({_HYBRID_G}, 6) AS score FROM m JOIN gest USING (query_id, concept_id)"))
def _(g):
    return name_pairs(g).select("query_id", "concept_id", F.round(tx.hybrid_score(F.col("keyword"), F.col("concept_name")), 6).alias("score"))


@query("g10_hybrid_levenshtein", v(f", {_NAMED} SELECT query_id, concept_id, round({_HYBRID}, 6) AS score FROM m"))
def _(g):
    return name_pairs(g).select("query_id", "concept_id", F.round(tx.hybrid_score(F.col("keyword"), F.col("concept_name"), tx.levenshtein_ratio), 6).alias("score"))


@query("g11_rerank_cosine", v(f"""{_VECTORS}, m AS (SELECT r.query_id, a.p_name AS keyword, r.concept_id, b.p_name AS concept_name, similarity FROM ranked r JOIN part a ON a.p_partkey = r.query_id JOIN part b ON b.p_partkey = r.concept_id WHERE rank <= 50),
    s AS (SELECT *, round(0.4 * similarity + 0.3 * ({_LEV}) + 0.3 * ({_JAC}), 6) AS score FROM m) SELECT query_id, concept_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, concept_id) AS n FROM s) WHERE n <= 10"""))
def _(g):
    names = g.read("part").select("p_partkey", "p_name")
    hits = nearest(g, 50).drop("rank").join(names.select(F.col("p_partkey").alias("query_id"), F.col("p_name").alias("keyword")), "query_id").join(names.select(F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("concept_name")), "concept_id")
    return semantic.rerank_cosine(hits).select("query_id", "concept_id", "score")


_TIERS = """, hits AS (SELECT query_id, keyword, concept_id, concept_name, 0 AS source, concept_name AS t FROM asked JOIN concept ON concept_name ILIKE '%' || keyword || '%' WHERE standard_concept = 'S' AND invalid_reason IS NULL
      UNION ALL SELECT query_id, keyword, concept_id, concept_name, 1, concept_synonym_name FROM asked JOIN synonym ON concept_synonym_name ILIKE '%' || keyword || '%' JOIN concept USING (concept_id) WHERE standard_concept = 'S' AND invalid_reason IS NULL),
    t1 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN concept_name ILIKE keyword THEN 0 ELSE 1 END, length(concept_name), concept_name, concept_id) AS place FROM hits WHERE source = 0),
    short AS (SELECT query_id FROM asked WHERE query_id NOT IN (SELECT query_id FROM t1 WHERE place <= 20 GROUP BY 1 HAVING count(*) >= 3)),
    once AS (SELECT *, row_number() OVER (PARTITION BY query_id, concept_id ORDER BY source, length(t), t) AS turn FROM hits WHERE query_id IN (SELECT query_id FROM short)),
    t2 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY source, CASE WHEN concept_name ILIKE keyword THEN 0 ELSE 1 END, length(concept_name), concept_name, concept_id) AS place FROM once WHERE turn = 1),
    cand AS (SELECT query_id, keyword, concept_id, concept_name, tier AS match_tier, place FROM (SELECT *, row_number() OVER (PARTITION BY query_id, concept_id ORDER BY tier, place) AS n FROM (
      SELECT query_id, keyword, concept_id, concept_name, 1 AS tier, place FROM t1 WHERE place <= 20 UNION ALL SELECT query_id, keyword, concept_id, concept_name, 2, place FROM t2 WHERE place <= 20)) WHERE n = 1),"""
_ASKED = f"{KEYWORDS_SQL}, asked AS (SELECT * FROM keywords UNION ALL SELECT DISTINCT 300 + item, noun || ', ' || adj FROM parts)"


def terms(g):
    """All words, and all synonyms, which no name holds."""
    return keywords(g).union(g.parts.select(300 + F.col("item"), F.concat_ws(", ", "noun", "adj")).distinct())


_BEST = "SELECT query_id, rank, concept_id, concept_name, CAST(match_tier AS BIGINT) AS match_tier, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, concept_id) AS rank FROM s) WHERE rank <= 5"


@query("g12_ground_terms", v(f", {_ASKED}{_TIERS} {_gestalt('cand')}, s AS (SELECT *, round({_HYBRID_G}, 6) AS score FROM cand JOIN gest USING (query_id, concept_id)) {_BEST}"))
def _(g):
    return semantic.ground_terms(g.concept, g.synonym, terms(g))


@query("g12_ground_levenshtein", v(f", {_ASKED}{_TIERS} s AS (SELECT *, round({_HYBRID}, 6) AS score FROM cand) {_BEST}"))
def _(g):
    return semantic.ground_terms(g.concept, g.synonym, terms(g), ratio=tx.levenshtein_ratio)


@query("g12_ground_under_parent", v(f""", {_ASKED}{_TIERS} {_gestalt('cand')}, s AS (SELECT c.*, round({_HYBRID_G}, 6) AS score, CASE WHEN concept_id = 101 THEN 0 ELSE (SELECT min(min_levels_of_separation) FROM closure WHERE ancestor_concept_id = 101 AND descendant_concept_id = concept_id AND min_levels_of_separation > 0) END AS separation FROM cand c JOIN gest USING (query_id, concept_id)),
    k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY match_tier, place, concept_id) AS turn FROM s WHERE separation IS NOT NULL)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY separation, score DESC, concept_id) AS rank, concept_id, concept_name, CAST(match_tier AS BIGINT) AS match_tier, score, CAST(separation AS BIGINT) AS separation FROM k WHERE turn <= 5"""))
def _(g):
    return semantic.ground_terms(g.concept, g.synonym, terms(g).withColumn("parent_concept_id", F.lit(101).cast("long")), g.closure)


@query("g12_ground_with_vectors")
def _(g):
    asked = terms(g)
    both = [semantic.embed_texts(df, key, name) for df, key, name in ((asked, "query_id", "keyword"), (g.concept.where("standard_concept = 'S' and invalid_reason is null"), "concept_id", "concept_name"))]
    return semantic.ground_terms(g.concept, g.synonym, asked, vectors=(both[0], both[1]))


_LISTS = f"""{_VECTORS}, lists AS (SELECT query_id, 'a' AS source, concept_id, rank FROM ranked WHERE rank <= 20
    UNION ALL SELECT query_id, 'b', concept_id, row_number() OVER (PARTITION BY query_id ORDER BY abs(concept_id - query_id), concept_id) FROM (SELECT * FROM ranked WHERE rank <= 40))"""


def lists(g):
    """The nearest by cosine, and the nearest 40 by closeness of ids."""
    found = written(nearest(g, 40))  # both lists read it
    by_id = top(found.drop("rank"), ["query_id"], [F.abs(F.col("concept_id") - F.col("query_id")), "concept_id"], None)
    one = found.where("rank <= 20").select("query_id", F.lit("a").alias("source"), "concept_id", "rank")
    return one.union(by_id.select("query_id", F.lit("b"), "concept_id", "rank"))


@query("g13_rrf_fuse", v(f"{_LISTS}, f AS (SELECT query_id, concept_id, round(sum(1.0 / CAST(60 + rank AS DOUBLE)), 9) AS score FROM lists GROUP BY ALL) SELECT query_id, concept_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, concept_id) AS rank FROM f"))
def _(g):
    return semantic.rrf_fuse(lists(g))


@query("g14_round_robin", v(f"{_LISTS}, f AS (SELECT query_id, concept_id, min(rank * 10 + CASE source WHEN 'a' THEN 0 ELSE 1 END) AS turn FROM lists GROUP BY ALL) SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY turn, concept_id) AS position, concept_id FROM f"))
def _(g):
    return semantic.round_robin_union(lists(g))


_TRUTH = f"""{_LISTS}, truth AS (SELECT query_id, query_id + 1 AS target_id, query_id + 2 AS other_id, label AS tier FROM q JOIN embeddings ON vec_id = query_id),
    hit AS (SELECT t.query_id, min(rank) AS rank, min_by(similarity, rank) AS similarity FROM truth t JOIN ranked r ON r.query_id = t.query_id WHERE rank <= 200 AND (concept_id = target_id OR concept_id = other_id) GROUP BY 1)"""


def truth(g):
    e = g.read("embeddings").where("vec_id % 20 = 0")
    return e.select(F.col("vec_id").alias("query_id"), (F.col("vec_id") + 1).alias("target_id"), (F.col("vec_id") + 2).alias("other_id"), F.col("label").cast("long").alias("tier"))


@query("i13_retrieval_metrics", v(f"""{_TRUTH} SELECT CAST(tier AS BIGINT) AS tier, count(*) AS n, round(avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0 END), 6) AS acc_1, round(avg(CASE WHEN rank <= 5 THEN 1.0 ELSE 0 END), 6) AS acc_5, round(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0 END), 6) AS acc_10,
    round(avg(coalesce(1.0 / CAST(rank AS DOUBLE), 0)), 6) AS mrr, round(avg(rank), 6) AS mean_rank, round(avg(similarity), 9) AS mean_similarity FROM truth LEFT JOIN hit USING (query_id) GROUP BY 1"""))
def _(g):
    return picks.retrieval_metrics(nearest(g, 200), truth(g), by=("tier",))


@query("i14_complementarity", v(f"{_LISTS}, e AS (SELECT DISTINCT source AS method, concept_id AS query_id FROM lists), n AS (SELECT *, count(*) OVER (PARTITION BY query_id) AS k FROM e) SELECT method, count(*) AS n_found, count(*) FILTER (k = 1) AS n_only, (SELECT count(DISTINCT query_id) FROM e) AS n_union FROM n GROUP BY method"))
def _(g):
    return picks.complementarity(lists(g).select(F.col("source").alias("method"), F.col("concept_id").alias("query_id")))


@query("i15_category_summary", v("SELECT coalesce(invalid_reason, 'valid') AS category, count(*) AS n, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM concept), 6) AS share FROM concept GROUP BY 1"))
def _(g):
    return picks.category_summary(g.concept.select(F.coalesce("invalid_reason", F.lit("valid")).alias("category")))
