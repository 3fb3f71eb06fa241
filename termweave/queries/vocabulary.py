"""Sources, filters, search, hierarchy and relationships (A-D, AG1-AG2, W, SO, SC)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import catalogue, hierarchy, mapping, search
from ..operators._rank import top
from ..plans.derive import Given
from ..plans.derive import with_vocabulary as v
from ..sources import files
from . import query

_SHOWN = "concept_id, concept_name, domain_id, vocabulary_id, concept_class_id, concept_code, standard_concept, invalid_reason"
_CORE = "concept_id, concept_name, domain_id, vocabulary_id, concept_class_id, concept_code, standard_concept"
_CORE_D = ", ".join(f"c.{x}" for x in _CORE.split(", "))
KEYWORDS_SQL = "keywords AS (SELECT DISTINCT nr AS query_id, noun AS keyword FROM parts UNION ALL SELECT DISTINCT 100 + ar, adj FROM parts)"


def keywords(g: Given) -> DataFrame:
    """Every noun and adjective of the catalogue as a keyword."""
    return g.parts.select(F.col("nr").alias("query_id"), F.col("noun").alias("keyword")).union(g.parts.select(100 + F.col("ar"), "adj")).distinct()


def ids(g: Given, *classes: str) -> DataFrame:
    return g.concept.where(F.col("concept_class_id").isin(*classes)).select("concept_id")


def asked(g: Given) -> DataFrame:
    """Known ids, and as many unknown ones beyond them."""
    known = g.concept.select("concept_id")
    return known.union(g.parts.select((F.col("srcid") + 50000000).alias("concept_id")))


_ASKED = "asked AS (SELECT concept_id FROM concept UNION ALL SELECT srcid + 50000000 FROM parts)"


@query("a2_table", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(g):
    n, r = files.table(g.spark, g.dir, "nation", "cdm"), files.table(g.spark, g.dir, "region", "cdm")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


for _mode, _cond in (("standard", "standard_concept = 'S'"), ("nonstandard", "coalesce(standard_concept, 'X') <> 'S'"), ("all", "true")):

    @query(f"a3_metadata_{_mode}", v(f"SELECT concept_id, concept_name FROM concept WHERE invalid_reason IS NULL AND {_cond}"))
    def _(g, mode=_mode):
        return files.embedding_metadata(g.concept, mode).select("concept_id", "concept_name")


@query("a4_embedding_table", v(", vec AS (SELECT 101 + vec_id % (SELECT max(nr) FROM parts) AS concept_id, vec_id, embedding FROM embeddings) SELECT concept_id, concept_name, vec_id, CAST(len(embedding) AS BIGINT) AS dims FROM concept JOIN vec USING (concept_id) WHERE invalid_reason IS NULL AND standard_concept = 'S'"))
def _(g):
    vec = g.read("embeddings").join(F.broadcast(g.nouns())).select((101 + F.col("vec_id") % F.col("n_nouns")).alias("concept_id"), "vec_id", "embedding")
    built = files.build_embedding_table(files.embedding_metadata(g.concept).select("concept_id", "concept_name"), vec, 64)
    return built.join(vec.select("concept_id", "vec_id"), "concept_id").select("concept_id", "concept_name", "vec_id", F.size("embedding").cast("long").alias("dims")).distinct()


@query("a11_capped_select", "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 1000")
def _(g):
    return files.capped_select(g.read("part").select("p_partkey", "p_name"), ["p_name", "p_partkey"])


@query("a12_transcript_text", "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS transcript FROM conversations WHERE role = 'user' AND coalesce(text, '') <> '' GROUP BY conv_id")
def _(g):
    return files.transcript_text(g.read("conversations"), "user")


@query("a13_session_summary", "SELECT conv_id, max(turn) AS last_turn, count(*) AS n_messages FROM conversations GROUP BY conv_id ORDER BY last_turn DESC, conv_id LIMIT 50")
def _(g):
    c = g.read("conversations")
    return files.session_summary(c.groupBy("conv_id").agg(F.max("turn").alias("last_turn")), c)


@query("b1_concept_filter", v(f"SELECT {_SHOWN} FROM concept WHERE domain_id ILIKE 'prod%' AND vocabulary_id ILIKE 'brand' AND concept_class_id ILIKE '%item' AND standard_concept = 'S' AND invalid_reason IS NULL"))
def _(g):
    return search.concept_filter(g.concept, "prod%", "brand", "%item", True, True).select(*_SHOWN.split(", "))


@query("b2_lookup_concepts", v(f", {_ASKED} SELECT {_SHOWN} FROM concept WHERE concept_id IN (SELECT concept_id FROM asked)"))
def _(g):
    return search.lookup_concepts(g.concept, asked(g))


@query("b3_missing_ids", v(f", {_ASKED} SELECT DISTINCT concept_id FROM asked WHERE concept_id NOT IN (SELECT concept_id FROM concept)"))
def _(g):
    return search.missing_ids(g.concept, asked(g))


@query("b4_concept_names", v(f", {_ASKED} SELECT a.concept_id, coalesce(c.concept_name, 'Unknown (' || a.concept_id || ')') AS concept_name FROM asked a LEFT JOIN concept c USING (concept_id)"))
def _(g):
    return search.concept_names(g.concept, asked(g))


@query("b5_source_header", v(f", {_ASKED} SELECT a.concept_id, coalesce(c.concept_name, 'Unknown (' || a.concept_id || ')') AS concept_name, coalesce(c.vocabulary_id, '?') AS vocabulary_id FROM asked a LEFT JOIN concept c USING (concept_id)"))
def _(g):
    return search.source_header(g.concept, asked(g))


@query("b6_concept_batch", v(f"SELECT bn AS set_id, {_SHOWN} FROM (SELECT DISTINCT bn, branded FROM parts) JOIN concept ON concept_id = branded"))
def _(g):
    return search.concept_batch(g.concept, seed_sets(g))


def seed_sets(g: Given) -> DataFrame:
    return g.parts.select(F.col("bn").alias("set_id"), F.col("branded").alias("concept_id")).distinct()


_FLAGSHIP = [(1, "ring", "Product"), (2, "red", "Product"), (3, "Brand#1", None)]


@query("b7_search_name", v("""
    , q(query_id, keyword, domain) AS (VALUES (1, 'ring', 'Product'), (2, 'red', 'Product'), (3, 'Brand#1', NULL)),
    hits AS (SELECT CAST(query_id AS BIGINT) AS query_id, concept_id, concept_name, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN concept_name ILIKE keyword THEN 0 ELSE 1 END, length(concept_name), concept_name, concept_id) AS rank
      FROM q JOIN concept ON concept_name ILIKE '%' || keyword || '%' AND (domain IS NULL OR domain_id ILIKE domain) WHERE standard_concept = 'S' AND invalid_reason IS NULL)
    SELECT query_id, rank, concept_id, concept_name FROM hits WHERE rank <= 10"""))
def _(g):
    q = g.spark.createDataFrame(_FLAGSHIP, "query_id long, keyword string, domain string")
    return search.search_concepts(g.concept, q, limit=10, standard_only=True, valid_only=True).select("query_id", "rank", "concept_id", "concept_name")


@query("b7_search_all_words", v(f"""
    , {KEYWORDS_SQL},
    hits AS (SELECT query_id, concept_id, concept_name, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN concept_name ILIKE keyword THEN 0 ELSE 1 END, length(concept_name), concept_name, concept_id) AS rank
      FROM keywords JOIN concept ON concept_name ILIKE '%' || keyword || '%' WHERE invalid_reason IS NULL)
    SELECT query_id, rank, concept_id, concept_name FROM hits WHERE rank <= 25"""))
def _(g):
    return search.search_concepts(g.concept, keywords(g), valid_only=True).select("query_id", "rank", "concept_id", "concept_name")


@query("b8_search_synonyms", v(f"""
    , {KEYWORDS_SQL},
    hits AS (SELECT query_id, keyword, concept_id, concept_name, 0 AS source, concept_name AS t FROM keywords JOIN concept ON concept_name ILIKE '%' || keyword || '%' WHERE standard_concept = 'S' AND invalid_reason IS NULL
      UNION ALL SELECT query_id, keyword, concept_id, concept_name, 1, concept_synonym_name FROM keywords JOIN synonym ON concept_synonym_name ILIKE '%' || keyword || '%' JOIN concept USING (concept_id) WHERE standard_concept = 'S' AND invalid_reason IS NULL),
    once AS (SELECT *, row_number() OVER (PARTITION BY query_id, concept_id ORDER BY source, length(t), t) AS turn FROM hits),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY source, CASE WHEN concept_name ILIKE keyword THEN 0 ELSE 1 END, length(concept_name), concept_name, concept_id) AS rank FROM once WHERE turn = 1)
    SELECT query_id, rank, concept_id, concept_name FROM ranked WHERE rank <= 50"""))
def _(g):
    return search.search_concepts(g.concept, keywords(g), g.synonym, limit=50, standard_only=True, valid_only=True).select("query_id", "rank", "concept_id", "concept_name")


@query("jn1_inner_join", v("SELECT descendant_concept_id, ancestor_concept_id, concept_name FROM closure JOIN concept ON ancestor_concept_id = concept_id"))
def _(g):
    return g.closure.join(g.concept, F.col("ancestor_concept_id") == F.col("concept_id")).select("descendant_concept_id", "ancestor_concept_id", "concept_name")


@query("jn2_left_join_zero_groups", v("SELECT v.vocabulary_id, count(c.concept_id) AS n FROM vocabulary v LEFT JOIN concept c ON c.vocabulary_id = v.vocabulary_id AND c.invalid_reason IS NOT NULL GROUP BY v.vocabulary_id"))
def _(g):
    gone = g.concept.where("invalid_reason is not null").select("vocabulary_id", "concept_id")
    return g.vocabulary.join(gone, "vocabulary_id", "left").groupBy("vocabulary_id").agg(F.count("concept_id").alias("n"))


@query("jn3_semi_join", v("SELECT concept_id, concept_name FROM concept WHERE concept_id IN (SELECT ancestor_concept_id FROM closure WHERE min_levels_of_separation > 0)"))
def _(g):
    up = g.closure.where("min_levels_of_separation > 0").select(F.col("ancestor_concept_id").alias("concept_id"))
    return g.concept.join(up, "concept_id", "left_semi").select("concept_id", "concept_name")


@query("jn4_anti_join", v("SELECT concept_id FROM concept WHERE concept_id NOT IN (SELECT ancestor_concept_id FROM closure WHERE min_levels_of_separation > 0)"))
def _(g):
    up = g.closure.where("min_levels_of_separation > 0").select(F.col("ancestor_concept_id").alias("concept_id"))
    return g.concept.join(up, "concept_id", "left_anti").select("concept_id")


_PAIRS = "pairs AS (SELECT partkey AS pair_id, CASE WHEN partkey % 2 = 0 THEN branded ELSE 100 + nr END AS left_id, CASE WHEN partkey % 2 = 0 THEN 200 + ar ELSE item END AS right_id FROM parts UNION ALL SELECT partkey + 10000000, item, branded + 1 FROM parts UNION ALL SELECT partkey + 20000000, NULL, item FROM parts)"


def pairs(g: Given) -> DataFrame:
    even = F.col("partkey") % 2 == 0
    one = g.parts.select(F.col("partkey").alias("pair_id"), F.when(even, F.col("branded")).otherwise(100 + F.col("nr")).alias("left_id"), F.when(even, 200 + F.col("ar")).otherwise(F.col("item")).alias("right_id"))
    two = g.parts.select(F.col("partkey") + 10000000, "item", F.col("branded") + 1)
    return one.union(two).union(g.parts.select(F.col("partkey") + 20000000, F.lit(None).cast("long"), "item"))


_WITHIN = v(f", {_PAIRS} SELECT pair_id, left_id, right_id, EXISTS (SELECT 1 FROM closure WHERE min_levels_of_separation <= 3 AND (ancestor_concept_id = left_id AND descendant_concept_id = right_id OR ancestor_concept_id = right_id AND descendant_concept_id = left_id)) AS near FROM pairs")


@query("jn5_symmetric_join", _WITHIN)
def _(g):
    return hierarchy.within_levels(g.closure, pairs(g), 3)


@query("jn6_theta_join", v(f", {KEYWORDS_SQL} SELECT query_id, concept_id FROM keywords JOIN concept ON concept_name ILIKE '%' || keyword || '%'"))
def _(g):
    return search._name_hits(g.concept.select("concept_id", F.col("concept_name").alias("text")), keywords(g)).select("query_id", "concept_id")


@query("jn8_positional_join", v("""
    , a AS (SELECT noun, partkey, row_number() OVER (PARTITION BY noun ORDER BY partkey) AS place FROM parts), b AS (SELECT noun, partkey, row_number() OVER (PARTITION BY noun ORDER BY p_type, partkey DESC) AS place FROM parts)
    SELECT a.noun, a.place, a.partkey AS left_key, b.partkey AS right_key FROM a JOIN b ON a.noun = b.noun AND a.place = b.place"""))
def _(g):
    a = top(g.parts.select("noun", F.col("partkey").alias("left_key")), ["noun"], ["left_key"], None, "place")
    b = top(g.parts.select("noun", "p_type", F.col("partkey").alias("right_key")), ["noun"], ["p_type", F.col("right_key").desc()], None, "place")
    return a.join(b, ["noun", "place"]).select("noun", "place", "left_key", "right_key")


@query("c1_ancestors", v(f"""SELECT * FROM (SELECT descendant_concept_id AS source_id, row_number() OVER (PARTITION BY descendant_concept_id ORDER BY min_levels_of_separation, ancestor_concept_id) AS rank, {_CORE_D},
    min_levels_of_separation AS min_separation, max_levels_of_separation AS max_separation FROM closure JOIN concept c ON concept_id = ancestor_concept_id WHERE min_levels_of_separation > 0 AND min_levels_of_separation <= 2) WHERE rank <= 50"""))
def _(g):
    return hierarchy.ancestors(g.concept, g.closure, g.concept.select("concept_id"), 2)


@query("c2_descendants", v(f"""SELECT * FROM (SELECT ancestor_concept_id AS source_id, row_number() OVER (PARTITION BY ancestor_concept_id ORDER BY min_levels_of_separation, concept_name, concept_id) AS rank, {_CORE_D},
    min_levels_of_separation AS min_separation, max_levels_of_separation AS max_separation FROM closure JOIN concept c ON concept_id = descendant_concept_id WHERE min_levels_of_separation > 0) WHERE rank <= 50"""))
def _(g):
    return hierarchy.descendants(g.concept, g.closure, g.concept.select("concept_id"))


@query("c3_ancestry_check", v(f", {_PAIRS} SELECT pair_id, left_id AS ancestor, right_id AS descendant, (SELECT min(min_levels_of_separation) FROM closure WHERE ancestor_concept_id = left_id AND descendant_concept_id = right_id AND min_levels_of_separation > 0) AS separation FROM pairs"))
def _(g):
    return hierarchy.ancestry_check(g.closure, pairs(g).select("pair_id", F.col("left_id").alias("ancestor"), F.col("right_id").alias("descendant")))


@query("c1_build_closure", v("SELECT * FROM closure"))
def _(g):
    return hierarchy.build_closure(g.is_a, g.concept.where("standard_concept is not null").select("concept_id"))


@query("c4_direct_parents", v("SELECT descendant_concept_id AS child, concept_id AS parent, concept_name AS parent_name FROM closure JOIN concept ON concept_id = ancestor_concept_id WHERE min_levels_of_separation = 1 AND invalid_reason IS NULL"))
def _(g):
    return hierarchy.direct_parents(g.concept, g.closure, g.concept.select("concept_id"))


_BELOW = "below AS (SELECT ancestor_concept_id AS parent, count(DISTINCT descendant_concept_id) AS n_descendants FROM closure JOIN concept ON concept_id = descendant_concept_id WHERE min_levels_of_separation > 0 AND standard_concept = 'S' AND invalid_reason IS NULL GROUP BY 1)"


@query("c5_descendant_count", v(f", {_BELOW} SELECT concept_id AS parent, coalesce(n_descendants, 0) AS n_descendants FROM concept LEFT JOIN below ON parent = concept_id"))
def _(g):
    return hierarchy.standard_descendant_count(g.concept, g.closure, g.concept.select("concept_id"))


@query("c6_within_levels", _WITHIN)
def _(g):
    return hierarchy.within_levels(g.closure, pairs(g))


_RELATED = """SELECT * FROM (SELECT concept_id_1 AS source_id, relationship_id, concept_id AS related_concept_id, concept_name AS {name}, domain_id, vocabulary_id, concept_class_id, concept_code, standard_concept,
    row_number() OVER (PARTITION BY concept_id_1 ORDER BY relationship_id, concept_name, concept_id) AS rank FROM edges JOIN concept ON concept_id = concept_id_2 WHERE edges.invalid_reason IS NULL {more}) WHERE rank <= 50"""


@query("d1_relationships", v(_RELATED.format(name="related_concept_name", more="")))
def _(g):
    return mapping.relationships(g.concept, g.edges, g.concept.select("concept_id"))


@query("d1_relationships_filtered", v(_RELATED.format(name="related_concept_name", more="AND relationship_id ILIKE 'has%'")))
def _(g):
    return mapping.relationships(g.concept, g.edges, g.concept.select("concept_id"), "has%")


@query("d2_trace_mapping", v("""
    , step AS (SELECT a AS at, min(b) AS nxt FROM maps WHERE a <> b GROUP BY a),
    s0 AS (SELECT concept_id, concept_id AS at, standard_concept AS s FROM concept),
    h1 AS (SELECT s0.*, n1.nxt AS at1, c1.standard_concept AS s1 FROM s0 LEFT JOIN step n1 ON s0.at = n1.at LEFT JOIN concept c1 ON c1.concept_id = n1.nxt),
    h2 AS (SELECT h1.*, n2.nxt AS at2, c2.standard_concept AS s2 FROM h1 LEFT JOIN step n2 ON h1.at1 = n2.at LEFT JOIN concept c2 ON c2.concept_id = n2.nxt),
    h3 AS (SELECT h2.*, n3.nxt AS at3, c3.standard_concept AS s3 FROM h2 LEFT JOIN step n3 ON h2.at2 = n3.at LEFT JOIN concept c3 ON c3.concept_id = n3.nxt)
    SELECT concept_id, CASE WHEN s = 'S' THEN concept_id WHEN s1 = 'S' THEN at1 WHEN s2 = 'S' THEN at2 WHEN s3 = 'S' THEN at3 END AS target_id,
      CAST(CASE WHEN s = 'S' OR at1 IS NULL THEN 0 WHEN s1 = 'S' OR at2 IS NULL THEN 1 WHEN s2 = 'S' OR at3 IS NULL THEN 2 ELSE 3 END AS BIGINT) AS hops,
      concat_ws('>', concept_id, CASE WHEN s = 'S' THEN NULL ELSE at1 END, CASE WHEN s = 'S' OR s1 = 'S' THEN NULL ELSE at2 END, CASE WHEN s = 'S' OR s1 = 'S' OR s2 = 'S' THEN NULL ELSE at3 END) AS chain,
      CASE WHEN s = 'S' OR s1 = 'S' OR s2 = 'S' OR s3 = 'S' THEN NULL WHEN at1 IS NULL OR at2 IS NULL OR at3 IS NULL THEN 'no mapping' ELSE 'too many hops' END AS error FROM h3"""))
def _(g):
    traced = mapping.trace_standard_mapping(g.concept, g.edges, g.concept.select("concept_id"))
    return traced.withColumn("chain", F.array_join(F.transform("chain", lambda x: x.cast("string")), ">"))


_KINDS = """kinds AS (SELECT r.relationship_id, CASE WHEN r.defines_ancestry = '1' THEN 'ontological' WHEN lower(r.relationship_name) LIKE '%maps to%' OR lower(r.relationship_name) LIKE '%mapped from%' OR lower(r.relationship_name) LIKE '%equivalent%' THEN 'mapping'
    WHEN lower(r.relationship_name) LIKE '%replaced%' OR lower(r.relationship_name) LIKE '%replaces%' THEN 'versioning' WHEN lower(r.relationship_name) LIKE 'has %' OR lower(b.relationship_name) LIKE 'has %' THEN 'attribute' ELSE 'metadata' END AS kind
    FROM relationship r LEFT JOIN relationship b ON b.relationship_id = r.reverse_relationship_id)"""


@query("d3_classify_predicates", v(f", {_KINDS} SELECT kind, relationship_id, count(*) AS n_edges FROM kinds JOIN edges USING (relationship_id) GROUP BY ALL"))
def _(g):
    return mapping.classify_predicates(g.relationship).join(g.edges, "relationship_id").groupBy("kind", "relationship_id").agg(F.count("*").alias("n_edges"))


@query("d4_kind_edges", v(f", {_KINDS} SELECT concept_id_1, relationship_id, concept_id_2 FROM edges WHERE relationship_id IN (SELECT relationship_id FROM kinds WHERE kind IN ('mapping', 'versioning'))"))
def _(g):
    wanted = mapping.relationship_ids_for_kinds(g.relationship, ["mapping", "versioning", "no such kind"])
    return g.edges.join(wanted, "relationship_id", "left_semi").select("concept_id_1", "relationship_id", "concept_id_2")


for _name, _own, _other in (("outgoing", "concept_id_1", "concept_id_2"), ("incoming", "concept_id_2", "concept_id_1")):

    @query(f"d5_{_name}_edges", v(f"SELECT concept_id_1, relationship_id, concept_id_2 FROM (SELECT *, row_number() OVER (PARTITION BY {_own} ORDER BY relationship_id, {_other}) AS n FROM edges WHERE invalid_reason IS NULL) WHERE n <= 200"))
    def _(g, incoming=_name == "incoming"):
        return mapping.outgoing_edges(g.edges, g.concept.select("concept_id"), incoming=incoming)


@query("d6_standardise", v("SELECT DISTINCT coalesce(b, concept_id) AS concept_id FROM concept LEFT JOIN maps ON a = concept_id"))
def _(g):
    return mapping.standardise(g.edges, g.concept)


@query("d7_one_hop", v("SELECT a AS concept_id, t AS target_id, concept_name AS target_name, vocabulary_id AS target_vocabulary, standard_concept AS target_standard FROM (SELECT a, min(b) AS t FROM maps WHERE a <> b GROUP BY a) JOIN concept ON concept_id = t"))
def _(g):
    return mapping.one_hop_maps_to(g.concept, g.edges, g.concept)


@query("d8_as_concepts", v(_RELATED.format(name="concept_name", more="").replace("related_concept_id", "concept_id")))
def _(g):
    return mapping.relationships_as_concepts(mapping.relationships(g.concept, g.edges, g.concept.select("concept_id")))


@query("ag1_domain_counts", v("SELECT d.domain_id, count(c.concept_id) AS n FROM domain d LEFT JOIN concept c ON c.domain_id = d.domain_id AND standard_concept = 'S' AND invalid_reason IS NULL GROUP BY 1"))
def _(g):
    fine = g.concept.where("standard_concept = 'S' and invalid_reason is null").select("domain_id", "concept_id")
    return g.domain.join(fine, "domain_id", "left").groupBy("domain_id").agg(F.count("concept_id").alias("n"))


@query("ag2_vocabulary_counts", v("SELECT d.vocabulary_id, vocabulary_version, count(c.concept_id) AS n FROM vocabulary d LEFT JOIN concept c ON c.vocabulary_id = d.vocabulary_id AND standard_concept = 'S' AND invalid_reason IS NULL GROUP BY ALL"))
def _(g):
    fine = g.concept.where("standard_concept = 'S' and invalid_reason is null").select("vocabulary_id", "concept_id")
    return g.vocabulary.join(fine, "vocabulary_id", "left").groupBy("vocabulary_id", "vocabulary_version").agg(F.count("concept_id").alias("n"))


@query("w1_row_number_dedup", v("SELECT concept_id, concept_synonym_name FROM (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY length(concept_synonym_name), concept_synonym_name) AS n FROM synonym) WHERE n = 1"))
def _(g):
    return top(g.synonym, ["concept_id"], [F.length("concept_synonym_name"), "concept_synonym_name"], 1, "n").select("concept_id", "concept_synonym_name")


@query("w2_position_in_key", v("SELECT partkey, row_number() OVER (PARTITION BY item ORDER BY partkey) - 1 AS position FROM parts"))
def _(g):
    return top(g.parts.select("item", "partkey"), ["item"], ["partkey"], None, "n").select("partkey", (F.col("n") - 1).alias("position"))


@query("w4_previous_row", "SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations")
def _(g):
    return g.read("conversations").select("conv_id", "turn", "role", F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn")).alias("before"))


@query("w5_case_rank_limit", v("SELECT concept_class_id, concept_id FROM (SELECT *, row_number() OVER (PARTITION BY concept_class_id ORDER BY CASE WHEN concept_name ILIKE '%ring%' THEN 0 ELSE 1 END, length(concept_name), concept_id) AS n FROM concept) WHERE n <= 10"))
def _(g):
    return top(g.concept, ["concept_class_id"], [F.when(F.col("concept_name").ilike("%ring%"), 0).otherwise(1), F.length("concept_name"), "concept_id"], 10, "n").select("concept_class_id", "concept_id")


@query("w6_edge_cap", v("SELECT concept_id_1, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY concept_id_1 ORDER BY relationship_id, concept_id_2) AS n FROM edges) WHERE n <= 200 GROUP BY 1"))
def _(g):
    return mapping.outgoing_edges(g.edges, g.concept).groupBy("concept_id_1").agg(F.count("*").alias("n"))


@query("w7_order_limit", v("SELECT concept_id, concept_name FROM concept ORDER BY length(concept_name) DESC, concept_id LIMIT 100"))
def _(g):
    return g.concept.orderBy(F.length("concept_name").desc(), "concept_id").limit(100).select("concept_id", "concept_name")


@query("so1_union_all", v("SELECT concept_id, concept_name AS name FROM concept UNION ALL SELECT concept_id, concept_synonym_name FROM synonym"))
def _(g):
    return g.concept.select("concept_id", F.col("concept_name").alias("name")).unionByName(g.synonym.select("concept_id", F.col("concept_synonym_name").alias("name")))


@query("so2_union_distinct", v("SELECT branded AS concept_id FROM parts UNION SELECT descendant_concept_id FROM closure"))
def _(g):
    return g.parts.select(F.col("branded").alias("concept_id")).union(g.closure.select("descendant_concept_id")).distinct()


@query("so3_distinct_ids", v("SELECT DISTINCT concept_id_2 AS concept_id FROM edges"))
def _(g):
    return g.edges.select(F.col("concept_id_2").alias("concept_id")).distinct()


@query("so4_intersect_except", v(f", {_ASKED} SELECT 'both' AS side, concept_id FROM (SELECT concept_id FROM asked INTERSECT SELECT item FROM parts) UNION ALL SELECT 'only', concept_id FROM (SELECT concept_id FROM asked EXCEPT SELECT item FROM parts)"))
def _(g):
    items = g.parts.select(F.col("item").alias("concept_id"))
    return asked(g).intersect(items).select(F.lit("both").alias("side"), "concept_id").union(asked(g).subtract(items).select(F.lit("only"), "concept_id"))


@query("so5_first_by_key", v("SELECT item, partkey FROM (SELECT item, partkey, row_number() OVER (PARTITION BY item ORDER BY partkey) AS n FROM parts) WHERE n = 1"))
def _(g):
    return top(g.parts.select("item", "partkey"), ["item"], ["partkey"], 1, "n").select("item", "partkey")


@query("sc1_ilike", v("SELECT concept_id, concept_name ILIKE '%RING%' AS holds, concept_name ILIKE 'Red Ring' AS same FROM concept"))
def _(g):
    n = F.col("concept_name")
    return g.concept.select("concept_id", n.ilike("%RING%").alias("holds"), n.ilike("Red Ring").alias("same"))


@query("sc2_text_basics", "SELECT p_partkey, CAST(length(p_name) AS BIGINT) AS n, upper(trim(p_name)) AS u, lower(p_brand) AS l, array_to_string(string_split(p_name, ' '), '|') AS words FROM part")
def _(g):
    return g.read("part").select("p_partkey", F.length("p_name").cast("long").alias("n"), F.upper(F.trim("p_name")).alias("u"), F.lower("p_brand").alias("l"), F.array_join(F.split("p_name", r"\s+"), "|").alias("words"))


@query("sc3_normal_name", v("SELECT concept_id, lower(trim(coalesce(invalid_reason, ''))) AS reason, lower(trim(concept_name)) AS name FROM concept"))
def _(g):
    return g.concept.select("concept_id", tx.normal_name(F.col("invalid_reason")).alias("reason"), tx.normal_name(F.col("concept_name")).alias("name"))


@query("sc4_preview", "SELECT doc_id, replace(substring(coalesce(text, ''), 1, 500), chr(10), '\\n') AS preview FROM documents")
def _(g):
    return g.read("documents").select("doc_id", tx.preview(F.col("text")).alias("preview"))


@query("sc5_pipe_join", "SELECT conv_id, string_agg(role, '|' ORDER BY turn) AS roles, CAST(count(*) AS BIGINT) AS n FROM conversations GROUP BY conv_id")
def _(g):
    joined = g.read("conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), "|").alias("roles"))
    return joined.withColumn("n", F.size(F.split("roles", r"\|")).cast("long"))


@query("sc6_leading_code", "SELECT p_partkey, regexp_extract(upper(p_type) || p_size, '^([A-Z]+[0-9]+)', 1) AS code FROM part")
def _(g):
    return g.read("part").select("p_partkey", catalogue.leading_code(F.concat(F.upper("p_type"), F.col("p_size").cast("string"))).alias("code"))


@query("sc13_rounding", "SELECT l_orderkey, l_linenumber, round(sum(l_discount) / 3, 3) AS d3, round(sum(l_tax) * 7, 2) AS d2 FROM lineitem GROUP BY ALL")
def _(g):
    return g.read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.round(F.sum("l_discount") / 3, 3).alias("d3"), F.round(F.sum("l_tax") * 7, 2).alias("d2"))


@query("sc17_text_keys", "SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON CAST(o.o_custkey AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)")
def _(g):
    o, c = g.read("orders"), g.read("customer")
    return o.join(c, o.o_custkey.cast("string") == c.c_custkey.cast("string")).select("o_orderkey", "c_name")
