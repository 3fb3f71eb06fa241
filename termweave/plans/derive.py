"""Vocabulary and clinical tables derived from the given tables, in Spark and as DuckDB CTEs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators._rank import dealt
from ..sources.scratch import written

CONCEPT = ["concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id", "standard_concept", "concept_code", "invalid_reason"]

#: Relationship id, name, reverse id, defines_ancestry.
RELATIONSHIPS = [
    ("Is a", "Is a", "Subsumes", "1"),
    ("Subsumes", "Subsumes", "Is a", "1"),
    ("Maps to", "Non-standard to standard map (maps to)", "Mapped from", "0"),
    ("Mapped from", "Standard to non-standard map (mapped from)", "Maps to", "0"),
    ("Has brand", "Has brand", "Brand of", "0"),
    ("Brand of", "Brand of", "Has brand", "0"),
    ("Concept replaced by", "Concept replaced by", "Concept replaces", "0"),
    ("Concept replaces", "Concept replaces", "Concept replaced by", "0"),
    ("Related to", "Related to", "Related to", "0"),
]


#: Derived tables of this process's sessions, each written once to the shared folder: queries of one session share a vocabulary.
_TABLES: dict[tuple[str, str, str], DataFrame] = {}


class Given:
    """The given tables of one folder and what is derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _cached(name):  # noqa: N805
        def get(self) -> DataFrame:
            key = (self.spark.sparkContext.applicationId, self.dir, name)
            if key not in _TABLES:
                _TABLES[key] = written(getattr(self, f"_{name}")())
            return _TABLES[key]

        return property(get)

    parts, concept, is_a, closure, edges, relationship, synonym, domain, vocabulary = map(_cached, ("parts", "concept", "is_a", "closure", "edges", "relationship", "synonym", "domain", "vocabulary"))

    person, drug_exposure, condition, visit, measurement, cost, observation_period = (property(lambda self, n=n: getattr(self, f"_{n}")()) for n in ("person", "drug_exposure", "condition", "visit", "measurement", "cost", "observation_period"))

    def _parts(self) -> DataFrame:
        p = self.read("part").select(
            F.col("p_partkey").cast("long").alias("partkey"), "p_name", "p_brand", "p_type", "p_size", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("adj"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("noun"), F.expr("cast(substr(p_brand, 7) as bigint)").alias("bn")
        )
        for word, rank in (("adj", "ar"), ("noun", "nr")):  # the words are few; only they are ranked in one place
            p = p.join(p.select(word).distinct().withColumn(rank, F.dense_rank().over(Window.orderBy(word)).cast("long")), word)
        return p.withColumns({"item": 10000 + 100 * F.col("ar") + F.col("nr"), "branded": 1000000 + 10000 * F.col("ar") + 100 * F.col("nr") + F.col("bn"), "srcid": 10000000 + F.col("partkey")})

    def _concept(self) -> DataFrame:
        p, text = self.parts, F.concat_ws

        def rows(df, key, name, domain, vocabulary, kind, standard, code, invalid=None):
            lit = lambda x: F.lit(x).cast("string")
            return df.select(F.col(key).cast("long").alias("concept_id"), name.alias("concept_name"), lit(domain).alias("domain_id"), lit(vocabulary).alias("vocabulary_id"), lit(kind).alias("concept_class_id"), lit(standard).alias("standard_concept"), code.alias("concept_code"), (lit(None) if invalid is None else invalid).alias("invalid_reason"))

        one = lambda key, *c: p.select(key, *c).distinct()
        noun, adj, brand = one((100 + F.col("nr")).alias("id"), "noun"), one((200 + F.col("ar")).alias("id"), "adj"), one((500 + F.col("bn")).alias("id"), "p_brand")
        invalid = F.when(F.col("partkey") % 17 == 0, F.lit("D")).when(F.col("partkey") % 19 == 0, F.lit("U"))
        root = self.spark.range(1, 2)
        return reduce(DataFrame.unionByName, [
            rows(root, "id", F.lit("product"), "Product", "CAT", "Root", "C", F.lit("ROOT")),
            rows(noun, "id", F.col("noun"), "Product", "CAT", "Noun", "S", F.col("noun")),
            rows(adj, "id", F.col("adj"), "Product", "CAT", "Adjective", "S", F.col("adj")),
            rows(one("item", "p_name"), "item", F.col("p_name"), "Product", "CAT", "Item", "S", F.col("p_name")),
            rows(one("branded", "p_name", "p_brand"), "branded", text(" ", "p_name", "p_brand"), "Product", "BRAND", "Branded Item", "S", text("/", "p_name", "p_brand")),
            rows(brand, "id", F.col("p_brand"), "Brand", "BRAND", "Brand", "S", F.col("p_brand")),
            rows(p, "srcid", text(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string")), "Product", "SRC", "Source Item", None, F.concat(F.lit("P"), F.col("partkey").cast("string")), invalid),
        ])

    def _is_a(self) -> DataFrame:
        p = self.parts
        edge = lambda a, b: p.select(a.alias("child"), b.cast("long").alias("parent"))
        noun, adj = 100 + F.col("nr"), 200 + F.col("ar")
        return reduce(DataFrame.union, [edge(F.col("item"), noun), edge(F.col("item"), adj), edge(noun, F.lit(1)), edge(adj, F.lit(1)), edge(F.col("branded"), F.col("item")), edge(F.col("branded"), adj)]).distinct()

    def _closure(self) -> DataFrame:
        one = self.is_a.select(F.col("parent").alias("ancestor_concept_id"), F.col("child").alias("descendant_concept_id"), F.lit(1).cast("long").alias("levels"))
        step = lambda df: df.join(self.is_a, F.col("descendant_concept_id") == F.col("parent")).select("ancestor_concept_id", F.col("child").alias("descendant_concept_id"), (F.col("levels") + 1).alias("levels"))
        two = step(one)
        own = self.concept.where("standard_concept is not null").select(F.col("concept_id").alias("ancestor_concept_id"), F.col("concept_id").alias("descendant_concept_id"), F.lit(0).cast("long").alias("levels"))
        return one.union(two).union(step(two)).union(own).groupBy("ancestor_concept_id", "descendant_concept_id").agg(F.min("levels").alias("min_levels_of_separation"), F.max("levels").alias("max_levels_of_separation"))

    def _edges(self) -> DataFrame:
        p = self.parts
        e = lambda df, a, b, name: df.select(a.cast("long").alias("concept_id_1"), b.cast("long").alias("concept_id_2"), F.lit(name).alias("relationship_id"), F.lit(None).cast("string").alias("invalid_reason"))
        c, keys = F.col, p.select(F.col("partkey").alias("k"))
        known = p.join(keys, c("partkey") + 1 == c("k"), "left")
        mapped = known.where((c("partkey") % 13 != 0) & ((c("partkey") % 10 != 0) | c("k").isNotNull())).select("srcid", F.when(c("partkey") % 10 == 0, c("srcid") + 1).otherwise(c("branded")).alias("to"))
        brand = p.select("branded", (500 + c("bn")).alias("brand")).distinct()
        replaced = known.where((c("partkey") % 17 != 0) & (c("partkey") % 19 == 0) & c("k").isNotNull()).select("srcid", (c("srcid") + 1).alias("to"))
        nouns = p.select("nr").distinct()
        related = nouns.join(nouns.select((c("nr") - 1).alias("before")), c("nr") == c("before")).select((100 + c("nr")).alias("a"), (101 + c("nr")).alias("b"))
        pairs = [(self.is_a, "child", "parent", "Is a", "Subsumes"), (mapped, "srcid", "to", "Maps to", "Mapped from"), (brand, "branded", "brand", "Has brand", "Brand of"), (replaced, "srcid", "to", "Concept replaced by", "Concept replaces")]
        both = [x for df, a, b, name, back in pairs for x in (e(df, c(a), c(b), name), e(df, c(b), c(a), back))]
        return reduce(DataFrame.union, [*both, e(related, c("a"), c("b"), "Related to")])

    def _relationship(self) -> DataFrame:
        return self.spark.createDataFrame([(i, n, r, "1" if d == "1" else "0", d) for i, n, r, d in RELATIONSHIPS], "relationship_id string, relationship_name string, reverse_relationship_id string, is_hierarchical string, defines_ancestry string")

    def _synonym(self) -> DataFrame:
        items = self.parts.select("item", "noun", "adj").distinct()
        name = F.col("item").alias("concept_id")
        return items.select(name, F.concat_ws(", ", "noun", "adj").alias("concept_synonym_name")).union(items.where("adj = 'old'").select(name, F.concat(F.lit("old-style "), "noun")))

    def _domain(self) -> DataFrame:
        return self.spark.createDataFrame([(d, d) for d in ("Product", "Brand", "Empty")], "domain_id string, domain_name string")

    def _vocabulary(self) -> DataFrame:
        return self.spark.createDataFrame([(v, v, "v1") for v in ("CAT", "BRAND", "SRC", "NONE")], "vocabulary_id string, vocabulary_name string, vocabulary_version string")

    def nouns(self):
        """Number of nouns, as a one-row frame to be joined."""
        return self.parts.agg(F.max("nr").alias("n_nouns"))

    def _person(self) -> DataFrame:
        k = F.col("c_custkey").cast("long")
        return self.read("customer").select(k.alias("person_id"), (8507 + 25 * (k % 2)).alias("gender_concept_id"), (1930 + k % 80).alias("year_of_birth"), F.col("c_name").alias("person_source_value"), F.lit(0).cast("long").alias("gender_source_concept_id"))

    @property
    def n_exposures(self) -> int:
        """Rows of drug_exposure at most, by the files' own counts."""
        return self.read("lineitem").count()

    def _drug_exposure(self) -> DataFrame:
        o = self.read("orders").select("o_orderkey", F.col("o_custkey").cast("long").alias("person_id"), F.col("o_orderdate").cast("date").alias("start"))
        n = self.n_exposures
        rows = dealt(self.read("lineitem"), n, "l_orderkey").join(dealt(o, n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(F.broadcast(self.nouns()))
        return rows.select("person_id", (101 + F.col("l_partkey").cast("long") % F.col("n_nouns")).alias("drug_concept_id"), "start", F.greatest(F.col("l_shipdate").cast("date"), "start").alias("end"), F.col("l_quantity").cast("double").alias("quantity"), F.col("l_orderkey").cast("long").alias("visit_id"))

    def _condition(self) -> DataFrame:
        day = F.col("ts").cast("date")
        return self.read("events").select(F.col("user_id").cast("long").alias("person_id"), F.concat(F.lit("event "), "event_type").alias("condition_name"), (101 + F.length("event_type").cast("long") % 8).alias("condition_concept_id"), day.alias("start"), day.alias("end"))

    def _visit(self) -> DataFrame:
        return self.read("orders").select(F.col("o_orderkey").cast("long").alias("visit_id"), F.col("o_custkey").cast("long").alias("person_id"), F.when(F.col("o_orderstatus") == "F", 9201).otherwise(9202).cast("long").alias("visit_concept_id"), F.col("o_orderdate").cast("date").alias("start"))

    def _measurement(self) -> DataFrame:
        return self.read("events").select(F.col("user_id").cast("long").alias("person_id"), (101 + F.length("event_type").cast("long") % 8).alias("measurement_concept_id"), F.col("value").cast("double").alias("value"), F.col("ts").cast("date").alias("day"))

    def _cost(self) -> DataFrame:
        return self.read("lineitem").groupBy(F.col("l_orderkey").cast("long").alias("cost_event_id")).agg(F.sum(F.col("l_extendedprice").cast("double")).alias("total_paid")).withColumn("cost_domain_id", F.lit("Visit"))

    def _observation_period(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        return self.read("orders").groupBy(F.col("o_custkey").cast("long").alias("person_id")).agg(F.min(day).alias("period_start"), F.max(day).alias("period_end"))


_VALUES = ", ".join(f"('{i}', '{n}', '{r}', '{d}', '{d}')" for i, n, r, d in RELATIONSHIPS)

#: The same tables as DuckDB CTEs.
VOCABULARY_SQL = f"""
p0 AS (SELECT CAST(p_partkey AS BIGINT) AS partkey, p_name, p_brand, p_type, p_size, split_part(p_name, ' ', 1) AS adj, split_part(p_name, ' ', 2) AS noun, CAST(substr(p_brand, 7) AS BIGINT) AS bn FROM part),
p1 AS (SELECT *, dense_rank() OVER (ORDER BY adj) AS ar, dense_rank() OVER (ORDER BY noun) AS nr FROM p0),
parts AS (SELECT *, 10000 + 100 * ar + nr AS item, 1000000 + 10000 * ar + 100 * nr + bn AS branded, 10000000 + partkey AS srcid FROM p1),
concept AS (
  SELECT CAST(1 AS BIGINT) AS concept_id, 'product' AS concept_name, 'Product' AS domain_id, 'CAT' AS vocabulary_id, 'Root' AS concept_class_id, 'C' AS standard_concept, 'ROOT' AS concept_code, CAST(NULL AS VARCHAR) AS invalid_reason
  UNION ALL SELECT DISTINCT 100 + nr, noun, 'Product', 'CAT', 'Noun', 'S', noun, NULL FROM parts
  UNION ALL SELECT DISTINCT 200 + ar, adj, 'Product', 'CAT', 'Adjective', 'S', adj, NULL FROM parts
  UNION ALL SELECT DISTINCT item, p_name, 'Product', 'CAT', 'Item', 'S', p_name, NULL FROM parts
  UNION ALL SELECT DISTINCT branded, p_name || ' ' || p_brand, 'Product', 'BRAND', 'Branded Item', 'S', p_name || '/' || p_brand, NULL FROM parts
  UNION ALL SELECT DISTINCT 500 + bn, p_brand, 'Brand', 'BRAND', 'Brand', 'S', p_brand, NULL FROM parts
  UNION ALL SELECT srcid, p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_size, 'Product', 'SRC', 'Source Item', NULL, 'P' || partkey,
    CASE WHEN partkey % 17 = 0 THEN 'D' WHEN partkey % 19 = 0 THEN 'U' END FROM parts),
is_a AS (
  SELECT DISTINCT item AS child, 100 + nr AS parent FROM parts UNION SELECT item, 200 + ar FROM parts UNION SELECT 100 + nr, 1 FROM parts UNION SELECT 200 + ar, 1 FROM parts
  UNION SELECT branded, item FROM parts UNION SELECT branded, 200 + ar FROM parts),
steps AS (
  SELECT parent AS a, child AS d, 1 AS lv FROM is_a
  UNION ALL SELECT x.parent, y.child, 2 FROM is_a x JOIN is_a y ON x.child = y.parent
  UNION ALL SELECT x.parent, z.child, 3 FROM is_a x JOIN is_a y ON x.child = y.parent JOIN is_a z ON y.child = z.parent
  UNION ALL SELECT concept_id, concept_id, 0 FROM concept WHERE standard_concept IS NOT NULL),
closure AS (SELECT a AS ancestor_concept_id, d AS descendant_concept_id, CAST(min(lv) AS BIGINT) AS min_levels_of_separation, CAST(max(lv) AS BIGINT) AS max_levels_of_separation FROM steps GROUP BY a, d),
maps AS (SELECT srcid AS a, CASE WHEN partkey % 10 = 0 THEN srcid + 1 ELSE branded END AS b FROM parts WHERE partkey % 13 <> 0 AND (partkey % 10 <> 0 OR partkey + 1 IN (SELECT partkey FROM parts))),
replaced AS (SELECT srcid AS a, srcid + 1 AS b FROM parts WHERE partkey % 17 <> 0 AND partkey % 19 = 0 AND partkey + 1 IN (SELECT partkey FROM parts)),
edges AS (
  SELECT a AS concept_id_1, b AS concept_id_2, r AS relationship_id, CAST(NULL AS VARCHAR) AS invalid_reason FROM (
    SELECT child AS a, parent AS b, 'Is a' AS r FROM is_a UNION ALL SELECT parent, child, 'Subsumes' FROM is_a
    UNION ALL SELECT a, b, 'Maps to' FROM maps UNION ALL SELECT b, a, 'Mapped from' FROM maps
    UNION ALL SELECT DISTINCT branded, 500 + bn, 'Has brand' FROM parts UNION ALL SELECT DISTINCT 500 + bn, branded, 'Brand of' FROM parts
    UNION ALL SELECT a, b, 'Concept replaced by' FROM replaced UNION ALL SELECT b, a, 'Concept replaces' FROM replaced
    UNION ALL SELECT DISTINCT 100 + nr, 101 + nr, 'Related to' FROM parts WHERE nr < (SELECT max(nr) FROM parts))),
relationship(relationship_id, relationship_name, reverse_relationship_id, is_hierarchical, defines_ancestry) AS (VALUES {_VALUES}),
synonym AS (SELECT DISTINCT item AS concept_id, noun || ', ' || adj AS concept_synonym_name FROM parts UNION ALL SELECT DISTINCT item, 'old-style ' || noun FROM parts WHERE adj = 'old'),
domain(domain_id, domain_name) AS (VALUES ('Product', 'Product'), ('Brand', 'Brand'), ('Empty', 'Empty')),
vocabulary(vocabulary_id, vocabulary_name, vocabulary_version) AS (VALUES ('CAT', 'CAT', 'v1'), ('BRAND', 'BRAND', 'v1'), ('SRC', 'SRC', 'v1'), ('NONE', 'NONE', 'v1'))"""

CLINICAL_SQL = """
person AS (SELECT CAST(c_custkey AS BIGINT) AS person_id, CAST(8507 + 25 * (c_custkey % 2) AS BIGINT) AS gender_concept_id, CAST(1930 + c_custkey % 80 AS BIGINT) AS year_of_birth, c_name AS person_source_value, CAST(0 AS BIGINT) AS gender_source_concept_id FROM customer),
drug_exposure AS (SELECT CAST(o_custkey AS BIGINT) AS person_id, CAST(101 + l_partkey % (SELECT count(DISTINCT split_part(p_name, ' ', 2)) FROM part) AS BIGINT) AS drug_concept_id, CAST(o_orderdate AS DATE) AS "start", greatest(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS "end", CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_orderkey AS BIGINT) AS visit_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
condition_occurrence AS (SELECT CAST(user_id AS BIGINT) AS person_id, 'event ' || event_type AS condition_name, CAST(101 + length(event_type) % 8 AS BIGINT) AS condition_concept_id, CAST(ts AS DATE) AS "start", CAST(ts AS DATE) AS "end" FROM events),
visit AS (SELECT CAST(o_orderkey AS BIGINT) AS visit_id, CAST(o_custkey AS BIGINT) AS person_id, CAST(CASE WHEN o_orderstatus = 'F' THEN 9201 ELSE 9202 END AS BIGINT) AS visit_concept_id, CAST(o_orderdate AS DATE) AS "start" FROM orders),
measurement AS (SELECT CAST(user_id AS BIGINT) AS person_id, CAST(101 + length(event_type) % 8 AS BIGINT) AS measurement_concept_id, CAST(value AS DOUBLE) AS value, CAST(ts AS DATE) AS "day" FROM events),
cost AS (SELECT CAST(l_orderkey AS BIGINT) AS cost_event_id, sum(CAST(l_extendedprice AS DOUBLE)) AS total_paid, 'Visit' AS cost_domain_id FROM lineitem GROUP BY 1),
observation_period AS (SELECT CAST(o_custkey AS BIGINT) AS person_id, min(CAST(o_orderdate AS DATE)) AS period_start, max(CAST(o_orderdate AS DATE)) AS period_end FROM orders GROUP BY 1)"""


def with_vocabulary(query: str) -> str:
    return f"WITH RECURSIVE {VOCABULARY_SQL} {query}" if query.lstrip().startswith(",") else f"WITH RECURSIVE {VOCABULARY_SQL}\n{query}"


def with_clinical(query: str) -> str:
    return with_vocabulary(f", {CLINICAL_SQL}{query}")
