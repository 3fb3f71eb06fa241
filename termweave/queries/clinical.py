"""Clinical analytics (K), ranges and dates (SC8-SC10, W3, JN7), catalogue search (J), governance (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ranges
from ..operators import catalogue, clinical, governance, intervals
from ..operators._rank import dealt
from ..plans.derive import with_clinical as k
from ..sources.scratch import written
from . import query
from .vocabulary import KEYWORDS_SQL, keywords

_ADJ = "SELECT DISTINCT 200 + ar AS concept_id FROM parts"


def nouns(g):
    return g.concept.where("concept_class_id = 'Root'").select("concept_id")


@query("k1_patients_with", k(" SELECT DISTINCT person_id FROM drug_exposure WHERE drug_concept_id IN (SELECT descendant_concept_id FROM closure WHERE ancestor_concept_id = 102)"))
def _(g):
    wanted = g.concept.where("concept_id = 102").select("concept_id")
    return clinical.patients_with(g.drug_exposure, g.closure, wanted, "drug_concept_id")


@query("k2_birth_years", k(" SELECT year_of_birth, count(*) AS n FROM person GROUP BY 1"))
def _(g):
    return clinical.patients_by_birth_year(g.person)


@query("k3_measurement_by_gender", k(" SELECT measurement_concept_id, gender_concept_id, round(avg(value), 6) AS avg_value, count(*) AS n FROM measurement JOIN person USING (person_id) GROUP BY ALL"))
def _(g):
    return clinical.avg_measurement_by_gender(g.person, g.measurement)


@query("k4_patient_conditions", k(' SELECT person_id, year_of_birth, condition_name, condition_concept_id, "start" FROM condition_occurrence JOIN person USING (person_id)'))
def _(g):
    return clinical.with_person(g.person, g.condition).select("person_id", "year_of_birth", "condition_name", "condition_concept_id", "start")


@query("k4_patient_medications", k(' SELECT person_id, gender_concept_id, drug_concept_id, "start", "end", quantity FROM drug_exposure JOIN person USING (person_id)'))
def _(g):
    return clinical.with_person(g.person, g.drug_exposure).select("person_id", "gender_concept_id", "drug_concept_id", "start", "end", "quantity")


@query("k5_inpatient_visits", k(' SELECT visit_id, person_id, "start" FROM visit WHERE visit_concept_id = 9201'))
def _(g):
    return clinical.visits_of(g.visit).select("visit_id", "person_id", "start")


@query("k5_rows_during_visit", k(' SELECT visit_id, drug_concept_id, quantity, visit_concept_id, v."start" AS visit_start FROM drug_exposure d JOIN visit v USING (visit_id)'))
def _(g):
    return clinical.rows_during_visit(g.visit, g.drug_exposure).select("visit_id", "drug_concept_id", "quantity", "visit_concept_id", "visit_start")


@query("k6_condition_cohort", k(""", codes AS (SELECT DISTINCT concept_id FROM concept WHERE concept_class_id = 'Noun' AND concept_code < 'm'),
    std AS (SELECT DISTINCT coalesce(b, concept_id) AS concept_id FROM codes LEFT JOIN maps ON a = concept_id),
    below_ AS (SELECT DISTINCT descendant_concept_id AS concept_id FROM closure JOIN std ON ancestor_concept_id = std.concept_id JOIN concept c ON c.concept_id = descendant_concept_id WHERE standard_concept = 'S' AND invalid_reason IS NULL AND domain_id = 'Product')
    SELECT DISTINCT person_id, "start" FROM drug_exposure WHERE drug_concept_id IN (SELECT concept_id FROM below_) AND "start" < DATE '1997-01-01'"""))
def _(g):
    codes = g.concept.where("concept_class_id = 'Noun' and concept_code < 'm'").select("concept_code", "vocabulary_id")
    return clinical.condition_cohort(g.concept, g.edges, g.closure, g.drug_exposure, codes, "Product", "drug_concept_id", F.expr("date'1997-01-01'"))


@query("k7_cost_by_label", k(" SELECT visit_concept_id, round(sum(total_paid), 2) AS total_paid FROM cost JOIN visit ON cost_event_id = visit_id WHERE cost_domain_id = 'Visit' GROUP BY 1"))
def _(g):
    return clinical.cost_by(g.cost, g.visit.select("visit_id", "visit_concept_id"), "visit_id", "visit_concept_id", "Visit")


@query("k8_cost_by_payer", k(" SELECT c_mktsegment AS payer, round(avg(total_paid), 2) AS avg_paid, count(*) AS n FROM cost JOIN visit ON cost_event_id = visit_id JOIN customer ON c_custkey = person_id GROUP BY 1"))
def _(g):
    payer = g.read("customer").select(F.col("c_custkey").cast("long").alias("person_id"), F.col("c_mktsegment").alias("payer"))
    return clinical.avg_cost_by_payer(g.cost, g.visit, payer)


def _eras(table, concept, gap):
    return f""", o AS (SELECT person_id, {concept}, "start", "end", max("end") OVER (PARTITION BY person_id, {concept} ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM {table}),
    f AS (SELECT *, CASE WHEN reached IS NULL OR "start" - reached > {gap} THEN 1 ELSE 0 END AS new FROM o),
    r AS (SELECT *, sum(new) OVER (PARTITION BY person_id, {concept} ORDER BY "start", "end") AS era FROM f),
    eras AS (SELECT person_id, {concept}, min("start") AS era_start, max("end") AS era_end, count(*) AS n_events, CAST(sum(CASE WHEN new = 1 THEN 0 ELSE greatest("start" - reached - 1, 0) END) AS BIGINT) AS gap_days FROM r GROUP BY person_id, {concept}, era)"""


@query("k9_long_eras", k(_eras("drug_exposure", "drug_concept_id", 30) + " SELECT drug_concept_id, count(DISTINCT person_id) AS n_persons FROM eras WHERE era_end - era_start > 60 GROUP BY 1"))
def _(g):
    return clinical.long_eras(intervals.eras(g.drug_exposure, "drug_concept_id"), "drug_concept_id", 60)


@query("k10_event_cost", k(" SELECT cost_event_id, round(total_paid, 2) AS total_paid, cost_domain_id, person_id FROM cost JOIN visit ON cost_event_id = visit_id"))
def _(g):
    drugs = g.drug_exposure.select("visit_id", "person_id").distinct()
    found = clinical.event_cost(g.cost, {"Visit": (g.visit, "visit_id"), "Drug": (drugs, "visit_id")})
    return found.withColumn("total_paid", F.round("total_paid", 2))


@query("k11_cohort_demographics", k(" SELECT drug_concept_id AS cohort_id, gender_concept_id, count(DISTINCT person_id) AS n_subjects FROM drug_exposure JOIN person USING (person_id) GROUP BY ALL"))
def _(g):
    return clinical.cohort_demographics(g.drug_exposure.select(F.col("drug_concept_id").alias("cohort_id"), "person_id"), g.person)


@query("k12_drug_era", k(_eras("drug_exposure", "drug_concept_id", 30) + " SELECT * FROM eras"))
def _(g):
    return intervals.eras(g.drug_exposure, "drug_concept_id")


@query("k12_condition_era", k(_eras("condition_occurrence", "condition_concept_id", 2) + " SELECT * FROM eras"))
def _(g):
    return intervals.eras(g.condition, "condition_concept_id", 2)


@query("k13_dose_era", k(""", d AS (SELECT person_id, drug_concept_id, quantity, min("start") AS "start", max("end") AS "end" FROM drug_exposure GROUP BY person_id, drug_concept_id, quantity, visit_id),
    u AS (SELECT person_id, drug_concept_id, "start", quantity, max("end") AS "end" FROM d GROUP BY ALL),
    f AS (SELECT *, CASE WHEN lag(quantity) OVER w = quantity THEN 0 ELSE 1 END AS new FROM u WINDOW w AS (PARTITION BY person_id, drug_concept_id ORDER BY "start", quantity)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY person_id, drug_concept_id ORDER BY "start", quantity ROWS UNBOUNDED PRECEDING) AS run FROM f)
    SELECT person_id, drug_concept_id, quantity, min("start") AS era_start, max("end") AS era_end, count(*) AS n_events FROM r GROUP BY person_id, drug_concept_id, run, quantity"""))
def _(g):
    exposures = dealt(g.drug_exposure, g.n_exposures, "person_id", "drug_concept_id")  # serves the grouping, the window and the runs
    once = exposures.groupBy("person_id", "drug_concept_id", "start", "quantity").agg(F.max("end").alias("end"))
    return clinical.dose_eras(once, "drug_concept_id", "quantity", ["start", "quantity"])


def _ranges(g):
    a = written(intervals.eras(g.drug_exposure, "drug_concept_id").select("person_id", F.col("drug_concept_id").alias("a"), F.col("era_start").alias("start"), F.col("era_end").alias("end")))  # both sides read the eras
    b = a.select("person_id", F.col("a").alias("b"), F.col("start").alias("other_start"), F.col("end").alias("other_end"))
    return a, b


_OVERLAP = k(_eras("drug_exposure", "drug_concept_id", 30) + ' SELECT x.person_id, x.drug_concept_id AS a, y.drug_concept_id AS b, greatest(x.era_start, y.era_start) AS "start", least(x.era_end, y.era_end) AS "end" FROM eras x JOIN eras y ON x.person_id = y.person_id AND x.drug_concept_id < y.drug_concept_id AND x.era_start <= y.era_end AND y.era_start <= x.era_end')


def _overlap(g):
    found = intervals.overlap_join(*_ranges(g)).where("a < b")
    return found.select("person_id", "a", "b", F.col("shared.start").alias("start"), F.col("shared.end").alias("end"))


@query("k14_overlap_join", _OVERLAP)
def _(g):
    return _overlap(g)


@query("jn7_interval_join", _OVERLAP)
def _(g):
    return _overlap(g)


@query("k15_within_days", k(' , c AS (SELECT DISTINCT person_id, condition_concept_id AS x, "start" AS d FROM condition_occurrence) SELECT a.person_id, a.x AS a, b.x AS b, a.d AS day, b.d AS other_day, b.d - a.d AS days FROM c a JOIN c b ON a.person_id = b.person_id AND b.d - a.d BETWEEN 0 AND 3 AND a.x < b.x'))
def _(g):
    c = g.condition.select("person_id", F.col("condition_concept_id").alias("a"), F.col("start").alias("day")).distinct()
    other = c.select("person_id", F.col("a").alias("b"), F.col("day").alias("other_day"))
    return intervals.within_days(c, other, 3).where("a < b").select("person_id", "a", "b", "day", "other_day", "days")


@query("k15_within_days_absolute", k(' , c AS (SELECT DISTINCT person_id, condition_concept_id AS x, "start" AS d FROM condition_occurrence) SELECT a.person_id, a.d AS day, b.d AS other_day, abs(b.d - a.d) AS days FROM c a JOIN c b ON a.person_id = b.person_id AND abs(b.d - a.d) <= 1 AND a.x < b.x'))
def _(g):
    c = g.condition.select("person_id", F.col("condition_concept_id").alias("a"), F.col("start").alias("day")).distinct()
    other = c.select("person_id", F.col("a").alias("b"), F.col("day").alias("other_day"))
    return intervals.within_days(c, other, 1, absolute=True).where("a < b").select("person_id", "day", "other_day", "days")


_NEXT = 'SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) RANGE BETWEEN CURRENT ROW AND INTERVAL 7 DAY FOLLOWING) AS n_next FROM events'


@query("k16_events_in_next", _NEXT)
def _(g):
    rows = g.read("events").select("event_id", F.col("user_id").alias("person_id"), F.col("ts").cast("date").alias("day"))
    return intervals.in_next(rows, 7).select("event_id", "n_next")


@query("w3_range_frame", "SELECT o_orderkey, count(*) OVER w AS n, round(sum(o_totalprice) OVER w, 2) AS paid FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) RANGE BETWEEN CURRENT ROW AND INTERVAL 90 DAY FOLLOWING)")
def _(g):
    rows = g.read("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    return intervals.in_next(rows, 90, "o_custkey", count="n", paid="o_totalprice").select("o_orderkey", "n", F.round("paid", 2).alias("paid"))


@query("k17_in_observation", k(' SELECT person_id, drug_concept_id, "start", "end" FROM drug_exposure JOIN observation_period USING (person_id) WHERE period_start + 30 <= "start" AND "start" <= period_end - 30'))
def _(g):
    return clinical.in_observation(g.drug_exposure, g.observation_period, 30, 30).select("person_id", "drug_concept_id", "start", "end")


@query("k18_named", k(" SELECT person_id, gender_concept_id, CAST(NULL AS VARCHAR) AS gender_name, drug_concept_id, concept_name AS drug_name, gender_source_concept_id, 'unmapped' AS gender_source_name, count(*) AS n FROM drug_exposure JOIN person USING (person_id) LEFT JOIN concept ON concept_id = drug_concept_id GROUP BY ALL"))
def _(g):
    rows = clinical.with_person(g.person, g.drug_exposure).select("person_id", "gender_concept_id", "drug_concept_id", "gender_source_concept_id")
    found = clinical.named(rows, g.concept, ["gender_concept_id", "drug_concept_id", "gender_source_concept_id"])
    return found.groupBy(*found.columns).agg(F.count("*").alias("n"))


@query("sc8_day_difference", "SELECT o_orderkey, l_linenumber, CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS days, abs(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE)) AS apart FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def _(g):
    rows = g.read("orders").join(g.read("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    a, b = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    return rows.select("o_orderkey", "l_linenumber", ranges.days_between(a, b).alias("days"), ranges.days_between(a, b, True).alias("apart"))


@query("sc9_add_days", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 45 AS due FROM orders")
def _(g):
    return g.read("orders").select("o_orderkey", F.date_add(F.col("o_orderdate").cast("date"), 45).alias("due"))


@query("sc10_ranges", """WITH r AS (SELECT o_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 30 AS b, CAST(l_shipdate AS DATE) AS c, CAST(l_shipdate AS DATE) + 10 AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    SELECT o_orderkey, l_linenumber, a <= d AND c <= b AS meets, greatest(a, c) > least(b, d) AS is_empty, greatest(a, c) AS shared_start, least(b, d) AS shared_end FROM r""")
def _(g):
    rows = g.read("orders").join(g.read("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    a, b = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    rows = rows.select("o_orderkey", "l_linenumber", ranges.date_range(a, F.date_add(a, 30)).alias("x"), ranges.date_range(b, F.date_add(b, 10)).alias("y")).withColumn("s", ranges.intersection(F.col("x"), F.col("y")))
    return rows.select("o_orderkey", "l_linenumber", ranges.overlaps(F.col("x"), F.col("y")).alias("meets"), ranges.is_empty(F.col("s")).alias("is_empty"), F.col("s.start").alias("shared_start"), F.col("s.end").alias("shared_end"))


def _score(key, name, desc, tag):
    low = lambda c: f"lower(coalesce({c}, ''))"
    return f"CASE WHEN contains({low(name)}, {key}) THEN 10 ELSE 0 END + CASE WHEN starts_with({low(name)}, {key}) OR contains({low(name)}, ' ' || {key}) THEN 5 ELSE 0 END + CASE WHEN contains({low(desc)}, {key}) THEN 5 ELSE 0 END + CASE WHEN contains({low(tag)}, {key}) THEN 3 ELSE 0 END"


@query("j1_catalogue_score", k(f", {KEYWORDS_SQL}, s AS (SELECT query_id, p_partkey, {_score('lower(keyword)', 'p_name', 'p_type', 'p_brand')} AS score FROM keywords, part) SELECT query_id, p_partkey, CAST(score AS BIGINT) AS score FROM s WHERE score > 0"))
def _(g):
    return catalogue.scored_pairs(g.read("part"), keywords(g), "p_name", "p_type", "p_brand").select("query_id", "p_partkey", "score")


@query("j1_document_score", "WITH q(query_id, keyword) AS (VALUES (1, 'the'), (2, 'src1'), (3, 'license')), s AS (SELECT query_id, doc_id, " + _score("keyword", "source", "text", "lang") + " AS score FROM q, documents) SELECT CAST(query_id AS BIGINT) AS query_id, doc_id, CAST(score AS BIGINT) AS score FROM s WHERE score > 0")
def _(g):
    q = g.spark.createDataFrame([(1, "the"), (2, "src1"), (3, "license")], "query_id long, keyword string")
    return catalogue.scored_pairs(g.read("documents"), q, "source", "text", "lang").select("query_id", "doc_id", "score")


_CATALOGUE = ", cat AS (SELECT CAST(p_partkey AS BIGINT) AS cohortId, p_name AS cohortName, CASE WHEN p_partkey % 4 = 0 THEN 'Pending' ELSE 'Accepted' END AS status, p_type AS logicDescription, p_brand AS hashTag, p_size > 25 AS drug, p_size % 2 = 0 AS death FROM part)"


def cohorts(g):
    """A cohort catalogue of all parts."""
    flags = {f: F.lit("0") for f in catalogue.DOMAIN_FLAGS} | {"domainDrugExposure": F.when(F.col("p_size") > 25, "TRUE").otherwise("0"), "domainDeath": F.when(F.col("p_size") % 2 == 0, "1").otherwise("")}
    p = g.read("part").select(F.col("p_partkey").cast("long").alias("cohortId"), F.col("p_name").alias("cohortName"), F.when(F.col("p_partkey") % 4 == 0, "Pending").otherwise("Accepted").alias("status"), F.col("p_type").alias("logicDescription"), F.col("p_brand").alias("hashTag"), "p_size")
    return p.withColumns(flags).drop("p_size")


@query("j2_search_phenotypes", k(f"""{_CATALOGUE}, {KEYWORDS_SQL}, s AS (SELECT query_id, cohortId, cohortName, {_score('lower(keyword)', 'cohortName', 'logicDescription', 'hashTag')} AS score FROM keywords, cat WHERE drug AND lower(status) LIKE '%accept%'),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, cohortName, cohortId) AS rank, count(*) OVER (PARTITION BY query_id) AS total FROM s WHERE score > 0) SELECT query_id, rank, CAST(score AS BIGINT) AS score, cohortName, total FROM r WHERE rank <= 20"""))
def _(g):
    return catalogue.search_phenotypes(cohorts(g), keywords(g), "Drug", "accept").select("query_id", "rank", "score", "cohortName", "total")


@query("j3_active_domains", k(f"{_CATALOGUE} SELECT cohortId, CASE WHEN drug AND death THEN 'drug, death' WHEN drug THEN 'drug' WHEN death THEN 'death' ELSE 'none' END AS domains FROM cat"))
def _(g):
    return cohorts(g).select("cohortId", catalogue.active_domains().alias("domains"))


@query("j4_definition_summary", k("""{0} SELECT cohortId, CASE WHEN cohortId % 10 = 0 THEN '' ELSE 'Unnamed-0; ' || cohortName END AS concept_sets, CASE WHEN cohortId % 10 = 0 THEN NULL ELSE 'DateOffset EndDate + ' || (cohortId % 30) END AS end_strategy, CASE WHEN cohortId % 10 = 0 THEN 'malformed definition' END AS error FROM cat""".format(_CATALOGUE)))
def _(g):
    c = cohorts(g)
    good = F.concat(F.lit('{"ConceptSets": [{"id": 0}, {"name": "'), "cohortName", F.lit('"}], "InclusionRules": [], "EndStrategy": {"DateOffset": {"DateField": "EndDate", "Offset": '), (F.col("cohortId") % 30).cast("string"), F.lit("}}}"))
    definitions = c.select("cohortId", F.when(F.col("cohortId") % 10 == 0, F.lit('{"ConceptSets": [')).otherwise(good).alias("json"))
    found = catalogue.definition_summary(definitions, c)
    return found.select("cohortId", F.when(F.col("error").isNull(), F.col("concept_sets")).otherwise("").alias("concept_sets"), F.when(F.col("error").isNull(), F.col("end_strategy")).alias("end_strategy"), "error")


def templates(g):
    """One markdown query template a part."""
    p = g.read("part")
    content = F.concat(F.lit("<!---\nGroup:"), "p_brand", F.lit("\nName:"), F.upper(F.substring("p_type", 1, 1)), F.col("p_partkey").cast("string"), F.lit(" find "), "p_name", F.lit("\nAuthor:someone\nCDM Version: 5.0\n-->\n\n# Title\n\n## Description\nFinds all "), "p_type", F.lit(".\n\n## Query\n```sql\nSELECT "), F.col("p_size").cast("string"), F.lit("\n```\n\n## Input\nnone\n\n## Output\na row\n"))
    return catalogue.parse_query_files(p.select(F.concat(F.lit("q/"), F.col("p_partkey").cast("string"), F.lit(".md")).alias("path"), content.alias("content")))


_TEMPLATES = ", t AS (SELECT 'q/' || p_partkey || '.md' AS path, upper(substring(p_type, 1, 1)) || p_partkey || ' find ' || p_name AS name, p_brand AS \"group\", 'someone' AS author, '5.0' AS version, 'Finds all ' || p_type || '.' AS description, 'SELECT ' || p_size AS sql, 'none' AS input, 'a row' AS output, upper(substring(p_type, 1, 1)) || p_partkey AS query_id FROM part)"


@query("j5_parse_query_files", k(f"{_TEMPLATES} SELECT * FROM t"))
def _(g):
    return templates(g)


@query("j6_search_queries", k(f"""{_TEMPLATES}, {KEYWORDS_SQL}, s AS (SELECT k.query_id, t.query_id AS template_id, {_score('lower(keyword)', 't.name', 't.description', 't."group"')} AS score FROM keywords k, t WHERE lower("group") LIKE '%brand#1%'),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, template_id) AS rank FROM s WHERE score > 0) SELECT query_id, rank, template_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 15"""))
def _(g):
    return catalogue.search_queries(templates(g), keywords(g), "brand#1").select("query_id", "rank", "template_id", "score")


@query("j7_get_query", k(f"{_TEMPLATES} SELECT query_id, sql FROM t"))
def _(g):
    found = templates(g)
    return catalogue.get_query(found, found.select(F.lower("query_id").alias("query_id"))).select("query_id", "sql")


@query("sc7_sections", k(f"{_TEMPLATES} SELECT path, \"group\", description, output FROM t"))
def _(g):
    return templates(g).select("path", "group", "description", "output")


@query("sc15_last_json", "SELECT doc_id, '{\"target_concept_id\": ' || doc_id || '}' AS answer FROM documents")
def _(g):
    from ..operators.picks import extract_answers

    note = F.concat(F.regexp_replace(F.coalesce("text", F.lit("")), r"[{}\[\]\"]", " "), F.lit(' {"a": 1} {"target_concept_id": '), F.col("doc_id").cast("string"), F.lit("} done"))
    return g.read("documents").select("doc_id", extract_answers(note).alias("answer"))


@query("sc16_json_paths", k(f"{_CATALOGUE} SELECT cohortId, cohortName AS first_name FROM cat"))
def _(g):
    body = F.concat(F.lit('{"ConceptSets": [{"name": "'), "cohortName", F.lit('"}]}'))
    return cohorts(g).select("cohortId", F.variant_get(F.try_parse_json(body), "$.ConceptSets[0].name", "string").alias("first_name"))


@query("l3_conformance", k(""" SELECT 'drug_exposure' AS table_name, 'person_id' AS column_name, 'null' AS check_name, count(*) FILTER (person_id IS NULL) AS n_failed FROM drug_exposure UNION ALL SELECT 'drug_exposure', 'end', 'null', count(*) FILTER ("end" IS NULL) FROM drug_exposure
    UNION ALL SELECT 'drug_exposure', 'dose_unit', 'missing', 1 UNION ALL SELECT 'measurement', 'person_id', 'orphan', count(*) FROM measurement WHERE person_id NOT IN (SELECT person_id FROM person)
    UNION ALL SELECT 'cost', 'cost_event_id', 'orphan', count(*) FROM cost WHERE cost_event_id NOT IN (SELECT visit_id FROM visit)"""))
def _(g):
    tables = {"drug_exposure": g.drug_exposure, "measurement": g.measurement, "person": g.person, "cost": g.cost, "visit": g.visit}
    return governance.conformance(tables, {"drug_exposure": ["person_id", "end", "dose_unit"]}, [("measurement", "person_id", "person", "person_id"), ("cost", "cost_event_id", "visit", "visit_id")])


@query("l4_drop_restricted", k(" SELECT person_id, gender_concept_id, year_of_birth FROM person"))
def _(g):
    return governance.drop_restricted(g.person)


@query("l5_safe_aggregate", k(" SELECT gender_concept_id, count(*) AS n_rows, count(DISTINCT person_id) AS n_persons, round(avg(year_of_birth), 4) AS mean_year FROM person GROUP BY 1 HAVING count(*) >= 5"))
def _(g):
    return governance.safe_agg(g.person, ["gender_concept_id"], 5, n_persons=F.countDistinct("person_id"), mean_year=F.round(F.avg("year_of_birth"), 4))
