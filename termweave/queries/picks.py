"""Mapping answers (I), score report (AG5), run summary (AG6)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import picks, search
from ..plans.derive import with_vocabulary as v
from ..sources import files
from ..sources.scratch import scratch_dir
from . import query

#: Truth and predictions as derived from parts: the same rows and keys, h being half the part key.
_TRUTH = """, mapped AS (SELECT p.*, m.b AS one_hop, CAST(partkey // 2 AS BIGINT) AS h FROM parts p JOIN maps m ON m.a = p.srcid),
    truth AS (SELECT CAST(h % 4 AS VARCHAR) AS source_data_identifier, 'P' || h AS source_code, partkey AS row_id, one_hop AS target_concept_id, CASE WHEN partkey % 5 = 0 THEN item END AS alternative_target_concept_id, CASE WHEN partkey % 3 = 0 THEN 'broadMatch' ELSE 'exactMatch' END AS predicate, p_name AS source_name, upper(p_name) AS original_source_name FROM mapped),
    preds AS (SELECT CAST(h % 4 AS VARCHAR) AS source_data_identifier, 'P' || h AS source_code, partkey AS row_id, CASE partkey % 6 WHEN 0 THEN one_hop WHEN 1 THEN item WHEN 2 THEN item WHEN 3 THEN 999 WHEN 4 THEN srcid END AS target_concept_id,
      CASE WHEN partkey % 11 = 0 THEN 'wrong name' WHEN partkey % 6 = 0 THEN upper(c.concept_name) WHEN partkey % 6 IN (1, 2) THEN p_name END AS target_concept_name, CASE WHEN partkey % 3 = 1 THEN 'ExactMatch' WHEN partkey % 3 = 2 THEN 'closeMatch' ELSE 'broadMatch' END AS predicate,
      CASE WHEN partkey % 4 <> 0 THEN 's' || partkey END AS session_id, CASE WHEN partkey % 9 = 0 THEN 'timeout' END AS error, 'why' AS reasoning FROM mapped LEFT JOIN concept c ON c.concept_id = one_hop),
    valid AS (SELECT p.* EXCLUDE (target_concept_id, target_concept_name), p.target_concept_id AS wanted, CASE WHEN p.target_concept_id IS NULL THEN 'no_target' WHEN c.concept_id IS NULL THEN 'not_in_vocabulary' WHEN standard_concept IS DISTINCT FROM 'S' THEN 'not_standard' WHEN invalid_reason IS NOT NULL THEN 'invalid'
      WHEN coalesce(lower(trim(target_concept_name)), '') <> '' AND lower(trim(target_concept_name)) <> lower(trim(c.concept_name)) THEN 'name_mismatch' END AS validation_error, c.concept_name AS target_concept_name, c.vocabulary_id AS target_vocabulary FROM preds p LEFT JOIN concept c ON c.concept_id = p.target_concept_id)"""


def _mapped(g):
    maps = g.edges.where("relationship_id = 'Maps to'").select(F.col("concept_id_1").alias("srcid"), F.col("concept_id_2").alias("one_hop"))
    return g.parts.join(maps, "srcid").withColumn("h", F.expr("partkey div 2")).withColumns({"source_data_identifier": (F.col("h") % 4).cast("string"), "source_code": F.concat(F.lit("P"), F.col("h").cast("string")), "row_id": F.col("partkey")})


_KEY = ["source_data_identifier", "source_code", "row_id"]


def truth(g):
    k = F.col("partkey")
    return _mapped(g).select(*_KEY, F.col("one_hop").alias("target_concept_id"), F.when(k % 5 == 0, F.col("item")).alias("alternative_target_concept_id"), F.when(k % 3 == 0, "broadMatch").otherwise("exactMatch").alias("predicate"), F.col("p_name").alias("source_name"), F.upper("p_name").alias("original_source_name"))


def preds(g):
    k = F.col("partkey")
    m = _mapped(g).join(g.concept.select(F.col("concept_id").alias("one_hop"), "concept_name"), "one_hop", "left")
    target = F.when(k % 6 == 0, F.col("one_hop")).when((k % 6).isin(1, 2), F.col("item")).when(k % 6 == 3, F.lit(999)).when(k % 6 == 4, F.col("srcid"))
    name = F.when(k % 11 == 0, "wrong name").when(k % 6 == 0, F.upper("concept_name")).when((k % 6).isin(1, 2), F.col("p_name"))
    case = F.when(k % 3 == 1, "ExactMatch").when(k % 3 == 2, "closeMatch").otherwise("broadMatch")
    return m.select(*_KEY, target.cast("long").alias("target_concept_id"), name.alias("target_concept_name"), case.alias("predicate"), F.when(k % 4 != 0, F.concat(F.lit("s"), k.cast("string"))).alias("session_id"), F.when(k % 9 == 0, "timeout").alias("error"), F.lit("why").alias("reasoning"))


def stored(g, df, form="csv"):
    """A path in the shared folder where df was written."""
    path = f"{scratch_dir(g.spark).rstrip('/')}/{uuid.uuid4().hex}"
    files.write_predictions(df, path, form)
    return path


_PREDS = f"{_TRUTH} SELECT source_data_identifier, source_code, CAST(row_id AS VARCHAR) AS row_id, CAST(target_concept_id AS VARCHAR) AS target_concept_id, predicate FROM preds"


@query("a8_read_predictions", v(_PREDS))
def _(g):
    return files.read_predictions(g.spark, stored(g, preds(g))).select(*_KEY, "target_concept_id", "predicate")


@query("a9_read_truth", v(f"{_TRUTH} SELECT source_data_identifier, source_code, CAST(target_concept_id AS VARCHAR) AS target_concept_id, CAST(alternative_target_concept_id AS VARCHAR) AS alternative_target_concept_id, predicate FROM truth"))
def _(g):
    return files.read_truth(g.spark, stored(g, truth(g)))


@query("a10_write_detail", v(f"{_TRUTH} SELECT row_id, validation_error FROM valid"))
def _(g):
    return g.spark.read.parquet(stored(g, picks.validate_picks(preds(g), g.concept), "parquet")).select("row_id", "validation_error")


@query("a5_read_catalogue", "SELECT CAST(p_partkey AS BIGINT) AS \"cohortId\", p_name AS \"cohortName\", 'a, \"b\" ' || p_type AS status FROM part")
def _(g):
    rows = g.read("part").select(F.col("p_partkey").cast("string").alias(" cohortId"), F.col("p_name").alias("cohortName "), F.concat(F.lit('a, "b" '), "p_type").alias("status"))
    bad = rows.select(F.lit("none").alias(" cohortId"), "cohortName ", "status")
    return files.read_catalogue_csv(g.spark, stored(g, rows.union(bad)), files.CATALOGUE_COLUMNS).select("cohortId", "cohortName", "status")


@query("a1_load_vocabulary", v("SELECT concept_id, concept_name, standard_concept, invalid_reason FROM concept"))
def _(g):
    return vocabulary_files(g)["concept"].select("concept_id", "concept_name", "standard_concept", "invalid_reason")


def vocabulary_files(g):
    """All nine vocabulary files of the derived tables, written and loaded."""
    folder = f"{scratch_dir(g.spark).rstrip('/')}/{uuid.uuid4().hex}"
    strength = g.read("part").select((10000000 + F.col("p_partkey")).cast("long").alias("drug_concept_id"), F.col("p_size").cast("double").alias("amount_value"))
    held = {"concept": g.concept, "concept_ancestor": g.closure, "concept_relationship": g.edges, "concept_synonym": g.synonym, "drug_strength": strength, "domain": g.domain, "vocabulary": g.vocabulary, "relationship": g.relationship, "concept_class": g.concept.select("concept_class_id").distinct()}
    for name, schema in files.VOCABULARY_FILES.items():
        kinds = dict(c.split() for c in schema.split(", "))
        rows = held[name].select(*(F.col(c) if c in held[name].columns else F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()))
        rows.write.csv(f"{folder}/{name.upper()}.csv", sep="\t", header=True, quote="")
    return files.load_vocabulary(g.spark, folder)


@query("a1_vocabulary_rows", v("""SELECT 'concept' AS name, count(*) AS n_rows FROM concept UNION ALL SELECT 'concept_ancestor', count(*) FROM closure UNION ALL SELECT 'concept_relationship', count(*) FROM edges UNION ALL SELECT 'concept_synonym', count(*) FROM synonym
    UNION ALL SELECT 'drug_strength', count(*) FROM part UNION ALL SELECT 'domain', count(*) FROM domain UNION ALL SELECT 'vocabulary', count(*) FROM vocabulary UNION ALL SELECT 'relationship', count(*) FROM relationship UNION ALL SELECT 'concept_class', count(DISTINCT concept_class_id) FROM concept"""))
def _(g):
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows") for name, df in vocabulary_files(g).items()]
    return reduce(DataFrame.union, counts)


def one_file_each(g, content, suffix):
    """A folder in the shared space with a file a supplier, named by its key: the sources to be read are many small files."""
    folder = f"{scratch_dir(g.spark).rstrip('/')}/{uuid.uuid4().hex}"
    files.write_files(g.read("supplier").select(F.concat(F.col("s_suppkey").cast("string"), F.lit(suffix)).alias("name"), content.alias("value")), folder)
    return folder


@query("a6_read_definitions", "SELECT CAST(s_suppkey AS BIGINT) AS \"cohortId\", '{\"ConceptSets\": [{\"name\": \"' || s_name || '\"}]}' AS json FROM supplier")
def _(g):
    return files.read_definitions(g.spark, one_file_each(g, F.concat(F.lit('{"ConceptSets": [{"name": "'), "s_name", F.lit('"}]}')), ".json"))


@query("a7_read_query_corpus", "SELECT s_suppkey || '.md' AS file, '## ' || s_name || chr(10) || 'text' AS content FROM supplier")
def _(g):
    found = files.read_query_corpus(g.spark, one_file_each(g, F.concat(F.lit("## "), "s_name", F.lit("\ntext")), ".md"))
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


@query("i1_dedupe_sources", v(f"{_TRUTH} SELECT source_data_identifier, source_code, row_id FROM (SELECT *, row_number() OVER (PARTITION BY source_data_identifier, source_code ORDER BY row_id) AS n FROM truth) WHERE n = 1"))
def _(g):
    return picks.dedupe_sources(truth(g)).select(*_KEY)


@query("i2_request_text", v(f"{_TRUTH} SELECT row_id, 'Source: ' || source_data_identifier || chr(10) || 'Code: ' || source_code || chr(10) || 'Name: ' || source_name AS request FROM truth"))
def _(g):
    t = truth(g)
    return t.select("row_id", picks.request_text(t).alias("request"))


@query("i3_extract_answers", "SELECT conv_id, turn, '{\"target_concept_id\": ' || turn || '}' AS answer FROM conversations")
def _(g):
    c = g.read("conversations")
    wrapped = F.concat(F.coalesce("text", F.lit("")), F.lit(' {"target_concept_id": '), F.col("turn").cast("string"), F.lit("} "), F.col("role"))
    return c.select("conv_id", "turn", picks.extract_answers(wrapped).alias("answer"))


_ARRAYS = "arr AS (SELECT srcid, partkey % 4 AS n FROM parts)"


@query("i4_fan_out_picks", v("""
    , arr AS (SELECT partkey AS row_id, partkey % 4 AS n, CASE WHEN partkey % 5 = 0 THEN 'timeout' END AS error FROM parts)
    SELECT row_id, CAST(k AS BIGINT) AS pick_index, CASE WHEN n = 3 THEN 0 ELSE n END AS n_targets, CASE WHEN n IN (1, 2) THEN CAST(row_id + k AS VARCHAR) END AS target_concept_id, nullif(concat_ws('|', error, CASE WHEN n = 3 THEN 'no_json_extracted' END), '') AS error
    FROM arr, (VALUES (0), (1)) t(k) WHERE k < greatest(CASE WHEN n = 3 THEN 0 ELSE n END, 1)"""))
def _(g):
    n, k = F.col("partkey") % 4, F.col("partkey")
    one = lambda i: F.concat(F.lit('{"target_concept_id": "'), (k + i).cast("string"), F.lit('"}'))
    answer = F.when(n == 0, F.lit("[]")).when(n == 1, one(0)).when(n == 2, F.concat(F.lit("["), one(0), F.lit(", "), one(1), F.lit("]")))
    rows = g.parts.select(k.alias("row_id"), picks.parse_picks(answer).alias("picks"), F.when(k % 5 == 0, "timeout").alias("error"))
    return picks.fan_out_picks(rows).select("row_id", "pick_index", "n_targets", "target_concept_id", "error")


@query("i5_pad_picks", v(", arr AS (SELECT partkey AS row_id, partkey % 4 AS n FROM parts) SELECT row_id, CAST(k AS BIGINT) AS pick_index, CASE WHEN k < n THEN CAST(row_id AS VARCHAR) END AS target_concept_id FROM arr, (VALUES (0), (1)) t(k)"))
def _(g):
    pick = F.from_json(F.concat(F.lit('{"target_concept_id": "'), F.col("partkey").cast("string"), F.lit('"}')), picks.PICK)
    rows = g.parts.select(F.col("partkey").alias("row_id"), F.posexplode(picks.pad_picks(F.array_repeat(pick, (F.col("partkey") % 4).cast("int")), 2)).alias("i", "p"))
    return rows.select("row_id", F.col("i").cast("long").alias("pick_index"), F.col("p.target_concept_id").alias("target_concept_id"))


@query("i6_validate_picks", v(f"{_TRUTH} SELECT row_id, CASE WHEN validation_error IS NULL THEN wanted END AS target_concept_id, target_concept_name, target_vocabulary, validation_error FROM valid"))
def _(g):
    return picks.validate_picks(preds(g), g.concept).select("row_id", "target_concept_id", "target_concept_name", "target_vocabulary", "validation_error")


@query("i7_recovery_candidates", v(f"{_TRUTH} SELECT row_id, session_id FROM preds WHERE target_concept_id IS NULL AND coalesce(session_id, '') <> ''"))
def _(g):
    return picks.recovery_candidates(preds(g)).select("row_id", "session_id")


@query("i8_apply_recovery", v(f"""{_TRUTH}, patches AS (SELECT partkey AS row_id, CASE WHEN partkey % 7 = 0 THEN srcid ELSE branded END AS pid, partkey % 5 = 0 AS declined FROM mapped WHERE partkey % 6 = 5 AND partkey % 8 <> 3),
    j AS (SELECT p.row_id, p.session_id, p.target_concept_id AS old, t.pid, t.declined, t.row_id IS NOT NULL AS patched, c.concept_name, CASE WHEN t.pid IS NULL THEN 'no_target' WHEN c.concept_id IS NULL THEN 'not_in_vocabulary' WHEN standard_concept IS DISTINCT FROM 'S' THEN 'not_standard' WHEN invalid_reason IS NOT NULL THEN 'invalid' END AS ve FROM preds p LEFT JOIN patches t USING (row_id) LEFT JOIN concept c ON c.concept_id = t.pid),
    e AS (SELECT *, CASE WHEN old IS NOT NULL THEN NULL WHEN coalesce(session_id, '') = '' THEN 'no_session_id' WHEN NOT patched THEN 'no_json' WHEN declined THEN 'declined' ELSE ve END AS recovery_error FROM j)
    SELECT row_id, CASE WHEN old IS NULL AND recovery_error IS NULL THEN pid ELSE old END AS target_concept_id, recovery_error FROM e"""))
def _(g):
    k = F.col("partkey")
    patches = _mapped(g).where("partkey % 6 = 5 and partkey % 8 <> 3").select("row_id", F.when(k % 7 == 0, F.col("srcid")).otherwise(F.col("branded")).alias("patch_id"), (k % 5 == 0).alias("declined"), F.lit("reviewed").alias("reasoning"))
    return picks.apply_recovery(preds(g), patches, g.concept).select("row_id", "target_concept_id", "recovery_error")


@query("i9_validate_targets", v(f"{_TRUTH} SELECT concept_id, concept_name, vocabulary_id, standard_concept, invalid_reason FROM concept WHERE concept_id IN (SELECT target_concept_id FROM preds)"))
def _(g):
    return picks.validate_targets(preds(g).select(F.col("target_concept_id").alias("concept_id")), g.concept)


_SUBMISSION = f"""{_TRUTH}, sub AS (SELECT t.source_data_identifier, t.source_code, t.source_name, p.target_concept_id, c.concept_name AS target_concept_name, CAST(NULL AS BIGINT) AS alternative_target_concept_id, CAST(NULL AS VARCHAR) AS alternative_target_concept_name, p.predicate, t.row_id
    FROM truth t LEFT JOIN preds p USING (source_data_identifier, source_code) LEFT JOIN concept c ON c.concept_id = p.target_concept_id)"""


def submission(g, align="key"):
    return picks.format_submission(truth(g), preds(g), g.concept, align)


@query("i10_format_submission", v(f"{_SUBMISSION} SELECT * FROM sub"))
def _(g):
    return submission(g)


@query("i10_format_by_position", v(f"""{_TRUTH}, a AS (SELECT *, row_number() OVER (PARTITION BY source_data_identifier, source_code ORDER BY row_id) AS n FROM truth), b AS (SELECT *, row_number() OVER (PARTITION BY source_data_identifier, source_code ORDER BY row_id) AS n FROM preds)
    SELECT a.row_id, b.target_concept_id, b.predicate FROM a LEFT JOIN b USING (source_data_identifier, source_code, n)"""))
def _(g):
    return submission(g, "position").select("row_id", "target_concept_id", "predicate")


@query("i11_submission_report", v(f"""{_SUBMISSION} SELECT count(*) AS n_rows, count(*) FILTER (target_concept_id IS NULL) AS n_unmapped, count(*) FILTER (predicate NOT IN ('exactMatch', 'broadMatch')) AS n_invalid_predicate,
    count(*) FILTER (c.concept_id IS NOT NULL AND standard_concept IS DISTINCT FROM 'S') AS n_non_standard, count(*) FILTER (target_concept_id IS NOT NULL AND c.concept_id IS NULL) AS n_not_in_vocabulary FROM sub LEFT JOIN concept c ON c.concept_id = target_concept_id"""))
def _(g):
    return picks.submission_report(submission(g), g.concept)


_SCORED = f"""{_TRUTH}, a AS (SELECT *, row_number() OVER (PARTITION BY source_data_identifier, source_code ORDER BY row_id) AS n FROM preds), b AS (SELECT *, row_number() OVER (PARTITION BY source_data_identifier, source_code ORDER BY row_id) AS n FROM truth),
    sc AS (SELECT a.row_id, coalesce(a.target_concept_id = b.target_concept_id, false) OR coalesce(a.target_concept_id = b.alternative_target_concept_id, false) AS exact, coalesce(lower(a.predicate) = lower(b.predicate), false) AS predicate_ok,
      EXISTS (SELECT 1 FROM closure WHERE min_levels_of_separation <= 3 AND (ancestor_concept_id = a.target_concept_id AND descendant_concept_id = b.target_concept_id OR descendant_concept_id = a.target_concept_id AND ancestor_concept_id = b.target_concept_id)) AS near FROM a LEFT JOIN b USING (source_data_identifier, source_code, n))"""


@query("i12_score_rows", v(f"{_SCORED} SELECT *, exact AND predicate_ok AS joint FROM sc"))
def _(g):
    return picks.score_rows(preds(g), truth(g), g.closure).select("row_id", "exact", "predicate_ok", "near", "joint")


_MARKS = {"exact": "exact", "predicate_ok": "predicate_ok", "near": "near", "joint": "exact AND predicate_ok"}
_REPORT = v(f"{_SCORED} SELECT count(*) AS n, " + ", ".join(f"count(*) FILTER ({c}) AS n_{m}, round(100 * avg(CASE WHEN {c} THEN 1.0 ELSE 0 END), 2) AS pct_{m}" for m, c in _MARKS.items()) + " FROM sc")


@query("i12_score_report", _REPORT)
def _(g):
    return picks.score_report(picks.score_rows(preds(g), truth(g), g.closure))


@query("ag5_score_report", _REPORT)
def _(g):
    return picks.score_report(picks.score_rows(preds(g), truth(g), g.closure))


@query("i12_missing_truth", v(f"{_TRUTH} SELECT DISTINCT source_data_identifier, source_code FROM preds WHERE source_code NOT IN (SELECT source_code FROM truth WHERE row_id % 2 = 0)"))
def _(g):
    return picks.missing_truth(preds(g), truth(g).where("row_id % 2 = 0"))


@query("i16_prefer_vocabulary", v("SELECT nr AS query_id, concept_id, CAST(CASE vocabulary_id WHEN 'BRAND' THEN 1 WHEN 'CAT' THEN 2 ELSE 3 END AS BIGINT) AS preference, row_number() OVER (PARTITION BY nr ORDER BY CASE vocabulary_id WHEN 'BRAND' THEN 1 WHEN 'CAT' THEN 2 ELSE 3 END, concept_id) AS rank FROM (SELECT DISTINCT nr, noun FROM parts) JOIN concept ON concept_name ILIKE '%' || noun || '%'"))
def _(g):
    words = g.parts.select(F.col("nr").alias("query_id"), "noun").distinct()
    found = search._name_hits(g.concept.withColumn("text", F.col("concept_name")), words.withColumnRenamed("noun", "keyword")).select("query_id", "concept_id", "vocabulary_id")
    return picks.prefer_vocabulary(found, ["BRAND", "CAT"]).select("query_id", "concept_id", "preference", "rank")


@query("ag6_run_summary", v(f"{_TRUTH} SELECT count(*) AS n_rows, count(error) AS n_errors, (SELECT string_agg(error, ';' ORDER BY row_id) FROM (SELECT * FROM preds WHERE error IS NOT NULL ORDER BY row_id LIMIT 5)) AS first_errors FROM preds"))
def _(g):
    return picks.run_summary(preds(g))
