"""Catalogue search and definition parsing (J)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._pieces import contained
from ._rank import top

#: Domain names as users give and read them, and the flag columns of a cohort catalogue.
DOMAINS = {
    "condition": "domainConditionOccurrence",
    "drug": "domainDrugExposure",
    "procedure": "domainProcedureOccurrence",
    "measurement": "domainMeasurement",
    "observation": "domainObservation",
    "visit": "domainVisitOccurrence",
    "device": "domainDeviceExposure",
    "death": "domainDeath",
}
DOMAIN_FLAGS = list(DOMAINS.values())
_TRUE = ["1", "TRUE", "true"]


def catalogue_score(keyword: Column, name: Column, description: Column, tag: Column) -> Column:
    """10 for the name, 5 more at its start or a word's, 5 for the description, 3 for the tag."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    k, n = low(keyword), low(name)
    hit = n.contains(k)
    begins = hit & (n.startswith(k) | n.contains(F.concat(F.lit(" "), k)))
    return (hit.cast("long") * 10 + begins.cast("long") * 5 + low(description).contains(k).cast("long") * 5 + low(tag).contains(k).cast("long") * 3).cast("long")


def scored_pairs(rows: DataFrame, queries: DataFrame, name: str, description: str, tag: str) -> DataFrame:
    """Rows with each query(query_id, keyword) that scores for them, and the score."""
    score = catalogue_score(F.col("keyword"), F.col(name), F.col(description), F.col(tag))
    return contained(rows, F.concat_ws("\n", name, description, tag), queries, score > 0).withColumn("score", score)


def search_catalogue(rows: DataFrame, queries: DataFrame, name: str, description: str, tag: str, tie: str, limit: int | None = 20) -> DataFrame:
    """Rows that score for queries(query_id, keyword): total found, and the best by score and tie."""
    scored = scored_pairs(rows, queries, name, description, tag)
    totals = scored.groupBy("query_id").agg(F.count("*").alias("total"))
    return top(scored, ["query_id"], [F.col("score").desc(), tie], limit).join(totals, "query_id")


def search_phenotypes(catalogue: DataFrame, queries: DataFrame, domain: str | None = None, status: str | None = None, limit: int = 20) -> DataFrame:
    """Cohorts of a domain (see DOMAINS) and status that match, 1..30 a query; an unknown domain is an error."""
    if domain:
        if domain.lower() not in DOMAINS:
            raise ValueError(f"unknown domain {domain}: one of {', '.join(sorted(DOMAINS))}")
        catalogue = catalogue.where(F.col(DOMAINS[domain.lower()]).isin(_TRUE))
    if status is not None:
        catalogue = catalogue.where(F.lower("status").contains(status.lower()))
    return search_catalogue(catalogue, queries, "cohortName", "logicDescription", "hashTag", "cohortName", min(max(limit, 1), 30))


def active_domains(domains: dict[str, str] = DOMAINS) -> Column:
    """Names of the domains whose flags are set, comma-joined, or none."""
    found = F.array_compact(F.array(*(F.when(F.col(flag).isin(_TRUE), F.lit(name)) for name, flag in domains.items())))
    return F.when(F.size(found) == 0, F.lit("none")).otherwise(F.array_join(found, ", "))


def definition_summary(definitions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """definitions(cohortId, json) with their catalogue row: concept-set and rule names, end strategy, preview, error."""
    schema = "struct<ConceptSets:array<struct<name:string>>,InclusionRules:array<struct<name:string>>,EndStrategy:struct<DateOffset:struct<DateField:string,Offset:int>,CustomEra:struct<GapDays:int,DrugCodesetId:int>>>"
    rows = catalogue.join(definitions, "cohortId", "left").withColumn("d", F.from_json("json", schema)).withColumn("ok", F.try_parse_json("json").isNotNull())
    named = lambda c, word: F.array_join(F.transform(F.coalesce(c, F.array()), lambda x, i: F.coalesce(x["name"], F.concat(F.lit(f"Unnamed-{word}"), i.cast("string")))), "; ")
    end, off, era = F.col("d.EndStrategy"), F.col("d.EndStrategy.DateOffset"), F.col("d.EndStrategy.CustomEra")
    strategy = F.when(off.isNotNull(), F.concat(F.lit("DateOffset "), F.coalesce(off["DateField"], F.lit("StartDate")), F.lit(" + "), F.coalesce(off["Offset"], F.lit(0)).cast("string"))).when(era.isNotNull(), F.concat(F.lit("CustomEra gap "), F.coalesce(era["GapDays"], F.lit(0)).cast("string"))).when(end.isNotNull(), "Custom")
    error = F.when(F.col("json").isNull(), "missing definition").when(~F.col("ok"), "malformed definition")
    return rows.select("cohortId", "cohortName", named(F.col("d.ConceptSets"), "").alias("concept_sets"), named(F.col("d.InclusionRules"), "").alias("inclusion_rules"), strategy.alias("end_strategy"), F.substring("json", 1, 500).alias("preview"), error.alias("error"))


def strip(c: Column) -> Column:
    """Without white space at either end, line breaks included."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def parse_query_files(files: DataFrame) -> DataFrame:
    """files(path, content) of markdown query templates, one row each; files without a name are dropped."""
    meta = lambda name: strip(F.regexp_extract("content", rf"(?m)^\s*{name}:\s*(.*)$", 1))
    section = lambda name: strip(F.regexp_extract("content", rf"(?s)##\s+{name}[^\n]*\n(.*?)(?=\n##\s|\z)", 1))
    rows = files.select("path", meta("Name").alias("name"), meta("Group").alias("group"), meta("Author").alias("author"), meta("CDM Version").alias("version"), section("Description").alias("description"), strip(F.regexp_extract("content", r"(?s)```sql\s*\n(.*?)```", 1)).alias("sql"), section("Input").alias("input"), section("Output").alias("output"))
    return rows.withColumn("query_id", leading_code(F.col("name"))).where("name <> ''")


def leading_code(name: Column) -> Column:
    return F.regexp_extract(name, r"^([A-Z]+\d+)", 1)


def search_queries(rows: DataFrame, queries: DataFrame, category: str | None = None, limit: int = 15) -> DataFrame:
    """Query templates of a category (underscores for spaces) that match, 1..20 a query, by score and query_id."""
    if category is not None:
        rows = rows.where(F.lower("group").contains(category.replace("_", " ").lower()))
    return search_catalogue(rows.withColumnRenamed("query_id", "template_id"), queries, "name", "description", "group", "template_id", min(max(limit, 1), 20))


def get_query(rows: DataFrame, ids: DataFrame, key: str = "query_id", order: str = "path") -> DataFrame:
    """The first row of each id(query_id), whatever the case."""
    wanted = ids.select(F.upper("query_id").alias("_wanted")).distinct()
    return top(rows.join(wanted, F.upper(key) == F.col("_wanted")), ["_wanted"], [order], 1, "_turn").drop("_turn", "_wanted")
