"""Clinical-table analytics (K)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._rank import maybe_broadcast


def below_or_equal(closure: DataFrame, ids: DataFrame) -> DataFrame:
    """concept_id of the ids and all their descendants."""
    return closure.join(ids.select(F.col("concept_id").alias("ancestor_concept_id")).distinct(), "ancestor_concept_id", "left_semi").select(F.col("descendant_concept_id").alias("concept_id")).distinct()


def patients_with(occurrences: DataFrame, closure: DataFrame, ids: DataFrame, concept: str) -> DataFrame:
    """Persons with an occurrence of a concept or one below it."""
    wanted = below_or_equal(closure, ids).withColumnRenamed("concept_id", concept)
    return occurrences.join(wanted, concept, "left_semi").select("person_id").distinct()


def patients_by_birth_year(person: DataFrame) -> DataFrame:
    return person.groupBy("year_of_birth").agg(F.count("*").alias("n"))


def avg_measurement_by_gender(person: DataFrame, measurement: DataFrame) -> DataFrame:
    return measurement.join(person.select("person_id", "gender_concept_id"), "person_id").groupBy("measurement_concept_id", "gender_concept_id").agg(F.round(F.avg("value"), 6).alias("avg_value"), F.count("*").alias("n"))


def with_person(person: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.join(person, "person_id")


def visits_of(visit: DataFrame, concept_id: int = 9201) -> DataFrame:
    return visit.where(F.col("visit_concept_id") == concept_id)


def rows_during_visit(visit: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.join(visit.select("visit_id", "visit_concept_id", F.col("start").alias("visit_start")), "visit_id")


def condition_cohort(concepts: DataFrame, edges: DataFrame, closure: DataFrame, occurrences: DataFrame, codes: DataFrame, domain: str, concept: str, before=None) -> DataFrame:
    """Persons and first dates of a code set: codes(concept_code, vocabulary_id) to standard concepts, to what is below, to occurrences."""
    from .mapping import standardise

    found = concepts.join(codes, ["concept_code", "vocabulary_id"], "left_semi").select("concept_id")
    fine = concepts.where("standard_concept = 'S' and invalid_reason is null").where(F.col("domain_id") == domain).select("concept_id")
    wanted = below_or_equal(closure, standardise(edges, found)).join(fine, "concept_id", "left_semi").withColumnRenamed("concept_id", concept)
    rows = occurrences if before is None else occurrences.where(F.col("start") < before)
    return rows.join(wanted, concept, "left_semi").select("person_id", "start").distinct()


def cost_by(cost: DataFrame, events: DataFrame, event_key: str, label: str, domain: str) -> DataFrame:
    """Sum paid of a domain's events by a label column."""
    return cost.where(F.col("cost_domain_id") == domain).join(events.withColumnRenamed(event_key, "cost_event_id"), "cost_event_id").groupBy(label).agg(F.round(F.sum("total_paid"), 2).alias("total_paid"))


def avg_cost_by_payer(cost: DataFrame, events: DataFrame, payer: DataFrame) -> DataFrame:
    return cost.join(events.select(F.col("visit_id").alias("cost_event_id"), "person_id"), "cost_event_id").join(payer, "person_id").groupBy("payer").agg(F.round(F.avg("total_paid"), 2).alias("avg_paid"), F.count("*").alias("n"))


def long_eras(eras: DataFrame, concept: str, days: int) -> DataFrame:
    """Distinct persons with an era of more than `days` days, by concept."""
    return eras.where(F.datediff("era_end", "era_start") > days).groupBy(concept).agg(F.countDistinct("person_id").alias("n_persons"))


def event_cost(cost: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Cost rows with the person of their event, which the domain names the table of: {domain: (table, key)}."""
    one = lambda domain, table, key: cost.where(F.col("cost_domain_id") == domain).join(table.select(F.col(key).alias("cost_event_id"), "person_id"), "cost_event_id")
    return reduce(DataFrame.unionByName, (one(d, t, k) for d, (t, k) in tables.items()))


def cohort_demographics(cohort: DataFrame, person: DataFrame) -> DataFrame:
    """Distinct subjects of each cohort by gender, of cohort(cohort_id, person_id)."""
    return cohort.join(person.select("person_id", "gender_concept_id"), "person_id").groupBy("cohort_id", "gender_concept_id").agg(F.countDistinct("person_id").alias("n_subjects"))


def dose_eras(exposures: DataFrame, concept: str, dose: str, order: list[str]) -> DataFrame:
    """Runs of the same dose of each person and concept in the given order."""
    by = Window.partitionBy("person_id", concept).orderBy(*order)
    rows = exposures.withColumn("new", F.when(F.lag(dose).over(by).eqNullSafe(F.col(dose)) & (F.row_number().over(by) > 1), 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("person_id", concept, "run", dose).agg(F.min("start").alias("era_start"), F.max("end").alias("era_end"), F.count("*").alias("n_events")).drop("run")


def in_observation(events: DataFrame, periods: DataFrame, before: int = 0, after: int = 0) -> DataFrame:
    """Events within their person's period, with `before` and `after` days of it on either side."""
    rows = events.join(periods, "person_id")
    return rows.where((F.date_add("period_start", before) <= F.col("start")) & (F.col("start") <= F.date_sub("period_end", after)))


def named(df: DataFrame, concepts: DataFrame, columns: list[str]) -> DataFrame:
    """df with a name beside each concept column; 0 is unmapped."""
    for column in columns:
        names = maybe_broadcast(concepts.select(F.col("concept_id").alias(column), F.col("concept_name").alias("_name")))
        df = df.join(names, column, "left").withColumn(column.removesuffix("_concept_id") + "_name", F.when(F.col(column) == 0, F.lit("unmapped")).otherwise(F.col("_name"))).drop("_name")
    return df
