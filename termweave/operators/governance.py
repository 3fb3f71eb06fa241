"""Conformance and privacy rules (L)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Endings of restricted columns, and columns that may not be shown.
RESTRICTED = ("_source_value", "_source_concept_id")
PRIVATE = ("subject_id", "person_id", "year_of_birth", "month_of_birth", "day_of_birth", "birth_datetime")
_ROW = "table_name string, column_name string, check_name string, n_failed long"


def conformance(tables: dict[str, DataFrame], required: dict[str, list[str]], foreign: list[tuple[str, str, str, str]]) -> DataFrame:
    """table_name, column_name, check_name, n_failed: nulls of required columns, required columns that lack, and orphans of foreign keys.

    One pass over a table counts the nulls of all its columns. A foreign key
    (table, column, other table, other column) is counted by its values first, in
    each task before the shuffle, so one anti-join compares distinct values, however
    many rows hold one.
    """
    out = []
    for name, columns in required.items():
        df = tables[name]
        held, lacking = [c for c in columns if c in df.columns], [c for c in columns if c not in df.columns]
        if lacking:
            out.append(df.sparkSession.createDataFrame([(name, c, "missing", 1) for c in lacking], _ROW))
        if held:
            counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in held))
            out.append(counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in held))).alias("x")).select(F.lit(name).alias("table_name"), F.col("x.c").alias("column_name"), F.lit("null").alias("check_name"), F.col("x.n").alias("n_failed")))
    for table, column, other, key in foreign:
        values = tables[table].where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        orphans = values.join(tables[other].select(F.col(key).alias(column)), column, "left_anti")
        out.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_failed")).select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit("orphan").alias("check_name"), "n_failed"))
    return reduce(DataFrame.unionByName, out)


def drop_restricted(df: DataFrame, allowed: tuple[str, ...] = ()) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.endswith(RESTRICTED) and c not in allowed))


def deidentify(df: DataFrame) -> DataFrame:
    """df, which may not show private columns."""
    shown = [c for c in df.columns if c.lower() in PRIVATE]
    if shown:
        raise ValueError(f"private columns in the result: {', '.join(shown)}")
    return df


def safe_agg(df: DataFrame, by: list[str], least: int | None = None, **aggregates: Column) -> DataFrame:
    """Aggregates by columns that may be shown; groups of fewer than `least` rows are left out."""
    rows = df.groupBy(*by).agg(F.count("*").alias("n_rows"), *(c.alias(n) for n, c in aggregates.items()))
    return deidentify(rows if least is None else rows.where(F.col("n_rows") >= least))
