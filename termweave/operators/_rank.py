"""Ranking and broadcasting shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows up to which a query side is broadcast; larger sides are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Rows that a task gets, about, of a table dealt by key.
PART_ROWS = 500_000


def top(df: DataFrame, keys: list[str], order: list[Column | str], k: int | None, name: str = "rank") -> DataFrame:
    """The first k rows of each key in the given order, numbered from 1."""
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    return ranked if k is None else ranked.where(F.col(name) <= k)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most `rows` rows, found by reading no more than one beyond."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if small(df, rows) else df


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df, of about so many rows, dealt by keys to as many tasks as they need, however few the session's settings would take; a small one stays as it is."""
    parts = -(-rows // PART_ROWS)
    return df if parts <= 1 else df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), *keys)
