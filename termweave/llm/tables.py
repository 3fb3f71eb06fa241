"""Reading the given tables and cutting lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import clear, mark, scratch_dir, written

__all__ = ["clear", "mark", "read", "scratch_dir", "written"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
