"""Date ranges as structs of start and end (SC8-SC10); a range is empty when it starts after its end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_range(start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"))


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] <= b["end"]) & (b["start"] <= a["end"])


def intersection(a: Column, b: Column) -> Column:
    return date_range(F.greatest(a["start"], b["start"]), F.least(a["end"], b["end"]))


def is_empty(a: Column) -> Column:
    return a["start"] > a["end"]


def days_between(a: Column, b: Column, absolute: bool = False) -> Column:
    days = F.datediff(b, a).cast("long")
    return F.abs(days) if absolute else days
