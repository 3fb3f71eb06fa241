"""Interval analytics by bins and days, so that a person with very many rows is spread over tasks (K12, K14-K16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ranges
from ..sources.scratch import written

#: Pairs of a key's ranges beyond which they meet in bins.
BUSY_PAIRS = 1_000_000
#: Bins of a level are so many times as wide as those of the level below, whose bins are a day wide.
STEP = 8
#: Levels of bins; ranges longer than a bin of the last one touch several of them.
LEVELS = 6


def eras(events: DataFrame, concept: str, gap: int = 30) -> DataFrame:
    """Eras of each person and concept: events that overlap or lie at most `gap` days after all before them, with their count and the days between.

    The running end is the greatest so far, so events within others don't end an
    era. An end before its start counts as the start. Events of one start always
    share an era, so they are joined first, before the shuffle too; a window holds
    a row for each day on which a person's events begin, however many these are.
    """
    key = ["person_id", concept]
    days = events.select(*key, "start", F.greatest("end", "start").alias("end")).groupBy(*key, "start").agg(F.max("end").alias("end"), F.count("*").alias("n"))
    of_key = Window.partitionBy(*key).orderBy("start")
    rows = days.withColumn("reached", F.max("end").over(of_key.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("new", F.when(F.col("reached").isNull() | (F.datediff("start", "reached") > gap), 1).otherwise(0))
    rows = rows.withColumn("idle", F.when(F.col("new") == 1, 0).otherwise(F.greatest(F.datediff("start", "reached") - 1, F.lit(0)))).withColumn("era", F.sum("new").over(of_key.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*key, "era").agg(F.min("start").alias("era_start"), F.max("end").alias("era_end"), F.sum("n").alias("n_events"), F.sum("idle").cast("long").alias("gap_days")).drop("era")


def _day(date: Column) -> Column:
    return F.unix_date(date.cast("date")).cast("long")


def _at(day: Column, level: Column) -> Column:
    """The bin of a day."""
    return F.floor(day / F.element_at(F.array(*(F.lit(STEP**i) for i in range(LEVELS))), level + 1)).cast("long")


def _own_level(start: Column, end: Column) -> Column:
    """The first level whose bins are as wide as the range, so that it touches two of them at most."""
    days = _day(end) - _day(start) + 1
    return sum((F.when(days > STEP**i, 1).otherwise(0) for i in range(LEVELS - 1)), F.lit(0))


def _binned(df: DataFrame, start: str, end: str, own_marks: str, above_marks: str) -> DataFrame:
    """df in each bin that a range touches: of its own level, with each of own_marks, and of the levels above, with each of above_marks."""
    first, last = _day(F.col(start)), _day(F.col(end))
    bins = lambda level, marks: F.flatten(F.transform(F.sequence(_at(first, level), _at(last, level)), lambda b: F.transform(marks, lambda m: F.struct(level.alias("_level"), b.alias("_bin"), m.alias("_role")))))
    own = _own_level(F.col(start), F.col(end))
    above = F.filter(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda level: level > own)
    at_own, at_above = (F.array(*map(F.lit, marks)) for marks in (own_marks, above_marks))
    return df.withColumn("_at", F.explode(F.concat(bins(own, at_own), F.flatten(F.transform(above, lambda level: bins(level, at_above)))))).select(*df.columns, "_at.*")


def overlap_candidates(a: DataFrame, b: DataFrame, key: str = "person_id") -> DataFrame:
    """Pairs of a(key, start, end, ...) and b(key, other_start, other_end, ...) that meet in the bin of the later start.

    A range stands in the bins of its own level, whose width fits its length, and
    in those of the coarser levels. Two ranges meet at the coarser one of their own
    levels only: role 1 pairs a's own level with all of b, role 2 b's own with what
    of a is finer. So rows that no long range is near to don't meet in wide bins,
    and overlapping ranges meet once.
    """
    x = _binned(a.where("start <= end"), "start", "end", "1", "2")
    y = _binned(b.where("other_start <= other_end"), "other_start", "other_end", "12", "1")
    once = F.col("_bin") == _at(F.greatest(_day(F.col("start")), _day(F.col("other_start"))), F.col("_level"))
    return x.join(y, [key, "_level", "_bin", "_role"]).where(once).drop("_level", "_bin", "_role")


def overlap_join(a: DataFrame, b: DataFrame, key: str = "person_id") -> DataFrame:
    """Pairs of a(key, start, end, ...) and b(key, other_start, other_end, ...) whose ranges meet, with their intersection.

    The ranges of a key of few rows are paired as they are; those of a key of very
    many meet in bins, so that their work grows with what overlaps. Null keys and
    ends, and ranges that start after their end, meet nothing.
    """
    a, b = a.where("start <= end"), b.where("other_start <= other_end")
    sizes = a.groupBy(key).agg(F.count("*").alias("n")).join(b.groupBy(key).agg(F.count("*").alias("m")), key)
    busy = written(sizes.where(F.col("n") * F.col("m") > BUSY_PAIRS).select(key))
    if busy.isEmpty():
        both = a.join(b, key)
    else:
        both = a.join(busy, key, "left_anti").join(b, key).union(overlap_candidates(a.join(busy, key, "left_semi"), b.join(busy, key, "left_semi"), key))
    x, y = ranges.date_range(F.col("start"), F.col("end")), ranges.date_range(F.col("other_start"), F.col("other_end"))
    return both.where(ranges.overlaps(x, y)).withColumn("shared", ranges.intersection(x, y))


def near_candidates(a: DataFrame, b: DataFrame, n: int, absolute: bool = False, key: str = "person_id") -> DataFrame:
    """Pairs of a(key, day) and b(key, other_day) in bins of n + 1 days: b's bin is a's, the next, or for either side the one before."""
    at = lambda c: F.floor(_day(F.col(c)) / (n + 1)).cast("long")
    x = a.withColumn("_bin", F.explode(F.sequence(at("day") - (1 if absolute else 0), at("day") + 1)))
    return x.join(b.withColumn("_bin", at("other_day")), [key, "_bin"])


def within_days(a: DataFrame, b: DataFrame, n: int, absolute: bool = False, key: str = "person_id") -> DataFrame:
    """Pairs of a(key, day) and b(key, other_day): b at most n days after a, or on either side. Null keys and days are near nothing."""
    days = ranges.days_between(F.col("day"), F.col("other_day"), absolute)
    return near_candidates(a, b, n, absolute, key).drop("_bin").withColumn("days", days).where(F.col("days").between(0, n))


def in_next(events: DataFrame, n: int, key: str = "person_id", day: str = "day", count: str = "n_next", **sums: str) -> DataFrame:
    """events with the number of the key's events from their day to n days later, and sums (name=column) over these.

    Events of a day are joined first, so a window holds a row a day, and a frame n
    days. Rows without a day count those of their key; rows without a key are one key.
    """
    daily = events.groupBy(F.col(key).alias("_key"), F.col(day).alias("_day")).agg(F.count("*").alias(count), *(F.sum(c).alias(name) for name, c in sums.items()))
    frame = f"over (partition by _key order by _day range between current row and interval {int(n)} days following)"
    ahead = daily.selectExpr("_key", "_day", *(f"sum({c}) {frame} as {c}" for c in (count, *sums)))
    return events.join(ahead, F.col(key).eqNullSafe(F.col("_key")) & F.col(day).eqNullSafe(F.col("_day"))).drop("_key", "_day")
