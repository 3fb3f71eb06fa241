import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from termweave.operators import intervals

BASE = dt.date(2000, 1, 1)


def day(n):
    return None if n is None else BASE + dt.timedelta(days=n)


def ranged(spark, rows, names):
    return spark.createDataFrame([(p, i, day(s), day(e)) for i, (p, s, e) in enumerate(rows)], f"person_id long, {names}".format())


def sides(spark, a, b):
    return ranged(spark, a, "a int, start date, end date"), ranged(spark, b, "b int, other_start date, other_end date")


ranges_ = st.lists(st.tuples(st.sampled_from([1, 1, 2, None]), st.one_of(st.none(), st.integers(-50, 400)), st.one_of(st.none(), st.integers(-60, 60), st.sampled_from([1000, 5000, 40_000, 400_000]))), max_size=25)


@settings(max_examples=8, deadline=None)
@given(ranges_, ranges_)
def test_overlaps_equal_all_pairs(spark, a, b):
    span = lambda rows: [(p, s, None if e is None or s is None else s + e) for p, s, e in rows]
    a, b = span(a), span(b)
    fine = lambda r: None not in r and r[1] <= r[2]
    want = sorted((i, j, day(max(x[1], y[1])), day(min(x[2], y[2]))) for i, x in enumerate(a) for j, y in enumerate(b) if fine(x) and fine(y) and x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2])
    x, y = sides(spark, a, b)
    before = intervals.BUSY_PAIRS
    try:
        for intervals.BUSY_PAIRS in (before, 200, 0):  # no key meets in bins, some do, all do
            found = intervals.overlap_join(x.withColumn("_x", F.lit(1)), y)
            assert found.columns == ["person_id", "a", "start", "end", "_x", "b", "other_start", "other_end", "shared"]
            assert sorted((r.a, r.b, r.shared.start, r.shared.end) for r in found.collect()) == want
    finally:
        intervals.BUSY_PAIRS = before


def test_candidates_of_a_hot_person_grow_with_overlaps(spark):
    """50,000 rows of one person, some of them years long: pairs that meet in bins are a few times those that overlap."""
    n = 50_000
    rng = random.Random(1)
    rows = [(7, rng.randrange(200_000), None) for _ in range(n)]
    long = set(rng.sample(range(n), 20))
    rows = [(p, s, s + (rng.randrange(700) if i in long else rng.randrange(4))) for i, (p, s, _) in enumerate(rows)]
    a, b = sides(spark, rows, rows[: n // 2])
    overlaps = intervals.overlap_join(a, b).count()
    met = intervals.overlap_candidates(a, b).count()
    assert overlaps < met < 5 * overlaps < n * n / 2 / 500


@pytest.mark.parametrize("absolute", [False, True])
@pytest.mark.parametrize("n", [0, 1, 5])
def test_near_days_equal_all_pairs(spark, n, absolute):
    rng = random.Random(n)
    a, b = ([(rng.choice([1, 2, None]), rng.choice([None, *range(-20, 40)])) for _ in range(60)] for _ in range(2))
    frame = lambda rows, i, d: spark.createDataFrame([(p, k, day(x)) for k, (p, x) in enumerate(rows)], f"person_id long, {i} int, {d} date")
    found = intervals.within_days(frame(a, "a", "day"), frame(b, "b", "other_day"), n, absolute)
    apart = lambda x, y: abs(y - x) if absolute else y - x
    want = sorted((i, j, apart(x[1], y[1])) for i, x in enumerate(a) for j, y in enumerate(b) if None not in (*x, *y) and x[0] == y[0] and 0 <= apart(x[1], y[1]) <= n)
    assert sorted((r.a, r.b, r.days) for r in found.collect()) == want


def test_near_days_of_a_hot_person(spark):
    rows = spark.range(50_000).select(F.lit(7).alias("person_id"), F.date_add(F.lit(BASE), (F.col("id") * 3).cast("int")).alias("day"))
    other = rows.withColumnRenamed("day", "other_day")
    pairs = intervals.within_days(rows, other, 6).count()
    assert pairs == 3 * 50_000 - 3
    assert intervals.near_candidates(rows, other, 6).count() < 3 * pairs


def windowed_eras(events, gap):
    """Eras by one window over all events of a key."""
    of_key = Window.partitionBy("person_id", "c").orderBy("start", "end")
    rows = events.select("person_id", "c", "start", F.greatest("end", "start").alias("end")).withColumn("reached", F.max("end").over(of_key.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("new", F.when(F.col("reached").isNull() | (F.datediff("start", "reached") > gap), 1).otherwise(0))
    rows = rows.withColumn("idle", F.when(F.col("new") == 1, 0).otherwise(F.greatest(F.datediff("start", "reached") - 1, F.lit(0))))
    rows = rows.withColumn("era", F.sum("new").over(of_key.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy("person_id", "c", "era").agg(F.min("start").alias("era_start"), F.max("end").alias("era_end"), F.count("*").alias("n_events"), F.sum("idle").cast("long").alias("gap_days")).drop("era")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(0, 120), st.one_of(st.none(), st.integers(-3, 40))), max_size=40), st.integers(0, 10))
def test_eras_equal_one_window(spark, rows, gap):
    events = spark.createDataFrame([(1, c, day(s), None if e is None else day(s + e)) for c, s, e in rows], "person_id long, c long, start date, end date")
    assert sorted(intervals.eras(events, "c", gap).collect()) == sorted(windowed_eras(events, gap).collect())


def test_a_hot_key_costs_its_days(spark):
    """200,000 events of one key on 900 days: the windows see a row a day."""
    events = spark.range(200_000).select(F.lit(1).alias("person_id"), F.lit(9).alias("c"), F.date_add(F.lit(BASE), (F.col("id") % 900 * 5).cast("int")).alias("start"))
    events = events.withColumn("end", F.date_add("start", 2))
    found = intervals.eras(events, "c", 1).collect()
    assert len(found) == 900 and sum(r.n_events for r in found) == 200_000
    days = events.select("person_id", F.col("start").alias("day"), F.lit(2.0).alias("paid"))
    ahead = intervals.in_next(days, 4, total="paid").distinct().collect()
    assert len(ahead) == 900 and all(r.n_next in (222, 223) and r.total == 2 * r.n_next for r in ahead)
    for df in (intervals.eras(events, "c", 1), intervals.in_next(days, 5)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Window") < plan.index("Aggregate", plan.index("Window"))  # below every window the events of a day are one row


def test_counts_ahead_equal_a_range_frame(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, None]), day(rng.choice([None, *range(30)])), rng.choice([None, 1.5, 2.0])) for _ in range(200)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, person_id long, day date, paid double")
    frame = "over (partition by person_id order by day range between current row and interval 4 days following)"
    want = df.selectExpr("*", f"count(*) {frame} as n_next", f"sum(paid) {frame} as total")
    assert sorted(intervals.in_next(df, 4, total="paid").collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)
