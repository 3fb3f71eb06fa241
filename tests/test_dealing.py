"""Tables are dealt to as many tasks as their rows need, whatever the session's number is."""

import os

import pytest

from termweave import queries
from termweave.operators import _rank

from .oracle import connect, rows, twin

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables aren't here")


def test_dose_eras_take_more_tasks_as_rows_grow(spark, monkeypatch):
    monkeypatch.setattr(_rank, "PART_ROWS", 500)
    found = queries.queries()["k13_dose_era"](spark, SF)
    assert found.rdd.getNumPartitions() == 12  # of 6,000 rows; the session's number is 4
    assert rows(found) == twin(connect(SF), queries.oracle_sql()["k13_dose_era"])


def test_traced_mappings_join_only_what_is_open(spark, monkeypatch):
    monkeypatch.setattr(_rank, "PART_ROWS", 300)
    found = queries.queries()["d2_trace_mapping"](spark, SF)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1  # the last hop's; ended rows, with no next concept, are in none
    assert rows(found) == twin(connect(SF), queries.oracle_sql()["d2_trace_mapping"])
