import os

import pytest

from termweave import queries

from .oracle import connect, rows, twin

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables aren't here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_duckdb(spark, con, name):
    assert rows(queries.queries()[name](spark, SF)) == twin(con, queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(queries.queries().keys() - queries.oracle_sql().keys()))
def test_runs(spark, name):
    assert queries.queries()[name](spark, SF).count() >= 0


def test_partitions_do_not_matter(spark, con):
    name = "f5_common_parents"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(rows(queries.queries()[name](spark, SF)))
        assert found[0] == found[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
