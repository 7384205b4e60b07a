"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from compare import duck_result, spark_result
from tallyline.workload.oracle import ORACLE
from tallyline.workload.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, name):
    columns, rows = spark_result(REGISTRY[name](spark, SF_DIR))
    expected_columns, expected = duck_result(ORACLE[name], SF_DIR)
    assert columns == expected_columns
    assert rows == expected
    if name != "top_by_rating" and name != "dashboard_table":
        assert rows


def test_entry(spark):
    assert entry.entry(spark).count() == 10
