"""Every registered query against its DuckDB counterpart."""

from __future__ import annotations

import pytest
from compare import differences

import __spark_entry__ as driver
from tristrata.workload.registry import ORACLES, QUERIES


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, sf_dir, name):
    assert differences(spark, sf_dir, name) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
