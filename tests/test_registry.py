"""Every registered query against its SQL counterpart, all rows and columns."""

import pytest

import __spark_entry__ as registry
import check
from oracles import ORACLES

SF = "/root/testdata/sf0.001"


def test_every_query_has_a_counterpart():
    assert set(ORACLES) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("key", list(ORACLES))
def test_rows_are_equal(spark, key):
    assert check.compare(spark, SF, key).startswith("equal")


def test_the_flagship_query(spark):
    assert registry.entry(spark).count() > 100
