"""Every registered query against its SQL answer, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import SMALLEST, entry, oracle_sql, queries
from tools.check import compare, database
from workload.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert compare(queries()[name](spark, SMALLEST), database(SMALLEST),
                   oracle_sql()[name]) == ""


def test_every_answer_has_a_query(spark):
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0
