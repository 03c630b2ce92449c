"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import os
import sys

import pytest
from conftest import SF_DIR

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as target  # noqa: E402
import check  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.mark.parametrize("name", sorted(target.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    line = check.compare(name, spark, SF_DIR, target.oracle_sql()[name])
    assert line.startswith("ok"), line
    assert "types" not in line, line


def test_entry_has_rows(spark):
    assert target.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(target.oracle_sql()) <= set(target.queries())
