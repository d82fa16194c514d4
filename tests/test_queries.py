"""Every registered query against its SQL, and the shape of those without one."""

from __future__ import annotations

import os

import pytest
from oracle import compare, connect

from prepmill.catalog import ENTRIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql is not None])
def test_equals_sql(spark, database, name):
    entry = ENTRIES[name]
    difference = compare(entry.run(spark, FOLDER), entry.sql, database)
    assert difference is None, difference


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql is None])
def test_returns_rows(spark, name):
    assert len(ENTRIES[name].run(spark, FOLDER).take(1)) == 1
