"""The driver contract."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from oracle import connect

import __spark_entry__ as contract
from prepmill.catalog import ENTRIES

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_is_registered_once():
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(ENTRIES) <= set(queries) and set(oracle) <= set(queries)
    assert len(oracle) > 80


def test_entry(spark):
    flagship = contract.entry(spark)
    assert flagship.columns == contract.entry(spark).columns
    assert flagship.count() > 0


@pytest.mark.parametrize("name", [n for n in contract.oracle_sql() if n in ENTRIES])
def test_column_types_are_those_of_the_sql(spark, database, name):
    described = database.execute(f"DESCRIBE {contract.oracle_sql()[name]}").fetchall()
    expected = {row[0]: row[1] for row in described}
    found = {column: TYPES[kind] for column, kind in contract.queries()[name](spark, FOLDER).dtypes}
    assert found == expected


@pytest.mark.parametrize("left", [None, "prepmill/llm", "prepmill/llm/__pycache__"])
def test_the_rest_works_without_the_operators_for_training_data(tmp_path, left):
    """Their folder may be gone, or be there without any source."""
    root = Path(contract.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "prepmill", tmp_path / "prepmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    if left:
        (tmp_path / left).mkdir(parents=True)
    code = "import __spark_entry__ as c; print(len(c.queries()), len(c.oracle_sql()), any(n.startswith('op1') for n in c.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert done.stdout.split() == [str(len(ENTRIES)), str(len([e for e in ENTRIES.values() if e.sql])), "False"], done.stderr
