"""Every registered query against its SQL on the smallest tables."""

import pathlib
import re
import sys

import duckdb
import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402
from tools.check import compare  # noqa: E402

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def tables(small):
    con = duckdb.connect()
    for path in pathlib.Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    """Only training-data queries may lack SQL; tests of their own hold them against brute force."""
    missing = set(contract.queries()) - set(SQL)
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in missing)
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, tables, name):
    verdict = compare(spark, tables, name, contract.queries()[name], SQL[name], small)
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_entry(spark, small):
    assert contract.entry(spark).count() > 0
