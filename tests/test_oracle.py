"""Every registered query against independent SQL on the same tables."""

import pytest
from conftest import SMALL, TINY

import __spark_entry__ as entry
from shopledger_checks.compare import SAME_TYPE, duckdb_rows, duckdb_types, spark_rows
from shopledger_checks.oracle import all_oracles
from shopledger_checks.registry import REPORTS, all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


def check(spark, con, key, directory):
    frame = QUERIES[key](spark, directory)
    assert {c: SAME_TYPE[kind] for c, kind in frame.dtypes} == duckdb_types(con, ORACLES[key])
    assert spark_rows(frame) == duckdb_rows(con, ORACLES[key])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_small(spark, duck, key):
    check(spark, duck(SMALL), key, SMALL)


@pytest.mark.parametrize("key", sorted(REPORTS))
def test_tiny_where_most_invoices_have_no_store(spark, duck, key):
    check(spark, duck(TINY), key, TINY)


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns[-1] == "avgSale"
    assert frame.count() == 1
