"""The registered queries: names, schemas and equality with their SQL on the smallest tables."""

import re

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as e
from tillworks.plans import catalog, oracle

SF_DIR = str(TESTDATA / "sf0.001")

pytestmark = pytest.mark.skipif(not (TESTDATA / "sf0.001").is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in (TESTDATA / "sf0.001").glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(e.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_sql(spark, duck, name):
    df = e.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    relation = duck.sql(e.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == want


def test_entry_runs(spark):
    assert e.entry(spark).count() > 0


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_month_report_reads_one_month_and_few_columns(spark):
    plan = plan_of(e.queries()["cashiers_below_target"](spark, SF_DIR))
    scan = next(l for l in plan.splitlines() if "FileScan" in l)
    assert "PartitionFilters: [isnotnull(sales_month" in scan
    assert "GreaterThanOrEqual(transaction_date" in scan
    schema = re.search(r"ReadSchema: struct<([^>]*)", scan).group(1)
    assert "receipt_number" not in schema and "discount" not in schema


@pytest.mark.parametrize("name", ["revenue_by_city", "payment_by_store", "daily_summary", "fk_orphans"])
def test_facts_are_scanned_once_and_totalled_before_the_join(spark, name):
    plan = plan_of(e.queries()[name](spark, SF_DIR))
    # Only the facts have a month.
    assert sum("FileScan" in l and "sales_month" in l for l in plan.splitlines()) == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_the_share_reuses_the_totals_of_its_own_query(spark):
    df = e.queries()["store_revenue_share"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = e.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
