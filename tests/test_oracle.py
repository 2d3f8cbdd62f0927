"""A cross-section of the queries against their SQL. `python -m verification.compare` runs all."""

import pytest

from __spark_entry__ import entry, queries
from verification.compare import compare, connect
from verification.oracle import ORACLE
from verification.queries import QUERIES

SELECTED = [
    "silver_transform",
    "mart_spending_by_department",
    "gold_marts_from_base",
    "amount_extremes",
    "profile_duplicates",
    "profile_dimensions",
    "profile_time_coverage",
    "stratified_sample",
    "raw_scan",
    "validate_gold_failing",
    "full_row_duplicates",
    "critical_missing_rows",
]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", SELECTED)
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) == ""


def test_findings_are_not_trivial(con):
    """The ledger holds what the checks look for."""
    row = con.execute(ORACLE["full_row_duplicates"]).fetchdf().iloc[0]
    assert row["duplicate_rows_beyond_first"] > 0
    assert con.execute(ORACLE["critical_examples"]).fetchall()
    assert con.execute(ORACLE["fiscal_year"] + " where fiscal_year is null").fetchall()
    statuses = {r[0] for r in con.execute(f'select status from ({ORACLE["validate_gold_failing"]})').fetchall()}
    assert len(statuses) == 4


def test_every_query_but_the_file_listing_has_sql():
    assert set(QUERIES) - set(ORACLE) == {"file_sizes"}
    assert set(ORACLE) <= set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 8


def test_plans_have_no_cross_join_and_no_python(spark, sf_dir):
    for name in SELECTED:
        plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan, name
