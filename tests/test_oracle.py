"""Registered queries against their SQL on the small tables."""

import pytest
from compare import connect, spark_table, sql_table

from workload.queries import registered

QUERIES, ORACLE = registered()

# Every month report, 30-day table and operator; of the other runs what differs.
OTHER_RUNS = ("_week", "_biweek", "_day", "_excl", "_excl_code")
DIFFERING = ("fund_change_count", "repayment", "state_stock", "migration_rates", "structure_detail",
             "reloan_new_vs_cumulative", "overdue_by_province", "m30_overdue_interest", "text_output")
OPERATORS = ("snapshot_", "population_")


def _tested(name: str) -> bool:
    run = next((s for s in OTHER_RUNS if name.endswith(s)), None)
    return run is None or name.startswith(OPERATORS) or name.removesuffix(run) in DIFFERING


@pytest.fixture(scope="module")
def connection(data):
    return connect(data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", [n for n in QUERIES if _tested(n)])
def test_query_equals_sql(spark, data, connection, name):
    assert spark_table(QUERIES[name](spark, data)) == sql_table(connection, ORACLE[name])


def test_entry_has_rows(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
