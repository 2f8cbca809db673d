"""Plan shapes that must hold on a cluster, and very uneven keys."""

from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from compare import connect, spark_table, sql_table

from riskbook.sources.shared import shared_folder
from riskbook.schema import ATTRIBUTES, FACTS, require_columns
from riskbook.sources.tables import read_snapshots
from workload import book
from workload.queries import cells, registered, snapshots

QUERIES, ORACLE = registered()


def physical(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@pytest.fixture
def large_sides(spark):
    """Plans as for tables too large to broadcast."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for s in settings:
        spark.conf.set(s, "-1")
    yield
    for s in settings:
        spark.conf.unset(s)


@pytest.mark.parametrize("cadence", ["month", "history"])
def test_state_and_prior_state_need_no_shuffle_or_sort_after_the_ledger_join(spark, data, large_sides, cadence):
    plan = physical(snapshots(spark, data, cadence))
    top = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line)
    assert not [line for line in plan[:top] if "Exchange" in line or "Sort" in line or "Window" in line]
    assert not [line for line in plan if "NestedLoop" in line or "Cartesian" in line]


def test_lines_are_combined_before_they_move(spark, data, large_sides):
    plan = physical(snapshots(spark, data, "month"))
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "l_orderkey" in line)
    below = [line for line in plan[:scan] if "Exchange" in line or "partial_sum" in line]
    assert "partial_sum" in below[-1] and "l_linenumber" in below[-2]
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan[scan]


def test_reports_read_only_their_columns_and_shuffle_sums(spark, data):
    plan = physical(QUERIES["overdue_by_date"](spark, data))
    assert sum("Exchange" in line for line in plan) == 1
    scan = next(line for line in plan if "FileScan" in line)
    read = scan.split("ReadSchema: struct<")[1]
    assert "LIGHT" not in read and "DIFF_OD_AMT" not in read
    assert any("partial_sum" in line for line in plan)


def test_newest_date_prunes_partitions(spark, data):
    plan = physical(QUERIES["overdue_by_province"](spark, data))
    scan = next(line for line in plan if "FileScan" in line and "OVERDUE_STATUS_3" in line)
    assert "DATA_DT" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


@pytest.fixture(scope="module")
def uneven(data, tmp_path_factory):
    """The tables with a third of all orders on one customer and a third of all lines on one order."""
    folder = tmp_path_factory.mktemp("uneven")
    for name in ("nation", "customer"):
        pq.write_table(pq.read_table(f"{data}/{name}.parquet"), folder / f"{name}.parquet")
    orders = pq.read_table(f"{data}/orders.parquet")
    every_third = pa.array([i % 3 == 0 for i in range(len(orders))])
    customer = pc.if_else(every_third, pa.scalar(7, pa.int64()), orders["o_custkey"])
    orders = orders.set_column(orders.schema.get_field_index("o_custkey"), "o_custkey", customer)
    pq.write_table(orders, folder / "orders.parquet")
    lines = pq.read_table(f"{data}/lineitem.parquet")
    early = orders.take(pc.sort_indices(orders["o_orderdate"])[:1])["o_orderkey"][0].as_py()
    every_third = pa.array([i % 3 == 0 for i in range(len(lines))])
    order = pc.if_else(every_third, pa.scalar(early, pa.int64()), lines["l_orderkey"])
    lines = lines.set_column(lines.schema.get_field_index("l_orderkey"), "l_orderkey", order)
    pq.write_table(lines, folder / "lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["snapshot_month", "overdue_by_city", "reloan_overdue_by_date", "fund_change_amount"])
def test_uneven_keys_give_the_same_results(spark, uneven, large_sides, name):
    assert spark_table(QUERIES[name](spark, uneven)) == sql_table(connect(uneven), ORACLE[name])


@pytest.fixture(scope="module")
def uneven_day(data, uneven, tmp_path_factory):
    """The tables with a third of all orders on one customer and one day, a few of them at other times of that day."""
    folder = tmp_path_factory.mktemp("uneven_day")
    for name in ("nation", "customer", "lineitem"):
        pq.write_table(pq.read_table(f"{data}/{name}.parquet"), folder / f"{name}.parquet")
    orders = pq.read_table(f"{data}/orders.parquet")
    chosen = pa.array([i % 3 == 0 for i in range(len(orders))])
    customer = pc.if_else(chosen, pa.scalar(7, pa.int64()), orders["o_custkey"])
    times = [datetime(2001, 5, 9) + timedelta(minutes=i % 7 if i % 5 == 0 else 0) for i in range(len(orders))]
    day = pc.if_else(chosen, pa.array(times, orders.schema.field("o_orderdate").type), orders["o_orderdate"])
    orders = orders.set_column(orders.schema.get_field_index("o_custkey"), "o_custkey", customer)
    orders = orders.set_column(orders.schema.get_field_index("o_orderdate"), "o_orderdate", day)
    pq.write_table(orders, folder / "orders.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["snapshot_month", "reloan_overdue_by_date"])
def test_uneven_day_gives_the_same_results(spark, uneven_day, large_sides, monkeypatch, name):
    monkeypatch.setattr(book, "KEYS_IN_A_PART", 64)
    assert spark_table(QUERIES[name](spark, uneven_day)) == sql_table(connect(uneven_day), ORACLE[name])


def test_orders_of_an_uneven_day_meet_in_bounded_parts(spark, uneven_day, large_sides, monkeypatch):
    monkeypatch.setattr(book, "KEYS_IN_A_PART", 64)
    loans = book._loans(spark, uneven_day, date(2001, 8, 31))
    day = spark.read.parquet(f"{uneven_day}/orders.parquet").groupBy("o_custkey", "o_orderdate").count()
    assert day.agg({"count": "max"}).first()[0] > 64 * 3
    plan = physical(loans)
    windows = [line.split("windowspecdefinition(")[1] for line in plan if "Window [" in line]
    ranked = [w for w in windows if w.split(" ASC")[0].count("#") >= 5]
    # rows are numbered by customer, day, time and part; the other windows run over counts
    assert len(windows) == 3 and len(ranked) == 1 and "row_number" in "".join(line for line in plan if "Window [" in line)
    parts = spark.read.parquet(f"{uneven_day}/orders.parquet").selectExpr("o_custkey", "o_orderdate", "floor(o_orderkey / 64) AS part")
    assert parts.groupBy(*parts.columns).count().agg({"count": "max"}).first()[0] <= 64
    joins = [line for line in plan if "SortMergeJoin" in line and "part" in line]
    assert joins and "part" in joins[0]  # the orders' own join is by part as well


def test_uneven_order_is_one_row_per_line_number_when_joined(spark, uneven):
    from workload.book import _lines

    largest = _lines(spark, uneven).groupBy("l_orderkey").count().agg({"count": "max"}).first()[0]
    numbers = spark.read.parquet(f"{uneven}/lineitem.parquet").select("l_linenumber").distinct().count()
    assert largest <= numbers


@pytest.mark.parametrize(("cadence", "share"), [("week", 0.5), ("day", 0.5)])
def test_cells_are_fewer_than_loans(spark, data, cadence, share):
    # Far fewer as the book grows: README has the figures at a larger scale.
    loans = snapshots(spark, data, cadence)
    assert cells(spark, data, cadence).count() < share * loans.count()
    assert cells(spark, data, cadence).agg({"CNT": "sum"}).first()[0] == loans.count()


def test_cells_keep_attribute_values_and_are_no_snapshots(spark, data, tmp_path):
    loans, found = snapshots(spark, data, "month"), cells(spark, data, "month")
    for name in set(ATTRIBUTES) & set(found.columns):
        assert found.select(name).distinct().exceptAll(loans.select(name).distinct()).count() == 0
    with pytest.raises(ValueError, match="MATURITY_DAYS"):
        require_columns(found, FACTS)
    found.write.parquet(str(tmp_path / "cells"))
    with pytest.raises(ValueError, match="RELOAN"):
        read_snapshots(spark, str(tmp_path / "cells"))


def test_shared_folder_is_the_one_the_cluster_names():
    def session(**conf):
        return SimpleNamespace(conf=conf)

    assert shared_folder(session(**{"spark.checkpoint.dir": "hdfs://shared/run/"})) == "hdfs://shared/run"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session())


def test_latest_of_a_known_date_reads_the_tables_once(spark, data, large_sides):
    plan = "\n".join(physical(QUERIES["latest_snapshot"](spark, data)))
    assert plan.count("lineitem.parquet") == 1
    # The ledger itself reads orders for day counts and for the orders: no more than that.
    ledger = "\n".join(physical(snapshots(spark, data, "month")))
    assert plan.count("orders.parquet") == ledger.count("orders.parquet")


def test_newest_province_report_has_no_scan_for_the_maximum(spark, data):
    plan = "\n".join(physical(QUERIES["light_by_province"](spark, data)))
    assert "max(" not in plan and "Subquery" not in plan


@pytest.mark.parametrize("name", ["vintage_rate", "vintage_amount_history", "vintage_rate_excl"])
def test_cohorts_are_summed_by_two_keys_in_one_scan(spark, data, name):
    plan = physical(QUERIES[name](spark, data))
    assert sum("FileScan" in line for line in plan) == 1 and not any("Subquery" in line for line in plan)
    large = next(line for line in reversed(plan) if "HashAggregate" in line)  # the one next to the scan
    keys, sums = large.split("keys=[")[1].split("]")[0], large.split("functions=[")[1]
    assert keys.count("#") == 2 and sums.count("partial_sum") == 2
    # the first date comes from the stored folders' names; a population of its own brings it along
    assert ("min(" in "".join(plan)) == name.endswith("_excl")
    if not name.endswith("_excl"):
        scan = next(line for line in plan if "FileScan" in line)
        assert "GreaterThanOrEqual(BEGIN_DATE" in scan


def test_stored_dates_come_from_the_folders(spark, data):
    from riskbook.sources.tables import stored_dates
    from workload.queries import cells_path

    found = {r[0] for r in cells(spark, data, "month").select("DATA_DT").distinct().collect()}
    assert set(stored_dates(spark, cells_path(spark, data, "month"))) == found
    assert stored_dates(spark, "/no/such/folder") == []
