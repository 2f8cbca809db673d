"""Edge cases on hand-made rows, and identities between reports."""

from datetime import date

import pytest
from compare import dims, facts, rows_by

from riskbook.schema import classified
from riskbook.sources.calendar import months_spanned
from riskbook.plans import lending, light, migration, month_30, overdue, reloan, structure, vintage
from riskbook.plans.cadence import BIWEEK, DAY, MONTH, WEEK, Options
from workload import queries as workload

JAN, FEB, MAR = date(2020, 1, 31), date(2020, 2, 29), date(2020, 3, 31)
OPTIONS = Options(detail_from=date(2020, 1, 1))


def test_settled_province_has_missing_rate_not_an_error(spark):
    df = facts(spark, {"OVERDUE_STATUS_3": 2, "LOAN_PR": 5}, {"OVERDUE_STATUS_3": 2, "LOAN_PR": 6})
    out = rows_by(overdue.overdue_by_province(df, dims(spark), MONTH), "code")
    assert out["3101"]["out_cnt"] == 0 and out["3101"]["od_rate"] is None
    assert out[None]["bal"] == 0 and out[None]["od_rate"] is None


def test_code_without_a_name_keeps_its_row(spark):
    df = facts(spark, {"PROV_CD": "9901", "CNT": 2, "BAL": 10}, {"CNT": 3, "BAL": 5})
    out = rows_by(lending.lending_by_province(df, dims(spark), MONTH), "code")
    assert (out["9901"]["name"], out["9901"]["cnt"]) == (None, 2)
    assert (out["3101"]["name"], out[None]["cnt"], out[None]["bal"]) == ("North", 5, 15)


def test_missing_code_is_left_out(spark):
    df = facts(spark, {"PROV_CD": None, "CNT": 2}, {"CNT": 3})
    out = rows_by(lending.lending_by_province(df, dims(spark), MONTH), "code")
    assert out[None]["cnt"] == 3


def test_size_class_without_overdue_keeps_missing_sums(spark):
    df = facts(
        spark,
        {"LOAN_PR_SCOPE": 1, "BAL": 10},
        {"LOAN_PR_SCOPE": 2, "OVERDUE_STATUS_3": 1, "BAL": 10, "OD_AMT": 4},
        {"LOAN_PR_SCOPE": 3, "OVERDUE_STATUS_3": 2},
    )
    out = rows_by(overdue.overdue_by_scope(df, dims(spark), MONTH), "loan_pr_scope")
    assert set(out) == {1, 2, None}
    assert (out[1]["od_amt"], out[1]["od_rate"], out[2]["od_rate"]) == (None, None, 0.4)
    assert (out[None]["od_amt"], out[None]["od_rate"]) == (4, 0.2)


def test_absent_state_is_zero_by_month_and_missing_by_day(spark):
    df = facts(spark, {"OVERDUE_STATUS_5": 1, "CNT": 4}, {"OVERDUE_STATUS_5": 3, "CNT": 1})
    month = structure.state_stock(df, None, MONTH).first()
    assert (month["cnt_0"], month["cnt_1"], month["cnt_2"], month["regular"]) == (0, 4, 0, 4)
    day = structure.state_stock(df, None, DAY).first()
    assert (day["cnt_0"], day["cnt_1"], day["cnt_2"], day["regular"]) == (None, 4, None, 4)
    share = structure.structure_count_share(df, None, MONTH).first()
    assert (share["normal_share"], share["ordinary_share"], share["collection_share"]) == (0.8, 0.0, 0.2)


def test_single_period_has_no_roll_rates_and_no_increment(spark):
    df = facts(spark, {"OVERDUE_STATUS_5": 0, "BAL": 5}, {"OVERDUE_STATUS_5": 2, "BAL": 15})
    assert migration.migration_rates(df, None, MONTH).count() == 0
    detail = rows_by(structure.structure_detail(df, None, MONTH, OPTIONS), "status")
    assert set(detail) == {"正常", "一般", "汇总"}
    assert (detail["一般"]["bal_share"], detail["汇总"]["bal_share"]) == (0.75, 1.0)


def test_roll_rates_use_the_stock_of_the_date_before(spark):
    df = facts(
        spark,
        {"DATA_DT": JAN, "OVERDUE_STATUS_5": 0, "CNT": 8},
        {"DATA_DT": JAN, "OVERDUE_STATUS_5": 2, "CNT": 4},
        # February has no flow at all; March still divides by February's stock.
        {"DATA_DT": FEB, "OVERDUE_STATUS_5": 2, "CNT": 10},
        {"DATA_DT": MAR, "OVERDUE_STATUS_5": 3, "OVERDUE_STATUS_5_LAST": 2, "CNT": 5},
    )
    (row,) = migration.migration_rates(df, None, WEEK).collect()
    assert (row["data_dt"], row["f_2_3"], row["f_2_3_rate"]) == ("2020-03-31", 5, 0.5)
    assert (row["regular_to_late"], row["regular_to_late_rate"]) == (0, None)


def test_increment_rows_are_changes_or_as_written_totals(spark):
    df = facts(spark, {"DATA_DT": JAN, "CNT": 3, "BAL": 10}, {"DATA_DT": FEB, "CNT": 5, "BAL": 4})
    change = rows_by(structure.structure_detail(df, None, MONTH, OPTIONS), "status")["增量"]
    assert (change["data_dt"], change["cnt"], change["bal"], change["cnt_share"]) == ("2020-02", 2, -6, None)
    written = Options(detail_from=OPTIONS.detail_from, true_increments=False)
    repeated = rows_by(structure.structure_detail(df, None, MONTH, written), "status")["增量"]
    assert (repeated["cnt"], repeated["bal"]) == (5, 4)
    assert "增量" not in rows_by(structure.structure_detail(df, None, DAY, OPTIONS), "status")


def test_detail_starts_at_its_floor(spark):
    df = facts(spark, {"DATA_DT": JAN}, {"DATA_DT": FEB})
    late = Options(detail_from=date(2020, 2, 1))
    assert {r["data_dt"] for r in structure.structure_detail(df, None, MONTH, late).collect()} == {"2020-02"}


def test_date_matching_no_part_of_a_report_is_left_out(spark):
    df = facts(
        spark,
        {"DATA_DT": JAN, "OVERDUE_STATUS_3": 2, "OVERDUE_STATUS_3_LAST": 2, "RELOANTIMES": 3},
        {"DATA_DT": FEB, "OVERDUE_STATUS_3": 1, "OVERDUE_STATUS_3_LAST": 0, "RELOANTIMES": 2},
    )
    for plan in (migration.fund_change_count, lending.termination_maturity, reloan.reloan_rate_by_date):
        assert plan(df, None, WEEK).count() == 1
    rate = reloan.reloan_rate_by_date(df, None, MONTH).first()
    assert (rate["second_cnt"], rate["settled_first_cnt"], rate["reloan_rate"]) == (1, None, None)


def test_two_begin_dates_in_a_month_are_one_row_by_month(spark):
    repeat = {"NEW_LOAN": 1, "RELOAN": 2, "RELOANTIMES": 2, "LOAN_PR": 10}
    df = facts(
        spark,
        {**repeat, "BEGIN_DATE": date(2020, 1, 3)},
        {**repeat, "BEGIN_DATE": date(2020, 1, 20)},
        {**repeat, "BEGIN_DATE": date(2020, 1, 20)},
        {"RELOAN": 1},
    )
    (month,) = reloan.reloan_new_vs_cumulative(df, None, MONTH).collect()
    assert (month["data_dt"], month["new_cnt"], month["new_loan_pr"], month["cum_cnt"]) == ("2020-01", 3, 30, 3)
    week = rows_by(reloan.reloan_new_vs_cumulative(df, None, WEEK), "data_dt")
    assert {k: (r["new_cnt"], r["cum_cnt"]) for k, r in week.items()} == {
        "2020-01-03": (1, None),
        "2020-01-20": (2, None),
        "2020-01-31": (None, 3),
    }


def test_titles_and_labels_by_cadence(spark):
    df = facts(spark, {"DATA_DT": MAR})
    month = lending.repayment(df, None, MONTH).first()
    assert (month["title"], month["data_dt"]) == ("3月回款", "2-3月汇总")
    for cadence in (WEEK, BIWEEK, DAY):
        row = lending.repayment(df, None, cadence).first()
        assert (row["title"], row["data_dt"]) == ("2020-03-31回款", "2020-03-31")


def test_light_without_green_loans(spark):
    df = facts(spark, {"LIGHT": 1, "BAL": 10}, {"LIGHT": 1, "BAL": 10, "OVERDUE_STATUS_3": 1, "OD_AMT": 5})
    row = light.light_by_date(df, None, MONTH).first()
    assert (row["all_cnt"], row["yellow_od_rate"], row["green_cnt"], row["green_od_rate"]) == (2, 0.25, 0, None)


def test_vintage_cells_and_cohort_floor(spark):
    df = facts(
        spark,
        {"DATA_DT": JAN, "BEGIN_DATE": JAN, "LOAN_M_CNT": 0, "NEW_AMT": 100, "OD_AMT": 0},
        {"DATA_DT": FEB, "BEGIN_DATE": JAN, "LOAN_M_CNT": 1, "OD_AMT": 25},
        {"DATA_DT": FEB, "BEGIN_DATE": FEB, "LOAN_M_CNT": 0, "NEW_AMT": 0, "OD_AMT": 7, "BRELOAN": 2},
        {"DATA_DT": FEB, "BEGIN_DATE": date(2019, 12, 31), "LOAN_M_CNT": 2, "OD_AMT": 9},
    )
    amounts = vintage.vintage(df, 2)
    by_cohort = rows_by(amounts, "begin_month")
    assert set(by_cohort) == {"2020-01", "2020-02"}
    assert (by_cohort["2020-01"]["m0"], by_cohort["2020-01"]["m1"], by_cohort["2020-02"]["m1"]) == (0, 25, None)
    rates = rows_by(vintage.vintage_rates(amounts), "begin_month")
    assert (rates["2020-01"]["m1"], rates["2020-02"]["m0"]) == (0.25, None)
    repeats = vintage.vintage(df, 2, which="BRELOAN_CLASS <> 1")
    assert [r["begin_month"] for r in repeats.collect()] == ["2020-02"]
    assert vintage.age_labels(3) == ["当月", "第2个月", "第3个月"]


def test_first_loan_non_performing_option(spark):
    df = facts(
        spark,
        {"RELOAN": 1, "MATURITY_DAYS": 3, "OD_AMT_30": 5, "LOAN_PR_FEE": 50},
        {"RELOAN": 2, "MATURITY_DAYS": 3, "OD_AMT_30": 7, "LOAN_PR_FEE": 70},
    )
    as_written = month_30.overdue_index(df, month_30.INTEREST).first()
    assert (as_written["first_bn_amt"], as_written["repeat_bn_amt"]) == (7, 7)
    meant = month_30.overdue_index(df, month_30.INTEREST, Options(first_bn_of_first_loans=True)).first()
    assert (meant["first_bn_amt"], meant["first_bn_rate"]) == (5, 0.1)


@pytest.mark.parametrize("population", ["all", "excl", "excl_code"])
def test_reports_agree_with_each_other(spark, data, population):
    df = workload.POPULATIONS[population](workload.cells(spark, data, "month"))
    codes = workload.dimension(spark, data)
    by_date = overdue.overdue_by_date(df, codes, MONTH).orderBy("data_dt").collect()
    last = by_date[-1]
    provinces = rows_by(overdue.overdue_by_province(df, codes, MONTH), "code")
    cities = rows_by(overdue.overdue_by_city(df, codes, MONTH), "code")
    for column in ("out_cnt", "bal", "od_cnt"):
        assert provinces[None][column] == cities[None][column] == last[column]
        assert sum(r[column] for k, r in provinces.items() if k) == provinces[None][column]
    for share in structure.structure_count_share(df, codes, MONTH).collect():
        assert sum(share[1:]) == pytest.approx(1)
    changes = {r["data_dt"]: r for r in migration.fund_change_count(df, codes, MONTH).collect()}
    for row in by_date[1:]:
        month = int(row["data_dt"][-2:])
        change = changes[f"{month - 1}-{month}月汇总"]
        assert change["new_overdue"] + change["t_0_1"] + change["t_1_1"] == row["od_cnt"]


def test_loans_and_cells_give_equal_reports(spark, data):
    loans, cells = classified(workload.snapshots(spark, data, "month")), workload.cells(spark, data, "month")
    codes = workload.dimension(spark, data)
    for plan in (overdue.overdue_by_province, reloan.reloan_overdue_by_date, reloan.reloan_rate_by_province,
                 lending.termination_maturity, reloan.reloan_new_vs_cumulative):
        both = [sorted(map(tuple, plan(f, codes, MONTH).collect()), key=repr) for f in (loans, cells)]
        assert both[0] == both[1]


def test_vintage_keeps_every_age_when_dates_have_gaps(spark):
    days = [date(2020, 1, 31), date(2020, 4, 30), date(2020, 10, 31)]
    rows = [
        {"DATA_DT": day, "BEGIN_DATE": begin, "OD_AMT": 10 + i, "NEW_AMT": 5, "LOAN_M_CNT": 12 * (day.year - begin.year) + day.month - begin.month}
        for i, day in enumerate(days)
        for begin in (date(2019, 12, 31), *days)
        if begin <= day
    ]
    df = facts(spark, *rows)
    ages = months_spanned(days)
    assert ages == 10
    amounts = vintage.vintage(df, ages)
    total = sum(v or 0 for r in amounts.collect() for k, v in r.asDict().items() if k.startswith("m"))
    assert total == sum(r["OD_AMT"] for r in rows if r["BEGIN_DATE"] >= days[0])
