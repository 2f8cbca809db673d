from datetime import date

import pytest
from compare import rows_by

from riskbook.sources import snapshot
from riskbook.schema import ATTRIBUTES, FACTS, LEDGER, MEASURES
from riskbook.sources.calendar import Period
from riskbook.sources.snapshot import build_snapshots, compact_ledger, to_cells

JAN, FEB, MAR = date(2020, 1, 31), date(2020, 2, 29), date(2020, 3, 31)
PERIODS = [Period(JAN, date(2019, 12, 31)), Period(FEB, JAN), Period(MAR, FEB)]


def ledger(spark, *rows):
    """Rows of (loan, begin, amount, due, paid); one customer, one place."""
    values = [(loan, 5, 7, 2, begin, 1, amount, due, paid) for loan, begin, amount, due, paid in rows]
    return spark.createDataFrame(values, LEDGER)


def states(spark, *rows, **options):
    built = build_snapshots(ledger(spark, *rows), PERIODS, **options)
    return {(r["LOAN_ID"], r["DATA_DT"]): r for r in built.collect()}


def test_schema_is_the_documented_one(spark):
    built = build_snapshots(ledger(spark), PERIODS)
    assert built.columns == ["LOAN_ID", *ATTRIBUTES, *MEASURES]
    assert [f.dataType for f in built.schema.fields[1:]] == [f.dataType for f in FACTS.fields]


def test_loan_appears_from_the_first_date_on_or_after_its_start(spark):
    seen = states(
        spark,
        (1, FEB, 100, date(2020, 3, 30), None),
        (2, date(2020, 3, 1), 100, date(2020, 3, 30), None),
        (3, date(2020, 4, 1), 100, date(2020, 5, 1), None),
    )
    assert sorted(seen) == [(1, FEB), (1, MAR), (2, MAR)]
    assert seen[1, FEB]["NEW_LOAN"] == 1 and seen[1, MAR]["NEW_LOAN"] == 0
    assert seen[1, FEB]["NEW_AMT"] == 100 and seen[1, MAR]["NEW_AMT"] == 0


def test_due_on_the_date_is_not_late_and_paid_on_the_date_is_paid(spark):
    seen = states(
        spark,
        (1, date(2020, 1, 1), 100, JAN, None),
        (2, date(2020, 1, 1), 100, date(2020, 1, 20), JAN),
    )
    assert seen[1, JAN]["OVERDUE_STATUS_3"] == 0 and seen[1, JAN]["MATURITY_DAYS"] == 0
    assert seen[1, FEB]["OVERDUE_STATUS_3"] == 1 and seen[1, FEB]["MATURITY_DAYS"] == 29
    assert seen[2, JAN]["OVERDUE_STATUS_3"] == 2 and seen[2, JAN]["BAL"] == 0


@pytest.mark.parametrize(
    ("late_days", "state", "is_30", "terminated"),
    [(0, 0, 0, 0), (1, 1, 0, 0), (3, 1, 0, 0), (4, 2, 0, 0), (29, 2, 0, 0), (30, 2, 1, 0), (31, 3, 1, 0), (60, 3, 1, 0), (61, 4, 1, 1)],
)
def test_status_limits(spark, late_days, state, is_30, terminated):
    due = date.fromordinal(MAR.toordinal() - late_days)
    row = states(spark, (1, date(2020, 1, 1), 1000, due, None))[1, MAR]
    assert (row["OVERDUE_STATUS_5"], row["OVERDUE_STATUS_3_30"], row["STATUS_THIS_MONTH"]) == (state, is_30, terminated)
    assert row["OD_AMT"] == (1050 if late_days else 0)
    assert row["OD_AMT_30"] == (1050 if is_30 else 0)
    assert row["LOAN_PR_FEE"] == 1060


def test_prior_state_comes_from_the_date_before_and_is_missing_at_first(spark):
    seen = states(spark, (1, date(2020, 1, 1), 1000, date(2020, 2, 10), date(2020, 3, 5)))
    assert [seen[1, d]["OVERDUE_STATUS_3"] for d in (JAN, FEB, MAR)] == [0, 1, 2]
    assert [seen[1, d]["OVERDUE_STATUS_3_LAST"] for d in (JAN, FEB, MAR)] == [None, 0, 1]
    assert [seen[1, d]["DIFF_OD_AMT"] for d in (JAN, FEB, MAR)] == [0, 1050, -1050]
    assert [seen[1, d]["DIFF_SP_AMT"] for d in (JAN, FEB, MAR)] == [0, 1000, 0]
    assert [seen[1, d]["DIFF_AP_AMT"] for d in (JAN, FEB, MAR)] == [0, 0, 1000]


@pytest.mark.parametrize("per_row", [1, 2, 8])
def test_dates_per_row_do_not_change_results(spark, monkeypatch, per_row):
    rows = [
        (1, date(2020, 1, 1), 1000, date(2020, 2, 10), date(2020, 3, 5)),
        (2, date(2020, 2, 3), 500, date(2020, 2, 20), None),
        (3, date(2020, 3, 31), 700, date(2020, 5, 20), None),
    ]
    whole = {k: tuple(r) for k, r in states(spark, *rows).items()}
    monkeypatch.setattr(snapshot, "DATES_PER_ROW", per_row)
    assert {k: tuple(r) for k, r in states(spark, *rows).items()} == whole
    assert len(whole) == 3 + 2 + 1


def test_newest_date_alone_keeps_its_prior_state(spark):
    rows = [(1, date(2020, 1, 1), 1000, date(2020, 2, 10), date(2020, 3, 5))]
    whole = states(spark, *rows)
    alone = build_snapshots(ledger(spark, *rows), PERIODS[1:], keep=[MAR]).collect()
    assert [tuple(r) for r in alone] == [tuple(whole[1, MAR])]


def test_cohort_date(spark):
    loan = (1, date(2020, 1, 15), 10, FEB, None)
    assert states(spark, loan)[1, JAN]["BEGIN_DATE"] == date(2020, 1, 15)
    by_month = states(spark, loan, cohort_by_month=True)
    assert by_month[1, JAN]["BEGIN_DATE"] == JAN
    assert [by_month[1, d]["LOAN_M_CNT"] for d in (JAN, FEB, MAR)] == [0, 1, 2]


def test_compacting_the_ledger_changes_nothing(spark):
    rows = [
        (1, date(2020, 1, 1), 10, FEB, None),
        (1, date(2020, 1, 1), 20, FEB, None),
        (1, date(2020, 1, 1), 30, FEB, MAR),
        (2, date(2020, 1, 1), 40, MAR, None),
    ]
    raw = ledger(spark, *rows)
    assert compact_ledger(raw).count() == 3
    plain = sorted(map(tuple, build_snapshots(raw, PERIODS).collect()), key=repr)
    assert plain == sorted(map(tuple, build_snapshots(compact_ledger(raw), PERIODS).collect()), key=repr)


def test_cells_merge_equal_loans(spark):
    begin = date(2020, 1, 1)
    raw = ledger(spark, (1, begin, 10, FEB, None), (2, begin, 20, FEB, None), (3, begin, 5, JAN, JAN))
    cells = to_cells(build_snapshots(raw, PERIODS[:1]))
    by_state = rows_by(cells, "OVERDUE_STATUS_3")
    assert cells.count() == 2
    assert (by_state[0]["CNT"], by_state[0]["BAL"], by_state[2]["CNT"]) == (2, 30, 1)
