"""One more date from the stored state equals building the history."""

from datetime import date

import pytest
from compare import spark_table
from pyspark.sql import functions as F

from riskbook.schema import LEDGER
from riskbook.sources import carry
from riskbook.sources.calendar import Period, month_ends
from riskbook.sources.snapshot import build_snapshots
from riskbook.sources.tables import read_snapshots, stored_dates

PERIODS = month_ends(date(2020, 2, 1), date(2020, 7, 1))


def ledger(spark, rows):
    """Rows of (loan, begin, amount, due, paid)."""
    values = [(loan, loan % 5, 7, loan % 3, begin, 1 + loan % 3, amount, due, paid) for loan, begin, amount, due, paid in rows]
    return spark.createDataFrame(values, LEDGER)


def odd_rows():
    rows = []
    for loan in range(60):
        begin = date(2020, 1 + loan % 6, 1 + loan % 27)
        for n in range(1, 2 + loan % 4):
            due = date.fromordinal(begin.toordinal() + 17 * n)
            delay = (0, 7, 45, None, -3, 33)[(loan // 4 + n) % 6]
            rows.append((loan, begin, 1000 * n + loan, due, None if delay is None else date.fromordinal(due.toordinal() + delay)))
    rows += [
        (100, date(2020, 2, 10), 0, date(2020, 3, 1), None),  # late without an amount
        (100, date(2020, 2, 10), 50, date(2020, 3, 9), date(2020, 4, 2)),
        (101, date(2020, 2, 29), 70, date(2020, 2, 1), date(2020, 2, 3)),  # due and paid before it begins
        (102, date(2020, 3, 31), 80, date(2020, 3, 31), date(2020, 3, 31)),
        (103, date(2020, 1, 1), 90, None, None),  # never due
        (104, date(2020, 1, 2), None, date(2020, 2, 2), None),
        (105, date(2020, 9, 1), 10, date(2020, 9, 30), None),  # begins after all dates
        (106, None, 10, date(2020, 2, 2), None),
    ]
    rows += [(107, date(2020, 1, 5), 3, date(2020, 2, 20), date(2020, 5, 1))] * 4  # equal lines
    return rows


CALENDARS = {
    "months": PERIODS,
    # dates left out: the period start lies after the stored state's date
    "gaps": PERIODS[::2],
    # and before it
    "overlapping": [Period(p.day, date.fromordinal(p.before.toordinal() - 40)) for p in PERIODS],
}


@pytest.mark.parametrize("calendar", CALENDARS)
@pytest.mark.parametrize("by_month", [True, False])
def test_chain_of_dates_equals_the_history(spark, tmp_path, calendar, by_month):
    book, periods = ledger(spark, odd_rows()), CALENDARS[calendar]
    events, states, snapshots = (str(tmp_path / n) for n in ("events", "states", "snapshots"))
    carry.write_events(book, events)
    carry.open_state(spark, events, states, snapshots, periods[0], by_month)
    for period in periods[1:]:
        carry.add_date(spark, events, states, snapshots, period, by_month)
    whole = build_snapshots(book, periods, by_month)
    stored = read_snapshots(spark, snapshots).select(*whole.columns)
    assert spark_table(stored) == spark_table(whole)
    assert stored_dates(spark, snapshots) == [p.day for p in periods]


def test_adding_a_date_again_changes_nothing(spark, tmp_path):
    book = ledger(spark, odd_rows())
    events, states, snapshots = (str(tmp_path / n) for n in ("events", "states", "snapshots"))
    carry.write_events(book, events)
    with pytest.raises(ValueError, match="no state"):
        carry.add_date(spark, events, states, snapshots, PERIODS[1])
    carry.open_state(spark, events, states, snapshots, PERIODS[0])
    for period in (PERIODS[1], PERIODS[2], PERIODS[1], PERIODS[2]):
        carry.add_date(spark, events, states, snapshots, period)
    whole = build_snapshots(book, PERIODS[:3])
    assert spark_table(read_snapshots(spark, snapshots).select(*whole.columns)) == spark_table(whole)


def test_plan_reads_one_state_and_the_months_since(spark, tmp_path):
    book = ledger(spark, odd_rows())
    events, states, snapshots = (str(tmp_path / n) for n in ("events", "states", "snapshots"))
    carry.write_events(book, events)
    for period in PERIODS[:4]:
        carry.open_state(spark, events, states, snapshots, period)
    since, period = PERIODS[3].day, PERIODS[4]
    slice_ = carry.read_events(spark, events, period.day, carry.events_after(period, since))
    made = carry.snapshot_of(carry.advance(slice_, period, carry.read_state(spark, states, since), since))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    pruned = [line.split("PartitionFilters: [")[1].split("]")[0] for line in scans]
    assert len(scans) == 2
    assert sum("<= 2020-05-01" in p and ">= 2020-04-01" in p for p in pruned) == 1
    assert sum("= 2020-04-30" in p for p in pruned) == 1
    read = {r[0].split("/")[-2] for df in (slice_, carry.read_state(spark, states, since)) for r in df.select(F.input_file_name()).distinct().collect()}
    assert read == {"EVENT_MONTH=2020-05-01", f"DATA_DT={since}"}


def test_no_lines_give_no_rows(spark, tmp_path):
    events = carry.to_events(ledger(spark, []))
    assert carry.snapshot_of(carry.advance(events, PERIODS[0])).count() == 0
