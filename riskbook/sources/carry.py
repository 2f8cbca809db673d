"""Snapshots of one more date, carried forward from the state stored for the date before.

The ledger is stored as events by month: a line is opened when its loan begins, falls due, and is
paid.  The state of a date has one row per loan: what never changes, the lines still open by due date,
and the sums a snapshot row is made of.  The next date needs that one partition and the events since
then; both meet once, by loan, and nothing of the older history is read.

A correction dated on or before a stored date does not reach the states after it: rebuild from
that date (``open_state`` and then ``add_date`` for each later one).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.schema import LOAN_KEY
from riskbook.sources.calendar import Period
from riskbook.sources.snapshot import LOAN_COLUMNS, PRIOR, loan_codes, named, snapshot_rows
from riskbook.sources.tables import stored_dates, write_snapshots

LOAN = (LOAN_KEY, *LOAN_COLUMNS)
OPENED, DUE, PAID = "opened", "due", "paid"
OPEN_LINES = "array<struct<DUE:date,N:bigint,AMT:bigint>>"


def to_events(ledger: DataFrame) -> DataFrame:
    """What happens to each line, and when, as seen from its loan's begin.

    Lines of a loan with equal due and paid dates are one event with their count: rows are
    combined inside each task first, so a loan of any number of lines brings one row per pair of dates.
    """
    kinds = {OPENED: "BD", DUE: "greatest(BD, DUE)", PAID: "greatest(BD, PAID)"}
    needs = {OPENED: "BD", DUE: "DUE", PAID: "PAID"}
    events = ", ".join(
        f"named_struct('KIND', '{kind}', 'EVENT_DT', CASE WHEN {needs[kind]} IS NOT NULL THEN {day} END)"
        for kind, day in kinds.items()
    )
    return (
        ledger.where("BD IS NOT NULL")
        .groupBy(*LOAN, "DUE", "PAID")
        .agg(F.count("*").alias("N"), F.sum("AMT").alias("AMT"))
        .selectExpr("*", f"inline(array({events}))")
        .where("EVENT_DT IS NOT NULL")
    )


def write_events(ledger: DataFrame, path: str) -> None:
    """Stores the ledger's events by month, replacing the months written."""
    events = to_events(ledger).selectExpr("*", "trunc(EVENT_DT, 'MM') AS EVENT_MONTH")
    (
        events.hint("rebalance", "EVENT_MONTH")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("EVENT_MONTH")
        .parquet(path)
    )


def read_events(spark: SparkSession, path: str, until: date, after: date | None = None) -> DataFrame:
    """Events up to a date, or between two dates; the months reach the scan as a partition filter."""
    events = spark.read.parquet(path).where(F.col("EVENT_MONTH") <= F.lit(until.replace(day=1)))
    if after is not None:
        events = events.where(F.col("EVENT_MONTH") >= F.lit(after.replace(day=1))).where(F.col("EVENT_DT") > F.lit(after))
    return events.where(F.col("EVENT_DT") <= F.lit(until)).drop("EVENT_MONTH")


def events_after(period: Period, since: date | None) -> date | None:
    """From when on events matter for a date: the stored state's date, or an earlier period start."""
    return None if since is None else min(since, period.before)


def advance(events: DataFrame, period: Period, state: DataFrame | None = None, since: date | None = None) -> DataFrame:
    """The state on a period's date, from the events after ``events_after`` and the state on ``since``.

    Without a state the events must reach back to the first loan.  Open lines, payments and new
    lines are rows of one table that moves by loan once; first they are netted by due date, then
    summed by loan, both inside the same task.
    """
    day, before = f"DATE '{period.day}'", f"DATE '{period.before}'"
    prior = f"DATE '{since}'" if since else "CAST(NULL AS DATE)"
    fresh = f"EVENT_DT > {prior}" if since else "TRUE"
    sign = f"CASE WHEN {fresh} AND KIND = '{OPENED}' THEN 1 WHEN {fresh} AND KIND = '{PAID}' THEN -1 ELSE 0 END"
    opened = f"{fresh} AND KIND = '{OPENED}'"
    moves = events.selectExpr(
        *LOAN,
        "DUE",
        f"N * ({sign}) AS N",
        f"AMT * ({sign}) AS AMT",
        "0L AS WAS_N",
        "0L AS WAS_AMT",
        f"CASE WHEN {opened} THEN AMT END AS LOAN_PR",
        f"CASE WHEN {opened} THEN DUE END AS MATURITY",
        f"CASE WHEN KIND = '{DUE}' AND DUE > {before} AND DUE <= {day} THEN AMT END AS SP",
        f"CASE WHEN KIND = '{PAID}' AND PAID > {before} AND PAID <= {day} THEN AMT END AS AP",
    )
    if state is not None:
        # one row for the loan itself, and one for each due date that has open lines
        lines = f"concat(array(named_struct('DUE', CAST(NULL AS DATE), 'N', 0L, 'AMT', 0L)), CAST(OPEN AS {OPEN_LINES}))"
        kept = state.selectExpr(*LOAN, "LOAN_PR", "MATURITY", f"posexplode({lines}) AS (place, line)").selectExpr(
            *LOAN,
            "line.DUE",
            "line.N",
            "line.AMT",
            "line.N AS WAS_N",
            "line.AMT AS WAS_AMT",
            "CASE WHEN place = 0 THEN LOAN_PR END AS LOAN_PR",
            "CASE WHEN place = 0 THEN MATURITY END AS MATURITY",
            "CAST(NULL AS BIGINT) AS SP",
            "CAST(NULL AS BIGINT) AS AP",
        )
        moves = kept.unionByName(moves)
    summed = ("N", "AMT", "WAS_N", "WAS_AMT", "LOAN_PR", "SP", "AP")
    by_due = (
        moves.repartition(LOAN_KEY)
        .groupBy(*LOAN, "DUE")
        .agg(*[F.sum(c).alias(c) for c in summed], F.max("MATURITY").alias("MATURITY"))
    )
    late, was_late = f"DUE < {day}", f"DUE < {prior}"
    totals = {
        "LOAN_PR": "sum(LOAN_PR)",
        "MATURITY": "max(MATURITY)",
        "BAL": "coalesce(sum(AMT), 0)",
        "OD_PRINCIPAL": f"coalesce(sum(CASE WHEN {late} THEN AMT END), 0)",
        "LATE_SINCE": f"min(CASE WHEN {late} AND N > 0 THEN DUE END)",
        f"{PRIOR}BAL": "coalesce(sum(WAS_AMT), 0)",
        f"{PRIOR}OD_PRINCIPAL": f"coalesce(sum(CASE WHEN {was_late} THEN WAS_AMT END), 0)",
        f"{PRIOR}LATE_SINCE": f"min(CASE WHEN {was_late} AND WAS_N > 0 THEN DUE END)",
        "DIFF_SP_AMT": "coalesce(sum(SP), 0)",
        "DIFF_AP_AMT": "coalesce(sum(AP), 0)",
        "OPEN": "sort_array(collect_list(CASE WHEN N > 0 THEN named_struct('DUE', DUE, 'N', N, 'AMT', AMT) END))",
    }
    return (
        by_due.groupBy(*LOAN)
        .agg(*map(F.expr, named(totals)))
        .selectExpr("*", f"{day} AS DATA_DT", f"{before} AS BEFORE", f"{prior} AS {PRIOR}DT")
    )


def snapshot_of(state: DataFrame, cohort_by_month: bool = False) -> DataFrame:
    """Snapshot rows of a date's state; no row moves."""
    return snapshot_rows(state.selectExpr("*", *named(loan_codes(cohort_by_month))))


def read_state(spark: SparkSession, path: str, day: date) -> DataFrame:
    """The state of one date: one partition of the stored table."""
    return spark.read.parquet(path).where(F.col("DATA_DT") == F.lit(day))


def open_state(spark: SparkSession, events: str, states: str, snapshots: str, period: Period, cohort_by_month: bool = False) -> None:
    """Stores state and snapshots of a first date, from all events up to it."""
    _store(spark, advance(read_events(spark, events, period.day), period), states, snapshots, period, cohort_by_month)


def add_date(spark: SparkSession, events: str, states: str, snapshots: str, period: Period, cohort_by_month: bool = False) -> None:
    """Stores state and snapshots of a date, from the newest earlier state and the events since.

    Running it again replaces that date and gives the same rows.
    """
    earlier = [d for d in stored_dates(spark, states) if d < period.day]
    if not earlier:
        raise ValueError(f"no state is stored before {period.day}")
    since = max(earlier)
    slice_ = read_events(spark, events, period.day, events_after(period, since))
    state = advance(slice_, period, read_state(spark, states, since), since)
    _store(spark, state, states, snapshots, period, cohort_by_month)


def _store(spark: SparkSession, state: DataFrame, states: str, snapshots: str, period: Period, cohort_by_month: bool) -> None:
    write_snapshots(state, states)
    write_snapshots(snapshot_of(read_state(spark, states, period.day), cohort_by_month), snapshots)
