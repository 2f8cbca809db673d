"""Snapshots of a loan book: the state of every loan on every evaluated date.

Input is a ledger, one row per installment with its loan's attributes
(``riskbook.schema.LEDGER``).  Output is ``riskbook.schema.FACTS`` plus the
loan key.  With a ledger partitioned by loan the whole build, prior state
included, runs without a further shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.schema import ATTRIBUTES, LOAN_KEY, MEASURES, cell_columns, classified
from riskbook.sources.calendar import Period

LOAN_COLUMNS = ("CUST", "NATION", "REGION", "BD", "K")

# Dates summed side by side in one row per loan; longer lists take several rows.
DATES_PER_ROW = 8


def _unpaid(day: str) -> str:
    return f"(PAID IS NULL OR PAID > {day})"


def _late(day: str) -> str:
    return f"(DUE < {day} AND {_unpaid(day)})"


def _sum_where(condition: str) -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN AMT END), 0)"


def _state(day: str) -> dict[str, str]:
    """What a loan's installments add up to on a date."""
    return {
        "BAL": _sum_where(_unpaid(day)),
        "OD_PRINCIPAL": _sum_where(_late(day)),
        "LATE_SINCE": f"min(CASE WHEN {_late(day)} THEN DUE END)",
    }


def _flows(day: str, before: str) -> dict[str, str]:
    """Amounts fallen due and paid between two dates."""
    return {
        "DIFF_SP_AMT": _sum_where(f"DUE > {before} AND DUE <= {day}"),
        "DIFF_AP_AMT": _sum_where(f"PAID > {before} AND PAID <= {day}"),
    }


def _status(day: str, prefix: str = "") -> dict[str, str]:
    """A loan's status on a date from its state on that date."""
    bal, od_principal = f"{prefix}BAL", f"{prefix}OD_PRINCIPAL"
    od_days = _od_days(day, prefix)
    return {
        "OD_AMT": f"{od_principal} + {od_principal} * 5 div 100",
        "OVERDUE_STATUS_3": f"CASE WHEN {bal} = 0 THEN 2 WHEN {od_days} > 0 THEN 1 ELSE 0 END",
        "OVERDUE_STATUS_5": (
            f"CASE WHEN {bal} = 0 OR {od_days} = 0 THEN 0 WHEN {od_days} <= 3 THEN 1 "
            f"WHEN {od_days} <= 30 THEN 2 WHEN {od_days} <= 60 THEN 3 ELSE 4 END"
        ),
        "STATUS_THIS_MONTH": f"CASE WHEN {od_days} > 60 THEN 1 ELSE 0 END",
    }


def _od_days(day: str, prefix: str = "") -> str:
    return f"coalesce(date_diff({day}, {prefix}LATE_SINCE), 0)"


PRIOR = "PRIOR_"
OD_DAYS = _od_days("DATA_DT")
SEEN_BEFORE = f"BD <= {PRIOR}DT"

# Codes of a loan, the same on every date.
PROVINCE = "concat(REGION + 31, lpad(NATION div 5 + 1, 2, '0'))"
LOAN_CODES = {
    "PROV_CD": PROVINCE,
    "SHENGSHI_CD": f"concat({PROVINCE}, lpad(CUST % 3 + 1, 2, '0'))",
    "RELOAN": "K",
    "RELOANTIMES": "K",
    "BRELOAN": "K",
    "LIGHT": "CASE WHEN CUST % 5 = 0 THEN 1 ELSE 0 END",
    "LOAN_PR_SCOPE": (
        "CASE WHEN LOAN_PR < 5000000 THEN 1 WHEN LOAN_PR < 15000000 THEN 2 "
        "WHEN LOAN_PR < 30000000 THEN 3 ELSE 4 END"
    ),
    "LOAN_PR_FEE": "LOAN_PR + LOAN_PR * 6 div 100",
}

# Status and prior status of a loan on a date.
STATUS = {
    **_status("DATA_DT"),
    **{f"{PRIOR}{name}": rule for name, rule in _status(f"{PRIOR}DT", PRIOR).items()},
    "OVERDUE_STATUS_3_30": f"CASE WHEN BAL = 0 THEN 2 WHEN {OD_DAYS} >= 30 THEN 1 ELSE 0 END",
    "MATURITY_DAYS": "greatest(date_diff(DATA_DT, MATURITY), -1)",
    "NEW_LOAN": "CASE WHEN BD > BEFORE THEN 1 ELSE 0 END",
    "LOAN_M_CNT": "12 * (year(DATA_DT) - year(BD)) + month(DATA_DT) - month(BD)",
    "CNT": "1",
}

# Columns that build on those.
DERIVED = {
    "NEW_AMT": "CASE WHEN NEW_LOAN = 1 THEN LOAN_PR ELSE 0 END",
    "OD_AMT_30": f"CASE WHEN {OD_DAYS} >= 30 THEN OD_AMT ELSE 0 END",
    "OD_PRINCIPAL_30": f"CASE WHEN {OD_DAYS} >= 30 THEN OD_PRINCIPAL ELSE 0 END",
    "OVERDUE_STATUS_3_LAST": f"CASE WHEN {SEEN_BEFORE} THEN {PRIOR}OVERDUE_STATUS_3 END",
    "OVERDUE_STATUS_5_LAST": f"CASE WHEN {SEEN_BEFORE} THEN {PRIOR}OVERDUE_STATUS_5 END",
    "STATUS_LAST_MONTH": f"CASE WHEN {SEEN_BEFORE} THEN {PRIOR}STATUS_THIS_MONTH END",
    "DIFF_OD_AMT": f"OD_AMT - CASE WHEN {SEEN_BEFORE} THEN {PRIOR}OD_AMT ELSE 0 END",
}


def compact_ledger(ledger: DataFrame) -> DataFrame:
    """Installments of a loan with equal due and paid dates as one row.

    Every snapshot column is a sum of amounts or an extreme of due dates, so
    this changes no result.  Rows are combined inside each task before they
    move; what then gathers by loan is bounded by the loan's distinct dates.
    """
    merged = ledger.groupBy(LOAN_KEY, *LOAN_COLUMNS, "DUE", "PAID").agg(F.sum("AMT").alias("AMT"))
    return merged.repartition(LOAN_KEY)


def build_snapshots(
    ledger: DataFrame,
    periods: Sequence[Period],
    cohort_by_month: bool = False,
    keep: Sequence[date] | None = None,
) -> DataFrame:
    """State of each loan begun on or before each evaluated date.

    The date list is literal, so pairing loans with dates is no join.
    ``*_LAST`` columns hold the loan's state on the previous date of the list
    and are null on its first one.  With ``keep`` the other dates only serve as
    previous ones: a stored table gains its newest date from the last two dates
    of the list, without redoing the history.
    """
    if not periods:
        raise ValueError("no dates to evaluate")
    snapshots = snapshot_rows(_states(ledger, periods, loan_codes(cohort_by_month)))
    return snapshots if keep is None else snapshots.where(F.col("DATA_DT").isin(*keep))


def loan_codes(cohort_by_month: bool) -> dict[str, str]:
    """Codes of a loan; cohorts are months or days."""
    return {"BEGIN_DATE": "last_day(BD)" if cohort_by_month else "BD", **LOAN_CODES}


def snapshot_rows(states: DataFrame) -> DataFrame:
    """The snapshot's columns from a loan's codes and its state on a date and on the one before."""
    columns = {**ATTRIBUTES, **MEASURES}
    return states.selectExpr("*", *named(STATUS)).selectExpr(
        LOAN_KEY,
        *[f"CAST({DERIVED.get(c, c)} AS {t.simpleString()}) AS {c}" for c, t in columns.items()],
    )


def _states(ledger: DataFrame, periods: Sequence[Period], codes: dict[str, str]) -> DataFrame:
    """A row per loan and date: the loan's codes, its state on the date and on the one before.

    Installments are summed once per loan for several dates side by side, and
    only the result, one row per loan, is spread to a row per date.  The state
    on the previous date is then a column of the same row: no window, no sort.
    """
    size = min(DATES_PER_ROW, len(periods))
    slots = range(1, size + 1)
    rows = [periods[i : i + size] for i in range(0, len(periods), size)]
    literal = ", ".join(
        _slot_dates(chunk, rows[n - 1][-1].day if n else None, size) for n, chunk in enumerate(rows)
    )
    dates = f"array({literal})"
    dated = ledger.selectExpr("*", f"posexplode({dates}) AS (nth, dates)").where(
        "BD <= dates.newest"
    )

    totals = {"LOAN_PR": "sum(AMT)", "MATURITY": "max(DUE)"}
    for slot in (0, *slots):
        state = _state(f"dates.day_{slot}")
        if slot:
            state |= _flows(f"dates.day_{slot}", f"dates.before_{slot}")
        totals |= {f"{name}_{slot}": rule for name, rule in state.items()}
    by_loan = (
        dated.groupBy(LOAN_KEY, *LOAN_COLUMNS, "nth")
        .agg(*map(F.expr, named(totals)))
        .selectExpr("*", f"get({dates}, nth) AS dates")
    )

    def at(slot: int) -> str:
        now = {
            "DATA_DT": f"dates.day_{slot}",
            "BEFORE": f"dates.before_{slot}",
            f"{PRIOR}DT": f"dates.day_{slot - 1}",
        }
        now |= {n: f"{n}_{slot}" for n in (*_state(""), *_flows("", ""))}
        now |= {f"{PRIOR}{n}": f"{n}_{slot - 1}" for n in _state("")}
        return "named_struct(" + ", ".join(f"'{n}', {c}" for n, c in now.items()) + ")"

    kept = (LOAN_KEY, "BD", "LOAN_PR", "MATURITY", *codes)
    return (
        by_loan.selectExpr("*", *named(codes))
        .selectExpr(*kept, f"inline(array({', '.join(map(at, slots))}))")
        .where("BD <= DATA_DT")
    )


def named(rules: dict[str, str]) -> list[str]:
    return [f"{rule} AS {name}" for name, rule in rules.items()]


def _slot_dates(chunk: Sequence[Period], previous: date | None, size: int) -> str:
    """Literal dates of one row: the one before, then each date and its period start."""
    padded = [(p.day, p.before) for p in chunk] + [(None, None)] * (size - len(chunk))
    dates = {"newest": chunk[-1].day, "day_0": previous}
    for slot, (day, before) in enumerate(padded, 1):
        dates |= {f"day_{slot}": day, f"before_{slot}": before}
    return "named_struct(" + ", ".join(
        f"'{n}', {f"DATE '{d}'" if d else 'CAST(NULL AS DATE)'}" for n, d in dates.items()
    ) + ")"


def to_cells(snapshots: DataFrame, cohorts: bool = True) -> DataFrame:
    """Loans of a snapshot that reports don't distinguish, as one row.

    Attributes that reports look at by class only are there as classes, under the classes' names;
    begin date and months on book only with ``cohorts``, for runs that have cohort matrices.
    """
    keys = cell_columns(cohorts)
    return (
        classified(snapshots)
        .groupBy(*keys)
        .agg(*[F.expr(f"sum({m}) AS {m}") for m in MEASURES])
    )
