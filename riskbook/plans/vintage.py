"""Cohort matrices: overdue amount by begin date and months on book."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbook.functions.columns import month_text, rate
from riskbook.operators.rows import arrange
from riskbook.operators.sums import Part, fused_sums, names, pivot_parts


def cohort_sums(
    facts: DataFrame, measures: Sequence[str], which: str = "TRUE", oldest: date | None = None, runs: Sequence[str] = ()
) -> DataFrame:
    """Sums of new lending and of the measures by cohort and age: the one aggregation that reads the snapshots.

    Only cohorts begun on or after the oldest snapshot are kept.  Where the run knows that date it is
    a literal filter on the scan; otherwise each cohort and age brings its own oldest date, and the least of them
    decides, so that the snapshots are read once either way.  ``runs`` are further keys.
    """
    if oldest is not None:
        facts = facts.where(F.col("BEGIN_DATE") >= F.lit(oldest))
    sums = {m: f"sum(CASE WHEN {which} THEN {m} END)" for m in ("NEW_AMT", *measures)}
    oldest_of = {} if oldest is not None else {"oldest": "min(DATA_DT)"}
    summed = facts.groupBy(*runs, "BEGIN_DATE", "LOAN_M_CNT").agg(
        *[F.expr(f"{rule} AS {name}") for name, rule in (sums | oldest_of).items()]
    )
    if oldest is None:
        within = Window.partitionBy(*runs) if runs else Window.partitionBy(F.lit(0))  # one row per cohort and age
        summed = summed.withColumn("oldest", F.min("oldest").over(within)).where("BEGIN_DATE >= oldest").drop("oldest")
    return summed.where("BEGIN_DATE IS NOT NULL")


def matrix(sums: DataFrame, ages: int, measure: str, runs: Sequence[str] = ()) -> DataFrame:
    """``new_amt`` and ``m0`` ... of each cohort of ``cohort_sums``, a few rows for each date."""
    cells = pivot_parts("LOAN_M_CNT", range(ages), [measure], _age)
    wide = fused_sums(sums, [*runs, "BEGIN_DATE"], [Part("new_amt", "NEW_AMT"), *cells])
    return wide.where(f"coalesce({', '.join(names(cells))}) IS NOT NULL")


def vintage(
    facts: DataFrame,
    ages: int,
    measure: str = "OD_AMT",
    which: str = "TRUE",
    ordered: bool = False,
    oldest: date | None = None,
) -> DataFrame:
    """``begin_month``, ``new_amt`` and ``m0`` ... of cohorts begun within the snapshots.

    ``ages`` is the number of months the snapshots span (``months_spanned``), which
    bounds the months on book of such cohorts and so fixes the columns, however
    many of those months have a snapshot.  A missing cell stays missing,
    and a cohort with no cell at all is left out.
    """
    return shown(matrix(cohort_sums(facts, [measure], which, oldest), ages, measure), ages, ordered)


def shown(cohorts: DataFrame, ages: int, ordered: bool = False) -> DataFrame:
    """Cohorts of ``matrix`` as the reports show them."""
    if ordered:
        cohorts = arrange(cohorts, "BEGIN_DATE")
    return cohorts.selectExpr(
        f"{month_text('BEGIN_DATE')} AS begin_month", "new_amt", *[f"m{a}" for a in range(ages)]
    )


def vintage_rates(amounts: DataFrame) -> DataFrame:
    """The matrix with each cell over the cohort's new lending."""
    cells = [c for c in amounts.columns if c not in ("begin_month", "new_amt")]
    return amounts.selectExpr(
        "begin_month", "new_amt", *[f"{rate(c, 'new_amt')} AS {c}" for c in cells]
    )


def age_labels(ages: int) -> list[str]:
    """Display names of the age columns: this month, then month 2, 3, ..."""
    return ["当月", *[f"第{n}个月" for n in range(2, ages + 1)]]


def _age(measure: str, months: object) -> str:
    return f"m{months}"
