"""A report run from end to end: store snapshots, read them back, write the tables."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from riskbook.operators.checks import FAIL, IGNORE, not_in, settle, unlisted_rows
from riskbook.operators.rows import everyone, repeated_codes
from riskbook.plans import bundle, month_30, vintage
from riskbook.plans.cadence import Cadence, Options
from riskbook.plans.structure import STATES
from riskbook.sources.calendar import Period, months_spanned
from riskbook.sources.snapshot import build_snapshots, to_cells
from riskbook.sources.tables import Population, read_cells, read_snapshots, stored_dates, write_snapshots


def refresh(
    ledger: DataFrame,
    periods: Sequence[Period],
    path: str,
    cohort_by_month: bool = False,
    keep: Sequence[date] | None = None,
) -> None:
    """Builds the snapshots of the periods and stores them, replacing those dates only.

    To add one date to a stored table, pass the last two periods and keep the
    newest: the one before gives it its prior state.
    """
    write_snapshots(build_snapshots(ledger, periods, cohort_by_month, keep), path)


def run_folder(folder: str, cadence: str, population: str) -> str:
    """Where one kind of run writes; cells, tables and manifest lie below it by run date."""
    return f"{folder}/cadence={cadence}/population={population}"


def run_standard(
    spark: SparkSession,
    snapshots: str,
    dims: DataFrame,
    cadence: Cadence,
    dates: Sequence[date],
    folder: str,
    name: str,
    population: Population = everyone,
    options: Options = Options(),
    fmt: str = "parquet",
) -> DataFrame:
    """All tables of a cadence over stored snapshots; returns the manifest.

    ``name`` says which population this is; with the cadence and the last date it
    is part of every path, so runs into one folder leave each other alone.  The snapshots are read once, merged to
    cells and stored.  The cells of all dates are then read three times at most: for the sums of the
    reports by date, for those of the cohort matrices, and for the one report by code and date.
    """
    run_date, ages = max(dates), months_spanned(dates)
    target = run_folder(folder, cadence.name, name)
    path = f"{target}/cells/run_date={run_date}"
    _check_codes(dims, options)
    cells = _store_cells(spark, snapshots, dates, path, population, cadence.vintages, options)
    cadence = replace(cadence, newest=run_date, oldest=min(stored_dates(spark, path), default=None))
    by_date = _stored(bundle.date_cells(cells), f"{target}/date_cells/run_date={run_date}")
    cohorts = None
    if cadence.vintages:
        sums = vintage.cohort_sums(cells, ["OD_AMT"], oldest=cadence.oldest)
        cohorts = _stored(sums, f"{target}/cohorts/run_date={run_date}")
    tables = bundle.standard_bundle(cells, dims, cadence, ages, options, by_date, cohorts)
    layout, labels = bundle.standard_layout(cadence), bundle.standard_labels(cadence, ages)
    return bundle.write_bundle(
        spark, tables, layout, labels, target, run_date, text=cadence.as_text, fmt=fmt
    )


def run_month_30(
    spark: SparkSession, snapshots: str, dates: Sequence[date], folder: str, options: Options = Options()
) -> DataFrame:
    """The 30-day tables and sheets of both populations on both bases; returns the manifest.

    The snapshots are read once, for the sums that all tables are cut from.
    """
    run_date = max(dates)
    target = run_folder(folder, "month_30", "both")
    path = f"{target}/sums/run_date={run_date}"
    sums = _stored(month_30.core(read_snapshots(spark, snapshots, dates)), path)
    return bundle.write_month_30(spark, sums, months_spanned(dates), target, run_date, options)


def _stored(table: DataFrame, path: str) -> DataFrame:
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def unlisted(dates: Sequence[date], cohorts: bool) -> dict[str, str]:
    """Conditions of cells that the pivots of the tables leave out."""
    found = {"five-state value": not_in("OVERDUE_STATUS_5", STATES)}
    if cohorts:
        ages = months_spanned(dates)
        found["months on book"] = (
            f"(BEGIN_DATE >= DATE '{min(dates)}' AND (LOAN_M_CNT IS NULL OR LOAN_M_CNT NOT BETWEEN 0 AND {ages - 1}))"
        )
    return found


def _store_cells(
    spark: SparkSession,
    snapshots: str,
    dates: Sequence[date],
    path: str,
    population: Population,
    cohorts: bool,
    options: Options = Options(),
) -> DataFrame:
    loans = read_snapshots(spark, snapshots, dates, population)
    cells = to_cells(loans, cohorts)
    write_snapshots(cells, path, whole=True)
    stored = read_cells(spark, path, cells.schema)
    if options.unlisted != IGNORE:
        settle(unlisted_rows(stored, unlisted(dates, cohorts)), options.unlisted)
    return stored


def _check_codes(dims: DataFrame, options: Options) -> None:
    """Refuses or warns about codes listed more than once: lookups then take the first label."""
    if options.repeated_codes == IGNORE:
        return
    found = repeated_codes(dims)
    count, some = found.count(), [f"{r['COL']} {r['CODE']}" for r in found.orderBy("COL", "CODE").take(5)]
    if count:
        text = f"{count} codes are listed more than once: {', '.join(some)}"
        if options.repeated_codes == FAIL:
            raise ValueError(text)
        warnings.warn(text, stacklevel=3)
