"""Every registered query: a Spark plan over the given tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cache, partial
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.functions.columns import unite
from riskbook.operators import rows, sums
from riskbook.plans import bundle, month_30, overdue, structure, vintage
from riskbook.plans.run import run_folder
from riskbook.plans.cadence import BIWEEK, DAY, MONTH, WEEK, Cadence, Options
from riskbook.schema import ATTRIBUTES, MEASURES
from riskbook.sources import carry
from riskbook.sources.calendar import months_spanned
from riskbook.sources.snapshot import build_snapshots, to_cells
from riskbook.sources.tables import read_cells, stored_dates, write_snapshots
from workload import book
from workload.folder import ensure_folder
from workload.oracle import LATEST, Reports, sheets_30, workbook, workbook_30
from workload.periods import DETAIL_FROM, GAPS, HISTORY, by_month, periods, reported

Query = Callable[[SparkSession, str], DataFrame]

POPULATIONS = {
    "all": rows.everyone,
    "excl": rows.without_prefix,
    "excl_code": rows.without_code,
}
OPTIONS = Options(detail_from=DETAIL_FROM)


# -- snapshots ---------------------------------------------------------------


def snapshots(spark: SparkSession, folder: str, cadence: str) -> DataFrame:
    """Loan-level snapshots of a cadence, as a plan over the given tables."""
    dates, days = periods(cadence), reported(cadence)
    ledger = book.ledger(spark, folder, dates[-1].day)
    keep = days if len(days) < len(dates) else None
    return build_snapshots(ledger, dates, cohort_by_month=by_month(cadence), keep=keep)


def cells(spark: SparkSession, folder: str, cadence: str) -> DataFrame:
    """The table all reports of a cadence read, built once per application."""
    return _cells(spark, spark.sparkContext.applicationId, folder, cadence)


def cells_path(spark: SparkSession, folder: str, cadence: str) -> str:
    return f"{_run_folder(spark, folder)}/cells/{cadence}"


@cache
def _cells(spark: SparkSession, application: str, folder: str, cadence: str) -> DataFrame:
    table = to_cells(snapshots(spark, folder, cadence), cohorts=by_month(cadence))
    path = cells_path(spark, folder, cadence)
    write_snapshots(table, path, whole=True)
    return read_cells(spark, path, table.schema)


def _run_folder(spark: SparkSession, folder: str) -> str:
    application, tables = spark.sparkContext.applicationId, sha256(folder.encode()).hexdigest()[:16]
    return f"{ensure_folder(spark)}/riskbook/{application}/{tables}"


def dimension(spark: SparkSession, folder: str) -> DataFrame:
    return _dimension(spark, spark.sparkContext.applicationId, folder)


@cache
def _dimension(spark: SparkSession, application: str, folder: str) -> DataFrame:
    return book.dimension(spark, folder)


def _ages(cadence: str) -> int:
    return months_spanned([p.day for p in periods(cadence)])


def report(plan, cadence: Cadence, population: str, spark: SparkSession, folder: str) -> DataFrame:
    facts = POPULATIONS[population](cells(spark, folder, cadence.name))
    return plan(facts, dimension(spark, folder), dated(cadence, population, spark, folder))


def dated(cadence: Cadence, population: str, spark: SparkSession, folder: str) -> Cadence:
    """The cadence with its last date, and for the whole population the first date that the cells have."""
    whole = population == "all" and cadence.vintages
    found = stored_dates(spark, cells_path(spark, folder, cadence.name)) if whole else []
    return replace(cadence, newest=reported(cadence.name)[-1], oldest=min(found, default=None))


def carried(spark: SparkSession, folder: str, cadence: str) -> DataFrame:
    """The last date's snapshots, from the state stored for the date before and the events since."""
    first, last = periods(cadence)[-2:]
    state, since = _carried(spark, spark.sparkContext.applicationId, folder, cadence), first.day
    events = carry.read_events(spark, _events(spark, spark.sparkContext.applicationId, folder), last.day, carry.events_after(last, since))
    return carry.snapshot_of(carry.advance(events, last, carry.read_state(spark, state, since), since), by_month(cadence))


@cache
def _events(spark: SparkSession, application: str, folder: str) -> str:
    """The ledger's events, stored once for all cadences."""
    path = f"{_run_folder(spark, folder)}/events"
    carry.write_events(book.ledger(spark, folder, max(periods(c)[-1].day for c in (MONTH.name, WEEK.name, DAY.name))), path)
    return path


@cache
def _carried(spark: SparkSession, application: str, folder: str, cadence: str) -> str:
    """States of the three dates before the last one, each but the first carried forward from the one before."""
    events, base = _events(spark, application, folder), f"{_run_folder(spark, folder)}/carried/{cadence}"
    before = periods(cadence)[-4:-1]
    for n, period in enumerate(before):
        step = carry.add_date if n else carry.open_state
        step(spark, events, f"{base}/states", f"{base}/snapshots", period, by_month(cadence))
    return f"{base}/states"


# -- reports -----------------------------------------------------------------

structure_detail_as_written = partial(
    structure.structure_detail, options=Options(detail_from=DETAIL_FROM, true_increments=False)
)


def report_plans(cadence: Cadence) -> dict[str, Callable]:
    plans = bundle.standard_reports(cadence, _ages(cadence.name), OPTIONS)
    if cadence.compares_periods:
        plans["structure_detail_as_written"] = structure_detail_as_written
    return plans


# Reports with a row per date or cohort: what a longer calendar changes.
ALONG_TIME = (
    "overdue_by_date",
    "reloan_overdue_by_date",
    "fund_change_count",
    "migration_rates",
    "structure_detail",
    "vintage_amount",
    "vintage_rate",
)

CHOSEN = {HISTORY: ALONG_TIME, GAPS: ("vintage_amount", "vintage_rate")}


def _report_queries() -> tuple[dict[str, Query], dict[str, str]]:
    queries, oracle = {}, {}
    runs = [
        (MONTH, "all", ""),
        (MONTH, "excl", "_excl"),
        (WEEK, "all", "_week"),
        (WEEK, "excl", "_week_excl"),
        (BIWEEK, "all", "_biweek"),
        (DAY, "all", "_day"),
        (DAY, "excl", "_day_excl"),
        (replace(MONTH, name=HISTORY), "all", "_history"),
        (replace(MONTH, name=GAPS), "all", "_gaps"),
    ]
    for cadence, population, suffix in runs:
        sql = Reports(cadence.name, population)
        for name, plan in report_plans(cadence).items():
            if name not in CHOSEN.get(cadence.name, (name,)):
                continue
            queries[name + suffix] = partial(report, plan, cadence, population)
            oracle[name + suffix] = getattr(sql, name)()
    return queries, oracle


def _month_30_queries() -> tuple[dict[str, Query], dict[str, str]]:
    queries, oracle = {}, {}
    ages = _ages(MONTH.name)

    def index(basis, population, options, spark, folder):
        return month_30.overdue_index(
            POPULATIONS[population](cells(spark, folder, MONTH.name)), basis, options
        )

    def capital(basis, population, table, spark, folder):
        facts = POPULATIONS[population](cells(spark, folder, MONTH.name))
        return month_30.capital_tables(facts, basis, ages)[table]

    for population, suffix in (("all", ""), ("excl_code", "_excl_code")):
        sql = Reports(MONTH.name, population)
        for basis in month_30.BASES:
            name = f"m30_overdue_{basis.name}{suffix}"
            queries[name] = partial(index, basis, population, Options())
            oracle[name] = sql.month_30_index(basis.overdue, basis.lent)
            for repeats in (False, True):
                for kind in ("amount", "rate"):
                    table = f"{'reloan_' if repeats else ''}vintage_{kind}"
                    name = f"m30_{table}_{basis.name}{suffix}"
                    queries[name] = partial(capital, basis, population, table)
                    oracle[name] = sql.month_30_vintage(basis.overdue, repeats, kind == "rate")
    def gaps(spark, folder):
        facts = cells(spark, folder, GAPS)
        return month_30.capital_tables(facts, month_30.INTEREST, _ages(GAPS))["vintage_amount"]

    queries["m30_vintage_amount_interest_gaps"] = gaps
    oracle["m30_vintage_amount_interest_gaps"] = Reports(GAPS).month_30_vintage("OD_AMT_30", False, False)
    name = "m30_overdue_interest_first_bn"
    queries[name] = partial(index, month_30.INTEREST, "all", Options(first_bn_of_first_loans=True))
    oracle[name] = Reports(MONTH.name).month_30_index("OD_AMT_30", "LOAN_PR_FEE", "RELOAN = 1")
    return queries, oracle


# -- single operators --------------------------------------------------------

DATES = ("DATA_DT", "BEGIN_DATE")
PROVINCES = [f"{31 + region}{n:02d}" for region in range(5) for n in range(1, 6)]


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in DATES if c in df.columns})


def _snapshot(cadence: str, spark: SparkSession, folder: str) -> DataFrame:
    return _dates_as_text(snapshots(spark, folder, cadence))


def _snapshot_carried(cadence: str, spark: SparkSession, folder: str) -> DataFrame:
    return _dates_as_text(carried(spark, folder, cadence))


def _snapshot_sql(cadence: str, where: str = "TRUE") -> str:
    columns = ["LOAN_ID", *ATTRIBUTES, *MEASURES]
    shown = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in DATES else c for c in columns)
    return Reports(cadence).sql(f"SELECT {shown} FROM facts WHERE {where}")


def _month(spark: SparkSession, folder: str) -> DataFrame:
    return cells(spark, folder, MONTH.name)


def _population_sums(population: str, spark: SparkSession, folder: str) -> DataFrame:
    facts = POPULATIONS[population](_month(spark, folder))
    return _dates_as_text(sums.sum_by(facts, ["DATA_DT", "PROV_CD"], ["CNT", "BAL"]))


def _population_sql(population: str) -> str:
    return Reports(MONTH.name, population).sql(
        "SELECT CAST(DATA_DT AS VARCHAR) AS DATA_DT, PROV_CD, CAST(sum(CNT) AS BIGINT) AS CNT, "
        "CAST(sum(BAL) AS BIGINT) AS BAL FROM facts GROUP BY 1, 2"
    )


def _stored_dates(days: list, spark: SparkSession, folder: str) -> DataFrame:
    """Chosen dates of the stored table, the date list reaching the scan."""
    stored = _month(spark, folder).schema
    chosen = read_cells(spark, cells_path(spark, folder, MONTH.name), stored, days, rows.without_prefix)
    return _dates_as_text(sums.sum_by(chosen, ["DATA_DT", "LIGHT"], ["CNT", "OD_AMT"]))


def _stored_dates_sql(days: list) -> str:
    shown = ", ".join(f"DATE '{d}'" for d in days)
    return Reports(MONTH.name, "excl").sql(
        "SELECT CAST(DATA_DT AS VARCHAR) AS DATA_DT, LIGHT, CAST(sum(CNT) AS BIGINT) AS CNT, "
        f"CAST(sum(OD_AMT) AS BIGINT) AS OD_AMT FROM facts WHERE DATA_DT IN ({shown}) GROUP BY 1, 2"
    )


def _dimension_lookup(spark: SparkSession, folder: str) -> DataFrame:
    counts = sums.sum_by(_month(spark, folder), ["SHENGSHI_CD", "PROV_CD"], ["CNT"])
    dims = dimension(spark, folder)
    cities = rows.lookup(counts, dims, "SHENGSHI_CD", "SHENGSHI_CD").select(
        F.col("code").alias("city"), F.col("name").alias("city_name"), "PROV_CD", "CNT"
    )
    return rows.lookup(cities, dims, "PROV_CD", "PROV_CD").select(
        "city", "city_name", F.col("code").alias("province"), F.col("name").alias("province_name"), "CNT"
    )


def _latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    newest = rows.latest(snapshots(spark, folder, MONTH.name), reported(MONTH.name)[-1])
    return _dates_as_text(newest.select("LOAN_ID", "DATA_DT", "PROV_CD", "BAL", "OD_AMT"))


def _subset_filter(spark: SparkSession, folder: str) -> DataFrame:
    cured = "OVERDUE_STATUS_5 = 0 AND OVERDUE_STATUS_5_LAST = 3"
    columns = ["LOAN_ID", "DATA_DT", "OVERDUE_STATUS_5", "OVERDUE_STATUS_5_LAST", "BAL"]
    return _dates_as_text(rows.subset(snapshots(spark, folder, MONTH.name), cured, columns))


def _unite_status(spark: SparkSession, folder: str) -> DataFrame:
    moved = unite("-", "OVERDUE_STATUS_5_LAST", "OVERDUE_STATUS_5")
    united = snapshots(spark, folder, MONTH.name).selectExpr(
        "DATA_DT", f"{moved} AS moved", "CNT", "DIFF_OD_AMT"
    )
    return _dates_as_text(sums.sum_by(united, ["DATA_DT", "moved"], ["CNT", "DIFF_OD_AMT"]))


def _sum_multi_measure(spark: SparkSession, folder: str) -> DataFrame:
    by = sums.sum_by(_month(spark, folder), ["DATA_DT", "PROV_CD"], ["CNT", "OD_AMT"])
    return _dates_as_text(by)


def _pivot_sum(spark: SparkSession, folder: str) -> DataFrame:
    return _dates_as_text(
        sums.pivot_sum(_month(spark, folder), "DATA_DT", "PROV_CD", PROVINCES, ["CNT"])
    )


def _grand_total(spark: SparkSession, folder: str) -> DataFrame:
    measures = ["CNT", "BAL", "OD_AMT"]
    return sums.with_grand_total(
        sums.sum_by(_month(spark, folder), ["SHENGSHI_CD"], measures), "SHENGSHI_CD", measures
    )


def _full_outer_fold(spark: SparkSession, folder: str) -> DataFrame:
    """City sums of three cadences, side by side."""
    frames = [
        sums.fused_sums(
            rows.latest(cells(spark, folder, c), reported(c)[-1]),
            "SHENGSHI_CD",
            [
                sums.Part(f"{c}_new_cnt", "CNT", "NEW_LOAN = 1"),
                sums.Part(f"{c}_od_cnt", "CNT", "OVERDUE_STATUS_5 = 4"),
            ],
        )
        for c in ("month", "week", "biweek")
    ]
    return rows.full_outer_fold(frames, ["SHENGSHI_CD"])


def _fold_sql() -> str:
    heads = []
    for c in ("month", "week", "biweek"):
        inner = Reports(c).sql(
            f"SELECT SHENGSHI_CD, CAST(sum(CNT) FILTER (NEW_LOAN = 1) AS BIGINT) AS {c}_new_cnt, "
            f"CAST(sum(CNT) FILTER (OVERDUE_STATUS_5 = 4) AS BIGINT) AS {c}_od_cnt FROM facts "
            f"WHERE {LATEST} AND (NEW_LOAN = 1 OR OVERDUE_STATUS_5 = 4) GROUP BY 1"
        )
        heads.append(f"({inner})")
    return (
        f"SELECT * FROM {heads[0]} a FULL OUTER JOIN {heads[1]} b USING (SHENGSHI_CD) "
        f"FULL OUTER JOIN {heads[2]} c USING (SHENGSHI_CD)"
    )


def _union_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots of two cadences stacked, then summed."""
    stacked = rows.union_rows([cells(spark, folder, c) for c in ("week", "biweek")])
    return _dates_as_text(sums.sum_by(stacked, ["DATA_DT"], ["CNT", "BAL"]))


STATE_COLUMNS = ("PROV_CD", "OVERDUE_STATUS_5", "LIGHT", "LOAN_PR_SCOPE", "OVERDUE_STATUS_3_30")


def _set_difference_rows(spark: SparkSession, folder: str) -> DataFrame:
    """States seen on the last date and not on the first."""
    days = reported(MONTH.name)
    facts = _month(spark, folder)
    on = [facts.where(F.col("DATA_DT") == F.lit(d)).select(*STATE_COLUMNS) for d in (days[-1], days[0])]
    return rows.row_difference(*on)


def _difference_sql() -> str:
    days = reported(MONTH.name)
    columns = ", ".join(STATE_COLUMNS)
    return Reports(MONTH.name).sql(
        f"SELECT {columns} FROM facts WHERE DATA_DT = DATE '{days[-1]}' "
        f"EXCEPT SELECT {columns} FROM facts WHERE DATA_DT = DATE '{days[0]}'"
    )


def _arrange_rows(spark: SparkSession, folder: str) -> DataFrame:
    facts = snapshots(spark, folder, MONTH.name)
    ordered = rows.arrange(
        facts.select("OVERDUE_STATUS_5", "OVERDUE_STATUS_5_LAST", "LOAN_ID", "DATA_DT"),
        "OVERDUE_STATUS_5",
        "OVERDUE_STATUS_5_LAST",
    )
    return _dates_as_text(ordered)


def _natural_right_join(spark: SparkSession, folder: str) -> DataFrame:
    """New lending per cohort beside the cohort's newest balance, cohorts in range only."""
    facts = _month(spark, folder)
    new = sums.sum_by(facts, ["BEGIN_DATE"], ["NEW_AMT"])
    begun = rows.begun_in_range(rows.latest(facts, reported(MONTH.name)[-1]), facts)
    balances = sums.sum_by(begun, ["BEGIN_DATE"], ["BAL"])
    return _dates_as_text(rows.natural_outer([new, balances], "right"))


def _natural_right_sql() -> str:
    return Reports(MONTH.name).sql(
        "SELECT CAST(b.BEGIN_DATE AS VARCHAR) AS BEGIN_DATE, NEW_AMT, BAL FROM "
        "(SELECT BEGIN_DATE, CAST(sum(NEW_AMT) AS BIGINT) AS NEW_AMT FROM facts GROUP BY 1) a RIGHT JOIN "
        f"(SELECT BEGIN_DATE, CAST(sum(BAL) AS BIGINT) AS BAL FROM facts WHERE {LATEST} AND "
        "BEGIN_DATE >= (SELECT min(DATA_DT) FROM facts) GROUP BY 1) b USING (BEGIN_DATE)"
    )


def _natural_full_outer(spark: SparkSession, folder: str) -> DataFrame:
    """Loans lent and loans overdue by date and size class, three sums side by side, joined on what they share."""
    facts = _month(spark, folder)
    key = ["DATA_DT", "LOAN_PR_SCOPE"]
    frames = [
        sums.sum_by(facts.where(which).withColumnRenamed("CNT", name), key, [name])
        for which, name in (("NEW_LOAN = 1", "new_cnt"), ("OVERDUE_STATUS_5 = 3", "late_cnt"), ("LIGHT = 1", "light_cnt"))
    ]
    return _dates_as_text(rows.natural_outer(frames))


def _natural_full_sql() -> str:
    heads = [
        f"(SELECT DATA_DT, LOAN_PR_SCOPE, CAST(sum(CNT) AS BIGINT) AS {name} FROM facts WHERE {which} GROUP BY 1, 2) {name[0]}"
        for which, name in (("NEW_LOAN = 1", "new_cnt"), ("OVERDUE_STATUS_5 = 3", "late_cnt"), ("LIGHT = 1", "light_cnt"))
    ]
    heads[2] = heads[2].removesuffix(" l") + " k"
    using = " USING (DATA_DT, LOAN_PR_SCOPE)"
    return Reports(MONTH.name).sql(
        "SELECT CAST(DATA_DT AS VARCHAR) AS DATA_DT, LOAN_PR_SCOPE, new_cnt, late_cnt, light_cnt FROM "
        f"{heads[0]} FULL OUTER JOIN {heads[1]}{using} FULL OUTER JOIN {heads[2]}{using}"
    )


def _text_output(spark: SparkSession, folder: str) -> DataFrame:
    """The weekly overdue report with every cell as text and rates as percents."""
    table = overdue.overdue_by_date(cells(spark, folder, WEEK.name), None, WEEK)
    return bundle.as_text(table)


def _text_sql() -> str:
    inner = Reports(WEEK.name).overdue_by_date()
    whole = ["data_dt", "out_cnt", "cnt", "loan_pr", "od_cnt", "bo_cnt", "bn_cnt", "od_amt", "bo_amt", "bn_amt", "bal"]
    shown = [f"CAST({c} AS VARCHAR) AS {c}" for c in whole]
    shown += [f"printf('%.2f%%', 100 * {c}) AS {c}" for c in ("od_rate", "bo_rate", "bn_rate")]
    return f"SELECT {', '.join(shown)} FROM ({inner})"


def _operator_queries() -> tuple[dict[str, Query], dict[str, str]]:
    month = Reports(MONTH.name)
    data_dt = "CAST(DATA_DT AS VARCHAR) AS DATA_DT"
    counted = ", ".join(
        f"CAST(sum(CNT) FILTER (PROV_CD = '{p}') AS BIGINT) AS cnt_{p}" for p in PROVINCES
    )
    queries = {f"snapshot_{c}": partial(_snapshot, c) for c in ("month", "week", "biweek", "day")}
    oracle = {f"snapshot_{c}": _snapshot_sql(c) for c in ("month", "week", "biweek", "day")}
    runs = {"snapshot_incremental": MONTH.name, "snapshot_incremental_week": WEEK.name, "snapshot_incremental_gaps": GAPS}
    queries |= {name: partial(_snapshot_carried, c) for name, c in runs.items()}
    oracle |= {name: _snapshot_sql(c, LATEST) for name, c in runs.items()}
    days = reported(MONTH.name)
    stored = {"stored_snapshot_dates": days[1::2], "stored_snapshot_day": days[-1:]}
    queries |= {name: partial(_stored_dates, dates) for name, dates in stored.items()}
    oracle |= {name: _stored_dates_sql(dates) for name, dates in stored.items()}
    queries |= {
        "population_exclude_prefix": partial(_population_sums, "excl"),
        "population_exclude_code": partial(_population_sums, "excl_code"),
        "dimension_lookup": _dimension_lookup,
        "latest_snapshot": _latest_snapshot,
        "subset_filter": _subset_filter,
        "unite_status": _unite_status,
        "sum_multi_measure": _sum_multi_measure,
        "pivot_sum": _pivot_sum,
        "grand_total": _grand_total,
        "full_outer_fold": _full_outer_fold,
        "natural_right_join": _natural_right_join,
        "natural_full_outer": _natural_full_outer,
        "union_rows": _union_rows,
        "set_difference_rows": _set_difference_rows,
        "arrange_rows": _arrange_rows,
        "text_output": _text_output,
    }
    oracle |= {
        "population_exclude_prefix": _population_sql("excl"),
        "population_exclude_code": _population_sql("excl_code"),
        "dimension_lookup": month.sql(
            "SELECT SHENGSHI_CD AS city, c.NAME AS city_name, PROV_CD AS province, p.NAME AS province_name, "
            "CAST(sum(CNT) AS BIGINT) AS CNT FROM facts "
            "LEFT JOIN (SELECT * FROM dims WHERE COL = 'SHENGSHI_CD') c ON SHENGSHI_CD = c.CODE "
            "LEFT JOIN (SELECT * FROM dims WHERE COL = 'PROV_CD') p ON PROV_CD = p.CODE GROUP BY ALL"
        ),
        "latest_snapshot": month.sql(f"SELECT LOAN_ID, {data_dt}, PROV_CD, BAL, OD_AMT FROM facts WHERE {LATEST}"),
        "subset_filter": month.sql(
            f"SELECT LOAN_ID, {data_dt}, OVERDUE_STATUS_5, OVERDUE_STATUS_5_LAST, BAL FROM facts "
            "WHERE OVERDUE_STATUS_5 = 0 AND OVERDUE_STATUS_5_LAST = 3"
        ),
        "unite_status": month.sql(
            f"SELECT {data_dt}, coalesce(CAST(OVERDUE_STATUS_5_LAST AS VARCHAR), 'NA') || '-' || "
            "CAST(OVERDUE_STATUS_5 AS VARCHAR) AS moved, CAST(sum(CNT) AS BIGINT) AS CNT, "
            "CAST(sum(DIFF_OD_AMT) AS BIGINT) AS DIFF_OD_AMT FROM facts GROUP BY 1, 2"
        ),
        "sum_multi_measure": month.sql(
            f"SELECT {data_dt}, PROV_CD, CAST(sum(CNT) AS BIGINT) AS CNT, CAST(sum(OD_AMT) AS BIGINT) AS OD_AMT "
            "FROM facts GROUP BY 1, 2"
        ),
        "pivot_sum": month.sql(f"SELECT {data_dt}, {counted} FROM facts GROUP BY 1"),
        "grand_total": month.sql(
            "SELECT SHENGSHI_CD, CAST(sum(CNT) AS BIGINT) AS CNT, CAST(sum(BAL) AS BIGINT) AS BAL, "
            "CAST(sum(OD_AMT) AS BIGINT) AS OD_AMT FROM facts GROUP BY GROUPING SETS ((SHENGSHI_CD), ())"
        ),
        "full_outer_fold": _fold_sql(),
        "natural_right_join": _natural_right_sql(),
        "natural_full_outer": _natural_full_sql(),
        "union_rows": (
            "SELECT DATA_DT, CAST(sum(CNT) AS BIGINT) AS CNT, CAST(sum(BAL) AS BIGINT) AS BAL FROM ("
            + " UNION ALL ".join(
                f"({Reports(c).sql(f'SELECT {data_dt}, CNT, BAL FROM facts')})" for c in ("week", "biweek")
            )
            + ") GROUP BY 1"
        ),
        "set_difference_rows": _difference_sql(),
        "arrange_rows": month.sql(f"SELECT OVERDUE_STATUS_5, OVERDUE_STATUS_5_LAST, LOAN_ID, {data_dt} FROM facts"),
        "text_output": _text_sql(),
    }
    return queries, oracle


# -- bundles -----------------------------------------------------------------

MANIFEST_COLUMNS = ("seq", "sheet", "table", "text", "start_row", "start_column", "n_columns", "header", "n_rows")


def _bundle(cadence: Cadence, spark: SparkSession, folder: str) -> DataFrame:
    """Writes all tables of a cadence to the shared folder; shows the manifest."""
    ages = _ages(cadence.name)
    facts = cells(spark, folder, cadence.name)
    known = dated(cadence, "all", spark, folder)
    stored = f"{_run_folder(spark, folder)}/sums/{cadence.name}"
    by_date = _stored(bundle.date_cells(facts), f"{stored}/date_cells")
    cohorts = _stored(vintage.cohort_sums(facts, ["OD_AMT"], oldest=known.oldest), f"{stored}/cohorts") if cadence.vintages else None
    tables = bundle.standard_bundle(facts, dimension(spark, folder), known, ages, OPTIONS, by_date, cohorts)
    manifest = bundle.write_bundle(
        spark,
        tables,
        bundle.standard_layout(cadence),
        bundle.standard_labels(cadence, ages),
        run_folder(f"{_run_folder(spark, folder)}/bundles", cadence.name, "all"),
        reported(cadence.name)[-1],
        text=cadence.as_text,
    )
    return manifest.select(*MANIFEST_COLUMNS)


def _month_30_run(spark: SparkSession, folder: str) -> DataFrame:
    """Writes the 30-day tables and sheets of all runs; gives the manifest."""
    target = run_folder(f"{_run_folder(spark, folder)}/bundles", "month_30", "both")
    day = reported(MONTH.name)[-1]
    totals = _stored(month_30.core(cells(spark, folder, MONTH.name)), f"{target}/sums/run_date={day}")
    return bundle.write_month_30(spark, totals, _ages(MONTH.name), target, day)


def _stored(table: DataFrame, path: str) -> DataFrame:
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _month_30_bundle(spark: SparkSession, folder: str) -> DataFrame:
    return _month_30_run(spark, folder).select(*MANIFEST_COLUMNS)


def _month_30_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the 30-day sheets, as read back from the stored dataset."""
    found = bundle.read_run_sheets(spark, _month_30_run(spark, folder))
    shown = "concat_ws('|', transform(cells, c -> coalesce(c, ''))) AS cells"
    return found.selectExpr("sheet", "block", "kind", "row", shown)


def _bundle_queries() -> tuple[dict[str, Query], dict[str, str]]:
    runs = {f"report_bundle_{c.name}": c for c in (DAY, WEEK, MONTH)}
    queries = {n: partial(_bundle, c) for n, c in runs.items()}
    queries |= {"report_bundle_month_30": _month_30_bundle, "report_sheets_month_30": _month_30_sheets}
    oracle = {n: workbook(c.name) for n, c in runs.items()}
    oracle |= {"report_bundle_month_30": workbook_30(), "report_sheets_month_30": sheets_30()}
    return queries, oracle


def registered() -> tuple[dict[str, Query], dict[str, str]]:
    queries, oracle = {}, {}
    for part in (_operator_queries, _report_queries, _month_30_queries, _bundle_queries):
        q, o = part()
        queries |= q
        oracle |= o
    return queries, oracle
