from dataclasses import replace
from datetime import date

import pytest
from compare import dims, facts, spark_table
from pyspark.sql import functions as F

from riskbook.operators.checks import settle, unlisted_rows
from riskbook.operators.rows import everyone, repeated_codes, without_prefix
from riskbook.plans import bundle, lending, month_30, overdue, run, vintage
from riskbook.plans.cadence import DAY, MONTH, WEEK, Options
from riskbook.schema import LEDGER
from riskbook.sources.calendar import days, month_ends, months_spanned
from riskbook.sources.snapshot import build_snapshots, compact_ledger, to_cells
from riskbook.sources.tables import read_cells, read_snapshots, stored_dates, write_snapshots

PERIODS = month_ends(date(2020, 2, 1), date(2020, 5, 1))


def ledger(spark):
    """40 loans in two regions, begun over four months, some paid late or never."""
    rows = []
    for loan in range(40):
        begin = date(2020, 1 + loan % 4, 1 + loan % 27)
        region = 0 if loan % 4 else 4
        for n in (1, 2, 3):
            due = date.fromordinal(begin.toordinal() + 20 * n)
            delay = (0, 7, 45, None)[(loan // 4 + n) % 4]
            paid = None if delay is None else date.fromordinal(due.toordinal() + delay)
            rows.append((loan, loan % 7, 5 + loan % 2, region, begin, 1 + loan % 3, 1000 * n + loan, due, paid))
    return compact_ledger(spark.createDataFrame(rows, LEDGER))


def test_adding_a_date_equals_building_the_history(spark, tmp_path):
    book, path = ledger(spark), str(tmp_path / "snapshots")
    run.refresh(book, PERIODS[:3], path, cohort_by_month=True)
    run.refresh(book, PERIODS[2:], path, cohort_by_month=True, keep=[PERIODS[3].day])
    whole = build_snapshots(book, PERIODS, cohort_by_month=True)
    stored = read_snapshots(spark, path)
    assert spark_table(stored.select(*whole.columns)) == spark_table(whole)


def test_standard_run_over_stored_snapshots(spark, tmp_path):
    path, out = str(tmp_path / "snapshots"), str(tmp_path / "out")
    run.refresh(ledger(spark), PERIODS, path, cohort_by_month=True)
    last = days(PERIODS)[-1:]
    manifest = run.run_standard(spark, path, dims(spark), DAY, last, out, "without_prefix", without_prefix)
    rows = {r["table"]: r for r in manifest.collect() if r["table"]}
    assert set(rows) == set(bundle.standard_reports(DAY, 1))
    stored = spark.read.parquet(rows["overdue_by_date"]["path"]).first()
    expected = overdue.overdue_by_date(
        read_snapshots(spark, path, last, without_prefix), None, DAY
    ).first()
    assert (stored["data_dt"], stored["cnt"]) == ("2020-04-30", str(expected["cnt"])) == ("2020-04-30", "30")


def test_runs_into_one_folder_leave_each_other_alone(spark, tmp_path, monkeypatch):
    reports = bundle.standard_reports
    monkeypatch.setattr(
        bundle, "standard_reports", lambda *a: {k: v for k, v in reports(*a).items() if k in ("overdue_by_date", "overdue_by_scope")}
    )
    path, out = str(tmp_path / "snapshots"), str(tmp_path / "out")
    run.refresh(ledger(spark), PERIODS, path, cohort_by_month=True)
    last = days(PERIODS)[-1:]
    populations = {"all": everyone, "without_prefix": without_prefix}
    manifests = {
        (cadence.name, name): run.run_standard(spark, path, dims(spark), cadence, dates, out, name, population)
        for name, population in populations.items()
        for cadence, dates in ((DAY, last), (WEEK, days(PERIODS)))
    }
    found = {}
    for (cadence, name), manifest in manifests.items():
        row = next(r for r in manifest.collect() if r["table"] == "overdue_by_date")
        assert f"cadence={cadence}/population={name}/" in row["path"] and row["path"].endswith("run_date=2020-04-30")
        stored = spark.read.parquet(row["path"])
        found[cadence, name] = (stored.count(), stored.agg({"data_dt": "max"}).first()[0], row["path"])
        newest = stored.where("data_dt = '2020-04-30'").first()
        assert newest["cnt"] == {"all": "40", "without_prefix": "30"}[name]
    assert [found[c, "all"][0] for c in ("day", "week")] == [1, len(PERIODS)]
    assert len({f[2] for f in found.values()}) == 4
    assert len(list((tmp_path / "out").glob("cadence=*/population=*/manifest/run_date=2020-04-30"))) == 4


def test_month_30_run_over_stored_snapshots(spark, tmp_path):
    path, out = str(tmp_path / "snapshots"), str(tmp_path / "out")
    run.refresh(ledger(spark), PERIODS, path, cohort_by_month=True)
    manifest = run.run_month_30(spark, path, days(PERIODS), out)
    rows = {r["table"]: r for r in manifest.collect() if r["table"]}
    assert len(rows) == 4 + 16
    loans = read_snapshots(spark, path)
    direct = month_30.overdue_index(loans, month_30.PRINCIPAL)
    assert spark_table(spark.read.parquet(rows["overdue_index_2"]["path"]).drop("day")) == spark_table(direct)


def test_cells_of_an_earlier_run_do_not_linger(spark, tmp_path):
    path, cells = str(tmp_path / "snapshots"), str(tmp_path / "cells")
    run.refresh(ledger(spark), PERIODS, path)
    for dates in (days(PERIODS), days(PERIODS)[2:]):
        stored = run._store_cells(spark, path, dates, cells, everyone, True)
        assert stored.select("DATA_DT").distinct().count() == len(dates)


def test_no_snapshots_give_empty_tables(spark):
    none = facts(spark)
    for cadence in (MONTH, DAY):
        tables = bundle.standard_bundle(none, dims(spark), cadence, 2, Options(detail_from=date(2020, 1, 1)))
        for name, table in tables.items():
            assert table.collect() == [], name


def test_values_outside_the_lists_are_refused_or_warned_about(spark, tmp_path):
    path, out = str(tmp_path / "snapshots"), str(tmp_path / "out")
    built = build_snapshots(ledger(spark), PERIODS)
    odd = built.withColumn("OVERDUE_STATUS_5", F.expr("CASE WHEN OVERDUE_STATUS_5 = 4 THEN 9 ELSE OVERDUE_STATUS_5 END"))
    write_snapshots(odd, path)
    loans = odd.where("OVERDUE_STATUS_5 = 9").count()
    assert loans > 0
    with pytest.raises(ValueError, match=f"five-state value: .* {loans} CNT"):
        run.run_standard(spark, path, dims(spark), DAY, days(PERIODS), out, "all", options=Options(unlisted="fail"))
    found = unlisted_rows(read_snapshots(spark, path), run.unlisted(days(PERIODS), False))
    assert found["five-state value"]["CNT"] == loans
    with pytest.warns(UserWarning, match="no table shows"):
        settle(found, "warn")
    settle(found, "ignore")
    whole = build_snapshots(ledger(spark), PERIODS, cohort_by_month=True)
    settle(unlisted_rows(whole, run.unlisted(days(PERIODS), True)), "fail")
    aged = whole.withColumn("LOAN_M_CNT", F.col("LOAN_M_CNT") + 9)
    with pytest.raises(ValueError, match="months on book"):
        settle(unlisted_rows(aged, run.unlisted(days(PERIODS), True)), "fail")


def test_codes_listed_twice_add_no_rows(spark):
    twice = dims(spark).union(spark.createDataFrame([("PROV_CD", "3101", "Norton"), ("PROV_CD", "3101", "North")], "a string, b string, c string"))
    book_ = facts(spark, {"PROV_CD": "3101", "BAL": 5, "LOAN_PR": 7}, {"PROV_CD": "3102", "BAL": 5, "LOAN_PR": 7})
    assert spark_table(lending.lending_by_province(book_, twice, MONTH)) == spark_table(lending.lending_by_province(book_, dims(spark), MONTH))
    assert [tuple(r) for r in repeated_codes(twice).collect()] == [("PROV_CD", "3101", 3, 2)]
    with pytest.raises(ValueError, match="PROV_CD 3101"):
        run._check_codes(twice, Options(repeated_codes="fail"))
    with pytest.warns(UserWarning, match="1 codes"):
        run._check_codes(twice, Options())
    run._check_codes(dims(spark), Options(repeated_codes="fail"))


@pytest.mark.parametrize("cadence", [MONTH, DAY])
def test_tables_from_stored_sums_equal_those_from_cells(spark, tmp_path, cadence):
    whole = to_cells(build_snapshots(ledger(spark), PERIODS, cohort_by_month=True))
    write_snapshots(whole, str(tmp_path / "cells"), whole=True)
    cells = read_cells(spark, str(tmp_path / "cells"), whole.schema)
    known = replace(cadence, newest=PERIODS[-1].day, oldest=min(stored_dates(spark, str(tmp_path / "cells"))))
    ages, options = months_spanned(days(PERIODS)), Options(detail_from=date(2020, 1, 1))
    by_date = run._stored(bundle.date_cells(cells), str(tmp_path / "date_cells"))
    cohorts = run._stored(vintage.cohort_sums(cells, ["OD_AMT"], oldest=known.oldest), str(tmp_path / "cohorts"))
    assert by_date.count() < cells.count()
    direct = bundle.standard_bundle(cells, dims(spark), known, ages, options)
    found = bundle.standard_bundle(cells, dims(spark), known, ages, options, by_date, cohorts)
    half = bundle.standard_bundle(cells, dims(spark), known, ages, options, by_date)
    assert set(found) == set(half) == set(direct)
    reading = set()
    for name in direct:
        assert spark_table(found[name]) == spark_table(direct[name]), name
        scans = [line for line in found[name]._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and "/cells" in line]
        if any(f"= {PERIODS[-1].day}" not in line for line in scans):
            reading.add(name)
    # with the two sums above, three scans of all dates; the others read the newest date's partition
    assert reading == {"reloan_rate_by_province"}
