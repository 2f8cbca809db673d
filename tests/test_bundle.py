from datetime import date

import pytest
from compare import dims, facts, spark_table

from riskbook.plans import bundle, month_30
from riskbook.plans.cadence import BIWEEK, DAY, MONTH, WEEK, Options
from riskbook.sources.tables import family, read_dimension, read_snapshots, write_snapshots
from riskbook.operators.rows import without_code, without_prefix
from riskbook.plans.sheets import Block, places, read_sheets, sheet_rows

JAN, FEB, MAR = date(2020, 1, 31), date(2020, 2, 29), date(2020, 3, 31)
OPTIONS = Options(detail_from=JAN)


def book(spark):
    loan = {"NEW_AMT": 10, "LOAN_PR": 10, "BAL": 10, "OVERDUE_STATUS_5_LAST": 0, "OVERDUE_STATUS_3_LAST": 0}
    return facts(
        spark,
        *[
            {**loan, "DATA_DT": d, "BEGIN_DATE": d, "PROV_CD": p, "SHENGSHI_CD": p + "01",
             "OVERDUE_STATUS_3": s, "OVERDUE_STATUS_5": 2 * s, "OD_AMT": 3 * s, "RELOAN": r,
             "RELOANTIMES": r, "BRELOAN": r, "NEW_LOAN": 1, "LIGHT": s}
            for d in (JAN, FEB, MAR)
            for p in ("3101", "3502")
            for s in (0, 1)
            for r in (1, 2)
        ],
    )


def test_layout_has_the_tables_of_its_cadence():
    def names(cadence):
        return [p.table for p in bundle.standard_layout(cadence) if p.table]

    assert (len(names(MONTH)), len(names(WEEK)), len(names(BIWEEK)), len(names(DAY))) == (25, 23, 23, 20)
    assert "fund_change_count" not in names(DAY) and "vintage_rate" not in names(WEEK)
    for cadence in (MONTH, WEEK, DAY):
        assert set(names(cadence)) == set(bundle.standard_reports(cadence, 3))
    # Table writes and text cells of a run.
    assert [len(bundle.standard_layout(c)) for c in (MONTH, WEEK, DAY)] == [28, 26, 22]


@pytest.mark.parametrize("cadence", [MONTH, DAY])
def test_labels_cover_every_column(spark, cadence):
    tables = bundle.standard_bundle(book(spark), dims(spark), cadence, 3, OPTIONS)
    labels = bundle.standard_labels(cadence, 3)
    for place in bundle.standard_layout(cadence):
        if place.header:
            assert len(labels[place.table]) == len(tables[place.table].columns), place.table


def test_week_bundle_is_written_as_text_with_positions(spark, tmp_path):
    tables = bundle.standard_bundle(book(spark), dims(spark), WEEK, 3, OPTIONS)
    kept = ("overdue_by_date", "overdue_by_province", "overdue_by_city", "overdue_by_scope", "state_stock",
            "migration_rates", "structure_count_share", "structure_detail", "structure_amount_share")
    layout = [p for p in bundle.standard_layout(WEEK) if p.table in kept or "structure_count_share" in p.below]
    manifest = bundle.write_bundle(
        spark, tables, layout, bundle.standard_labels(WEEK, 3), str(tmp_path), MAR, text=WEEK.as_text
    )
    rows = {r["table"] or r["text"]: r for r in manifest.collect()}
    assert [r["seq"] for r in manifest.orderBy("seq").collect()] == list(range(1, len(layout) + 1))
    assert (rows["overdue_by_date"]["start_row"], rows["overdue_by_date"]["n_rows"]) == (2, 3)
    assert rows["overdue_by_province"]["start_row"] == 4 + 3
    assert rows["overdue_by_city"]["start_row"] == 6 + 3 + 3
    assert rows["migration_rates"]["start_column"] == 1 + 7
    assert rows["金额比"]["start_row"] == 3 + 3
    # The first table's rows are added twice.
    assert rows["structure_detail"]["start_row"] == 6 + 3 + 3
    assert rows["structure_detail"]["labels"][0] == "日期"
    assert rows["overdue_by_scope"]["n_columns"] == 6
    stored = spark.read.parquet(rows["overdue_by_province"]["path"])
    assert {t for _, t in stored.dtypes} == {"string"}
    written = stored.collect()
    assert [r["code"] for r in written] == ["3101", "3502", None]
    assert written[-1]["od_rate"] == "15.00%"


def test_month_bundle_rows_are_in_order(spark, tmp_path):
    tables = bundle.standard_bundle(book(spark), dims(spark), MONTH, 3, OPTIONS)
    assert [r["data_dt"] for r in tables["fund_change_count"].collect()] == ["12-1月汇总", "1-2月汇总", "2-3月汇总"]
    detail = [(r["data_dt"], r["status"]) for r in tables["structure_detail"].collect()]
    assert detail[:3] == [("2020-01", "正常"), ("2020-01", "一般"), ("2020-01", "汇总")]
    assert detail[3:7] == [("2020-02", "正常"), ("2020-02", "一般"), ("2020-02", "汇总"), ("2020-02", "增量")]
    by_code = [(r["code"], r["data_dt"]) for r in tables["reloan_rate_by_province"].collect()]
    assert by_code == sorted(by_code)


def test_csv_output(spark, tmp_path):
    tables = bundle.standard_bundle(book(spark), dims(spark), MONTH, 3, OPTIONS)
    layout = [p for p in bundle.standard_layout(MONTH) if p.table == "vintage_amount"]
    labels = bundle.standard_labels(MONTH, 3)
    (row,) = bundle.write_bundle(spark, tables, layout, labels, str(tmp_path), MAR, fmt="csv").collect()
    assert (row["n_rows"], row["labels"]) == (3, ["新增放款月份", "新增放款金额", "当月", "第2个月", "第3个月"])
    assert spark.read.option("header", "true").csv(row["path"]).columns == ["begin_month", "new_amt", "m0", "m1", "m2"]


def month_30_written(spark, book_, folder, options=Options()):
    sums = month_30.core(book_)
    sums.write.parquet(f"{folder}/sums")
    stored = spark.read.parquet(f"{folder}/sums")
    return bundle.write_month_30(spark, stored, 3, str(folder), MAR, options)


def test_month_30_runs_are_stacked(spark, tmp_path):
    manifest = month_30_written(spark, book(spark), tmp_path).orderBy("seq").collect()
    assert len(manifest) == 4 + 16 + 4 and [r["seq"] for r in manifest] == list(range(1, 25))
    rows = {(r["sheet"], r["table"] or r["text"]): r for r in manifest}
    # Three cohorts per block; each block starts three rows below the one before.
    for n in (1, 2, 3, 4):
        sheet = f"资产情况{n}"
        starts = [rows[sheet, f"{t}_{n}"]["start_row"] for t in month_30.CAPITAL]
        assert starts == [3, 9, 15, 21]
        assert rows[sheet, "续贷资产情况"]["start_row"] == 14
        assert [r["table"] or r["text"] for r in manifest if r["sheet"] == sheet][2] == "续贷资产情况"
        assert rows[f"逾期情况{n}", f"overdue_index_{n}"]["start_row"] == 4


def test_month_30_tables_equal_those_made_one_by_one(spark, tmp_path):
    whole, options = book(spark), Options(first_bn_of_first_loans=True)
    rows = {r["table"]: r for r in month_30_written(spark, whole, tmp_path, options).collect() if r["table"]}
    for n, (outside, basis) in enumerate(month_30.RUNS, 1):
        facts_ = without_code(whole) if outside else whole
        direct = {"overdue_index": month_30.overdue_index(facts_, basis, options), **month_30.capital_tables(facts_, basis, 3)}
        for name, table in direct.items():
            row = rows[f"{name}_{n}"]
            stored = spark.read.parquet(row["path"]).drop("day")
            assert stored.columns == table.columns and len(table.columns) == row["n_columns"]
            assert spark_table(stored) == spark_table(table), (name, n)
            assert row["n_rows"] == table.count()


def test_month_30_sheets_are_read_back_by_sheet_and_row(spark, tmp_path):
    manifest = month_30_written(spark, book(spark), tmp_path)
    path = next(str(p) for p in tmp_path.glob(f"version=*/sheets/run_date={MAR}"))
    assert spark_table(bundle.read_run_sheets(spark, manifest)) == spark_table(read_sheets(spark, path))
    top = read_sheets(spark, path, "资产情况3", (1, 4)).orderBy("row").collect()
    assert [(r["block"], r["kind"], r["row"]) for r in top] == [(1, "header", 3), (1, "body", 4)]
    assert top[0]["cells"] == ["新增放款月份", "新增放款金额", "当月", "第2个月", "第3个月"] and top[1]["cells"][0] == "2020-01"
    rows = read_sheets(spark, path, "资产情况1").orderBy("row").collect()
    numbers = [r["row"] for r in rows]
    assert len(set(numbers)) == len(numbers) and numbers[0] == 3 and numbers[-1] == 24
    heading = next(r for r in rows if r["kind"] == "heading")
    assert (heading["row"], heading["cells"], heading["block"]) == (14, ["续贷资产情况"], 3)
    rate = next(r for r in rows if r["row"] == 10)
    assert (rate["block"], rate["cells"][2]) == (2, "0.00%")
    plan = read_sheets(spark, path, "资产情况2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(sheet" in plan


def test_month_30_reads_the_cells_once(spark, tmp_path):
    write_snapshots(book(spark), str(tmp_path / "cells"))
    sums = month_30.core(read_snapshots(spark, str(tmp_path / "cells")))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    sums.write.parquet(str(tmp_path / "sums"))
    runs = month_30.by_run(spark.read.parquet(str(tmp_path / "sums")))
    for table in (month_30.overdue_index_of_runs(runs), month_30.capital_of_runs(runs, 3)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "/cells" not in plan and plan.count("FileScan") == 1


def test_blocks_without_rows_keep_their_place(spark):
    blocks = [Block("a", 1, "x", 2, ("h",)), Block("a", 2, "y", 2), Block("a", 3, "z", 2, ("h",), "over"), Block("b", 1, "w", 5)]
    rows = spark.createDataFrame([("a", 3, 1, ["u"]), ("a", 3, 2, ["v"])], "sheet string, block int, place int, cells array<string>")
    placed = places(spark, blocks, rows, 3)
    assert {(r["table"], r["start_row"], r["n_rows"]) for r in placed.collect()} == {("x", 2, 0), ("y", 5, 0), ("z", 8, 2), ("w", 5, 0)}
    found = sorted((r["sheet"], r["row"], r["kind"], r["cells"][0]) for r in sheet_rows(placed, rows).collect())
    assert found == [("a", 2, "header", "h"), ("a", 7, "heading", "over"), ("a", 8, "header", "h"), ("a", 9, "body", "u"), ("a", 10, "body", "v")]


def test_stored_snapshots_are_read_by_date_and_population(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    write_snapshots(book(spark), path)
    chosen = read_snapshots(spark, path, [FEB, MAR], without_prefix)
    assert chosen.select("DATA_DT", "PROV_CD").distinct().count() == 2
    plan = chosen.select("BAL")._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [" in scan and "DATA_DT" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<PROV_CD:string,BAL:bigint>" in scan
    # Writing one date again replaces that date only.
    write_snapshots(book(spark).where("DATA_DT = DATE '2020-02-29'").limit(1), path)
    counts = {r["DATA_DT"]: r["count"] for r in read_snapshots(spark, path).groupBy("DATA_DT").count().collect()}
    assert counts == {JAN: 8, FEB: 1, MAR: 8}


def test_dimension_is_read_and_split_by_family(spark, tmp_path):
    path = str(tmp_path / "dimension")
    dims(spark).write.parquet(path)
    assert [tuple(r) for r in family(read_dimension(spark, path), "PROV_CD").collect()] == [("3101", "North")]


def test_a_run_that_fails_leaves_the_one_before(spark, tmp_path):
    tables = bundle.standard_bundle(book(spark), dims(spark), DAY, 3, OPTIONS)
    kept = ("overdue_by_date", "overdue_by_province")
    layout, labels = [p for p in bundle.standard_layout(DAY) if p.table in kept], bundle.standard_labels(DAY, 3)

    def write(chosen):
        return bundle.write_bundle(spark, chosen, layout, labels, str(tmp_path), MAR)

    def whole(manifest):
        rows = manifest.orderBy("seq").collect()
        assert [r["table"] for r in rows] == list(kept)
        return [spark_table(spark.read.parquet(r["path"])) for r in rows]

    with pytest.raises(FileNotFoundError):
        bundle.read_manifest(spark, str(tmp_path), MAR)
    first = whole(write(tables))
    changed = {name: table.limit(1) for name, table in tables.items()}
    broken = {**changed, "overdue_by_province": changed["overdue_by_province"].selectExpr("*", "raise_error('lost') AS x")}
    with pytest.raises(Exception, match="lost"):
        write(broken)
    # the first table of the failed run is written, yet readers see the whole run before
    assert len(list(tmp_path.glob("version=*/report=overdue_by_date"))) == 2
    assert whole(bundle.read_manifest(spark, str(tmp_path), MAR)) == first
    second = whole(write(changed))
    assert whole(bundle.read_manifest(spark, str(tmp_path), MAR)) == second != first
