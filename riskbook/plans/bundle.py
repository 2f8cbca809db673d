"""Report bundles: every table of a run, where it belongs, and how it is written.

A run writes each table as a dataset of its own and one manifest that says, for
each table, its sheet, start row, start column and header labels.  Tables are
report results, bounded by periods times codes; nothing here collects them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date
from functools import partial
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbook.functions.columns import percent_text
from riskbook.operators.rows import union_rows
from riskbook.plans import lending, light, migration, month_30, overdue, reloan, structure, vintage
from riskbook.plans.cadence import Cadence, Options
from riskbook.plans.sheets import Block, body_rows, places, read_sheets, sheet_rows, write_sheets
from riskbook.schema import MEASURES, OF_COHORTS


class Place(NamedTuple):
    """A table (or a text cell) on a sheet.

    The start row is ``row`` plus the row counts of the tables in ``below``;
    the start column is ``column`` plus the column count of ``right_of``.
    """

    sheet: str
    table: str | None
    row: int
    column: int = 1
    header: bool = False
    below: tuple[str, ...] = ()
    right_of: str | None = None
    text: str | None = None


MANIFEST = T.StructType(
    [
        T.StructField("seq", T.IntegerType()),
        T.StructField("sheet", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("start_row", T.IntegerType()),
        T.StructField("start_column", T.IntegerType()),
        T.StructField("header", T.BooleanType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("n_rows", T.IntegerType()),
        T.StructField("n_columns", T.IntegerType()),
        T.StructField("path", T.StringType()),
    ]
)

# Sheets, cell positions and texts of the standard workbook.
STANDARD_LAYOUT = (
    Place("资金变化", "fund_change_count", 2),
    Place("资金变化", None, 2, below=("fund_change_count",), text="金额"),
    Place("资金变化", "fund_change_amount", 3, below=("fund_change_count",)),
    Place("续贷逾期情况", "reloan_overdue_by_date", 4),
    Place("续贷逾期情况", "reloan_overdue_by_province", 6, header=True, below=("reloan_overdue_by_date",)),
    Place("还款情况", "repayment", 3),
    Place("迁徙率月度情况", "state_stock", 2),
    Place("迁徙率月度情况", "migration_rates", 2, right_of="state_stock"),
    Place("资产情况月度分析", "vintage_amount", 3, header=True),
    Place("资产情况月度分析", "vintage_rate", 4, header=True, below=("vintage_amount",)),
    Place("终止和到期情况", "termination_maturity", 4),
    Place("资产结构类数据", "structure_count_share", 2, header=True),
    Place("资产结构类数据", None, 3, below=("structure_count_share",), text="金额比"),
    Place("资产结构类数据", "structure_amount_share", 4, header=True, below=("structure_count_share",)),
    # The row count of the first table is added twice, not that of the second.
    Place("资产结构类数据", "structure_detail", 6, header=True, below=("structure_count_share",) * 2),
    Place("放款情况", "lending_by_province", 2),
    Place("放款情况", "lending_by_city", 2, column=11),
    Place("放款情况", "lending_by_date", 25, column=3, header=True),
    Place("逾期率及不良率", "overdue_by_date", 2),
    Place("逾期率及不良率", "overdue_by_province", 4, header=True, below=("overdue_by_date",)),
    Place("逾期率及不良率", "overdue_by_city", 6, header=True, below=("overdue_by_date", "overdue_by_province")),
    Place("逾期率及不良率", "overdue_by_scope", 3, column=19),
    Place("黄绿灯逾期（历史值）", "light_by_date", 3, column=4),
    Place("黄绿灯逾期（历史值）", "light_by_province", 5, column=4, header=True, below=("light_by_date",)),
    Place("续贷情况（历史值）", "reloan_rate_by_date", 3),
    Place("续贷情况（历史值）", "reloan_rate_by_province", 3, column=11),
    Place("续贷情况（历史值）", None, 5, below=("reloan_rate_by_date",), text="借据号概念"),
    Place("续贷情况（历史值）", "reloan_new_vs_cumulative", 6, header=True, below=("reloan_rate_by_date",)),
)

# Header labels of the tables written with one.
FIRST_LABEL = {"month": "month", "other": "日期"}
LABELS = {
    "reloan_overdue_by_province": (
        "公司ID", "CORP", "首贷数量", "首贷逾期数", "首贷余额", "首贷逾期金额", "首贷逾期率",
        "续贷数量", "续贷逾期数", "续贷余额", "续贷逾期金额", "续贷逾期率",
        "未结清数", "保理逾期户数", "省余额", "保理逾期金额", "保理逾期率",
        "银行逾期户数", "银行逾期金额", "银行逾期率", "银行不良户数", "银行不良金额", "银行不良率",
    ),
    "structure_count_share": ("正常", "一般", "催收", "严重"),
    "structure_amount_share": ("一般", "催收", "严重"),
    "structure_detail": ("状态", "未结清户数", "占比", "逾期本金", "逾期总额", "余额", "占比"),
    "overdue_by_province": (
        "CORP", "公司ID", "未结清户数", "省余额", "保理逾期户数", "保理逾期金额", "保理逾期率",
        "银行逾期户数", "银行逾期金额", "银行逾期率", "银行不良户数", "银行不良金额", "银行不良率",
        "逾期余额", "余额逾期率",
    ),
    "overdue_by_city": ("编码", "地市营业部", "未结清数", "余额", "逾期数", "逾期金额", "逾期率"),
    "light_by_province": (
        "编号", "分公司", "未结清数", "余额", "逾期数", "逾期总额", "逾期率",
        "未结清_黄灯", "黄灯余额", "黄灯逾期数", "黄灯逾期金额", "黄灯逾期率",
        "未结清_绿灯", "绿灯余额", "绿灯逾期数", "绿灯逾期金额", "绿灯逾期率",
    ),
}
LENDING_LABELS = {
    "month": ("月份", "新增放款户数", "新增放款金额", "当月累计金额", "当月累计户数"),
    "other": ("日期", "新增放款户数", "新增放款金额", "当日累计金额", "当日累计户数"),
}
REPEAT_LABELS = {
    "month": ("月份", "续贷人次", "续贷金额", "累计续贷人次", "累计续贷金额"),
    "other": ("日期", "续贷人次", "续贷金额", "累计续贷人次", "累计续贷金额"),
}
VINTAGE_LABELS = ("新增放款月份", "新增放款金额")
REPEAT_HEADING = "续贷资产情况"
INDEX_SHEET, CAPITAL_SHEET = "逾期情况", "资产情况"

Report = Callable[[DataFrame, DataFrame, Cadence], DataFrame]


def standard_reports(cadence: Cadence, ages: int, options: Options = Options()) -> dict[str, Report]:
    """The reports a cadence has, by name."""
    reports: dict[str, Report] = {}
    if cadence.compares_periods:
        reports |= {
            "fund_change_count": migration.fund_change_count,
            "fund_change_amount": migration.fund_change_amount,
            "migration_rates": migration.migration_rates,
        }
    if cadence.vintages:
        reports |= {
            "vintage_amount": lambda f, d, c: vintage.vintage(f, ages, ordered=c.ordered, oldest=c.oldest),
            "vintage_rate": lambda f, d, c: vintage.vintage_rates(
                vintage.vintage(f, ages, ordered=c.ordered, oldest=c.oldest)
            ),
        }
    return reports | {
        "reloan_overdue_by_date": reloan.reloan_overdue_by_date,
        "reloan_overdue_by_province": reloan.reloan_overdue_by_province,
        "repayment": lending.repayment,
        "state_stock": structure.state_stock,
        "termination_maturity": lending.termination_maturity,
        "structure_count_share": structure.structure_count_share,
        "structure_amount_share": structure.structure_amount_share,
        "structure_detail": partial(structure.structure_detail, options=options),
        "lending_by_province": lending.lending_by_province,
        "lending_by_city": lending.lending_by_city,
        "lending_by_date": lending.lending_by_date,
        "overdue_by_date": overdue.overdue_by_date,
        "overdue_by_province": overdue.overdue_by_province,
        "overdue_by_city": overdue.overdue_by_city,
        "overdue_by_scope": overdue.overdue_by_scope,
        "light_by_date": light.light_by_date,
        "light_by_province": light.light_by_province,
        "reloan_rate_by_date": reloan.reloan_rate_by_date,
        "reloan_rate_by_province": reloan.reloan_rate_by_province,
        "reloan_new_vs_cumulative": reloan.reloan_new_vs_cumulative,
    }


# Attributes that only the reports below tell apart; the others see a date's cells without them.
CODES = ("PROV_CD", "SHENGSHI_CD", "LOAN_PR_SCOPE")
BY_CODE = (
    "reloan_overdue_by_province",
    "lending_by_province",
    "lending_by_city",
    "overdue_by_province",
    "overdue_by_city",
    "overdue_by_scope",
    "light_by_province",
    "reloan_rate_by_province",
)
MATRICES = ("vintage_amount", "vintage_rate")


def date_cells(cells: DataFrame) -> DataFrame:
    """The cells without codes and cohorts: a few rows for each date, enough for every report by date."""
    keys = [c for c in cells.columns if c not in (*CODES, *OF_COHORTS, *MEASURES)]
    return cells.groupBy(*keys).agg(*[F.expr(f"sum({m}) AS {m}") for m in MEASURES])


def standard_bundle(
    facts: DataFrame,
    dims: DataFrame,
    cadence: Cadence,
    ages: int,
    options: Options = Options(),
    by_date: DataFrame | None = None,
    cohorts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All tables of a cadence, rows in presentation order.

    With ``by_date`` (stored ``date_cells``) the reports by date read that, and with ``cohorts`` (stored
    ``cohort_sums``) the matrices; what is left reads the newest date's cells, and one report the codes of all dates.
    """
    ordered = replace(cadence, ordered=True)
    reports = standard_reports(cadence, ages, options)
    tables = {
        name: plan(facts if by_date is None or name in (*BY_CODE, *MATRICES) else by_date, dims, ordered)
        for name, plan in reports.items()
    }
    if cohorts is not None and cadence.vintages:
        amounts = vintage.shown(vintage.matrix(cohorts, ages, "OD_AMT"), ages, ordered=True)
        tables |= dict(zip(MATRICES, (amounts, vintage.vintage_rates(amounts)), strict=True))
    # Written without its key column: the sheet has the size classes printed on it.
    tables["overdue_by_scope"] = tables["overdue_by_scope"].drop("loan_pr_scope")
    return tables


def standard_layout(cadence: Cadence) -> list[Place]:
    """Places of the tables a cadence has; a text cell goes with the table it follows."""
    have = standard_reports(cadence, 0)
    return [p for p in STANDARD_LAYOUT if (p.table in have if p.table else set(p.below) <= set(have))]


def standard_labels(cadence: Cadence, ages: int) -> dict[str, tuple[str, ...]]:
    kind = "month" if cadence.monthly else "other"
    dated = ("structure_count_share", "structure_amount_share", "structure_detail")
    cohorts = (*VINTAGE_LABELS, *vintage.age_labels(ages))
    return {
        **LABELS,
        **{t: (FIRST_LABEL[kind], *LABELS[t]) for t in dated},
        "lending_by_date": LENDING_LABELS[kind],
        "reloan_new_vs_cumulative": REPEAT_LABELS[kind],
        "vintage_amount": cohorts,
        "vintage_rate": cohorts,
    }


# First rows of the 30-day sheets and the rows between their blocks.
INDEX_ROW, CAPITAL_ROW, BLOCK_GAP = 4, 3, 3


def month_30_blocks(ages: int) -> list[Block]:
    """The blocks of the 30-day sheets: an index for each run, and its four cohort tables one below the other."""
    runs = range(1, len(month_30.RUNS) + 1)
    labels = (*VINTAGE_LABELS, *vintage.age_labels(ages))
    index = [Block(f"{INDEX_SHEET}{n}", 1, f"overdue_index_{n}", INDEX_ROW) for n in runs]
    headings = {"reloan_vintage_amount": REPEAT_HEADING}
    return index + [
        Block(f"{CAPITAL_SHEET}{n}", place, f"{kind}_{n}", CAPITAL_ROW, labels, headings.get(kind))
        for n in runs
        for place, kind in enumerate(month_30.CAPITAL, 1)
    ]


def write_month_30(
    spark: SparkSession, sums: DataFrame, ages: int, folder: str, run_date: date, options: Options = Options()
) -> DataFrame:
    """Writes the 30-day tables of all runs and their sheets; returns the manifest.

    ``sums`` is the stored result of :func:`riskbook.plans.month_30.core`.  The index of all runs is one dataset by run,
    amounts and rates are one each by run and loans; the sheets are written from those, and the manifest
    from the sheets' places.
    """
    version = new_version()
    base, runs = f"{folder}/version={version}", month_30.by_run(sums)
    index, capital = month_30.overdue_index_of_runs(runs, options), month_30.capital_of_runs(runs, ages)
    cells = {"amount": [f"m{a}" for a in range(ages)], "rate": [f"r{a} AS m{a}" for a in range(ages)]}
    stored = {"overdue_index": _stored(index, f"{base}/report=overdue_index/run_date={run_date}", ["RUN"])}
    for place, kind in enumerate(("amount", "rate"), 1):
        of_kind = capital.where(f"block % 2 = {place % 2}").selectExpr(
            "RUN", "CASE WHEN block > 2 THEN 'repeat' ELSE 'all' END AS loans", "day", "begin_month", "new_amt", *cells[kind]
        )
        path = f"{base}/report=vintage_{kind}/run_date={run_date}"
        stored[f"vintage_{kind}"] = _stored(of_kind, path, ["RUN", "loans"])

    columns = {name: [c for c in df.columns if c not in ("RUN", "loans", "day")] for name, df in stored.items()}
    block = {"vintage_amount": "CASE loans WHEN 'all' THEN 1 ELSE 3 END", "vintage_rate": "CASE loans WHEN 'all' THEN 2 ELSE 4 END"}
    bodies = [
        body_rows(
            df,
            f"concat('{INDEX_SHEET if name == 'overdue_index' else CAPITAL_SHEET}', RUN)",
            block.get(name, "1"),
            "day",
            [f"({percent_text(c)})" if kind == "double" else c for c, kind in df.select(*columns[name]).dtypes],
        )
        for name, df in stored.items()
    ]
    body = bodies[0].unionByName(bodies[1]).unionByName(bodies[2])
    placed = places(spark, month_30_blocks(ages), body, BLOCK_GAP)
    write_sheets(sheet_rows(placed, body), f"{base}/sheets/run_date={run_date}")

    def path_of(table: str, run: str) -> str:
        kind = table.rpartition("_")[0]
        name = kind.removeprefix("reloan_")
        loans = "" if name == "overdue_index" else f"/loans={'repeat' if kind != name else 'all'}"
        return f"{base}/report={name}/run_date={run_date}/RUN={run}{loans}"

    rows, width = [], {name: len(c) for name, c in columns.items()}
    for r in sorted(placed.collect(), key=lambda r: (r["table"].startswith("overdue_index") is False, r["sheet"], r["block"])):
        run, name = r["sheet"][-1], r["table"].rpartition("_")[0].removeprefix("reloan_")
        if r["heading"]:
            rows.append((r["sheet"], None, r["heading"], r["start_row"] - 1, 1, False, None, 1, 1, None))
        header = r["labels"] is not None
        rows.append((r["sheet"], r["table"], None, r["start_row"], 1, header, r["labels"], r["n_rows"], width[name], path_of(r["table"], run)))
    return _commit(spark, [(i, *row) for i, row in enumerate(rows, 1)], folder, run_date, version)


def _stored(table: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """A small table stored by its keys, rows in order within them."""
    table.repartition(1).sortWithinPartitions(*keys, "day").write.mode("overwrite").partitionBy(*keys).parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def as_text(table: DataFrame) -> DataFrame:
    """Every cell as text, rates as percents."""
    return table.selectExpr(
        *[
            f"{percent_text(name) if kind == 'double' else f'CAST({name} AS STRING)'} AS {name}"
            for name, kind in table.dtypes
        ]
    )


# Tables that are written at the same time.
WRITERS = 8


def write_bundle(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    layout: Sequence[Place],
    labels: dict[str, tuple[str, ...]],
    folder: str,
    run_date: date,
    text: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """Writes each table into a new version of the run and returns the manifest.

    Tables lie under ``folder/version=<version>/report=<name>/run_date=<day>``.  The manifest, which names
    them, is the last thing written and appears at once (``read_manifest``); until then, and if a write
    fails, readers see the whole of the version before.  Row counts come from the written files.
    """
    options, version = {"header": "true"} if fmt == "csv" else {}, new_version()
    names = list(dict.fromkeys(p.table for p in layout if p.table))
    written = {name: as_text(tables[name]) if text else tables[name] for name in names}
    paths = {name: f"{folder}/version={version}/report={name}/run_date={run_date}" for name in names}
    # each table is a few rows and a few small jobs, so several are written at a time
    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(lambda n: written[n].write.format(fmt).options(**options).save(paths[n]), names))
    stored = [
        spark.read.format(fmt).options(**options).schema(written[n].schema).load(paths[n]).select(F.lit(n).alias("name"))
        for n in names
    ]
    found = {r["name"]: r["count"] for r in union_rows(stored).groupBy("name").count().collect()} if stored else {}
    shapes = {name: (found.get(name, 0), len(written[name].columns)) for name in names}
    rows = [_manifest_row(i, p, shapes, paths, labels) for i, p in enumerate(layout, 1)]
    return _commit(spark, rows, folder, run_date, version)


def new_version() -> str:
    """A name for a run's version; later ones sort after earlier ones."""
    return f"{time.time_ns():020d}-{uuid4().hex[:8]}"


def _commit(spark: SparkSession, rows: list[tuple], folder: str, run_date: date, version: str) -> DataFrame:
    """Writes the manifest beside its place and moves it there, which makes the version the one that is read."""
    passing, parent = f"{folder}/_manifest/{version}", f"{folder}/manifest/run_date={run_date}"
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(passing)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(parent))
    if not files.rename(path(passing), path(f"{parent}/version={version}")):
        raise OSError(f"the manifest of version {version} could not be moved to its place")
    return read_manifest(spark, folder, run_date)


def read_manifest(spark: SparkSession, folder: str, run_date: date) -> DataFrame:
    """The manifest of the newest whole version of a run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest/run_date={run_date}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    versions = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    if not versions:
        raise FileNotFoundError(f"no run of {run_date} in {folder}")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest/run_date={run_date}/{max(versions)}")


def read_run_sheets(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The sheet rows of the run that a 30-day manifest belongs to."""
    table = manifest.where("path IS NOT NULL").select("path").first()["path"]
    version, _, run_date = table.partition("/report=")[0], *table.rpartition("run_date=")[1:]
    return read_sheets(spark, f"{version}/sheets/run_date={run_date.split('/')[0]}")


def _manifest_row(seq, place: Place, shapes, paths, labels) -> tuple:
    n_rows, n_columns = shapes[place.table] if place.table else (1, 1)
    return (
        seq,
        place.sheet,
        place.table,
        place.text,
        place.row + sum(shapes[t][0] for t in place.below),
        place.column + (shapes[place.right_of][1] if place.right_of else 0),
        place.header,
        list(labels[place.table]) if place.header else None,
        n_rows,
        n_columns,
        paths.get(place.table),
    )
