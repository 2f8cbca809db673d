"""30-day overdue family: index by date and cohort matrices, on two amount bases."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions.columns import BANK_NON_PERFORMING, EXCLUDED_CODE, both, month_text, rate
from riskbook.operators.rows import arrange
from riskbook.operators.sums import Part, fused_sums
from riskbook.plans.cadence import Options
from riskbook.plans.vintage import cohort_sums, matrix, vintage, vintage_rates


class Basis(NamedTuple):
    name: str
    overdue: str
    lent: str


# The two amount bases, with and without interest and fees.
INTEREST = Basis("interest", "OD_AMT_30", "LOAN_PR_FEE")
PRINCIPAL = Basis("principal", "OD_PRINCIPAL_30", "LOAN_PR")
BASES = (INTEREST, PRINCIPAL)

FIRST, REPEAT, EVERY = "RELOAN_CLASS = 1", "RELOAN_CLASS <> 1", "TRUE"
REPEAT_COHORT = "BRELOAN_CLASS <> 1"

# What the tables of this family tell apart, and what they add up.
CORE_KEYS = (
    "DATA_DT",
    "BEGIN_DATE",
    "LOAN_M_CNT",
    "RELOAN_CLASS",
    "BRELOAN_CLASS",
    "MATURITY_CLASS",
    "OVERDUE_STATUS_3_30",
)
CORE_SUMS = ("CNT", "NEW_AMT", *(m for b in BASES for m in (b.overdue, b.lent)))

# The runs in their order: both populations, each on both bases.
RUNS = tuple((outside, basis) for outside in (False, True) for basis in BASES)


def core(facts: DataFrame, code: str = EXCLUDED_CODE) -> DataFrame:
    """Sums from which every table of every run is cut: the one pass over the cells.

    Its rows are dates by cohorts by a few classes, whatever the size of the book.  ``OUTSIDE`` is whether
    the loans are outside the excluded province.
    """
    outside = f"coalesce(PROV_CD <> '{code}', false) AS OUTSIDE"
    return facts.selectExpr(outside, *CORE_KEYS, *CORE_SUMS).groupBy("OUTSIDE", *CORE_KEYS).agg(
        *[F.expr(f"sum({m}) AS {m}") for m in CORE_SUMS]
    )


def by_run(sums: DataFrame) -> DataFrame:
    """Rows of ``core`` once for each run they belong to: ``RUN`` (from 1), and its basis as ``OD`` and ``LENT``."""
    runs = ", ".join(
        f"CASE WHEN {'OUTSIDE' if outside else 'TRUE'} THEN "
        f"named_struct('RUN', {n}, 'OD', {basis.overdue}, 'LENT', {basis.lent}) END"
        for n, (outside, basis) in enumerate(RUNS, 1)
    )
    keys = [f"`{k}`" for k in CORE_KEYS]
    return sums.selectExpr(*keys, "CNT", "NEW_AMT", f"inline(filter(array({runs}), r -> r IS NOT NULL))")


def overdue_index(
    facts: DataFrame, basis: Basis, options: Options = Options(), ordered: bool = False
) -> DataFrame:
    """First loans, repeat loans, all loans: counts, 30-day overdue and rates by month."""
    sums = fused_sums(facts, "DATA_DT", _index_parts(basis, options), fill=True)
    if ordered:
        sums = arrange(sums, "DATA_DT")
    return sums.selectExpr(*_index_columns())


def overdue_index_of_runs(runs: DataFrame, options: Options = Options()) -> DataFrame:
    """The index of all runs: its columns behind ``RUN`` and ``DATA_DT``."""
    parts = _index_parts(Basis("run", "OD", "LENT"), options)
    return fused_sums(runs, ["RUN", "DATA_DT"], parts, fill=True).selectExpr("RUN", "DATA_DT AS day", *_index_columns())


def _index_parts(basis: Basis, options: Options) -> list[Part]:
    return [
        *_parts("first", FIRST, FIRST if options.first_bn_of_first_loans else REPEAT, basis),
        *_parts("repeat", REPEAT, REPEAT, basis),
        *_parts("all", EVERY, EVERY, basis),
    ]


def _index_columns() -> list[str]:
    columns = []
    for who in ("first", "repeat"):
        columns += [f"{who}_{c}" for c in ("cnt", "od_cnt", "lent", "od_amt", "bn_amt")]
        columns += _rates(who)
    columns += [f"all_{c}" for c in ("cnt", "od_cnt", "od_amt", "bn_amt", "lent")]
    return [f"{month_text('DATA_DT')} AS data_dt", *columns, *_rates("all")]


def _parts(who: str, which: str, bn_which: str, basis: Basis) -> list[Part]:
    return [
        Part(f"{who}_cnt", "CNT", both(which, "OVERDUE_STATUS_3_30 <> 2")),
        Part(f"{who}_od_cnt", "CNT", both(which, "OVERDUE_STATUS_3_30 = 1")),
        Part(f"{who}_lent", basis.lent, which),
        Part(f"{who}_od_amt", basis.overdue, which),
        Part(f"{who}_bn_amt", basis.overdue, both(bn_which, BANK_NON_PERFORMING)),
    ]


def _rates(who: str) -> list[str]:
    return [
        f"{rate(f'{who}_od_amt', f'{who}_lent')} AS {who}_od_rate",
        f"{rate(f'{who}_bn_amt', f'{who}_lent')} AS {who}_bn_rate",
    ]


def capital_tables(
    facts: DataFrame, basis: Basis, ages: int, ordered: bool = False, oldest: date | None = None
) -> dict[str, DataFrame]:
    """Cohort matrices, amounts and rates, of all loans and of repeat loans."""
    everyone = vintage(facts, ages, basis.overdue, ordered=ordered, oldest=oldest)
    repeats = vintage(facts, ages, basis.overdue, REPEAT_COHORT, ordered, oldest)
    return dict(zip(CAPITAL, (everyone, vintage_rates(everyone), repeats, vintage_rates(repeats)), strict=True))


# The cohort tables in their order on a sheet.
CAPITAL = ("vintage_amount", "vintage_rate", "reloan_vintage_amount", "reloan_vintage_rate")


def capital_of_runs(runs: DataFrame, ages: int) -> DataFrame:
    """The cohort matrices of all runs: ``RUN``, ``block`` (1 and 2 all loans, 3 and 4 repeat loans; amounts
    before rates), ``day``, ``begin_month``, ``new_amt`` and the cells, rates beside amounts (``r0`` ...)."""
    repeats = {f"REPEAT_{m}": f"CASE WHEN {REPEAT_COHORT} THEN {m} END" for m in ("NEW_AMT", "OD")}
    marked = runs.selectExpr("*", *[f"{rule} AS {name}" for name, rule in repeats.items()])
    sums = cohort_sums(marked, ["OD", *repeats], runs=["RUN"])
    sets = "named_struct('first_block', 1, 'NEW_AMT', NEW_AMT, 'OD', OD), named_struct('first_block', 3, 'NEW_AMT', REPEAT_NEW_AMT, 'OD', REPEAT_OD)"
    split = sums.selectExpr("RUN", "BEGIN_DATE", "LOAN_M_CNT", f"inline(array({sets}))")
    wide = matrix(split, ages, "OD", ["RUN", "first_block"])
    rates = [f"{rate(f'm{a}', 'new_amt')} AS r{a}" for a in range(ages)]
    return wide.selectExpr(
        "RUN", "explode(array(first_block, first_block + 1)) AS block", "BEGIN_DATE AS day",
        f"{month_text('BEGIN_DATE')} AS begin_month", "new_amt", *[f"m{a}" for a in range(ages)], *rates,
    )
