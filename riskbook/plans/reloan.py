"""First loans against repeat loans: overdue state, repeat rate, repeat lending."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskbook.functions.columns import (
    BANK_NON_PERFORMING,
    BANK_OVERDUE,
    OUTSTANDING,
    OVERDUE,
    SETTLED,
    both,
    rate,
)
from riskbook.operators.rows import latest, lookup
from riskbook.operators.sums import Part, fused_sums, names, with_grand_total
from riskbook.plans.cadence import Cadence


def _ordinal_parts(prefix: str, which: str) -> list[Part]:
    return [
        Part(f"{prefix}_cnt", "CNT", both(which, OUTSTANDING)),
        Part(f"{prefix}_od_cnt", "CNT", both(which, OVERDUE)),
        Part(f"{prefix}_bal", "BAL", which),
        Part(f"{prefix}_od_amt", "OD_AMT", which),
    ]


FIRST = _ordinal_parts("first", "RELOAN_CLASS = 1")
REPEAT = _ordinal_parts("repeat", "RELOAN_CLASS <> 1")
REPEAT_RATE = [
    Part("second_cnt", "CNT", "RELOANTIMES_CLASS = 2"),
    Part("settled_first_cnt", "CNT", both("RELOANTIMES_CLASS = 1", SETTLED)),
]


def _rate_of_all(kind: str) -> str:
    return f"{rate(f'all_{kind}_amt', 'all_bal')} AS all_{kind}_rate"


def _od_rate(prefix: str) -> str:
    return f"{rate(f'{prefix}_od_amt', f'{prefix}_bal')} AS {prefix}_od_rate"


def reloan_overdue_by_date(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    every = [
        Part("all_cnt", "CNT", OUTSTANDING),
        Part("all_od_cnt", "CNT", OVERDUE),
        Part("all_od_amt", "OD_AMT"),
        Part("all_bo_amt", "OD_AMT", BANK_OVERDUE),
        Part("all_bn_amt", "OD_AMT", BANK_NON_PERFORMING),
        Part("all_bal", "BAL"),
    ]
    sums = fused_sums(facts, "DATA_DT", [*FIRST, *REPEAT, *every])
    return cadence.by_date(sums).selectExpr(
        f"{cadence.key()} AS data_dt",
        *names(FIRST),
        _od_rate("first"),
        *names(REPEAT),
        _od_rate("repeat"),
        *names(every),
        *[_rate_of_all(kind) for kind in ("od", "bo", "bn")],
    )


def reloan_overdue_by_province(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    every = [
        Part("all_cnt", "CNT", OUTSTANDING),
        Part("all_od_cnt", "CNT", OVERDUE),
        Part("all_bal", "BAL"),
        Part("all_od_amt", "OD_AMT"),
        Part("all_bo_cnt", "CNT", both(BANK_OVERDUE, OUTSTANDING)),
        Part("all_bo_amt", "OD_AMT", BANK_OVERDUE),
        Part("all_bn_cnt", "CNT", both(BANK_NON_PERFORMING, OUTSTANDING)),
        Part("all_bn_amt", "OD_AMT", BANK_NON_PERFORMING),
    ]
    parts = [*FIRST, *REPEAT, *every]
    sums = fused_sums(latest(facts, cadence.newest), "PROV_CD", parts, fill=True)
    rows = lookup(with_grand_total(sums, "PROV_CD", names(parts)), dims, "PROV_CD", "PROV_CD")
    return cadence.by_code(rows).selectExpr(
        "code",
        "name",
        *names(FIRST),
        _od_rate("first"),
        *names(REPEAT),
        _od_rate("repeat"),
        "all_cnt",
        "all_od_cnt",
        "all_bal",
        "all_od_amt",
        _rate_of_all("od"),
        "all_bo_cnt",
        "all_bo_amt",
        _rate_of_all("bo"),
        "all_bn_cnt",
        "all_bn_amt",
        _rate_of_all("bn"),
    )


def reloan_rate_by_date(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    return cadence.by_date(fused_sums(facts, "DATA_DT", REPEAT_RATE)).selectExpr(
        f"{cadence.key()} AS data_dt",
        *names(REPEAT_RATE),
        f"{rate('second_cnt', 'settled_first_cnt')} AS reloan_rate",
    )


def reloan_rate_by_province(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    sums = fused_sums(facts, ["PROV_CD", "DATA_DT"], REPEAT_RATE, fill=True)
    return cadence.by_code_and_date(lookup(sums, dims, "PROV_CD", "PROV_CD")).selectExpr(
        "code",
        "name",
        f"{cadence.key()} AS data_dt",
        *names(REPEAT_RATE),
        f"{rate('second_cnt', 'settled_first_cnt')} AS reloan_rate",
    )


def reloan_new_vs_cumulative(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    """Repeat lending begun on a date, beside all repeat lending as of that date."""

    def sums(kind: str, day: str, which: str) -> DataFrame:
        shown = facts.where(which).selectExpr(f"{cadence.key(day)} AS data_dt", "CNT", "LOAN_PR")
        parts = [Part(f"{kind}_cnt", "CNT"), Part(f"{kind}_loan_pr", "LOAN_PR")]
        return fused_sums(shown, "data_dt", parts)

    begun = sums("new", "REPEAT_BEGIN_DATE", "REPEAT_BEGIN_DATE IS NOT NULL")
    standing = sums("cum", "DATA_DT", "RELOANTIMES_CLASS <> 1")
    return cadence.by_date(begun.join(standing, "data_dt", "full_outer"))
