"""Overdue and non-performing rates by date, province, city and loan size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskbook.functions.columns import (
    BANK_NON_PERFORMING,
    BANK_OVERDUE,
    OUTSTANDING,
    OVERDUE,
    both,
    rate,
)
from riskbook.operators.rows import latest, lookup
from riskbook.operators.sums import Part, fused_sums, names, with_grand_total
from riskbook.plans.cadence import Cadence

BO = both(OVERDUE, BANK_OVERDUE)
BN = both(OVERDUE, BANK_NON_PERFORMING)


def overdue_by_date(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    parts = [
        Part("out_cnt", "CNT", OUTSTANDING),
        Part("cnt", "CNT"),
        Part("loan_pr", "LOAN_PR"),
        Part("od_cnt", "CNT", OVERDUE),
        Part("bo_cnt", "CNT", BO),
        Part("bn_cnt", "CNT", BN),
        Part("od_amt", "OD_AMT"),
        Part("bo_amt", "OD_AMT", BO),
        Part("bn_amt", "OD_AMT", BN),
        Part("bal", "BAL"),
    ]
    return cadence.by_date(fused_sums(facts, "DATA_DT", parts, fill=True)).selectExpr(
        f"{cadence.key()} AS data_dt",
        *names(parts),
        f"{rate('od_amt', 'bal')} AS od_rate",
        f"{rate('bo_amt', 'bal')} AS bo_rate",
        f"{rate('bn_amt', 'bal')} AS bn_rate",
    )


def overdue_by_province(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    parts = [
        Part("out_cnt", "CNT", OUTSTANDING),
        Part("bal", "BAL"),
        Part("od_cnt", "CNT", OVERDUE),
        Part("od_amt", "OD_AMT", OVERDUE),
        Part("bo_cnt", "CNT", BO),
        Part("bo_amt", "OD_AMT", BO),
        Part("bn_cnt", "CNT", BN),
        Part("bn_amt", "OD_AMT", BN),
        Part("od_bal", "BAL", OVERDUE),
    ]
    sums = fused_sums(latest(facts, cadence.newest), "PROV_CD", parts, fill=True)
    rows = lookup(with_grand_total(sums, "PROV_CD", names(parts)), dims, "PROV_CD", "PROV_CD")
    return cadence.by_code(rows).selectExpr(
        "code",
        "name",
        "out_cnt",
        "bal",
        "od_cnt",
        "od_amt",
        f"{rate('od_amt', 'bal')} AS od_rate",
        "bo_cnt",
        "bo_amt",
        f"{rate('bo_amt', 'bal')} AS bo_rate",
        "bn_cnt",
        "bn_amt",
        f"{rate('bn_amt', 'bal')} AS bn_rate",
        "od_bal",
        f"{rate('od_bal', 'bal')} AS od_bal_rate",
    )


def overdue_by_city(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    key = "SHENGSHI_CD"
    parts = [
        Part("out_cnt", "CNT", OUTSTANDING),
        Part("bal", "BAL"),
        Part("od_cnt", "CNT", OVERDUE),
        Part("od_amt", "OD_AMT", OVERDUE),
    ]
    sums = fused_sums(latest(facts, cadence.newest), key, parts, fill=True)
    rows = lookup(with_grand_total(sums, key, names(parts)), dims, key, key)
    return cadence.by_code(rows).selectExpr(
        "code", "name", *names(parts), f"{rate('od_amt', 'bal')} AS od_rate"
    )


def overdue_by_scope(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    """By principal size class; a class without overdue loans keeps missing sums."""
    key = "LOAN_PR_SCOPE"
    parts = [
        Part("cnt", "CNT", OUTSTANDING),
        Part("loan_pr", "LOAN_PR", OUTSTANDING),
        Part("bal", "BAL", OUTSTANDING),
        Part("od_cnt", "CNT", OVERDUE),
        Part("od_amt", "OD_AMT", OVERDUE),
    ]
    rows = with_grand_total(fused_sums(latest(facts, cadence.newest), key, parts), key, names(parts))
    return cadence.by_code(rows, key).selectExpr(
        f"{key} AS loan_pr_scope", *names(parts), f"{rate('od_amt', 'bal')} AS od_rate"
    )
