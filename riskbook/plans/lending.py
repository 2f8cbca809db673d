"""Lending, repayment and termination summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskbook.functions.columns import OUTSTANDING, OVERDUE, both, either
from riskbook.operators.rows import latest, lookup
from riskbook.operators.sums import Part, fused_sums, names, with_grand_total
from riskbook.plans.cadence import Cadence


def _lending_by_place(
    facts: DataFrame, dims: DataFrame, cadence: Cadence, key: str, *labels: str
) -> DataFrame:
    parts = [
        Part("cnt", "CNT"),
        Part("loan_pr", "LOAN_PR"),
        Part("out_cnt", "CNT", OUTSTANDING),
        Part("bal", "BAL"),
    ]
    sums = fused_sums(latest(facts, cadence.newest), key, parts, fill=True)
    rows = lookup(with_grand_total(sums, key, names(parts)), dims, key, key)
    return cadence.by_code(rows).select(*labels, *names(parts))


def lending_by_province(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    return _lending_by_place(facts, dims, cadence, "PROV_CD", "code", "name")


def lending_by_city(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    return _lending_by_place(facts, dims, cadence, "SHENGSHI_CD", "name", "code")


def lending_by_date(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    parts = [
        Part("new_cnt", "CNT", "NEW_LOAN = 1"),
        Part("new_amt", "NEW_AMT", "NEW_LOAN = 1"),
        Part("cum_loan_pr", "LOAN_PR"),
        Part("cum_cnt", "CNT"),
    ]
    return cadence.by_date(fused_sums(facts, "DATA_DT", parts)).selectExpr(
        f"{cadence.key()} AS data_dt", *names(parts)
    )


def repayment(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    """Amounts fallen due and paid in the period, for all loans and for overdue ones."""
    touched = either(OVERDUE, "OVERDUE_STATUS_3_LAST = 1")
    parts = [
        Part("sp_amt", "DIFF_SP_AMT"),
        Part("ap_amt", "DIFF_AP_AMT"),
        Part("od_sp_amt", "DIFF_SP_AMT", touched),
        Part("od_ap_amt", "DIFF_AP_AMT", touched),
    ]
    return cadence.by_date(fused_sums(facts, "DATA_DT", parts)).selectExpr(
        f"{cadence.repayment_title()} AS title", f"{cadence.span()} AS data_dt", *names(parts)
    )


def termination_maturity(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    matured = both("MATURITY_CLASS <> -1", OUTSTANDING)
    terminated = "STATUS_THIS_MONTH = 1"
    parts = [
        Part("od_cnt", "CNT", OVERDUE),
        Part("od_amt", "OD_AMT", OVERDUE),
        Part("matured_cnt", "CNT", matured),
        Part("matured_od_amt", "OD_AMT", matured),
        Part("terminated_cnt", "CNT", terminated),
        Part("terminated_od_amt", "OD_AMT", terminated),
    ]
    return cadence.by_date(fused_sums(facts, "DATA_DT", parts)).selectExpr(
        f"{cadence.key()} AS data_dt", *names(parts)
    )
