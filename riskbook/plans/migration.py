"""Change from one period to the next: fund change and roll rates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskbook.functions.columns import both, rate, row_sum
from riskbook.operators.sums import Part, fused_sums, names, pivot_parts
from riskbook.plans.cadence import Cadence

TRANSITIONS = ((0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2))

# Flows between five-state values, and the stock each is taken from.
FLOWS = {
    "regular_to_late": ("OVERDUE_STATUS_5_LAST IN (0, 1) AND OVERDUE_STATUS_5 NOT IN (0, 1)", "regular"),
    "f_2_3": ("OVERDUE_STATUS_5_LAST = 2 AND OVERDUE_STATUS_5 = 3", "cnt_2"),
    "f_2_4": ("OVERDUE_STATUS_5_LAST = 2 AND OVERDUE_STATUS_5 = 4", "cnt_2"),
    "f_3_4": ("OVERDUE_STATUS_5_LAST = 3 AND OVERDUE_STATUS_5 = 4", "cnt_3"),
    "f_4_4": ("OVERDUE_STATUS_5_LAST = 4 AND OVERDUE_STATUS_5 = 4", "cnt_4"),
}


def _fund_change_parts(new_measure: str, moved_measure: str) -> list[Part]:
    ended = both("STATUS_LAST_MONTH = 0", "STATUS_THIS_MONTH = 1")
    return [
        Part("new_normal", new_measure, both("NEW_LOAN = 1", "OVERDUE_STATUS_3 = 0")),
        Part("new_overdue", new_measure, both("NEW_LOAN = 1", "OVERDUE_STATUS_3 = 1")),
        *[
            Part(
                f"t_{was}_{now}",
                moved_measure,
                both(f"OVERDUE_STATUS_3_LAST = {was}", f"OVERDUE_STATUS_3 = {now}"),
            )
            for was, now in TRANSITIONS
        ],
        Part("newly_terminated", moved_measure, ended),
    ]


def _fund_change(facts: DataFrame, parts: list[Part], cadence: Cadence, *extra: str) -> DataFrame:
    return cadence.by_date(fused_sums(facts, "DATA_DT", parts, fill=True)).selectExpr(
        f"{cadence.span()} AS data_dt", *names(parts), "t_1_1 - newly_terminated AS diff", *extra
    )


def fund_change_count(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    return _fund_change(facts, _fund_change_parts("CNT", "CNT"), cadence)


def fund_change_amount(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    parts = _fund_change_parts("OD_AMT", "DIFF_OD_AMT")
    return _fund_change(facts, parts, cadence, f"{row_sum(*names(parts)[:-1])} AS diff_amt")


def migration_rates(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    """Flows between states over the previous period's stock of the state left.

    Stocks and flows are summed in one pass.  The previous stock is found by
    date over the result, which has one row per period.
    """
    stocks = pivot_parts("OVERDUE_STATUS_5", range(5), ["CNT"])
    flows = [Part(name, "CNT", moved) for name, (moved, _) in FLOWS.items()]
    bases = ("regular", "cnt_2", "cnt_3", "cnt_4")
    dated = (
        fused_sums(facts, "DATA_DT", [*stocks, *flows])
        .selectExpr("*", f"{row_sum('cnt_0', 'cnt_1')} AS regular")
        .selectExpr(
            "DATA_DT",
            *names(flows),
            *[f"lag({b}) OVER (ORDER BY DATA_DT) AS before_{b}" for b in bases],
            "lag(DATA_DT) OVER (ORDER BY DATA_DT) AS before",
        )
        .where(f"before IS NOT NULL AND coalesce({', '.join(names(flows))}) IS NOT NULL")
    )
    return cadence.by_date(dated).selectExpr(
        f"{cadence.span()} AS data_dt",
        *[f"coalesce({f}, 0) AS {f}" for f in names(flows)],
        *[
            f"{rate(f'coalesce({name}, 0)', f'before_{base}')} AS {name}_rate"
            for name, (_, base) in FLOWS.items()
        ],
    )
