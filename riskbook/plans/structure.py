"""Five-state structure of the book: stocks, shares, detail with subtotals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions.columns import (
    INCREMENT_LABEL,
    OUTSTANDING,
    TOTAL_LABEL,
    rate,
    row_sum,
    status_5_text,
)
from riskbook.operators.rows import arrange, on_or_after
from riskbook.operators.sums import Part, fused_sums, names, pivot_sum
from riskbook.plans.cadence import Cadence, Options

STATES = (0, 1, 2, 3, 4)
COUNTS = [f"cnt_{s}" for s in STATES]
LATE_STATES = (2, 3, 4)


def _stock(facts: DataFrame, cadence: Cadence, fill: bool = False) -> DataFrame:
    """Loan count per date and five-state value: ``cnt_0`` ... ``cnt_4``."""
    counts = pivot_sum(facts, "DATA_DT", "OVERDUE_STATUS_5", STATES, ["CNT"], fill=fill)
    return cadence.by_date(counts)


def state_stock(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    return _stock(facts, cadence, cadence.fills_stock).selectExpr(
        f"{cadence.key()} AS data_dt", *COUNTS, f"{row_sum('cnt_0', 'cnt_1')} AS regular"
    )


def structure_count_share(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    whole = row_sum(*COUNTS)
    return _stock(facts, cadence, cadence.fills_stock).selectExpr(
        f"{cadence.key()} AS data_dt",
        f"{rate('(cnt_0 + cnt_1)', whole)} AS normal_share",
        f"{rate('cnt_2', whole)} AS ordinary_share",
        f"{rate('cnt_3', whole)} AS collection_share",
        f"{rate('cnt_4', whole)} AS serious_share",
    )


def structure_amount_share(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    amounts = pivot_sum(facts, "DATA_DT", "OVERDUE_STATUS_5", LATE_STATES, ["OD_AMT"], fill=True)
    whole = row_sum(*[f"od_amt_{s}" for s in LATE_STATES])
    return cadence.by_date(amounts).selectExpr(
        f"{cadence.key()} AS data_dt",
        f"{rate('od_amt_2', whole)} AS ordinary_share",
        f"{rate('od_amt_3', whole)} AS collection_share",
        f"{rate('od_amt_4', whole)} AS serious_share",
    )


def structure_detail(
    facts: DataFrame, dims: DataFrame, cadence: Cadence, options: Options = Options()
) -> DataFrame:
    """Per date: a row per state, a subtotal row, and an increment row from the second date.

    The snapshot is summed once by date and state.  Subtotals, shares and
    increments all come from that result, a handful of rows per date.
    """
    parts = [Part(m.lower(), m) for m in ("CNT", "OD_PRINCIPAL", "OD_AMT", "BAL")]
    measures = names(parts)
    merged = on_or_after(facts.where(OUTSTANDING), options.detail_from).selectExpr(
        "DATA_DT",
        "CASE WHEN OVERDUE_STATUS_5 IN (0, 1) THEN 0 ELSE OVERDUE_STATUS_5 END AS state",
        *[p.measure for p in parts],
    )
    # level 0: one state of a date; level 1: the date's subtotal.
    rolled = (
        fused_sums(merged, ["DATA_DT", "state"], parts)
        .rollup("DATA_DT", "state")
        .agg(*[F.expr(f"sum({m}) AS {m}") for m in measures], F.grouping_id().alias("level"))
        .where("level < 2")
    )
    compares = cadence.compares_periods
    history = "OVER (PARTITION BY level ORDER BY DATA_DT)"
    rows = rolled.selectExpr(
        "*",
        *[f"sum(CASE level WHEN 1 THEN {m} END) OVER (PARTITION BY DATA_DT) AS all_{m}" for m in ("cnt", "bal")],
        *[f"lag({m}) {history} AS before_{m}" for m in measures],
        f"level = 1 AND lag(DATA_DT) {history} IS NOT NULL AS has_before",
    ).selectExpr(
        "*",
        f"explode(CASE WHEN {str(compares).lower()} AND has_before "
        "THEN array(false, true) ELSE array(false) END) AS increment",
    )
    if cadence.ordered:
        rows = arrange(rows, "DATA_DT", "level", "state", "increment")

    def amount(m: str) -> str:
        changed = f"{m} - before_{m}" if options.true_increments else m
        return f"CASE WHEN increment THEN {changed} ELSE {m} END AS {m}"

    def share(m: str) -> str:
        return f"CASE WHEN NOT increment THEN {rate(m, f'all_{m}')} END AS {m}_share"

    return rows.selectExpr(
        f"{cadence.key()} AS data_dt",
        f"CASE WHEN increment THEN '{INCREMENT_LABEL}' WHEN level = 1 THEN '{TOTAL_LABEL}' "
        f"ELSE {status_5_text('state')} END AS status",
        amount("cnt"),
        share("cnt"),
        amount("od_principal"),
        amount("od_amt"),
        amount("bal"),
        share("bal"),
    )
