"""Risk light: yellow against green loans."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskbook.functions.columns import OUTSTANDING, OVERDUE, both, rate
from riskbook.operators.rows import latest, lookup
from riskbook.operators.sums import Part, fused_sums
from riskbook.plans.cadence import Cadence

# Light codes, in report order.
LIGHTS = {"all": "TRUE", "yellow": "LIGHT = 1", "green": "LIGHT = 0"}


def _light_sums(outstanding: DataFrame, key: str) -> DataFrame:
    parts = []
    for light, shown in LIGHTS.items():
        parts += [
            Part(f"{light}_cnt", "CNT", shown),
            Part(f"{light}_bal", "BAL", shown),
            Part(f"{light}_od_cnt", "CNT", both(shown, OVERDUE)),
            Part(f"{light}_od_amt", "OD_AMT", both(shown, OVERDUE)),
        ]
    return fused_sums(outstanding, key, parts, fill=True)


def _light_columns() -> list[str]:
    columns = []
    for light in LIGHTS:
        columns += [f"{light}_{m}" for m in ("cnt", "bal", "od_cnt", "od_amt")]
        columns.append(f"{rate(f'{light}_od_amt', f'{light}_bal')} AS {light}_od_rate")
    return columns


def light_by_date(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    sums = _light_sums(facts.where(OUTSTANDING), "DATA_DT")
    return cadence.by_date(sums).selectExpr(f"{cadence.key()} AS data_dt", *_light_columns())


def light_by_province(facts: DataFrame, dims: DataFrame, cadence: Cadence) -> DataFrame:
    sums = _light_sums(latest(facts.where(OUTSTANDING), cadence.newest), "PROV_CD")
    rows = lookup(sums, dims, "PROV_CD", "PROV_CD")
    return cadence.by_code(rows).selectExpr("code", "name", *_light_columns())
