"""Rows that no table would show: counted once a table is stored, then refused or warned about."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What to do about such rows.
FAIL, WARN, IGNORE = "fail", "warn", "ignore"


def not_in(column: str, values) -> str:
    """Condition of rows whose value a pivot over ``values`` leaves out, a missing one included."""
    return f"({column} IS NULL OR {column} NOT IN ({', '.join(map(str, values))}))"


def unlisted_rows(
    df: DataFrame, conditions: Mapping[str, str], amounts: tuple[str, ...] = ("CNT", "BAL")
) -> dict[str, dict[str, int]]:
    """Rows and amounts for which each named condition holds, in one aggregation over the columns they need."""
    if not conditions:
        return {}
    metrics = []
    for name, condition in conditions.items():
        metrics.append(F.expr(f"count_if({condition})").alias(f"{name}:rows"))
        metrics += [F.expr(f"coalesce(sum(CASE WHEN {condition} THEN {a} END), 0)").alias(f"{name}:{a}") for a in amounts]
    found: dict[str, dict[str, int]] = {}
    for key, value in df.agg(*metrics).first().asDict().items():
        name, _, what = key.rpartition(":")
        found.setdefault(name, {})[what] = value
    return found


def settle(found: Mapping[str, Mapping[str, int]], how: str) -> None:
    """Makes any row found an error or a warning, as ``how`` says."""
    bad = {n: f for n, f in found.items() if f["rows"]}
    if not bad or how == IGNORE:
        return
    text = "; ".join(f"{n}: {', '.join(f'{v} {k}' for k, v in f.items())}" for n, f in bad.items())
    if how == FAIL:
        raise ValueError(f"rows that no table shows: {text}")
    warnings.warn(f"rows that no table shows: {text}", stacklevel=3)
