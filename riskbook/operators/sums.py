"""Group sums: many filtered sums in one aggregation, pivots and total rows.

A report that is written as k filtered group sums joined on the key is planned
here as one aggregation of k conditional sums.  The table is read once and the
only shuffle carries rows already combined inside each task, so a key holding
a large part of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Part(NamedTuple):
    """One filtered sum: ``name = sum(measure) where ...``."""

    name: str
    measure: str
    where: str | None = None

    def total(self, fill: bool, strict: bool) -> str:
        chosen, matched = self.measure, "1"
        if self.where:
            chosen = f"CASE WHEN {self.where} THEN {self.measure} END"
            matched = f"CASE WHEN {self.where} THEN 1 END"
        total = f"sum({chosen})"
        if strict:
            total = f"CASE WHEN count({chosen}) = count({matched}) THEN {total} END"
        return f"coalesce({total}, 0)" if fill else total

    def matches(self) -> str:
        return f"({self.where} AND {self.measure} IS NOT NULL)"


def fused_sums(
    facts: DataFrame,
    keys: str | Sequence[str],
    parts: Sequence[Part],
    fill: bool = False,
    strict: bool = False,
) -> DataFrame:
    """One row per key that any part has rows for, with every part's sum.

    A part without rows for a key is null there, as after a full outer join of
    separate group sums, or zero with ``fill``.  Rows with a missing key are
    left out.  ``strict`` makes a sum missing when one of its values is.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    kept = [f"{k} IS NOT NULL" for k in keys]
    if all(p.where for p in parts):
        kept.append("(" + " OR ".join(dict.fromkeys(p.matches() for p in parts)) + ")")
    totals = [F.expr(f"{p.total(fill, strict)} AS {p.name}") for p in parts]
    return facts.where(" AND ".join(kept)).groupBy(*keys).agg(*totals)


def sum_by(facts: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums of several measures by several keys."""
    return fused_sums(facts, keys, [Part(m, m) for m in measures])


def _measure_value(measure: str, value) -> str:
    return f"{measure.lower()}_{value}"


def pivot_parts(
    pivot: str,
    values: Sequence,
    measures: Sequence[str],
    name: Callable[[str, object], str] = _measure_value,
) -> list[Part]:
    return [Part(name(m, v), m, f"{pivot} = {_literal(v)}") for v in values for m in measures]


def pivot_sum(
    facts: DataFrame,
    key: str,
    pivot: str,
    values: Sequence,
    measures: Sequence[str],
    name: Callable[[str, object], str] = _measure_value,
    fill: bool = False,
) -> DataFrame:
    """One column per measure and pivot value, for a pivot list known up front."""
    return fused_sums(facts, key, pivot_parts(pivot, values, measures, name), fill)


def with_grand_total(detail: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """``detail`` (one row per key) and a last row, key null, of the sums over it."""
    return detail.rollup(key).agg(*[F.expr(f"sum({m}) AS {m}") for m in measures])


def names(parts: Sequence[Part]) -> list[str]:
    return [p.name for p in parts]


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)
