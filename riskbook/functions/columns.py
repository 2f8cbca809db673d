"""Conditions and column expressions shared by the reports, as Spark SQL text.

Text keeps a report's long column list readable and costs one call into Spark
per projection.  Everything here is a built-in expression.
"""

from __future__ import annotations

# Codes and labels of the loan book.
STATUS_5_LABELS = {0: "正常", 2: "一般", 3: "催收", 4: "严重"}
TOTAL_LABEL = "汇总"
INCREMENT_LABEL = "增量"
REPAID_LABEL = "回款"
EXCLUDED_PREFIX = "35"
EXCLUDED_CODE = "3502"

SETTLED = "OVERDUE_STATUS_3 = 2"
OUTSTANDING = "OVERDUE_STATUS_3 <> 2"
OVERDUE = "OVERDUE_STATUS_3 = 1"
BANK_OVERDUE = "MATURITY_CLASS > 0"
BANK_NON_PERFORMING = "MATURITY_CLASS >= 3"


def both(*conditions: str) -> str:
    return " AND ".join(f"({c})" for c in conditions)


def either(*conditions: str) -> str:
    return "(" + " OR ".join(f"({c})" for c in conditions) + ")"


def rate(numerator: str, denominator: str) -> str:
    """Quotient as a double; null when the denominator is zero or a side is missing."""
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def row_sum(*columns: str) -> str:
    """Sum across columns, a missing one counting as zero."""
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in columns) + ")"


def percent_text(value: str, digits: int = 2) -> str:
    """``0.1234`` as ``12.34%``; a missing value stays missing."""
    return f"CASE WHEN {value} IS NOT NULL THEN format_string('%.{digits}f%%', 100 * {value}) END"


def unite(sep: str, *columns: str) -> str:
    """Columns joined to one text; a missing part reads ``NA``."""
    parts = ", ".join(f"coalesce(CAST({c} AS STRING), 'NA')" for c in columns)
    return f"concat_ws('{sep}', {parts})"


def month_text(day: str) -> str:
    return f"date_format({day}, 'yyyy-MM')"


def day_text(day: str) -> str:
    return f"date_format({day}, 'yyyy-MM-dd')"


def compact_day_text(day: str) -> str:
    return f"date_format({day}, 'yyyyMMdd')"


def month_span_text(day: str) -> str:
    """``5-6月汇总`` for a June month-end: the month before, then the month."""
    return f"concat(month(add_months({day}, -1)), '-', month({day}), '月汇总')"


def status_5_text(status: str) -> str:
    whens = " ".join(f"WHEN {code} THEN '{label}'" for code, label in STATUS_5_LABELS.items())
    return f"CASE {status} {whens} END"
