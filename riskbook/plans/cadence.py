"""What changes between month, week, two-week and day reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions.columns import REPAID_LABEL, day_text, month_span_text, month_text
from riskbook.operators.checks import WARN
from riskbook.operators.rows import arrange


@dataclass(frozen=True)
class Cadence:
    name: str
    monthly: bool = False
    compares_periods: bool = True  # fund change, roll rates, increment rows
    fills_stock: bool = True
    vintages: bool = False
    as_text: bool = True
    # Rows in presentation order: wanted when a table is written out.
    ordered: bool = False
    # The last date a run evaluates, where the run says so.
    newest: date | None = None
    # The first date that the stored cells of the run have.
    oldest: date | None = None

    def by_date(self, table: DataFrame) -> DataFrame:
        return arrange(table, "DATA_DT") if self.ordered else table

    def by_code(self, table: DataFrame, key: str = "code") -> DataFrame:
        """Rows by code, a total row (code null) last."""
        return arrange(table, F.col(key).asc_nulls_last()) if self.ordered else table

    def by_code_and_date(self, table: DataFrame) -> DataFrame:
        return arrange(table, "code", "DATA_DT") if self.ordered else table

    def key(self, day: str = "DATA_DT") -> str:
        """A date as the reports of this cadence show it."""
        return month_text(day) if self.monthly else day_text(day)

    def span(self, day: str = "DATA_DT") -> str:
        """A date that stands for the period ending on it."""
        return month_span_text(day) if self.monthly else day_text(day)

    def repayment_title(self, day: str = "DATA_DT") -> str:
        shown = f"month({day}), '月'" if self.monthly else day_text(day)
        return f"concat({shown}, '{REPAID_LABEL}')"


MONTH = Cadence("month", monthly=True, vintages=True, as_text=False)
WEEK = Cadence("week")
BIWEEK = Cadence("biweek")
DAY = Cadence("day", compares_periods=False, fills_stock=False)


@dataclass(frozen=True)
class Options:
    """Choices a run makes beside its cadence."""

    # Fixed value: the structure detail starts here unless a run says otherwise.
    detail_from: date = date(2017, 1, 1)
    # True: increment rows are the change from the period before.
    # False: they repeat the period's own totals.
    true_increments: bool = True
    # Loan ordinal class of the first-loan non-performing sum in the 30-day index.
    first_bn_of_first_loans: bool = False
    # Rows with values that no table shows, and codes listed more than once: "fail", "warn" or "ignore".
    unlisted: str = WARN
    repeated_codes: str = WARN
