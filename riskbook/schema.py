"""Column contracts of the tables the reports read.

``FACTS`` is the snapshot table: one row per evaluated date and loan.  ``cell_columns``
are those of its cells: ``CNT`` loans that agree in what reports distinguish.  Reports read
``CLASSES`` where they look at an attribute only by class, and add up ``CNT`` and the money
columns, so loans (through ``classified``) and cells give equal results.  Money is whole cents
in the schemas below; decimals work as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Attributes of a snapshot row: what reports filter and group by.
ATTRIBUTES = {
    "DATA_DT": T.DateType(),
    "BEGIN_DATE": T.DateType(),
    "PROV_CD": T.StringType(),
    "SHENGSHI_CD": T.StringType(),
    "OVERDUE_STATUS_3": T.IntegerType(),
    "OVERDUE_STATUS_3_LAST": T.IntegerType(),
    "OVERDUE_STATUS_5": T.IntegerType(),
    "OVERDUE_STATUS_5_LAST": T.IntegerType(),
    "OVERDUE_STATUS_3_30": T.IntegerType(),
    "STATUS_THIS_MONTH": T.IntegerType(),
    "STATUS_LAST_MONTH": T.IntegerType(),
    "MATURITY_DAYS": T.IntegerType(),
    "NEW_LOAN": T.IntegerType(),
    "RELOAN": T.IntegerType(),
    "RELOANTIMES": T.IntegerType(),
    "BRELOAN": T.IntegerType(),
    "LIGHT": T.IntegerType(),
    "LOAN_PR_SCOPE": T.IntegerType(),
    "LOAN_M_CNT": T.IntegerType(),
}

# Classes of attributes, by the rule on the attributes; a missing attribute has a missing class.
CLASSES = {
    # Not matured, matured that day, one or two days past, three or more days past.
    "MATURITY_CLASS": "CASE WHEN MATURITY_DAYS >= 3 THEN 3 WHEN MATURITY_DAYS > 0 THEN 1 ELSE MATURITY_DAYS END",
    # A customer's first loan and later ones; for repeat rates also the second.
    "RELOAN_CLASS": "CASE WHEN RELOAN > 2 THEN 2 ELSE RELOAN END",
    "RELOANTIMES_CLASS": "CASE WHEN RELOANTIMES > 3 THEN 3 ELSE RELOANTIMES END",
    "BRELOAN_CLASS": "CASE WHEN BRELOAN > 2 THEN 2 ELSE BRELOAN END",
    # The begin date of what repeat lending reports show by it.
    "REPEAT_BEGIN_DATE": "CASE WHEN NEW_LOAN = 1 AND RELOAN > 1 THEN BEGIN_DATE END",
}

# Attributes that cells have by class only, and those that only cohort matrices read.
ONLY_BY_CLASS = ("MATURITY_DAYS", "RELOAN", "RELOANTIMES", "BRELOAN")
OF_COHORTS = ("BEGIN_DATE", "LOAN_M_CNT")

# Additive columns: what reports sum.
MEASURES = {
    "CNT": T.LongType(),
    "BAL": T.LongType(),
    "LOAN_PR": T.LongType(),
    "LOAN_PR_FEE": T.LongType(),
    "NEW_AMT": T.LongType(),
    "OD_AMT": T.LongType(),
    "OD_PRINCIPAL": T.LongType(),
    "OD_AMT_30": T.LongType(),
    "OD_PRINCIPAL_30": T.LongType(),
    "DIFF_OD_AMT": T.LongType(),
    "DIFF_SP_AMT": T.LongType(),
    "DIFF_AP_AMT": T.LongType(),
}

LOAN_KEY = "LOAN_ID"

FACTS = T.StructType([T.StructField(n, t) for n, t in {**ATTRIBUTES, **MEASURES}.items()])

def cell_columns(cohorts: bool) -> list[str]:
    """Attributes and classes that distinguish cells."""
    left_out = ONLY_BY_CLASS if cohorts else (*ONLY_BY_CLASS, *OF_COHORTS)
    return [*(a for a in ATTRIBUTES if a not in left_out), *CLASSES]


def classified(facts: DataFrame) -> DataFrame:
    """Loan rows with their classes, as reports read them."""
    loans = facts.drop(*CLASSES)
    return loans.selectExpr("*", *[f"{rule} AS {name}" for name, rule in CLASSES.items()])


DIMENSION = T.StructType([T.StructField(n, T.StringType()) for n in ("COL", "CODE", "NAME")])

LEDGER = T.StructType(
    [
        T.StructField("LOAN_ID", T.LongType()),
        T.StructField("CUST", T.LongType()),
        T.StructField("NATION", T.IntegerType()),
        T.StructField("REGION", T.IntegerType()),
        T.StructField("BD", T.DateType()),
        T.StructField("K", T.IntegerType()),
        T.StructField("AMT", T.LongType()),
        T.StructField("DUE", T.DateType()),
        T.StructField("PAID", T.DateType()),
    ]
)


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail early, by name, when a table lacks columns of ``schema``."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the table: {', '.join(missing)}")
    return df
