"""A loan book derived from order tables: each order is a loan, each line an installment.

The rules are in FIXTURES.md.  Keys may be very uneven (one customer with a
third of all orders, one order with a third of all lines); each step below says
what bounds the rows that meet in one task.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.operators.rows import numbered
from riskbook.schema import LEDGER


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its files are listed once per application."""
    return _table(spark, spark.sparkContext.applicationId, f"{folder.rstrip('/')}/{name}.parquet")


@cache
def _table(spark: SparkSession, application: str, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ledger(spark: SparkSession, folder: str, as_of: date) -> DataFrame:
    """Installments of loans begun on or before ``as_of``, partitioned by loan."""
    loans = _loans(spark, folder, as_of)
    lines = _lines(spark, folder)
    spread = "(LOAN_ID * 7 + CUST * 3) % 20"
    delay = f"""CASE WHEN {spread} < 12 THEN 0
                     WHEN {spread} < 16 THEN 15 * ({spread} - 11) + 2 * l_linenumber
                     WHEN {spread} < 18 THEN 130 + l_linenumber
                     WHEN l_linenumber <= LOAN_ID % 3 THEN 0 END"""
    return (
        lines.join(loans, F.col("l_orderkey") == F.col("LOAN_ID"))
        .selectExpr("*", "date_add(BD, 30 * l_linenumber) AS DUE")
        .selectExpr("*", f"date_add(DUE, CAST({delay} AS INT)) AS PAID")
        .selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in LEDGER])
    )


def dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Code table: a name per province (one left out) and per city code."""
    nation = table(spark, folder, "nation").selectExpr(
        "concat(n_regionkey + 31, lpad(n_nationkey div 5 + 1, 2, '0')) AS code", "n_name"
    )
    provinces = nation.where("code <> '3103'").selectExpr(
        "'PROV_CD' AS COL", "code AS CODE", "n_name AS NAME"
    )
    cities = nation.selectExpr("*", "explode(array('01', '02', '03')) AS suffix").selectExpr(
        "'SHENGSHI_CD' AS COL", "concat(code, suffix) AS CODE", "concat(n_name, '-', suffix) AS NAME"
    )
    return provinces.unionByName(cities)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Amount per order and line number.

    Summed before the join with orders, and inside each task before the
    shuffle: an order with any number of lines brings one row per line number.
    """
    # To the nearest cent, halves away from zero.
    amount = "CAST(l_extendedprice * 100 + signum(l_extendedprice) / 2 AS BIGINT)"
    return (
        table(spark, folder, "lineitem")
        .where("l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.expr(f"sum({amount}) AS AMT"))
    )


# Order keys that may lie in one part of a customer's day: no more orders than that meet in one task.
KEYS_IN_A_PART = 1 << 20


def _loans(spark: SparkSession, folder: str, as_of: date) -> DataFrame:
    """One row per order, with its customer's place and its number among the customer's orders.

    Orders meet per customer, time and range of order keys, so even a customer's single day with
    a third of all orders is spread; per customer only the counts of days meet, and per customer and day the
    counts of its times and key ranges.  Orders after ``as_of`` cannot change the number
    of an earlier one, so the scan leaves them out.
    """
    orders = table(spark, folder, "orders")
    cutoff = F.lit(str(as_of + timedelta(1))).cast(orders.schema["o_orderdate"].dataType)
    orders = orders.where(F.col("o_orderdate") < cutoff).selectExpr(
        "o_orderkey AS LOAN_ID",
        "o_custkey AS CUST",
        "o_orderdate",
        "to_date(o_orderdate) AS BD",
        f"floor(o_orderkey / {KEYS_IN_A_PART}) AS part",
    )
    nations = table(spark, folder, "nation").selectExpr("n_nationkey AS NATION", "n_regionkey AS REGION")
    places = (
        table(spark, folder, "customer")
        .selectExpr("c_custkey AS CUST", "c_nationkey AS NATION")
        .join(nations, "NATION")
    )
    levels = [["BD"], ["o_orderdate", "part"]]
    placed = numbered(orders, ["CUST"], levels, ["LOAN_ID"], "K", beside=places)
    return placed.select("LOAN_ID", "CUST", "NATION", "REGION", "BD", "K")
