"""Row and join operators: populations, slices, lookups, unions, differences."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.functions.columns import EXCLUDED_CODE, EXCLUDED_PREFIX


def subset(
    df: DataFrame, condition: str | Column, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows for which the condition holds; a missing condition drops the row."""
    kept = df.where(condition)
    return kept.select(*columns) if columns else kept


def everyone(facts: DataFrame) -> DataFrame:
    return facts


def without_prefix(facts: DataFrame, prefix: str = EXCLUDED_PREFIX) -> DataFrame:
    """Population whose province code does not start with ``prefix``."""
    return facts.where(~F.col("PROV_CD").startswith(prefix))


def without_code(facts: DataFrame, code: str = EXCLUDED_CODE) -> DataFrame:
    """Population outside one province code."""
    return facts.where(F.col("PROV_CD") != code)


def latest(facts: DataFrame, day: date | None = None) -> DataFrame:
    """Rows of the newest snapshot: of ``day`` where the run knows it, else of the newest date found.

    Finding it evaluates ``facts`` twice, so runs pass the last date they evaluate.
    """
    if day is not None:
        return facts.where(F.col("DATA_DT") == F.lit(day))
    return facts.where(F.col("DATA_DT") == facts.agg(F.max("DATA_DT")).scalar())


def begun_in_range(facts: DataFrame, within: DataFrame) -> DataFrame:
    """Rows of loans begun on or after the oldest snapshot of ``within``."""
    return facts.where(F.col("BEGIN_DATE") >= within.agg(F.min("DATA_DT")).scalar())


def on_or_after(facts: DataFrame, floor: date) -> DataFrame:
    return facts.where(F.col("DATA_DT") >= F.lit(floor))


def one_per_code(dimension: DataFrame, family: str) -> DataFrame:
    """Codes of a family with one label each (``CODE``, ``NAME``): of several labels of a code the first in order."""
    return dimension.where(F.col("COL") == family).groupBy("CODE").agg(F.min("NAME").alias("NAME"))


def repeated_codes(dimension: DataFrame) -> DataFrame:
    """Codes that the table lists more than once, with how often and under how many labels."""
    listed = dimension.groupBy("COL", "CODE").agg(F.count("*").alias("listed"), F.count_distinct("NAME").alias("names"))
    return listed.where("listed > 1")


def lookup(df: DataFrame, dimension: DataFrame, family: str, key: str) -> DataFrame:
    """``df`` with ``code`` (the key) and ``name``, null where the code has no name.

    A code that the table repeats adds no row.  No broadcast is forced: Spark broadcasts the
    code table when its measured size is under the session's threshold and joins by shuffle beyond it.
    """
    labels = one_per_code(dimension, family).selectExpr("CODE AS code", "NAME AS name")
    return df.withColumnRenamed(key, "code").join(labels, "code", "left")


def full_outer_fold(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of all frames on the keys, left to right.

    For tables of different origin; group sums of one table belong in
    :func:`riskbook.operators.sums.fused_sums`, which needs no join.
    """
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), frames)


def natural_outer(frames: Sequence[DataFrame], how: str = "full_outer") -> DataFrame:
    """Outer join on all columns the two sides share."""

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, [c for c in a.columns if c in b.columns], how)

    return reduce(join, frames)


def union_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not hold."""
    return left.subtract(right.select(*left.columns))


def insert_columns(df: DataFrame, after: str, **columns: Column) -> DataFrame:
    """New columns placed right behind the column ``after``."""
    at = df.columns.index(after) + 1
    new = [c.alias(n) for n, c in columns.items()]
    old = [F.col(c) for c in df.columns]
    return df.select(*old[:at], *new, *old[at:])


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    levels: Sequence[Sequence[str]],
    order: Sequence[str],
    name: str,
    beside: DataFrame | None = None,
) -> DataFrame:
    """``df`` with each row's number among the rows of its keys, for keys of any size.

    ``levels`` cut a key's rows into parts, each level finer than the one before and in step with
    ``order``.  Only the parts' row counts meet by key, level by level; the rows themselves meet in the finest part.
    A row's number is the rows in the parts before, on every level, and its place in its own part.
    ``beside`` has one row per key; its columns are joined to the parts, so that a large key does not meet there either.
    Rows with a missing key or level, or without a row in ``beside``, are left out.
    """
    cuts = [*keys, *(c for level in levels for c in level)]
    df = df.where(" AND ".join(f"{c} IS NOT NULL" for c in cuts))
    counts = df.groupBy(*cuts).agg(F.count("*").alias("__n"))
    ahead = None
    for depth in reversed(range(len(levels))):
        outer = [*keys, *(c for level in levels[:depth] for c in level)]
        before = Window.partitionBy(*outer).orderBy(*levels[depth]).rowsBetween(Window.unboundedPreceding, -1)
        within = [*outer, *levels[depth]]
        parts = counts if ahead is None else counts.groupBy(*within).agg(F.sum("__n").alias("__n"))
        parts = parts.select(*within, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(f"__ahead_{depth}"))
        ahead = parts if ahead is None else ahead.join(parts, within)
    own = F.row_number().over(Window.partitionBy(*cuts).orderBy(*order))
    total = reduce(lambda a, b: a + b, [F.col(f"__ahead_{i}") for i in range(len(levels))], own)
    if beside is not None:
        ahead = ahead.join(beside, list(keys))
    extra = [c for c in beside.columns if c not in keys] if beside is not None else []
    return df.join(ahead, cuts).select(*df.columns, *extra, total.alias(name))


def arrange(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows in order, for presentation."""
    return df.orderBy(*keys)
