"""Sheets of stacked blocks: tables one below the other, kept as one dataset with a row per sheet row.

Blocks are declared with their order on the sheet.  How far down each begins follows from the rows of
the blocks above, added up inside Spark; no table is counted by the driver.  A sheet, or some of its
rows, is read back by sheet and row number.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class Block(NamedTuple):
    """A table on a sheet: header labels, if it has any, and a heading in the row above.

    ``first`` is the row in which the first block of the sheet begins.
    """

    sheet: str
    block: int
    table: str
    first: int
    labels: tuple[str, ...] | None = None
    heading: str | None = None


#: Rows of a sheet as they are stored.
SHEET_ROWS = "sheet string, block int, kind string, row int, cells array<string>"
HEADING, HEADER, BODY = "heading", "header", "body"


def body_rows(table: DataFrame, sheet: str, block: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Rows (sheet, block, place, cells) of a table that holds the rows of several blocks.

    ``sheet`` and ``block`` are expressions, ``place`` is a row's number within its block by ``order``.
    """
    cells = ", ".join(f"CAST({c} AS STRING)" for c in columns)
    rows = table.selectExpr(f"{sheet} AS sheet", f"CAST({block} AS INT) AS block", f"{order} AS __order", f"array({cells}) AS cells")
    # a block has a row per date or cohort
    place = F.row_number().over(Window.partitionBy("sheet", "block").orderBy("__order"))
    return rows.select("sheet", "block", place.alias("place"), "cells")


def places(spark: SparkSession, blocks: Sequence[Block], rows: DataFrame, gap: int) -> DataFrame:
    """Each block with its start row and its number of rows.

    A block begins as many rows below the start of the one above as that has rows, and ``gap`` more;
    blocks without rows keep their place.
    """
    declared = spark.createDataFrame(
        [(b.sheet, b.block, b.table, b.first, list(b.labels) if b.labels else None, b.heading) for b in blocks],
        "sheet string, block int, table string, first int, labels array<string>, heading string",
    )
    sizes = rows.groupBy("sheet", "block").agg(F.count("*").cast("int").alias("n"))
    sized = declared.join(sizes, ["sheet", "block"], "left").withColumn("n_rows", F.coalesce("n", F.lit(0))).drop("n")
    above = Window.partitionBy("sheet").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("first") + F.coalesce(F.sum(F.col("n_rows") + gap).over(above), F.lit(0))
    return sized.withColumn("start_row", start.cast("int")).drop("first")


def sheet_rows(placed: DataFrame, rows: DataFrame) -> DataFrame:
    """Every row of every sheet, with its row number: headings, headers and table rows."""
    headings = placed.where("heading IS NOT NULL").selectExpr(
        "sheet", "block", f"'{HEADING}' AS kind", "start_row - 1 AS row", "array(heading) AS cells"
    )
    headers = placed.where("labels IS NOT NULL").selectExpr(
        "sheet", "block", f"'{HEADER}' AS kind", "start_row AS row", "labels AS cells"
    )
    top = placed.selectExpr("sheet", "block", "start_row + CASE WHEN labels IS NOT NULL THEN 1 ELSE 0 END AS top")
    body = rows.join(top, ["sheet", "block"]).selectExpr(
        "sheet", "block", f"'{BODY}' AS kind", "top + place - 1 AS row", "cells"
    )
    return body.unionByName(headers).unionByName(headings)


def write_sheets(sheets: DataFrame, path: str) -> None:
    """Stores sheet rows by sheet, in the order of the rows."""
    ordered = sheets.repartition("sheet").sortWithinPartitions("sheet", "row")
    ordered.write.mode("overwrite").partitionBy("sheet").parquet(path)


def read_sheets(
    spark: SparkSession, path: str, sheet: str | None = None, rows: tuple[int, int] | None = None
) -> DataFrame:
    """Stored sheet rows, of one sheet or all, and of a span of row numbers (both ends included)."""
    stored = spark.read.schema(SHEET_ROWS).parquet(path)
    if sheet is not None:
        stored = stored.where(F.col("sheet") == sheet)
    return stored if rows is None else stored.where(F.col("row").between(*rows))
