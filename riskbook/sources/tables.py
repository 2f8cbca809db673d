"""Reading and writing the snapshot table and the code table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskbook.operators.rows import everyone
from riskbook.schema import DIMENSION, FACTS, classified, require_columns

Population = Callable[[DataFrame], DataFrame]


def read_snapshots(
    spark: SparkSession,
    path: str,
    dates: Sequence[date] | None = None,
    population: Population = everyone,
) -> DataFrame:
    """Loan snapshots of the given dates (all dates when none are given), with their classes.

    The date list reaches the scan as a partition filter, the population as a
    pushed row filter, and each report's columns as the read schema.
    """
    stored = require_columns(spark.read.parquet(path), FACTS)
    return classified(_chosen(stored, dates, population))


def read_cells(
    spark: SparkSession,
    path: str,
    schema: StructType,
    dates: Sequence[date] | None = None,
    population: Population = everyone,
) -> DataFrame:
    """Stored cells of the given dates, read like snapshots."""
    return _chosen(spark.read.schema(schema).parquet(path), dates, population)


def read_snapshots_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    dates: Sequence[date],
    properties: dict[str, str],
    population: Population = everyone,
) -> DataFrame:
    """Snapshots from a database, one parallel query per date."""
    stored = spark.read.jdbc(
        url,
        table,
        predicates=[f"data_dt = DATE '{d.isoformat()}'" for d in dates],
        properties=properties,
    )
    dated = {c: F.to_date(c) for c in ("DATA_DT", "BEGIN_DATE")}
    return classified(_chosen(require_columns(stored.withColumns(dated), FACTS), None, population))


def write_snapshots(snapshots: DataFrame, path: str, whole: bool = False) -> None:
    """Stores snapshots by date, replacing only the dates written, or the whole table.

    Rows are brought together by date first, with large dates split and small
    ones packed, so that the number of files follows the amount of data and
    not tasks times dates.
    """
    (
        snapshots.hint("rebalance", "DATA_DT")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy("DATA_DT")
        .parquet(path)
    )


def stored_dates(spark: SparkSession, path: str) -> list[date]:
    """Dates that a table stored by date has, from its folders' names: no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    return sorted(date.fromisoformat(n.removeprefix("DATA_DT=")) for n in names if n.startswith("DATA_DT="))


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    stored = require_columns(spark.read.parquet(path), DIMENSION)
    return stored.select(*[F.col(f.name).cast(f.dataType) for f in DIMENSION.fields])


def family(dimension: DataFrame, name: str) -> DataFrame:
    """Codes and labels of one code family."""
    return dimension.where(F.col("COL") == name).select("CODE", "NAME")


def _chosen(facts: DataFrame, dates: Sequence[date] | None, population: Population) -> DataFrame:
    if dates is not None:
        facts = facts.where(F.col("DATA_DT").isin(*dates))
    return population(facts)
