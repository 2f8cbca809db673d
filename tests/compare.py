"""Row comparison with the SQL results, and hand-made fact rows."""

from __future__ import annotations

import math
from datetime import date
from pathlib import Path

import duckdb

from riskbook.schema import ATTRIBUTES, FACTS, MEASURES, classified

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            pattern = f"{path}/*.parquet" if path.is_dir() else str(path)
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{pattern}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)
    return [columns[i] for i in order], body


def spark_table(df):
    return _table(df.columns, [tuple(r) for r in df.collect()])


def sql_table(connection, sql):
    result = connection.execute(sql)
    return _table([c[0] for c in result.description], result.fetchall())


DEFAULTS = {
    "DATA_DT": date(2020, 1, 31),
    "BEGIN_DATE": date(2020, 1, 31),
    "PROV_CD": "3101",
    "SHENGSHI_CD": "310101",
    "MATURITY_DAYS": -1,
    "RELOAN": 1,
    "RELOANTIMES": 1,
    "BRELOAN": 1,
    "LOAN_PR_SCOPE": 1,
    "OVERDUE_STATUS_3_LAST": None,
    "OVERDUE_STATUS_5_LAST": None,
    "STATUS_LAST_MONTH": None,
    "CNT": 1,
}


def facts(spark, *rows):
    """Fact rows given as the columns that matter; the rest take plain defaults."""
    columns = [*ATTRIBUTES, *MEASURES]
    values = [tuple(r.get(c, DEFAULTS.get(c, 0)) for c in columns) for r in rows]
    return classified(spark.createDataFrame(values, FACTS))


def dims(spark):
    from riskbook.schema import DIMENSION

    return spark.createDataFrame(
        [("PROV_CD", "3101", "North"), ("SHENGSHI_CD", "310101", "North-01")], DIMENSION
    )


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
