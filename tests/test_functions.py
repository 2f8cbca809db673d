import pytest

from riskbook.functions import columns as C
from riskbook.schema import DIMENSION, require_columns


def value(spark, expression, row="1 AS one"):
    return spark.sql(f"SELECT {expression} AS v FROM (SELECT {row})").first()["v"]


def test_rate_is_null_for_a_zero_or_missing_side(spark):
    assert value(spark, C.rate("a", "b"), "1 AS a, 4 AS b") == 0.25
    assert value(spark, C.rate("a", "b"), "1 AS a, 0 AS b") is None
    assert value(spark, C.rate("a", "b"), "0 AS a, 0 AS b") is None
    assert value(spark, C.rate("a", "b"), "CAST(NULL AS INT) AS a, 4 AS b") is None


def test_rate_of_decimals_is_a_double(spark):
    assert value(spark, C.rate("a", "b"), "CAST(1 AS DECIMAL(18,2)) AS a, CAST(8 AS DECIMAL(18,2)) AS b") == 0.125


def test_percent_text_keeps_missing_values_missing(spark):
    assert value(spark, C.percent_text("a"), "0.12345D AS a") == "12.35%"
    assert value(spark, C.percent_text("a", 0), "1.0D AS a") == "100%"
    assert value(spark, C.percent_text("a"), "CAST(NULL AS DOUBLE) AS a") is None


def test_unite_shows_a_missing_part(spark):
    assert value(spark, C.unite("-", "a", "b"), "1 AS a, 2 AS b") == "1-2"
    assert value(spark, C.unite("-", "a", "b"), "CAST(NULL AS INT) AS a, 2 AS b") == "NA-2"


def test_date_texts(spark):
    day = "DATE '2017-01-31' AS d"
    assert value(spark, C.month_text("d"), day) == "2017-01"
    assert value(spark, C.day_text("d"), day) == "2017-01-31"
    assert value(spark, C.compact_day_text("d"), day) == "20170131"
    assert value(spark, C.month_span_text("d"), day) == "12-1月汇总"
    assert value(spark, C.month_span_text("d"), "DATE '2017-03-31' AS d") == "2-3月汇总"


def test_status_labels(spark):
    assert [value(spark, C.status_5_text("s"), f"{s} AS s") for s in (0, 2, 3, 4)] == ["正常", "一般", "催收", "严重"]
    assert value(spark, C.status_5_text("s"), "7 AS s") is None


def test_row_sum_counts_missing_as_zero(spark):
    assert value(spark, C.row_sum("a", "b"), "1 AS a, CAST(NULL AS INT) AS b") == 1


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="NAME"):
        require_columns(spark.sql("SELECT 'x' AS COL, 'y' AS CODE"), DIMENSION)
