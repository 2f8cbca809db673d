import random
from datetime import date

import duckdb
import pytest
from compare import dims, facts, rows_by, spark_table, sql_table
from pyspark.sql import functions as F

from riskbook.operators import rows, sums
from riskbook.operators.sums import Part


def test_fused_sums_leaves_out_missing_keys_and_unmatched_groups(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 0, 5), (None, 1, 7), ("b", 0, 3), ("c", None, 4), ("d", 1, None)],
        "k string, flag int, v int",
    )
    out = rows_by(sums.fused_sums(df, "k", [Part("x", "v", "flag = 1")]), "k")
    assert out == {"a": {"k": "a", "x": 10}}


def test_fused_sums_part_without_rows_is_missing_or_filled(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", 0, 3)], "k string, flag int, v int")
    parts = [Part("x", "v", "flag = 1"), Part("y", "v")]
    assert rows_by(sums.fused_sums(df, "k", parts), "k")["b"] == {"k": "b", "x": None, "y": 3}
    assert rows_by(sums.fused_sums(df, "k", parts, fill=True), "k")["b"] == {"k": "b", "x": 0, "y": 3}


def test_strict_sum_is_missing_when_a_value_is(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    parts = [Part("x", "v")]
    assert {k: r["x"] for k, r in rows_by(sums.fused_sums(df, "k", parts), "k").items()} == {"a": 1, "b": 2}
    strict = rows_by(sums.fused_sums(df, "k", parts, strict=True), "k")
    assert {k: r["x"] for k, r in strict.items()} == {"a": None, "b": 2}


@pytest.mark.parametrize("seed", range(3))
def test_fused_sums_equal_outer_joined_group_sums(spark, seed):
    rng = random.Random(seed)

    def maybe(v):
        return None if rng.random() < 0.2 else v

    data = [
        (maybe(rng.choice("abcdef")), maybe(rng.randrange(3)), maybe(rng.randrange(100)), rng.randrange(9))
        for _ in range(rng.choice([3, 12, 60]))
    ]
    df = spark.createDataFrame(data, "k string, s int, v int, w int")
    out = sums.fused_sums(df, "k", [Part("p", "v", "s = 1"), Part("q", "w", "s <> 2"), Part("r", "v", "s = 0 AND w > 3")])
    con = duckdb.connect()
    con.execute("CREATE TABLE t(k VARCHAR, s INTEGER, v INTEGER, w INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", data)

    def part(name, measure, where):
        return (
            f"(SELECT k, CAST(sum({measure}) AS BIGINT) AS {name} FROM t "
            f"WHERE {where} AND {measure} IS NOT NULL AND k IS NOT NULL GROUP BY k)"
        )

    sql = (
        f"SELECT * FROM {part('p', 'v', 's = 1')} a FULL OUTER JOIN {part('q', 'w', 's <> 2')} b USING (k) "
        f"FULL OUTER JOIN {part('r', 'v', 's = 0 AND w > 3')} c USING (k)"
    )
    assert spark_table(out) == sql_table(con, sql)


def test_pivot_has_a_column_per_listed_value_even_when_absent(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 5), ("b", 3, 2)], "k string, s int, V int")
    out = rows_by(sums.pivot_sum(df, "k", "s", [1, 2, 3], ["V"]), "k")
    assert out["a"] == {"k": "a", "v_1": 15, "v_2": None, "v_3": None}
    assert out["b"]["v_3"] == 2


def test_grand_total_row_skips_missing_sums(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, 5)], "k string, x int, y int")
    out = rows_by(sums.with_grand_total(df, "k", ["x", "y"]), "k")
    assert out[None] == {"k": None, "x": 3, "y": 5}
    assert out["a"]["y"] is None


def test_populations_drop_rows_without_a_code(spark):
    df = spark.createDataFrame([("3501",), ("3502",), ("3101",), (None,)], "PROV_CD string")
    assert {r[0] for r in rows.without_prefix(df).collect()} == {"3101"}
    assert {r[0] for r in rows.without_code(df).collect()} == {"3501", "3101"}
    assert rows.everyone(df).count() == 4


def test_latest_and_cohort_floor(spark):
    df = facts(
        spark,
        {"DATA_DT": date(2020, 1, 31), "BEGIN_DATE": date(2019, 12, 31)},
        {"DATA_DT": date(2020, 2, 29), "BEGIN_DATE": date(2020, 2, 29)},
    )
    assert [r["DATA_DT"] for r in rows.latest(df).collect()] == [date(2020, 2, 29)]
    assert [r["BEGIN_DATE"] for r in rows.begun_in_range(df, df).collect()] == [date(2020, 2, 29)]
    assert rows.on_or_after(df, date(2020, 2, 1)).count() == 1


def test_lookup_keeps_codes_without_a_name(spark):
    df = spark.createDataFrame([("3101", 1), ("9999", 2), (None, 3)], "PROV_CD string, n int")
    out = rows_by(rows.lookup(df, dims(spark), "PROV_CD", "PROV_CD"), "n")
    assert [(out[n]["code"], out[n]["name"]) for n in (1, 2, 3)] == [("3101", "North"), ("9999", None), (None, None)]


def test_folds_unions_and_differences(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(2, "z")], "k int, b string")
    c = spark.createDataFrame([(3, "w")], "k int, c string")
    assert sorted(r["k"] for r in rows.full_outer_fold([a, b, c], ["k"]).collect()) == [1, 2, 3]
    assert [tuple(r) for r in rows.natural_outer([a, b], "right").collect()] == [(2, "y", "z")]
    assert rows.union_rows([a, a]).count() == 4
    d = spark.createDataFrame([("x", 1), ("x", 1), ("q", 5)], "a string, k int")
    assert [tuple(r) for r in rows.row_difference(d, a).collect()] == [("q", 5)]


def test_insert_arrange_subset(spark):
    df = spark.createDataFrame([(2, 5), (1, None), (3, 7)], "k int, v int")
    out = rows.insert_columns(df, "k", twice=F.col("k") * 2)
    assert out.columns == ["k", "twice", "v"]
    assert [r["k"] for r in rows.arrange(df, F.desc("k")).collect()] == [3, 2, 1]
    assert [tuple(r) for r in rows.subset(df, "v <> 7", ["k"]).collect()] == [(2,)]


def test_numbers_of_rows_by_levels(spark):
    values = [(k, d, t, i) for i, (k, d, t) in enumerate((k, d, t) for k in (1, 2, None) for d in (3, 1, 2) for t in (5, 4, None) for _ in range(3))]
    df = spark.createDataFrame(values, "k int, d int, t int, i int").withColumn("part", F.expr("i div 2"))
    beside = spark.createDataFrame([(1, "one"), (2, "two"), (None, "none")], "k int, who string")
    found = {r["i"]: (r["n"], r["who"]) for r in rows.numbered(df, ["k"], [["d"], ["t", "part"]], ["i"], "n", beside).collect()}
    kept = [v for v in values if v[0] is not None and v[2] is not None]
    want = {}
    for k, who in ((1, "one"), (2, "two")):
        mine = sorted((v for v in kept if v[0] == k), key=lambda v: v[1:])
        want |= {v[3]: (n, who) for n, v in enumerate(mine, 1)}
    assert found == want
