import re

import pytest
from compare import spark_table, sql_table
from pyspark.sql import functions as F

from riskbook.llm import mixing as M
from riskbook.llm.sql import MIXING


def shares(sizes, most=3):
    """Targets by sharing again and again what exceeds the caps."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            return full
        left = total - sum(full.values())
        level = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if level[s] > most * sizes[s]]
        if not above:
            return full | level
        full |= {s: most * sizes[s] for s in above}


ROWS = [(i, "w " * (1 + i * 7 % 40), "en", ("a", "b", "c", "zé", None)[i * i % 5]) for i in range(300)]
ROWS += [(900, None, "en", "a"), (901, "", "en", "tiny"), (902, "one", "en", "tiny"), (903, "", "en", "none"), (None, "x y", "en", "b")]


def test_targets_and_words(table):
    found = M.taken(M.takes(table(*ROWS, extra=True))).collect()
    source = {r[0]: r[3] for r in ROWS}
    sizes, taken, target = {}, {}, {}
    for r in found:
        s = source[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    hand = shares(sizes)
    for s, goal in hand.items():
        assert target[s] == pytest.approx(goal) and abs(taken[s] - goal) <= 1, s
    assert all(r["source_size"] == sizes[source[r["doc_id"]]] for r in found)
    assert {r["doc_id"]: r["size"] for r in found} == {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in ROWS}


def test_sql_and_small_buckets(spark, data, monkeypatch, documents):
    from compare import connect

    monkeypatch.setattr(M, "BUCKET", 3)
    assert spark_table(M.taken(M.takes(documents))) == sql_table(connect(data), MIXING)


def test_mix_is_in_order_and_holds_what_is_taken(table):
    docs = table(*ROWS, ROWS[5], ROWS[5], extra=True)
    mixed = M.mix(docs, labels=("at", "n"))
    assert mixed.columns == [*docs.columns, "at", "n"] and M.mix(docs, labels=()).columns == docs.columns
    rows = mixed.collect()
    assert [r["at"] for r in rows] == sorted(r["at"] for r in rows) and all(0 <= r["at"] <= 1 for r in rows)
    assert all(len(r["text"].split()) == r["n"] for r in rows)
    plan = M.taken(M.takes(docs))
    assert sum(r["n"] for r in rows) == plan.agg(F.sum("taken")).first()[0]
    again = {(r["doc_id"], r["at"], r["n"]) for r in M.mix(docs.repartition(5), labels=("at", "n")).collect()}
    assert again == {(r["doc_id"], r["at"], r["n"]) for r in rows}


def test_schedules_are_integrated_and_inverted(spark):
    for shape in M.SHAPES:
        assert M.integrals(shape)[-1] == pytest.approx(1)
    levels, times = (0.5, 2.0, 0.0), (0.0, 0.25, 1.0)
    done = M.integrals(levels, times)

    def used(t):
        if t <= 0.25:
            return 0.5 * t + 3 * t * t
        x = t - 0.25
        return done[1] + 2 * x - (2 / 0.75) * x * x / 2

    df = spark.range(1, 100).withColumn("t", M.invert(levels, F.col("id") / 100, times))
    for r in df.collect():
        assert used(r["t"]) == pytest.approx(r["id"] / 100 * done[-1], abs=1e-9)


def test_no_rows_and_no_words(table):
    assert M.takes(table().limit(0)).count() == 0 and M.mix(table().limit(0)).count() == 0
    nothing = table((1, None, "en", "a"), (2, "", "en", None))
    assert [r["taken"] for r in M.taken(M.takes(nothing)).collect()] == [0, 0] and M.mix(nothing).count() == 0


def test_hot_source_is_dealt_into_buckets(table, monkeypatch):
    monkeypatch.setattr(M, "BUCKET", 10)
    docs = table(*[(i, "w x", "en", "hot" if i % 3 else f"s{i % 7}") for i in range(600)])
    plan = M.takes(docs)._jdf.queryExecution().toString()
    assert "bucket" in plan
    assert sum(r["taken"] for r in M.taken(M.takes(docs)).collect()) == pytest.approx(1200, abs=8)


def test_no_python_in_the_plans(documents):
    for df in (M.taken(M.takes(documents)), M.mix(documents)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
