import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskbook.llm import langid, queries


def test_held_out_accuracy(spark, data):
    found = queries.op1_language_id(spark, data)
    truth = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert found.count() == truth.count() and len(rows) > 30
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_text_alone_decides(spark, documents):
    models = langid.fit(documents, F.col("doc_id"), per_language=50)
    docs = documents.select("doc_id", "lang", "source", "text").limit(30)
    changed = docs.withColumns({"doc_id": F.lit(7), "lang": F.lit("xx"), "source": F.lit(None)})
    assert [r["score"] for r in langid.predict(docs, models).collect()] == [r["score"] for r in langid.predict(changed, models).collect()]


def test_odd_texts(table, documents):
    models = langid.fit(documents, F.col("doc_id"), per_language=50)
    docs = table((1, None), (2, ""), (3, "12 !? 34"), (None, "the and of in to"), (5, "x" * 300_000), (5, "x" * 300_000), extra=True)
    rows = langid.predict(docs.drop("lang_pred", "score"), models).collect()
    assert [r["lang_pred"] for r in rows[:3]] == [langid.UNKNOWN] * 3 and [r["score"] for r in rows[:3]] == [0.0] * 3
    assert rows[3]["lang_pred"] == "en" and rows[4]["score"] == rows[5]["score"]
    assert langid.predict(docs.limit(0).select("doc_id", "text"), models).count() == 0


def test_without_labels_nothing_is_learned_and_letters_decide(table):
    docs = table((1, "abc"), (2, "123"), (3, None), extra=True)
    assert langid.fit(docs, F.col("doc_id")) == []
    kept = langid.identified(docs)
    assert [r["doc_id"] for r in kept.collect()] == [1] and kept.columns == docs.columns


def test_one_language_only(table):
    docs = table(*[(i, f"hello world {i} abc", "en", "s") for i in range(20)])
    models = langid.fit(docs, F.col("doc_id"))
    names, scores = langid.predict_texts(pa.array(["hello", "", None]), models)
    assert names == ["en", "und", "und"] and list(scores[1:]) == [0, 0]


def test_families_come_first(spark, documents):
    models = langid.fit(documents, F.col("doc_id"), per_language=50)
    assert {(m.first, m.second) for m in models} == {("germanic", "romance"), ("de", "en"), ("es", "fr")}


def test_trigrams_do_not_cross_texts():
    together = langid.trigrams(pa.array(["ab", "", "cd"]))
    alone = [langid.trigrams(pa.array([t]))[0] for t in ("ab", "cd")]
    assert together[0].tolist() == [*alone[0], *alone[1]]


def test_clean_documents_stay(documents):
    kept = langid.identified(documents)
    assert kept.count() >= 0.98 * documents.count()


def test_texts_without_a_unicode_letter_have_no_language(table):
    letterless = ["\u2014 \u201c\u201d \u20ac 5", "\U0001f600\U0001f680", "\u3002\u3001\uff01", "\u00a0\u00a0", "\u0661\u0662", "12 !?", "", None]
    lettered = ["\u043c\u0438\u0440", "\u65e5\u672c", "\u00e9", "\u20ac x"]
    model = langid.Model("de", "en", np.zeros(1 << langid.BITS), 1.0)
    names, scores = langid.predict_texts(pa.array(letterless + lettered, pa.string()), [model])
    assert names == [langid.UNKNOWN] * len(letterless) + ["de"] * len(lettered)
    assert not scores[: len(letterless)].any() and scores[len(letterless) :].all()
    kept = langid.identified(table(*enumerate(letterless + lettered)))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(len(letterless), len(letterless + lettered)))
