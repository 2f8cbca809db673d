import pyarrow as pa
from conftest import words

from riskbook.llm import decontaminate as D

QUESTION = "If Tom buys 12 apples for 3 dollars each and gives 12 to Anna, how much money did Tom spend on all of the apples?"
AGAIN = "x y z. If Sue buys 15 apples for 4 dollars each and gives 15 to Kate, how much money did Sue spend on all of the apples? ok"
TANGLED = AGAIN.replace("gives 15", "gives 16").replace("did Sue", "did Bob")


def benchmark(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_question_with_other_values_is_caught_and_a_tangled_one_is_not(spark, table):
    items = benchmark(spark, QUESTION, " ".join(words(30, 5)), None, "")
    docs = table((1, AGAIN), (2, TANGLED), (3, QUESTION.upper()), (4, " ".join(words(200, 6))), (None, None), (6, ""), extra=True)
    rows = {r["doc_id"]: r for r in D.leaks(docs, items).collect()}
    assert set(rows) == {1, 3} and rows[1]["changed"] and rows[1]["item_id"] == 0
    assert rows[1]["longest"] == rows[1]["item_windows"]
    clean = D.without_leaks(docs, items)
    assert sorted(r["doc_id"] or 0 for r in clean.collect()) == [0, 2, 4, 6] and clean.columns == docs.columns


def test_planted_passages_are_found_by_brute_force_too(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda t: " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split())
    asked = [(r["item_id"], f" {plain(r['text'])} ") for r in items.collect()]
    whole = {(r["doc_id"], i) for r in docs.collect() for i, q in asked if q in f" {plain(r['text'])} "}
    found = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, items).collect()}
    assert whole and whole <= found
    grams = {tuple(q.split()[k : k + 5]) for _, q in asked for k in range(len(q.split()) - 4)}
    for doc_id in {d for d, _ in found - whole}:
        text = plain(docs.where(f"doc_id = {doc_id}").first()["text"]).split()
        assert sum(tuple(text[k : k + 5]) in grams for k in range(len(text) - 4)) >= 5


def test_long_text_repeated_rows_and_empty_tables(spark, table):
    long = " ".join([*words(20_000, 1), QUESTION, *words(20_000, 2)])
    docs = table((1, long), (1, long), (2, long))
    items = benchmark(spark, QUESTION)
    assert sorted(r["doc_id"] for r in D.leaks(docs, items).collect()) == [1, 2]
    assert D.leaks(docs.limit(0), items).count() == 0 and D.leaks(docs, items.limit(0)).count() == 0
    assert D.without_leaks(docs, items.limit(0)).count() == 3


def test_tokens_and_kinds():
    t = D.Tokens(pa.array(["Bob has 5 apples. He sold 3 kg to Ann Lee in 5km.", None, "!!! Érasmus said hi, Érasmus | Word X y"]))
    shown = [t.raw[a:b].tobytes().decode() for a, b in zip(t.starts, t.ends, strict=True)]
    kinds = dict(zip(shown, t.kinds.tolist(), strict=True))
    assert (kinds["5"], kinds["kg"], kinds["5km"], kinds["ann"], kinds["lee"]) == (D.NUMBER, D.UNIT, D.QUANTITY, D.NAME, D.NAME)
    assert [kinds[w] for w in ("bob", "he", "word", "x", "apples")] == [D.WORD] * 5
    assert [k for w, k in zip(shown, t.kinds, strict=True) if w == "érasmus"] == [D.WORD, D.NAME]
    assert t.offsets.tolist() == [0, 13, 13, 20]


def test_values_that_are_equal_by_chance_may_differ(spark, table):
    boxes = "a clerk puts 3 boxes of 3 pens on each of the long shelves and then counts all of the pens again"
    passage = f"in all there are 12 rows here, {' '.join(words(40, 9))}, and at the very end of it 12 rows are there again"
    named = boxes.replace("a clerk puts", "so Tom puts").replace("counts all", "tells Tom all")
    items = benchmark(spark, boxes, passage, named)
    docs = table(
        (1, boxes.replace("3 boxes of 3", "4 boxes of 5")),
        (2, passage.replace("it 12 rows", "it 13 rows")),
        (3, named.replace("tells Tom", "tells Ann").replace("3 boxes of 3", "4 boxes of 4")),
        (4, QUESTION.replace("spend on all of", "lose by most of")),
    )
    found = {(r["doc_id"], r["item_id"]): r["changed"] for r in D.leaks(docs, items).collect()}
    assert found[1, 0] and found[2, 1] and found[3, 2] and not any(d == 4 for d, _ in found)


def test_short_dense_and_title_case_items_are_found(spark, table):
    short, dense, sums = "What colour is the evening sky?", "Compute 12 + 15 - 3 * 4 / 2", "add 3 km 4 km 5 km 6 km 7 km 8 km 9 km"
    items = benchmark(spark, short, dense, sums, QUESTION, "yes")
    around = lambda t, k: " ".join([*words(30, k), t, *words(30, k + 1)])
    docs = table(
        (1, around(short, 1)),
        (2, around(dense, 2)),
        (3, around(sums, 3)),
        (4, around(" ".join(w.capitalize() for w in QUESTION.split()), 4)),
        (5, around("yes", 5)),
        (6, around(dense.replace("15", "16"), 6)),
        (7, "Yes!"),
    )
    assert {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, items).collect()} == {(1, 0), (2, 1), (3, 2), (4, 3), (7, 4)}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_windows_that_many_items_share_change_no_result(spark, data, table, monkeypatch):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    opening = "Read the passage below with care and then answer the question that stands under it in one short sentence."
    texts = [f"{opening} {' '.join(words(25, 100 + i))}" for i in range(30)]
    short = [f"{opening} {' '.join(words(4, 300 + i))}" for i in range(12)]  # hardly more than what they share
    asked = items.unionByName(benchmark(spark, *texts, *short, opening).selectExpr("item_id + 100000 AS item_id", "text"))
    more = table(
        *((10_000 + i, f"{' '.join(words(60, 500 + i))} {opening} {' '.join(words(60, 600 + i))}") for i in range(40)),
        *((20_000 + i, f"{' '.join(words(60, 700 + i))} {texts[i]} {' '.join(words(9, 800 + i))}") for i in range(5)),
        (None, f"{' '.join(words(60, 900))} {texts[7]}"),
    )
    both = docs.select("doc_id", "text").unionByName(more.select("doc_id", "text"))
    monkeypatch.setattr(D, "COMMON", 10**9)
    want = rows_of(D.leaks(both, asked))
    for common in (0, 2, 8):
        monkeypatch.setattr(D, "COMMON", common)
        assert rows_of(D.leaks(both, asked)) == want
    assert {(20_003, 100_003), (None, 100_007)} <= {(r[0], r[2]) for r in want}


def test_a_sentence_that_all_items_and_documents_hold_is_not_joined_with_all(spark, table, monkeypatch):
    opening = "please read every word of this long passage and answer"
    asked = benchmark(spark, *(f"{opening} {' '.join(words(40, i))}" for i in range(100)))
    docs = table(*((i, f"{opening} {' '.join(words(50, 1000 + i))}") for i in range(300)))
    made = []
    whole = D.matched_windows
    monkeypatch.setattr(D, "matched_windows", lambda *a: made.append(whole(*a)) or made[-1])
    assert D.leaks(docs, asked).count() == 0
    windows = D.templates(docs.select("doc_id", "text"), ["doc_id"], D.SIZE, 4).count()
    assert made[0].count() <= windows
