import random

import numpy as np
from conftest import words
from pyspark.sql import functions as F

from riskbook.llm import queries, toxicity

BAD = ["scumbag", "worthless", "pathetic"]


def labelled(n=160, seed=1):
    random_ = random.Random(seed)
    rows = []
    for i in range(n):
        text, toxic = words(120, seed * 1000 + i), i % 4 == 0
        for _ in range(4 * toxic):
            text[random_.randrange(120)] = random_.choice(BAD)
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_learns_from_one_sample_and_holds_on_another(spark, table):
    rows = labelled()
    labels = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    model = toxicity.fit(table(*[r[:2] for r in rows]), labels, F.col("doc_id"))
    other = labelled(80, 2)
    found = {r["doc_id"]: r for r in toxicity.score(table(*[r[:2] for r in other]).select("doc_id", "text"), model).collect()}
    right = np.mean([found[d]["predicted"] == t for d, _, t in other])
    assert right > 0.95 and all(r["predicted"] == int(r["score"] >= 0.3) for r in found.values())


def test_given_documents(spark, data):
    found = queries.op4_toxicity(spark, data)
    documents = spark.read.parquet(f"{data}/documents.parquet")
    rows = found.collect()
    assert len(rows) == documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]


def test_odd_texts_and_missing_labels(spark, table):
    rows = labelled(60)
    labels = spark.createDataFrame([*[(d, t) for d, _, t in rows], (None, 1), (3, None), (999, 1), (0, 0)], "doc_id long, toxic int")
    model = toxicity.fit(table(*[r[:2] for r in rows], (None, "x")), labels, F.col("doc_id"))
    odd = table((1, None), (2, ""), (3, " ".join(BAD * 20_000)), (None, "a"), (3, "b"), (3, "b"), extra=True)
    scored = toxicity.score(odd.select("doc_id", "text"), model).collect()
    assert len(scored) == 6 and scored[0]["score"] == scored[1]["score"] and scored[4]["score"] == scored[5]["score"]
    assert toxicity.score(odd.select("doc_id", "text").limit(0), model).count() == 0
    nothing = toxicity.fit(table((1, "a")), labels.limit(0), F.col("doc_id"))
    assert [r["score"] for r in toxicity.score(odd.select("doc_id", "text"), nothing).collect()] == [0.0] * 6
    one_sided = toxicity.fit(table((0, "a"), (1, "b")), labels.where("toxic = 0"), F.col("doc_id"))
    assert one_sided.pair is None and one_sided.prior == 0.0


def test_dictionaries_gain_on_toxic_windows_only():
    rows = labelled()
    model = toxicity.fit_texts([t for _, t, _ in rows], [x for _, _, x in rows])
    gains = toxicity.Gains(model.pair)
    assert gains.of(" ".join(["keba", "pathetic", "worthless", "scumbag", "lo", "mi"])).max() >= 2 + 5
    assert np.mean([gains.of(" ".join(words(60, 77 + i))).mean() for i in range(10)]) < 2.6


def test_scores_by_hand(spark, table):
    """Windows, compressed lengths, weights and the logistic function, one by one."""
    import math

    import zstandard

    rows = labelled()
    labels = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    model = toxicity.fit(table(*[r[:2] for r in rows]), labels, F.col("doc_id"))
    options = zstandard.ZstdCompressionParameters.from_level(
        3, strategy=zstandard.STRATEGY_BTOPT, min_match=3, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0, write_checksum=0, write_dict_id=0,
    )

    def length(data, content):
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=options)
        return len(zstandard.ZstdCompressor(dict_data=held, compression_params=options).compress(data))

    def by_hand(text):
        found, words_ = [], (text or "").lower().split()
        for i in range(0, len(words_), 6):
            window = model.pair.lead + (" " + " ".join(words_[i : i + 6]) + " ").encode()
            gain = length(window, model.pair.ordinary) - length(window, model.pair.toxic)
            found.append(model.weights[min(max(gain, -2), 9) + 2])
        top = sum(sorted((max(f, 0.0) for f in found), reverse=True)[:3])
        stretch = max([0.0, *(sum(found[a:b]) for a in range(len(found)) for b in range(a + 1, len(found) + 1))])
        x = [sum(found) / len(found) if found else 0.0, top, stretch, math.log(1 + len(found)), 1.0]
        return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.bias, strict=True))))

    texts = {d: t for d, t, _ in labelled(12, 9)} | {100: None, 101: "", 102: "Worthless", 103: "x " * 700}
    for r in toxicity.score(table(*texts.items()).select("doc_id", "text"), model).collect():
        assert abs(r["score"] - by_hand(texts[r["doc_id"]])) < 1e-9


def test_scores_have_the_share_of_the_labels(spark, table):
    rows = [r for seed in range(4) for r in [(1000 * seed + d, t, x) for d, t, x in labelled(200, 10 + seed)] if r[2] == 0 or r[0] % 8 == 0]
    labels = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    share = np.mean([t for _, _, t in rows])
    model = toxicity.fit(table(*[r[:2] for r in rows]), labels, F.col("doc_id"), per_label=60)
    other = [r for r in labelled(400, 30) if r[2] == 0 or r[0] % 8 == 0]
    found = toxicity.score(table(*[r[:2] for r in other]).select("doc_id", "text"), model).collect()
    assert abs(np.mean([r["score"] for r in found]) - np.mean([t for _, _, t in other])) < 0.03
    assert abs(share - model.prior) < 1e-9


def test_toxic_passages_in_texts_of_all_lengths(spark, table):
    rows = labelled(400)
    labels = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    model = toxicity.fit(table(*[r[:2] for r in rows]), labels, F.col("doc_id"))
    docs, planted = [], set()
    for k, n in enumerate((20, 60, 200, 600)):
        for i in range(20):
            text = words(n, 5000 + 100 * k + i)
            if i % 2:
                text[n // 2 : n // 2] = [*BAD, *BAD]
                planted.add(100 * k + i)
            docs.append((100 * k + i, " ".join(text)))
    found = {r["doc_id"]: r["score"] for r in toxicity.score(table(*docs).select("doc_id", "text"), model).collect()}
    clean = sorted(s for d, s in found.items() if d not in planted)
    limit = clean[int(0.9 * len(clean))]
    assert np.mean([found[d] > limit for d in planted]) > 0.9


def short_words(n, seed):
    """Texts marked by words that are shorter than a piece."""
    random_ = random.Random(seed)
    rows = []
    for i in range(n):
        text, toxic = words(120, seed * 10_000 + i), i % 4 == 0
        for _ in range(6 * toxic):
            text[random_.randrange(120)] = random_.choice(["ugh", "vex", "qix", "wib"])
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_short_words_are_learned(spark, table):
    rows = short_words(400, 3)
    labels = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    model = toxicity.fit(table(*[r[:2] for r in rows]), labels, F.col("doc_id"))
    other = short_words(200, 4)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(table(*[r[:2] for r in other]).select("doc_id", "text"), model).collect()}
    clean = sorted(found[d] for d, _, t in other if not t)
    assert np.mean([found[d] > clean[int(0.9 * len(clean))] for d, _, t in other if t]) > 0.8


def phrases(n, seed):
    """Texts of one kind of words; toxic ones hold some of them side by side in certain pairs."""
    random_ = random.Random(seed)
    syllables = ["ba", "ke", "lo", "mi", "tu", "ra", "sen", "dor"]
    pairs = [f"{a}{b} {b}{c}" for a, b, c in zip(syllables * 2, syllables[1:] + syllables * 2, syllables[3:] + syllables * 2, strict=False)]
    rows = []
    for i in range(n):
        text, toxic = words(120, seed * 1000 + i), i % 4 == 0
        for _ in range(4 * toxic):
            text[random_.randrange(120)] = random_.choice(pairs)
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_pairs_of_ordinary_words_are_learned(spark, table):
    rows = phrases(600, 5)
    labels = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    model = toxicity.fit(table(*[r[:2] for r in rows]), labels, F.col("doc_id"))
    other = phrases(200, 6)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(table(*[r[:2] for r in other]).select("doc_id", "text"), model).collect()}
    clean = sorted(found[d] for d, _, t in other if not t)
    assert np.mean([found[d] > clean[int(0.9 * len(clean))] for d, _, t in other if t]) > 0.8


def test_word_contexts_by_spark_equal_those_by_python(spark, table):
    rows = [(1, "Ugh  you ugh", 1), (2, "ugh you ugh", 1), (3, " so\tugh ", 0), (4, "", 0)]
    rows += [(10 + i, f"w{i} ugh z{i}", 1) for i in range(40)] + [(100 + i, f"w{i} and z{i} or", 0) for i in range(80)]
    labelled_ = table(*[r[:2] for r in rows]).select("doc_id", "text").join(
        spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int"), "doc_id"
    )
    ordinary, toxic, n, m = toxicity.word_contexts(labelled_)
    held = [set().union(*(toxicity.contexts(t) for _, t, x in rows if x == label)) for label in (0, 1)]
    assert (n, m) == tuple(map(len, held)) and set(toxic) == {"ugh"}
    assert (ordinary["ugh"], toxic["ugh"]) == tuple(sum(w == "ugh" for _, w, _ in h) for h in held) == (1, 42)


def test_what_pieces_cover_of_words():
    assert toxicity.spans("loweient", {" lowe", "lowei"}) == {b" lowei"}
    assert toxicity.spans("xxbadlyxxwrong", {"badly", "wrong"}) == {b"badly", b"wrong "}
