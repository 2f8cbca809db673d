from itertools import combinations

import numpy as np
import pytest
from conftest import words

from riskbook.llm import jaccard_join as J
from riskbook.llm.components import connected


def brute(rows, threshold=0.8, size=5):
    """Class and links of each row by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        same = (rows[a][1] or "") == (rows[b][1] or "")
        if same or (sets[a] & sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-12):
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    classes = {}
    for i, (d, _) in enumerate(rows):
        classes.setdefault(find(i), []).append(d)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in classes.items()}
    return sorted(((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows)), key=repr)


def near_copies():
    rows, n = [], 0
    for base in range(6):
        start = words(60, base)
        for copy in range(12):
            text = list(start)
            for at in range(copy % 4):
                text[(7 * copy + 11 * at) % 60] = f"edit{copy}x{at}"
            rows.append((n, " ".join(text)))
            n += 1
    rows += [(n, words_) for n, words_ in enumerate((" ".join(words(40, 100 + i)) for i in range(20)), n)]
    return rows


@pytest.mark.parametrize("chunk", [3, 256])
def test_equals_all_pairs(table, monkeypatch, chunk):
    monkeypatch.setattr(J, "CHUNK_TEXTS", chunk)
    rows = near_copies() + [(500, None), (501, ""), (502, "one two"), (503, "ONE  two"), (None, rows_text()), (None, rows_text())]
    found = J.similarity_join(table(*rows, extra=True))
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in found.collect()), key=repr) == brute(rows)


def rows_text():
    return " ".join(words(30, 999))


def test_given_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = J.similarity_join(documents)
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in found.collect()), key=repr) == brute(rows)


def test_one_of_each_class_stays(table):
    rows = near_copies() + [(3, near_copies()[3][1]), (None, None), (None, "")]
    docs = table(*rows, extra=True)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    classes = {}
    for (d, c, _), in zip(brute(rows)):
        classes.setdefault(c, []).append(d)
    got = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert got == sorted((None if c is None else c for c in classes), key=repr)


def test_empty_table(table):
    none = table().limit(0)
    assert J.similarity_join(none).count() == 0 and J.keep_one(none).count() == 0


def test_depth_meets_the_target():
    depth = J.depth_for(0.8, 0.999)
    assert J.recall(0.8, depth, J.TREES) >= 0.999 > J.recall(0.8, depth + 1, J.TREES)


def test_prefixes_agree_as_often_as_expected():
    random = np.random.default_rng(3)
    shared = random.integers(0, 1 << 63, 900, dtype=np.uint64)
    hits, depth = 0, 6
    for _ in range(40):
        a, b = (np.concatenate([shared, random.integers(0, 1 << 63, 100, dtype=np.uint64)]) for _ in range(2))
        paths = J.prefixes(np.concatenate([a, b]), np.array([0, 1000, 2000]), depth, J.TREES)
        hits += (paths[0] == paths[1]).sum()
    expected = 40 * J.TREES * (900 / 1100) ** depth
    assert 0.7 * expected < hits < 1.3 * expected


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (5, 5), (4, 1), (20, 10), *[(100 + i, 101 + i) for i in range(30)]]
    found = dict(tuple(r) for r in connected(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {found[i] for i in (1, 2, 3, 4)} == {1} and {found[i] for i in (10, 11, 12, 20)} == {10}
    assert {found[i] for i in range(100, 131)} == {100} and 5 not in found
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
