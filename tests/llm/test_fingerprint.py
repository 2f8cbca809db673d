import hashlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import words

from riskbook.llm import fingerprint as P


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(text, edited), jaccard(text, following))
    return out


def jaccard(a, b):
    sets = []
    for t in (a, b):
        w = t.lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def test_given_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    hand, found = brute(rows), P.edited_likeness(documents).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["n_chars"], r["edited_sha256"]) == hand[r["doc_id"]][:2]
    assert np.mean([abs(r["near_edited"] - hand[r["doc_id"]][2]) for r in found]) < 0.08
    assert np.mean([abs(r["near_next"] - hand[r["doc_id"]][3]) for r in found]) < 0.02
    text = dict(rows)
    prints = {}
    for r in found:
        assert prints.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "a b")],
        [(None, "x y z"), (3, "one two three four five six"), (5, None), (7, "")],
        [(i, " ".join(words(20 + i, i))) for i in range(400)],
        [(9, "é" * 200_001), (4, "b c d")],
    ],
)
def test_order_and_edit(table, rows):
    hand = brute(rows)
    found = {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in P.edited_likeness(table(*rows, extra=True)).collect()}
    assert found == {d: v[:2] for d, v in hand.items()}


def test_repeated_and_null_identifiers_and_no_rows(table):
    assert P.edited_likeness(table((2, "a a"), (2, "a a"), (1, "c"), (None, "x"), (None, "y"))).count() == 5
    assert P.edited_likeness(table().limit(0)).count() == 0


def test_merge_is_exact_and_containment_holds_for_unequal_texts():
    whole, part = words(4000, 1), words(4000, 1)[1000:1300]
    a, b = P.sketches([" ".join(whole), " ".join(part)])
    assert P.containment(b, a) == 1.0 and P.likeness(a, b) < 0.2
    halves = P.sketches([" ".join(whole[:2004]), " ".join(whole[2000:])])
    assert (P.merge(*halves) == a).all()
    tiny = P.sketches(["one", "two", ""])
    assert [len(t) for t in tiny] == [1, 1, 0] and len(P.merge(tiny[0], tiny[1])) >= 1
    assert (P.from_string(P.to_string(a)) == a).all()
    assert 0.2 < len(a) / 3996 < 0.3


@pytest.mark.parametrize("null", [False, True])
def test_identifiers_that_are_no_doubles(table, null):
    rows = [((1 << 62) + 1 + 2_003 * i, " ".join(words(12, i))) for i in range(400)] + [(None, "no identifier")] * null
    hand = brute(rows)
    found = {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in P.edited_likeness(table(*rows)).collect()}
    assert found == {d: v[:2] for d, v in hand.items()}


def test_a_part_without_its_tail_is_an_error():
    batch = pa.RecordBatch.from_pydict({"part": [0, 1], "is_tail": [False, False], "doc_id": [2, 1], "text": ["a", "b"]})
    with pytest.raises(RuntimeError, match="part 0"):
        list(P._compared(4, 5)(iter([batch])))
