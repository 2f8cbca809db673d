import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskbook.llm import packing as K
from riskbook.llm.queries import byte_tokenizer, op11_best_fit_packing
from riskbook.llm.storage import store

ODD = [
    "á e b ́x", "x y z​q", "<|endoftext|> hi", "a<|endoftext|>b", "'s it's 's don't. I'LL", "ＡＢ ﬁ ß İ", "\x00a b\x1c\x1d c\x85d",
    "Ünï-cödé, ÉTÉ!", "Hi!s", " ", "", "ªµº Straße*** x", "end.)", "12 1a2 a1", "½ ² ÷×", "word word　w", "a  b   c\n\n d \n", " x\xa0y ",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_tokenizer())


@pytest.fixture(scope="module")
def encoder():
    return K.Encoder(byte_tokenizer())


def ids_of(encoder, texts):
    ids, lengths = encoder.encode(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(ids, np.cumsum(lengths)[:-1])]


def test_ids_equal_the_tokenizers(tokenizer, encoder, documents):
    texts = [*ODD, *[r["text"] or "" for r in documents.select("text").collect()]]
    for text, ids in zip(texts, ids_of(encoder, texts), strict=True):
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text[:60]


SPACED = st.text(st.sampled_from("aé1,' \n\t\x85\xa0\x1c"), max_size=30)


@settings(max_examples=600, deadline=None)
@given(st.text(max_size=60) | SPACED)
def test_ids_of_any_text(encoder, text):
    assert ids_of(encoder, [text])[0] == list(encoder.whole(text))


def best_fit(lengths, capacity):
    """Rooms left by best fit, one piece at a time in descending order."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=120))
def test_the_plan_is_best_fit_one_by_one(lengths):
    counts = np.bincount(lengths, minlength=13)
    runs = K.plan(counts)
    used, spans = defaultdict(int), defaultdict(list)
    for length in range(1, 13):
        many = counts[length]
        sequence, offset = K.slots(runs, np.full(many, length), np.arange(many)) if many else ([], [])
        for s, o in zip(sequence, offset, strict=True):
            used[int(s)] += length
            spans[int(s)].append((int(o), int(o) + length))
    assert sorted(12 - u for u in used.values()) == best_fit(lengths, 12)
    assert sorted(used) == list(range(len(used)))
    for parts in spans.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))


def test_plan_size_does_not_follow_the_counts():
    counts = np.random.default_rng(1).integers(1, 100, 1025)
    counts[0] = 0
    few, many = K.plan(counts), K.plan(counts * 1_000_000_007)
    assert len(few) < 5000 and len(many) < 20_000
    total = int((counts * np.arange(1025)).sum())
    assert few["first_sequence"].max() + 1 <= total / 1024 * 1.01 + 1


def check(rows, found, tokenizer, capacity=1024):
    """Pieces are those of the tokenizer's ids, and sequences are filled without gaps."""
    want = defaultdict(int)
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, K.END_ID]
        head = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(head, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = defaultdict(int)
    places = defaultdict(list)
    for r in found:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
        assert sum(n for _, n in spans) <= capacity
    lengths = [n for spans in places.values() for _, n in spans]
    assert len(places) == len(best_fit([n for n in lengths if n < capacity], capacity)) + lengths.count(capacity)


def test_query_packs_every_document(spark, data, documents, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    check(rows, op11_best_fit_packing(spark, data).collect(), tokenizer)


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_small_capacity_over_many_tasks(documents, tokenizer, monkeypatch, broadcast):
    monkeypatch.setattr(K, "BROADCAST_ROWS", broadcast)
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = K.digests(K.packed(documents.repartition(5), byte_tokenizer(), 100)).collect()
    check(rows, found, tokenizer, 100)


def test_odd_tables(table, tokenizer):
    rows = [(5, None), (2, "b c"), (None, "z"), (None, "z"), (None, ""), (9, " ".join(["long"] * 50_000)), (9, "again"), (1, "a" * 30_000)]
    check(rows, K.digests(K.packed(table(*rows, extra=True), byte_tokenizer())).collect(), tokenizer)
    assert K.packed(table().limit(0), byte_tokenizer()).count() == 0


def test_sequences_hold_their_pieces(table, tokenizer):
    docs = table((1, "hello there"), (2, "another text"))
    row = store(K.packed(docs, byte_tokenizer())).collect()
    assert len(row) == 1
    ids = np.frombuffer(row[0]["ids"], "<u4").tolist()
    texts = {1: "hello there", 2: "another text"}
    for p in row[0]["pieces"]:
        assert ids[p["offset"] : p["offset"] + p["length"]] == [*tokenizer.encode(texts[p["doc_id"]]).ids, 2]
    assert row[0]["n_tokens"] == len(ids)
