import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskbook.llm import token_files as K
from riskbook.llm.queries import word_tokenizer
from riskbook.llm.storage import scratch

ODD = [
    "á e b ́x", "x y z​q", "<|endoftext|> hi", "a<|endoftext|>b", "'s it's 's don't.", "ＡＢ ﬁ ß İ", "\x00a b",
    "Ünï-cödé, ÉTÉ!", "Hi!s", " ", "", "ªµº Straße*** x", "end.)", "12 1a2 a1", "½ ² ÷×", "word word　w",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_tokenizer())


def test_ids_equal_the_tokenizers(tokenizer, documents):
    texts = [*ODD, *[r["text"] for r in documents.select("text").collect()]]
    found = K.Encoder(word_tokenizer()).encode(pa.array(texts, pa.string()))
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:60]


SPACED = st.text(st.sampled_from("aéÉ1,.' \n\t\x85\xa0\x1cªß"), max_size=30)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | SPACED)
def test_ids_of_any_text(text):
    encoder = K.Encoder.__dict__.get("shared") or K.Encoder(word_tokenizer())
    K.Encoder.shared = encoder
    assert encoder.encode(pa.array([text], pa.string()))[0].tolist() == list(encoder.whole(text))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=400), min_size=1, max_size=5))
def test_any_range_of_any_document_comes_back(docs):
    lengths = np.array([len(d) for d in docs])
    ids = np.array([i for d in docs for i in d], np.int64)
    shard = K.Shard(K.pack(list(range(len(docs))), lengths, ids, 10))
    assert shard.every().tolist() == ids.tolist()
    for i, doc in enumerate(docs):
        assert shard.decode(i).tolist() == doc
        for start, stop in ((0, 1), (1, 3), (len(doc) // 2, None), (5, 50)):
            assert shard.decode(i, start, stop).tolist() == doc[start:stop]


def test_repetitive_ids_become_rules():
    ids = np.tile(np.arange(50), 400)
    shard = K.Shard(K.pack([1], np.array([len(ids)]), ids, 100))
    assert len(shard.symbols) < len(ids) / 5 and len(shard.rules) > 40
    assert all(len(K.expand(np.array([100 + i]), shard.rules, 100)) == n for i, n in enumerate(shard.lengths))


def digests(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, K.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard", [200, 1 << 19])
def test_round_trip(documents, tokenizer, monkeypatch, shard):
    monkeypatch.setattr(K, "SHARD_TOKENS", shard)
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = K.round_trip(documents.repartition(3), word_tokenizer()).collect()
    assert sorted(tuple(r)[:4] for r in found) == digests(rows, tokenizer)


def test_odd_tables(table, tokenizer):
    rows = [(5, None), (2, "b c"), (None, "z"), (9, " ".join(["long"] * 50_000))]
    found = K.round_trip(table(*rows, extra=True), word_tokenizer()).collect()
    assert sorted((tuple(r)[:4] for r in found), key=lambda r: r[1]) == digests(rows, tokenizer)
    assert K.round_trip(table((1, "a"), (1, "a"), (1, "b")), word_tokenizer()).count() == 3
    assert K.round_trip(table().limit(0), word_tokenizer()).count() == 0


def test_ids_are_read_back(spark, table, tokenizer):
    folder = scratch(spark) + "/ids"
    docs = table((1, "hello there"), (2, ""))
    found = K.read_ids(K.write(docs, word_tokenizer(), folder), folder)
    assert {r["doc_id"]: r["ids"] for r in found.collect()} == {
        1: [*tokenizer.encode("hello there", add_special_tokens=False).ids, 1],
        2: [1],
    }
