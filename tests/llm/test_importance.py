import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from riskbook.llm import importance as K
from riskbook.llm.queries import op12_importance_resampling
from riskbook.llm.sql import RESAMPLING

UPPER = {i: i + 32 for i in range(65, 91)}


def features(text, orders=(1,)):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))
    return words, [" ".join(words[i : i + n]) for n in orders for i in range(len(words) - n + 1)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8), st.sampled_from([(1,), (1, 2), (1, 2, 3), (3,)]))
def test_grams_of_any_texts(texts, orders):
    line, starts, ends, first, words = K.grams(pa.array(texts, pa.string()), orders)
    found = [line[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    for i, text in enumerate(texts):
        want, runs = features(text, orders)
        assert words[i] == len(want)
        assert sorted(found[first[i] : first[i + 1]]) == sorted(runs)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=90), max_size=40))
def test_keys_are_xxhash64_and_equal_bytes_share_a_slot(items):
    items = items + items[::2]
    line = np.frombuffer(b"".join(items) + bytes(8), np.uint8).copy()
    ends = np.cumsum([len(x) for x in items]).astype(np.int64)
    starts = ends - np.array([len(x) for x in items], np.int64)
    assert K.xxhash64(line, starts, ends).tolist() == [xxhash.xxh64_intdigest(x) for x in items]
    table = K.Table(line, starts, ends, 97)
    assert len({(x, s) for x, s in zip(items, table.slot.tolist(), strict=True)}) == len(set(items)) == len(set(table.slot.tolist()))
    assert [table.bucket[s] for s in table.slot] == [zlib.crc32(x) % 97 for x in items]
    assert table.counts(97).tolist() == np.bincount([zlib.crc32(x) % 97 for x in items], minlength=97).tolist()
    gain = np.arange(97) - 40
    assert table.gathered(gain).tolist() == [gain[zlib.crc32(x) % 97] for x in items]


def test_equal_keys_of_different_bytes_have_slots_of_their_own(monkeypatch):
    monkeypatch.setattr(K, "xxhash64", lambda line, starts, ends: np.full(len(starts), 5, np.uint64))
    items = [b"aa", b"ab", b"aa", b"longer than eight", b"longer than eighT", b"ab", b"longer than eight"]
    line = np.frombuffer(b"".join(items) + bytes(8), np.uint8).copy()
    ends = np.cumsum([len(x) for x in items])
    table = K.Table(line, ends - [len(x) for x in items], ends, 1000)
    assert len(set(table.slot.tolist())) == 4 and table.count[table.slot].tolist() == [2, 2, 2, 2, 1, 2, 2]


def expected(rows, target, orders=(1,), buckets=10_000, least=20, percent=10, salt="2024"):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    found = [features(text, orders) for _, text in rows]
    for _, fs in found:
        for f in fs:
            s[bucket(f)] += 1
    for text in target:
        for f in features(text, orders)[1]:
            t[bucket(f)] += 1
    sums, sumt = int(s.sum()), int(t.sum())
    out = []
    for (doc_id, _), (words, fs) in zip(rows, found, strict=True):
        weight = sum(
            math.floor(1000 * math.log(float(t[b] + 1) * (sumt * 0 + sums + buckets) / (float(s[b] + 1) * (sumt + buckets))))
            for b in map(bucket, fs)
        )
        h = int(hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(fs), weight, score, None, len(words)])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(fit[: len(fit) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force_and_sql(spark, data, documents, monkeypatch):
    monkeypatch.setattr(K, "RANGE_ROWS", 150)
    rows = [(r[0], r[1]) for r in documents.select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{data}/benchmark.parquet").select("text").collect()]
    found = result(op12_importance_resampling(spark, data))
    assert found == expected(rows, target)
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    assert found == sorted(db.sql(RESAMPLING).fetchall(), key=repr)


@pytest.mark.parametrize("orders", [(1,), (1, 2, 3)])
def test_odd_tables(table, orders):
    rows = [(1, None), (2, ""), (3, "One, two; ÉTÉ 3"), (None, "a b c " * 20), (None, "a b c " * 20), (4, "x " * 40_000), (4, "x " * 40_000), (5, "w" * 5000)]
    rows += [(10 + i, f"Some words of text number {i} " * 6) for i in range(40)]
    target = table((1, "some words of text"), (2, None))
    found = K.resample(table(*rows, extra=True).repartition(3), target, orders, 500, 20, 30, "s")
    assert result(found) == expected(rows, ["some words of text"], orders, 500, 20, 30, "s")
    assert K.resample(table().limit(0), target).count() == 0
    assert result(K.resample(table(*rows), table().limit(0))) == expected(rows, [])
