"""Target-distribution importance resampling over hashed n-grams.

A text's n-grams go to buckets by their checksum.  A bucket's gain says how much more often the target
texts use it than the corpus does; a document's weight is the sum of the gains of all its n-grams, and the
draw without replacement takes the documents with the highest weight plus Gumbel noise (from a digest of
the identifier, so that reruns agree).

Inside a task, the n-grams of a batch are interned by an open-addressed NumPy table: xxhash64 keys, linear
probing, all n-grams at once, and a comparison of the bytes wherever keys agree.  Each slot stores its n-gram's
bucket and count.  Counting adds the slots' counts to their buckets; scoring gathers the gain of each
occurrence by its slot.  Counts of tasks are summed by bucket, so what reaches the driver has one number
for each bucket.  Ranks come from ranges of the sort order, numbered inside and by the ranges before.

Defined cases: a null text has no words, a text with fewer words than an n-gram has none of that size (weight
0); null identifiers share the digest of the empty one and come last among ties; rows equal in
identifier and score get ranks of their own; no target texts give gains from the corpus alone; an
empty table gives an empty result; clashing extra columns are left out.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbook.llm.storage import store
from riskbook.llm.text import slices, text_bytes

ORDERS = (1,)
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SALT = "2024"
#: Rows in one range of the sort order, about.
RANGE_ROWS = 100_000

#: Bytes of words: digits, letters, and all of characters beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# Fixed values of xxhash64.
P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


# -- n-grams -----------------------------------------------------------------------


def grams(column: pa.Array, orders: tuple[int, ...] = ORDERS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of texts as spans of bytes.

    Returns the bytes (words in lower case, one space between two), starts and ends of all n-grams text by text,
    each text's first place among them, and each text's number of words.
    """
    raw, places = text_bytes(column)
    raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    full = WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[places] = True
    first = full & (~np.concatenate([[False], full[:-1]]) | edge[:-1])
    starts = np.flatnonzero(first)
    last = full & (~np.concatenate([full[1:], [False]]) | edge[1:])
    lengths = np.flatnonzero(last) + 1 - starts
    # words side by side with one space after each; 8 bytes more, so that any place can be read as a long
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    line = np.full(int((lengths + 1).sum()) + 8, 0x20, np.uint8)
    line[np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))] = raw[full]
    offsets = np.searchsorted(starts, places)
    words = np.diff(offsets)
    text = np.repeat(np.arange(len(words)), words)
    left = np.repeat(offsets[1:], words) - np.arange(len(starts))  # words from this one to the text's end
    parts = []
    for n in orders:
        at = np.flatnonzero(left >= n)
        parts.append((text[at], begin[at], begin[at + n - 1] + lengths[at + n - 1]))
    if len(parts) == 1:
        owner, a, b = parts[0]
    else:
        owner, a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(owner, kind="stable")
        owner, a, b = owner[order], a[order], b[order]
    return line, a, b, np.searchsorted(owner, np.arange(len(words) + 1)), words


def xxhash64(line: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of spans of bytes; `line` has 8 bytes beyond the last span."""
    out = np.empty(len(starts), np.uint64)
    length = ends - starts
    longs = np.ndarray(len(line) - 7, "<u8", line, strides=(1,))
    ints = np.ndarray(len(line) - 3, "<u4", line, strides=(1,))
    short = length < 32

    def turn(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    at, rest = starts[short].copy(), length[short].copy()
    h = P5 + rest.astype(np.uint64)
    while len(here := np.flatnonzero(rest >= 8)):
        h[here] = turn(h[here] ^ (turn(longs[at[here]] * P2, 31) * P1), 27) * P1 + P4
        at[here] += 8
        rest[here] -= 8
    here = np.flatnonzero(rest >= 4)
    h[here] = turn(h[here] ^ (ints[at[here]].astype(np.uint64) * P1), 23) * P2 + P3
    at[here] += 4
    rest[here] -= 4
    while len(here := np.flatnonzero(rest > 0)):
        h[here] = turn(h[here] ^ (line[at[here]].astype(np.uint64) * P5), 11) * P1
        at[here] += 1
        rest[here] -= 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    out[short] = h ^ (h >> np.uint64(32))
    whole = memoryview(line)
    for i in np.flatnonzero(~short):
        out[i] = xxhash.xxh64_intdigest(whole[starts[i] : ends[i]])
    return out


def same_bytes(line: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether spans of one length are equal, 8 bytes at a time."""
    longs = np.ndarray(len(line) - 7, "<u8", line, strides=(1,))
    same = np.ones(len(a), bool)
    left, done = np.flatnonzero(a != b), 0
    while len(left):
        rest = np.minimum(length[left] - done, 8)
        cut = np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - rest) * 8).astype(np.uint64)
        equal = ((longs[a[left] + done] ^ longs[b[left] + done]) & cut) == 0
        same[left[~equal]] = False
        done += 8
        left = left[equal & (length[left] > done)]
    return same


class Table:
    """The n-grams of a batch in an open-addressed table.

    `slot` is each occurrence's slot; `bucket` and `count` are stored by slot (bucket -1: free).
    """

    def __init__(self, line: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int):
        keys, length = xxhash64(line, starts, ends), ends - starts
        size = 1 << max(4, (2 * len(starts)).bit_length())
        owner = np.full(size, -1, np.int64)  # the occurrence whose bytes stand for the slot
        self.slot = (keys & np.uint64(size - 1)).astype(np.int64)
        left = np.arange(len(starts))
        while len(left):
            at = self.slot[left]
            free = owner[at] < 0
            owner[at[free]] = left[free]  # of several that claim a slot, one stands
            there = owner[at]
            equal = (keys[there] == keys[left]) & (length[there] == length[left])
            here = np.flatnonzero(equal)
            equal[here] = same_bytes(line, starts[there[here]], starts[left[here]], length[left[here]])
            left = left[~equal]
            self.slot[left] = (self.slot[left] + 1) & (size - 1)
        self.count = np.bincount(self.slot, minlength=size)
        used = np.flatnonzero(owner >= 0)
        whole, first, last = memoryview(line), starts[owner[used]].tolist(), ends[owner[used]].tolist()
        self.bucket = np.full(size, -1, np.int64)
        self.bucket[used] = [zlib.crc32(whole[a:b]) % buckets for a, b in zip(first, last, strict=True)]

    def counts(self, buckets: int) -> np.ndarray:
        used = self.bucket >= 0
        return np.bincount(self.bucket[used], self.count[used], buckets).astype(np.int64)

    def gathered(self, gains: np.ndarray) -> np.ndarray:
        """The gain of each occurrence, by its slot."""
        return np.where(self.bucket >= 0, gains[self.bucket], 0)[self.slot]


# -- Spark -------------------------------------------------------------------------


def bucket_counts(texts: DataFrame, orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of n-grams by bucket, over all rows of `texts` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for rows in slices(batch):
                line, starts, ends, *_ = grams(rows.column("text"), orders)
                total += Table(line, starts, ends, buckets).counts(buckets)
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(here, pa.int32()), "n": pa.array(total[here])})

    found = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in found.collect():  # at most one for each bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    buckets, t, s = len(target), float(target.sum()), float(corpus.sum())
    return np.array(
        [
            math.floor(1000 * math.log((a + 1.0) * (s + buckets) / ((b + 1.0) * (t + buckets))))
            for a, b in zip(target.tolist(), corpus.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(name: str) -> int:
    """Thousandths of a Gumbel variable from a digest, rounded down."""
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, orders: tuple[int, ...] = ORDERS, salt: str = SALT) -> DataFrame:
    """Each document's n_words, n_features, weight and score, for `docs` (doc_id, text)."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                line, starts, ends, first, words = grams(piece.column("text"), orders)
                found = np.concatenate([[0], np.cumsum(Table(line, starts, ends, buckets).gathered(gain))])
                weight = found[first[1:]] - found[first[:-1]]
                ids = piece.column("doc_id")
                noises = [noise(f"{salt}:{'' if i is None else i}") for i in ids.to_pylist()]
                columns = [words, np.diff(first), weight, weight + np.array(noises, np.int64)]
                arrays = [ids, *(pa.array(c, pa.int64()) for c in columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def drawn(weighed: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Documents with their place in the draw (`rank`), null for those not drawn.

    Of N documents with at least `least_words` words, floor(N * percent / 100) are drawn.
    """
    rows = store(weighed.withColumn("tie", F.monotonically_increasing_id()), "weighed")
    fit = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    eligible = rows.where(fit)
    many = eligible.count()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("tie")]
    ranged = eligible.repartitionByRange(max(1, -(-many // RANGE_ROWS)), *order).withColumn("part", F.spark_partition_id())
    ranged = store(ranged, "ranged")  # which range a row is in must not change any more
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    ahead = ranged.groupBy("part").agg(F.count("*").alias("n"))
    ahead = ahead.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("ahead")
    ranked = ranged.join(ahead, "part").withColumn("place", place.cast("long"))
    rank = F.when(F.col("place") <= many * percent // 100, F.col("place"))
    shown = ["doc_id", "n_features", "weight", "score"]
    others = rows.where(~fit).select(*shown, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*shown, rank.alias("rank")).unionByName(others)


def resample(
    docs: DataFrame,
    target: DataFrame,
    orders: tuple[int, ...] = ORDERS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    salt: str = SALT,
) -> DataFrame:
    """Every document's weight, score and rank in the draw towards the texts of `target`."""
    gain = gains(bucket_counts(target, orders, buckets), bucket_counts(docs, orders, buckets))
    return drawn(weigh(docs, gain, orders, salt), least_words, percent)
