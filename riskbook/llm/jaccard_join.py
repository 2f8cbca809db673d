"""Similarity join on word shingles: MinHash banding for candidates, exact Jaccard for the result.

Each text has `trees` keys, each a hash of as many MinHash values as `depth_for` gives: the most, up to
LONGEST, at which a pair at the threshold is found with the target probability.  The depth is the same
for all texts, so this is fixed banding and not an LSH forest: no longer paths are kept, sorted or
shortened.  Texts that share a key (below: a prefix) in any tree are candidates of each other.

Pairs are never listed.  Equal texts are one node; a prefix links its members to its smallest one,
and the components of these links hold every candidate pair.  Members of a component are dealt into
chunks of bounded size; one task compares two chunks by exact shared-shingle counts, and returns per
text the number of links and one representative of what it is linked to.  A group of m different
texts thus costs (m / chunk)**2 tasks of fixed size and m * m / chunk rows, never a row per pair.

Defined cases: a null text counts as empty; texts without words link only to equal texts; a text
of fewer than `size` words has one shingle; repeated rows are copies like any other; null
identifiers are kept (a class of nothing else has a null id); empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbook.llm.bitmap import BITS, bitmap, holds
from riskbook.llm.components import connected
from riskbook.llm.storage import store
from riskbook.llm.text import mix, shingles, slices

TREES = 24
LONGEST = 12
#: Texts, and shingles, in one chunk of a component.
CHUNK_TEXTS = 256
CHUNK_SHINGLES = 1_000_000


def recall(similarity: float, depth: int, trees: int) -> float:
    """Chance that a pair of this similarity shares a prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def depth_for(threshold: float, target: float, trees: int = TREES) -> int:
    """Longest prefix at which pairs at the threshold are still found with the target recall."""
    depth = LONGEST
    while depth > 1 and recall(threshold, depth, trees) < target:
        depth -= 1
    return depth


def prefixes(found: np.ndarray, first: np.ndarray, depth: int, trees: int) -> np.ndarray:
    """Hash of each text's prefix in each tree; texts without shingles are left out."""
    starts = first[:-1][np.diff(first) > 0]
    out = np.zeros((len(starts), trees), np.uint64)
    if not len(starts):
        return out
    short = (found >> np.uint64(32)).astype(np.uint32)
    random = np.random.default_rng(20)
    for tree in range(trees):
        path = np.full(len(starts), tree + 1, np.uint64)
        for _ in range(depth):
            flip, factor = random.integers(0, 1 << 32, 2, dtype=np.uint32)
            least = np.minimum.reduceat((short ^ flip) * (factor | np.uint32(1)), starts)
            path = mix(path * np.uint64(0x9E3779B97F4A7C15) + least)
        out[:, tree] = path
    return out


def _marked(size: int, depth: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                found, first = shingles(piece.column("text"), size)
                number = np.diff(first)
                paths = prefixes(found, first, depth, trees)
                ends = np.concatenate([[0], np.cumsum((number > 0) * trees)]).astype(np.int32)
                buckets = pa.ListArray.from_arrays(pa.array(ends), pa.array(paths.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("key"), pa.array(number.astype(np.int64)), buckets],
                    names=["doc_id", "key", "shingles", "buckets"],
                )

    return run


def with_key(docs: DataFrame) -> DataFrame:
    """Identifier, text and the text's digest; equal texts have equal keys."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.unhex(F.md5(text)).alias("key"), text.alias("text"))


def _beginning(key: str) -> Column:
    """The first bits of a digest."""
    return F.shiftright(F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long"), 32 - BITS)


def _wanted(bits: np.ndarray):
    """Rows whose key may be wanted, before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins = b"".join([k[:4] for k in batch.column("k").to_pylist()])
            slots = np.frombuffer(begins, ">u4").astype(np.int64) >> (32 - BITS)
            yield batch.filter(pa.array(holds(bits, slots)))

    return run


# -- exact comparison of a block -------------------------------------------------


def shared_counts(sets: list[np.ndarray], rows: slice, columns: slice) -> np.ndarray:
    """Number of common elements of each pair of sets (sorted, without repeats)."""
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), lengths)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    many = times[code] > 1  # a shingle that stands once is shared by none
    place = np.cumsum(times > 1) - 1
    owner, code = owner[many], place[code[many]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    total = np.zeros((rows.stop - rows.start, columns.stop - columns.start), np.float32)
    width = max(256, 8_000_000 // len(sets))
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [low, low + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], code[a:b] - low] = 1
        total += part[rows] @ part[columns].T
    return total


def linked(sets: list[np.ndarray], split: int, threshold: float) -> np.ndarray:
    """Matrix of the pairs at or above the threshold; with `split`, only those across it."""
    n = len(sets)
    rows, columns = (slice(0, n), slice(0, n)) if not split else (slice(0, split), slice(split, n))
    lengths = np.array([len(s) for s in sets], np.float64)
    shared = shared_counts(sets, rows, columns).astype(np.float64)
    union = lengths[rows][:, None] + lengths[columns][None, :] - shared
    near = (shared > 0) & (shared >= threshold * union - 1e-9)
    out = np.zeros((n, n), bool)
    out[rows, columns] = near
    out |= out.T
    np.fill_diagonal(out, False)
    return out


def leaders(near: np.ndarray) -> np.ndarray:
    """Smallest index that each index is connected to."""
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(near)).min(1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compared(size: int, threshold: float):
    def finish(rows: list[tuple]) -> list[tuple]:
        seen: dict[bytes, tuple] = {}
        for row in rows:
            seen.setdefault(row[1], row)
        members = sorted(seen.values(), key=lambda r: (r[0], r[1]))
        found, first = shingles(pa.array([m[2] for m in members], pa.large_string()), size)
        sets = [np.unique(found[first[i] : first[i + 1]]) for i in range(len(members))]
        sides = [m[0] for m in members]
        crossing = members[0][4]
        split = sides.count(sides[0]) if crossing else 0
        if crossing and split == len(members):
            return []
        near = linked(sets, split, threshold)
        copies = np.array([m[3] for m in members])
        lead = leaders(near)
        return [
            (m[1], int(near[i] @ copies), int(near[i].sum()), members[lead[i]][1])
            for i, m in enumerate(members)
            if near[i].any()
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("texts", pa.int64()), ("lead", pa.binary())])
        current, rows, out = None, [], []

        def flush():
            nonlocal out
            columns = list(zip(*out, strict=True)) or [[]] * 4
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema
            )
            out = []
            return made

        for batch in batches:
            columns = [batch.column(c) for c in ("root", "low", "high", "side", "key", "text", "copies")]
            for i in range(batch.num_rows):
                root, low, high, side, key, text, copies = (c[i].as_py() for c in columns)
                if (root, low, high) != current:
                    if rows:
                        out += finish(rows)
                    current, rows = (root, low, high), []
                    if len(out) > 10_000:
                        yield flush()
                rows.append((side, key, text, copies, low != high))
        if rows:
            out += finish(rows)
        yield flush()

    return run


# -- the join ----------------------------------------------------------------------


def similarity_classes(
    docs: DataFrame, threshold: float = 0.8, size: int = 5, target: float = 0.999, trees: int = TREES
) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, key) and nodes: one row per different text.

    Nodes have key, doc_id (the smallest of the text's copies), copies, links (documents with another
    text at or above the threshold), texts (different texts among them), class_key and class_id (the
    smallest key and identifier of the connected class).
    """
    keyed = with_key(docs)
    depth = depth_for(threshold, target, trees)
    marks = store(
        keyed.mapInArrow(
            _marked(size, depth, trees),
            keyed.select("doc_id", "key").schema.add("shingles", "long").add("buckets", T.ArrayType(T.LongType())),
        ),
        "marks",
    )
    nodes = marks.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("shingles").alias("shingles"), F.first("buckets").alias("buckets")
    )
    entries = nodes.select("key", F.explode("buckets").alias("bucket"))
    heads = entries.groupBy("bucket").agg(F.min("key").alias("head"), F.count("*").alias("n")).where("n > 1")
    candidates = entries.join(heads, "bucket").where("key <> head").select(F.col("key").alias("a"), F.col("head").alias("b"))
    groups = connected(candidates)
    nodes = marks.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("shingles").alias("shingles")
    )
    members = store(groups.withColumnRenamed("node", "key").join(nodes, "key"), "members")
    chunks = members.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / CHUNK_TEXTS, F.sum("shingles") / CHUNK_SHINGLES)).cast("int").alias("chunks")
    )
    dealt = store(
        members.join(chunks, "root").select(
            "root", "chunks", F.expr("pmod(xxhash64(key, 'chunk'), chunks)").cast("int").alias("side"), "key", "doc_id", "copies"
        ),
        "dealt",
    )
    texts = keyed.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "text")
    texts = texts.mapInArrow(_wanted(bitmap(dealt, _beginning("key"))), texts.schema)
    blocks = (
        dealt.join(texts, (F.col("k") == F.col("key")) & F.col("d").eqNullSafe(F.col("doc_id")))
        .select("root", "side", "key", "text", "copies", F.explode(F.expr("sequence(0, chunks - 1)")).alias("other"))
        .select("root", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "key", "text", "copies")
    )
    compared = store(
        blocks.repartition("root", "low", "high")
        .sortWithinPartitions("root", "low", "high", "side", "key")
        .mapInArrow(_compared(size, threshold), "key binary, links long, texts long, lead binary"),
        "compared",
    )
    classes = connected(compared.select(F.col("key").alias("a"), F.col("lead").alias("b")))
    links = compared.groupBy("key").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    found = members.select("key", "doc_id").join(links, "key").join(classes.withColumnRenamed("node", "key"), "key")
    ids = found.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    near = found.join(ids, "root").select("key", "links", "texts", F.col("root").alias("class_key"), "class_id")
    whole = nodes.join(near, "key", "left").select(
        "key",
        "doc_id",
        "copies",
        F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("texts", F.lit(0)).alias("texts"),
        F.coalesce("class_key", "key").alias("class_key"),
        F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
    )
    return marks.select("doc_id", "key"), store(whole, "nodes")


def similarity_join(docs: DataFrame, threshold: float = 0.8, size: int = 5, target: float = 0.999) -> DataFrame:
    """One row per document: its class, its number of links, and how many documents have its very text."""
    rows, nodes = similarity_classes(docs, threshold, size, target)
    return rows.join(nodes.drop("doc_id"), "key").select(
        "doc_id",
        "class_id",
        (F.col("copies") - 1 + F.col("links")).alias("n_links"),
        F.col("copies").alias("n_copies"),
        F.col("texts").alias("n_near_texts"),
    )


def keep_one(docs: DataFrame, threshold: float = 0.8, size: int = 5, target: float = 0.999) -> DataFrame:
    """One row of each class of near and exact copies: that with the smallest identifier (nulls last).

    Of rows equal in text and identifier the one that sorts first by all columns stays.
    """
    _, nodes = similarity_classes(docs, threshold, size, target)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    kept = nodes.groupBy("class_key").agg(F.min(order).alias("kept")).select(
        F.col("kept.doc_id").alias("kept_id"), F.col("kept.key").alias("kept_key")
    )
    columns = docs.columns
    rows = docs.withColumn("__key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    return (
        rows.join(kept, (F.col("__key") == F.col("kept_key")) & F.col("doc_id").eqNullSafe(F.col("kept_id")))
        .groupBy("kept_key", "kept_id")
        .agg(F.min(F.struct(*columns)).alias("row"))
        .select("row.*")
    )
