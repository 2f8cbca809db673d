"""Threshold-scaled sketches: every word-shingle hash below a fixed share of the hash range.

A sketch's size follows its text's, so the sketch of a part can be held against that of the whole:
containment and Jaccard are estimated from the retained hashes alone, and the sketch of several texts
together is the union of theirs.  A text of which no hash is low enough keeps its smallest one, so
that short texts stay comparable; `merge` drops such a hash again beside a low one, and so stays exact.

Defined cases: a null text counts as empty; a text without words has the empty sketch, whose
likeness to another is 1 if that is empty too, else 0; a text of fewer than `size` words has one
shingle; null identifiers order last; rows with one identifier order by a hash of their text.
"""

from __future__ import annotations

import binascii
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.text import SLICE_BYTES, shingles

#: One in FRACTION hashes is kept.
FRACTION = 4
SIZE = 5


def threshold(fraction: int = FRACTION) -> np.uint64:
    return np.uint64((1 << 64) // fraction)


def sketches(texts: list[str], fraction: int = FRACTION, size: int = SIZE) -> list[np.ndarray]:
    """The retained hashes of each text, ascending."""
    found, first = shingles(pa.array(texts, pa.large_string()), size)
    low = found < threshold(fraction)
    places = np.concatenate([[0], np.cumsum(low)])[first]
    kept = found[low]
    out = []
    for i in range(len(texts)):
        own = np.unique(kept[places[i] : places[i + 1]])
        if not len(own) and first[i + 1] > first[i]:
            own = found[first[i] : first[i + 1]].min(keepdims=True)
        out.append(own)
    return out


def merge(a: np.ndarray, b: np.ndarray, fraction: int = FRACTION) -> np.ndarray:
    """Sketch of two texts' shingles together."""
    both = np.union1d(a, b)
    low = both[both < threshold(fraction)]
    return low if len(low) else both[:1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the shingles."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def containment(part: np.ndarray, whole: np.ndarray) -> float:
    """Estimated share of the part's shingles that the whole has."""
    if not len(part):
        return 1.0
    return len(np.intersect1d(part, whole, assume_unique=True)) / len(part)


def to_string(sketch: np.ndarray) -> str:
    return binascii.b2a_base64(sketch.astype("<u8").tobytes(), newline=False).decode()


def from_string(text: str) -> np.ndarray:
    return np.frombuffer(binascii.a2b_base64(text), "<u8")


def fingerprints(docs: DataFrame, fraction: int = FRACTION, size: int = SIZE) -> DataFrame:
    """`docs` (doc_id, text) with the sketch of each text as a string, by text alone."""
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            own = [to_string(s) for s in sketches(texts, fraction, size)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own, pa.string())], names=["doc_id", "fingerprint"])

    return rows.mapInArrow(run, "doc_id long, fingerprint string")


# -- each document beside the next one -------------------------------------------------


def _part(splitters: np.ndarray):
    """Part of an identifier that is not null."""

    @F.pandas_udf("int")
    def part(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, doc_id.to_numpy("int64")).astype("int32"))

    return part


def _places(tops: np.ndarray, has_null: bool, null_tie: int | None):
    """Part of an identifier, and the part that needs the row after its own last one (or null).

    `tops` are the largest identifiers of the parts, as they stand in the table, ascending.
    """
    parts = len(tops)

    @F.pandas_udf("struct<part: int, tail: int>")
    def place(known: pd.Series, doc_id: pd.Series, tie: pd.Series) -> pd.DataFrame:
        null = ~known.to_numpy(bool)
        ids = doc_id.to_numpy("int64")
        part = np.searchsorted(tops, ids)
        top = tops[np.minimum(part, parts - 1)] == ids if parts else np.zeros(len(ids), bool)
        after = np.where(part + 1 < parts, part + 1, -1 if has_null else 0)
        tail = np.where(null, null_tie == tie.to_numpy(), top)
        after = np.where(null, 0 if parts else -1, after)
        return pd.DataFrame({"part": np.where(null, -1, part).astype("int32"), "tail": pd.Series(after).where(tail).astype("Int32")})

    return place


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows (part, is_tail, doc_id, tie, text), each part sorted so that a row's next document follows it.

    Identifiers descend; after the last document comes the first.  A part is a range of identifiers
    found by approximate quantiles, up to the largest identifier in it; the first row of each part is also sent to the part
    before it, as its tail, so that no text moves twice and no task holds more than some parts.
    """
    spark = docs.sparkSession
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", tie)
    facts = docs.agg(
        F.count("*").alias("n"), F.max("doc_id").alias("last"), F.count("doc_id").alias("known"), F.min(F.when(F.col("doc_id").isNull(), tie)).alias("tie")
    ).first()
    parts = max(1, min(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), facts["known"] // 16))
    splitters = np.zeros(0, np.int64)
    if facts["known"]:
        asked = [i / parts for i in range(1, parts)]
        found = docs.stat.approxQuantile("doc_id", asked, 0.2 / parts) if asked else []
        # quantiles are doubles, which need not be identifiers of the table: each part's largest one is looked up
        splitters = np.unique(np.array([*(min(int(x), facts["last"]) for x in found), facts["last"]], np.int64))
        known = docs.where("doc_id IS NOT NULL").select("doc_id")
        largest = known.groupBy(_part(splitters)("doc_id").alias("part")).agg(F.max("doc_id").alias("top")).collect()
        splitters = np.array(sorted(r["top"] for r in largest), np.int64)
    has_null = facts["known"] < facts["n"]
    # a column with nulls reaches pandas as doubles, so nulls go as a flag of their own
    place = _places(splitters, has_null, facts["tie"])
    placed = rows.withColumn("at", place(F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(0).cast("long")), "tie"))
    spread = placed.withColumn(
        "to",
        F.explode(
            F.when(F.col("at.tail").isNull(), F.array(F.struct(F.col("at.part").alias("part"), F.lit(False).alias("is_tail")))).otherwise(
                F.array(
                    F.struct(F.col("at.part").alias("part"), F.lit(False).alias("is_tail")),
                    F.struct(F.col("at.tail").alias("part"), F.lit(True).alias("is_tail")),
                )
            )
        ),
    ).select("to.part", "to.is_tail", "doc_id", "tie", "text")
    return spread.repartition("part").sortWithinPartitions("part", "is_tail", F.desc_nulls_last("doc_id"), "tie", "text")


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the following text as there is."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _compared(fraction: int, size: int):
    def finish(rows: list[tuple], following: str) -> pa.RecordBatch:
        """Results of rows (doc_id, text), the last of which is followed by `following`."""
        texts = [t for _, t in rows]
        changed = [edited(t, n) for t, n in zip(texts, [*texts[1:], following], strict=True)]
        found = sketches([*texts, following, *changed], fraction, size)
        own, other = found[: len(texts) + 1], found[len(texts) + 1 :]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([d for d, _ in rows], pa.int64()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
                "fingerprint": pa.array([to_string(s) for s in own[:-1]], pa.string()),
                "edited_fingerprint": pa.array([to_string(s) for s in other], pa.string()),
                "near_edited": pa.array([likeness(a, b) for a, b in zip(own, other, strict=False)], pa.float64()),
                "near_next": pa.array([likeness(a, b) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
            }
        )

    def ended(part: int | None, held: list, done: bool) -> None:
        if held and not done:
            raise RuntimeError(f"part {part} ended without the document after its last one")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, total, done = None, [], 0, False
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "is_tail", "doc_id", "text"))
            for here, is_tail, doc_id, text in zip(*columns, strict=True):
                if here != part:
                    ended(part, held, done)
                    part, held, total, done = here, [], 0, False
                if done:  # the tail's other copies
                    continue
                if is_tail:
                    done = True
                    if held:
                        yield finish(held, text)
                    continue
                if total > SLICE_BYTES:
                    yield finish(held, text)
                    held, total = [], 0
                held.append((doc_id, text))
                total += len(text)
        ended(part, held, done)

    return run


def edited_likeness(docs: DataFrame, fraction: int = FRACTION, size: int = SIZE) -> DataFrame:
    """Each document's sketch, that of its edited text, and their likeness to each other and to the next's."""
    rows = neighbours(docs).select("part", "is_tail", "doc_id", "text")
    return rows.mapInArrow(_compared(fraction, size), SCHEMA)
